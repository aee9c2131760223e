"""Session defaults, lineage cuts, size-checked broadcasts and hot-key slicing."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes a written join side may have before it is broadcast.
BROADCAST_BYTES = 64_000_000
# A key with more rows than this is spread over several slices.
SLICE_ROWS = 4_000_000

# Adaptive execution splits skewed shuffle partitions of one-off joins.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(app: str = "edgeline", **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder shared by all executors that the session names."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    """A fresh path in the shared checkpoint folder, under this application's own subfolder."""
    app = spark.sparkContext.applicationId
    return f"{ensure_checkpoint_dir(spark)}/edgeline-{app}/{name}-{uuid.uuid4().hex}"


def row_bytes(schema: T.StructType) -> Column:
    """About how many bytes a row holds: texts by their length, nested values by their number of elements."""
    total = F.lit(16 * len(schema))
    for field in schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            size = F.octet_length(column)
        elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
            size = F.octet_length(F.array_join(column, "")) + 24 * F.size(column)
        elif isinstance(kind, (T.ArrayType, T.MapType)):
            size = (64 if isinstance(kind, T.MapType) or isinstance(kind.elementType, T.StructType) else 8) * F.size(column)
        else:
            continue
        total = total + F.coalesce(size, F.lit(0))
    return total.cast("long")


def materialize(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """Write `df` once as a table in the checkpoint folder, cutting its lineage.

    Returns the written table and the metrics observed during that same job; `rows`
    and `bytes` are always among them. A table rather than an RDD checkpoint, because its
    size is then known to the planner and no constraints of the old plan are carried along,
    which would slow planning down more with every round.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    seen = Observation()
    columns = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0)).alias("bytes")]
    columns += [c.alias(name) for name, c in metrics.items()]
    df.observe(seen, *columns).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get


def broadcast_if_small(df: DataFrame, size: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only behind a byte size already taken; otherwise a shuffle join."""
    return F.broadcast(df) if size <= limit else df


def hot_keys(df: DataFrame, key: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(key, n_slices) for keys holding more than `slice_rows` rows: at most one row per `slice_rows` rows of `df`."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > slice_rows) & F.col(key).isNotNull())
        .select(key, F.ceil(F.col("n") / F.lit(slice_rows)).cast("int").alias("n_slices"))
    )


def slice_rows_of(df: DataFrame, hot: DataFrame, key: str, by: Column) -> DataFrame:
    """Add `slice`: rows of a hot key are spread by the hash of `by`, all others get 0.

    `hot` comes from `hot_keys` and has a row for every `slice_rows` rows at most; whether
    it is broadcast is left to its measured size.
    """
    spread = F.pmod(F.xxhash64(by), F.coalesce(F.col("n_slices"), F.lit(1))).cast("int")
    return df.join(hot, key, "left").withColumn("slice", spread).drop("n_slices")


def replicate_over_slices(df: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Copy each row once per slice of its key, so it meets every slice of the sliced side."""
    copies = F.sequence(F.lit(0), F.coalesce(F.col("n_slices"), F.lit(1)) - 1)
    return df.join(hot, key, "left").withColumn("slice", F.explode(copies)).drop("n_slices")


def lookup(
    df: DataFrame, key: str, table: DataFrame, by: Column, rows: int | None = None, how: str = "left", keys: DataFrame | None = None
) -> DataFrame:
    """Join `table` (one row per `key`) to `df`, whose rows may pile up on a few keys.

    Hot keys are spread over slices by the hash of `by` and their table row is copied
    to each slice. With `rows` known to be small no key can be hot: a plain join. Else
    `df` is written first, so counting its keys does not work it out a second time; or they
    are counted in `keys`, a table already written whose rows those of `df` were made from.
    """
    if rows is None or (rows > SLICE_ROWS and keys is None):
        df, seen = materialize(df)
        rows = seen["rows"]
    if rows <= SLICE_ROWS:
        return df.join(table, key, how)
    hot, seen = materialize(hot_keys(df if keys is None else keys, key))
    if not seen["rows"]:
        return df.join(table, key, how)
    left = slice_rows_of(df, hot, key, by)
    right = replicate_over_slices(table, hot, key)
    return left.join(right, [key, "slice"], how).drop("slice")


def dense_index(df: DataFrame, order_by: str, name: str) -> tuple[DataFrame, int]:
    """Add `name` = 0, 1, 2, ... in the order of a unique column, without a one-task window.

    The sorted rows are written once; the row number inside a partition is the low
    part of the monotonic id, and the partition offsets are a prefix sum over one
    row per partition. Also returns the number of rows.
    """
    in_partition_bits = 33
    ordered, seen = materialize(
        df.orderBy(order_by).withColumn("__mid", F.monotonically_increasing_id())
    )
    part = F.shiftright("__mid", in_partition_bits)
    sizes = ordered.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition of the written table: one ordered running sum over a small table.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets, _ = materialize(sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")))
    low = F.col("__mid").bitwiseAND(F.lit((1 << in_partition_bits) - 1))
    numbered = (
        ordered.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__offset") + low)
        .drop("__mid", "__part", "__offset")
    )
    return numbered, seen["rows"]
