"""Picking up triplets as they arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from edgeline.schema import TRIPLET_SCHEMA, conform_triplets


def new_triplets(df: DataFrame, since: Column) -> DataFrame:
    """Rows written after the high-water mark."""
    return df.filter(F.col("created_at") > since)


def high_water_mark(df: DataFrame) -> DataFrame:
    """One row: the latest write time, the mark for the next read."""
    return df.agg(F.max("created_at").alias("next_since"))


def _keyed(df: DataFrame) -> DataFrame:
    """Add a key of 16 bytes that equal rows share."""
    columns = [F.col(name) for name in TRIPLET_SCHEMA.fieldNames()]
    # Nulls are told apart from nothing by their place.
    packed = F.struct(*columns, *(c.isNull() for c in columns))
    return df.withColumns({"k1": F.xxhash64(packed), "k2": F.xxhash64(F.lit(1), packed)})


KEYS = ["k1", "k2"]


def stream_triplets(
    spark: SparkSession, source: str, target: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Append conformed triplets from a folder of Parquet files, dropping repeats.

    A repeat is a row equal in every column to one that came before, however late it comes;
    rows without a time are compared like others. The keys that were seen are the query's
    own state, 16 bytes a row, kept in the checkpoint and dealt by key, so that a batch does
    not read the target. Set `spark.sql.streaming.stateStore.providerClass` to the RocksDB
    provider where they outgrow memory. Of a target that was there before the query's first
    start, the keys are written once beside the checkpoint and met by every batch. A batch
    that was begun before and is run again, after a failure, is the only one that is
    compared with the target, where its rows may be already.
    """
    known = f"{checkpoint}/known_before"
    # Spark writes the query's metadata when it starts for the first time.
    if not _exists(spark, f"{checkpoint}/metadata") and _exists(spark, target):
        before = _keyed(spark.read.schema(TRIPLET_SCHEMA).parquet(target)).select(*KEYS)
        before.distinct().write.mode("overwrite").parquet(known)

    def add(batch: DataFrame, number: int) -> None:
        fresh = batch
        if _exists(spark, known):
            fresh = fresh.join(spark.read.parquet(known), KEYS, "left_anti")
        mark = f"{checkpoint}/begun/{number}"
        if _exists(spark, mark) and _exists(spark, target):
            written = _keyed(spark.read.schema(TRIPLET_SCHEMA).parquet(target)).select(*KEYS)
            fresh = fresh.join(written, KEYS, "left_anti")
        _touch(spark, mark)
        fresh.drop(*KEYS).write.mode("append").parquet(target)

    arriving = conform_triplets(spark.readStream.schema(TRIPLET_SCHEMA).parquet(source))
    first_seen = _keyed(arriving).dropDuplicates(KEYS)
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return first_seen.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _file(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    place, files = _file(spark, path)
    return files.exists(place)


def _touch(spark: SparkSession, path: str) -> None:
    place, files = _file(spark, path)
    files.create(place, True).close()
