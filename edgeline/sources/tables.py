"""Reading graphs and writing results."""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from edgeline.operators.views import check_triplets
from edgeline.schema import Graph, GraphColumns, conform_triplets


def _is_path(ref: str) -> bool:
    return "/" in ref


# The file in a published folder that names its current version.
POINTER = "_current"


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, target: str) -> str | None:
    """The folder of a published path that holds its current rows; None where nothing was published."""
    place, files = _path(spark, f"{target}/{POINTER}")
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        name = bytes(b & 0xFF for b in stream.readAllBytes()).decode()
    finally:
        stream.close()
    return f"{target}/{name}"


def read_table(spark: SparkSession, ref: str, format: str = "parquet") -> DataFrame:
    """A catalog table by qualified name, or files when `ref` is a path; of a published path its current version."""
    if not _is_path(ref):
        return spark.table(ref)
    return spark.read.format(format).load(current_version(spark, ref) or ref)


def load_graph(
    spark: SparkSession, edges: str, nodes: str | None = None, cols: GraphColumns = GraphColumns()
) -> Graph:
    return Graph(read_table(spark, edges), read_table(spark, nodes) if nodes else None, cols)


def _write(df: DataFrame, target: str, mode: str, partition_by) -> None:
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if _is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)


def write_result(df: DataFrame, target: str, partition_by=(), keep: int = 2) -> None:
    """Publish `df` as the new version of the target; its schema may change.

    Every version is a folder (or table) of its own that never changes once written. The
    target is a pointer to one of them: a small file that is replaced in one step, or a
    view. `read_table` follows it, so a reader finds the old rows or the new ones, always
    whole, and one that has begun goes on reading the version it found. The `keep` newest
    versions stay, the older ones go. A failed write publishes nothing.
    """
    spark = df.sparkSession
    version = f"v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    if _is_path(target):
        _write(df, f"{target}/{version}", "errorifexists", partition_by)
        _point(spark, target, version)
        _forget(spark, target, keep)
        return
    _write(df, f"{target}_{version}", "errorifexists", partition_by)
    known = spark.catalog.tableExists(target)
    if known and spark.catalog.getTable(target).tableType != "VIEW":
        # A table from before versions: it becomes the oldest one.
        spark.sql(f"ALTER TABLE {target} RENAME TO {target}_v{0:020d}_{uuid.uuid4().hex[:8]}")
    spark.sql(f"CREATE OR REPLACE VIEW {target} AS SELECT * FROM {target}_{version}")
    own = target.split(".")
    listed = spark.catalog.listTables(".".join(own[:-1]) or None, f"{own[-1]}_v*")
    names = sorted(t.name for t in listed if re.fullmatch(rf"{re.escape(own[-1])}_v\d{{20}}_[0-9a-f]{{8}}", t.name, re.I))
    for name in names[:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {'.'.join([*own[:-1], name])}")


def _point(spark: SparkSession, target: str, version: str) -> None:
    """Replace the pointer in one step: written beside it, then renamed over it."""
    fresh, files = _path(spark, f"{target}/_{uuid.uuid4().hex}")
    stream = files.create(fresh, False)
    stream.write(bytearray(version.encode()))
    stream.close()
    place, _ = _path(spark, f"{target}/{POINTER}")
    fs = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(fresh.toUri(), spark._jsc.hadoopConfiguration()).rename(files.makeQualified(fresh), files.makeQualified(place), options)


def _forget(spark: SparkSession, target: str, keep: int) -> None:
    place, files = _path(spark, target)
    names = sorted(f.getPath().getName() for f in files.listStatus(place) if f.isDirectory())
    versions = [name for name in names if re.fullmatch(r"v\d{20}_[0-9a-f]{8}", name)]
    for name in versions[:-keep]:
        files.delete(_path(spark, f"{target}/{name}")[0], True)


def append_triplets(df: DataFrame, target: str, partition_by=()) -> None:
    """Conform, check the required keys and the confidence range, then append."""
    rows = conform_triplets(df)
    broken = {r["rule"]: r["n_bad"] for r in check_triplets(rows).collect() if r["n_bad"]}
    if broken:
        raise ValueError(f"triplets break the contract: {broken}")
    _write(rows, target, "append", partition_by)
