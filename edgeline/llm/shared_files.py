"""Files that every executor needs: written to the shared checkpoint folder and handed out by Spark."""

from __future__ import annotations

import hashlib
import io
import os
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from edgeline.runtime import scratch_path


def write_shared(spark: SparkSession, name: str, data: bytes) -> str:
    """Write a small file beside this application's tables; returns its path for Spark."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{os.path.dirname(scratch_path(spark))}/{name}")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    stream.write(data)
    stream.close()
    return path.toString()


def is_shared(spark: SparkSession, name: str) -> bool:
    return any(f.endswith(f"/{name}") for f in spark.sparkContext.listFiles)


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they were started."""
    package = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.writestr(zipfile.ZipInfo(str(file.relative_to(package.parent))), file.read_bytes())
    name = f"edgeline-{hashlib.sha256(packed.getvalue()).hexdigest()[:16]}.zip"
    if not is_shared(spark, name):
        spark.sparkContext.addPyFile(write_shared(spark, name, packed.getvalue()))
