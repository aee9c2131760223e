import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from edgeline.schema import conform_triplets  # noqa: E402

SF = "/root/testdata/sf0.001"

HAND_ROWS = [
    ("a", "P", "KNOWS", "b", "P", 1.0, "relationship"),
    ("a", "P", "KNOWS", "b", "P", 0.4, "relationship"),
    ("a", "P", "OWNS", "x", "A", 0.9, "relationship"),
    ("b", "P", "OWNS", "x", "A", None, "llm_semantic"),
    ("b", "P", "KNOWS", "c", "P", 0.7, "relationship"),
    ("c", "P", "KNOWS", "a", "P", 0.5, None),
    ("c", "P", "SELF", "c", "P", 0.8, "relationship"),
    ("c", "P", "KNOWS", "d", "P", 0.29, "relationship"),
    ("d", "P", "IN_GROUP", "g1", "Cluster", 0.6, "ml_clustering"),
    ("m", "P", "KNOWS", "n", "Q", 1.0, "relationship"),
    ("n", "P", "KNOWS", "m", "P", 0.0, "relationship"),
]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="edgeline-tests-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="edgeline-warehouse-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def hand(spark):
    """Eleven edges: unknown scores and agents, a self-loop, parallel edges, two components."""
    columns = (
        "subject_id string, subject_type string, predicate string, object_id string, object_type string, "
        "confidence double, source_agent string, source_method string"
    )
    rows = [(*r, "test") for r in HAND_ROWS]
    return conform_triplets(spark.createDataFrame(rows, columns)).persist()


def tuples(df):
    return [tuple(r) for r in df.collect()]
