"""Table contracts and the `Graph` handle every operator accepts.

A graph is one edge table, one row per directed, typed, scored relationship.
Anything with a source and a destination column qualifies; `GraphColumns`
says which columns play which role.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and types of the exchanged tables.
TRIPLET_SCHEMA = T.StructType(
    [
        T.StructField("subject_id", T.StringType(), False),
        T.StructField("subject_type", T.StringType()),
        T.StructField("predicate", T.StringType(), False),
        T.StructField("object_id", T.StringType(), False),
        T.StructField("object_type", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("source_agent", T.StringType()),
        T.StructField("source_method", T.StringType()),
        T.StructField("properties", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)
REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("dataset_key", T.StringType(), False),
        T.StructField("display_name", T.StringType()),
        T.StructField("triplet_table", T.StringType(), False),
        T.StructField("description", T.StringType()),
        T.StructField("sample_prompts", T.ArrayType(T.StringType())),
        T.StructField("owner", T.StringType()),
        T.StructField("agent_endpoint", T.StringType()),
        T.StructField("enabled", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
CENTRALITY_SCHEMA = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("entity_type", T.StringType()),
        T.StructField("pagerank", T.DoubleType()),
        T.StructField("degree", T.LongType()),
        T.StructField("betweenness", T.DoubleType()),
    ]
)
COMMUNITIES_SCHEMA = T.StructType(
    [
        T.StructField("entity_id", T.StringType()),
        T.StructField("entity_type", T.StringType()),
        T.StructField("community_id", T.LongType()),
        T.StructField("community_size", T.LongType()),
        T.StructField("component_id", T.LongType()),
    ]
)
OPTIONAL_TRIPLET_COLUMNS = ("properties", "created_at")


def require_columns(df: DataFrame, names, what: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing column(s) {missing}; found {df.columns}")


def conform(df: DataFrame, schema: T.StructType, optional=()) -> DataFrame:
    """Project `df` onto `schema` by name, casting; absent optional columns become NULL."""
    require_columns(df, [f.name for f in schema if f.name not in optional], "conform")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def conform_triplets(df: DataFrame) -> DataFrame:
    return conform(df, TRIPLET_SCHEMA, OPTIONAL_TRIPLET_COLUMNS)


def conform_registry(df: DataFrame) -> DataFrame:
    return conform(df, REGISTRY_SCHEMA)


def empty_results(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Both result tables with no rows, so lookups work before the first batch run."""
    return (
        spark.createDataFrame([], CENTRALITY_SCHEMA),
        spark.createDataFrame([], COMMUNITIES_SCHEMA),
    )


@dataclass(frozen=True)
class GraphColumns:
    src: str = "subject_id"
    dst: str = "object_id"
    label: str | None = "predicate"
    src_type: str | None = "subject_type"
    dst_type: str | None = "object_type"
    node_id: str = "id"


class Graph:
    """An edge table, optionally a node table, and the column mapping.

    Source and destination columns must exist. A missing label or type column
    only narrows what the operators can return, so it warns.
    """

    def __init__(self, edges: DataFrame, nodes: DataFrame | None = None, cols: GraphColumns = GraphColumns()):
        require_columns(edges, [cols.src, cols.dst], "edges")
        optional = ["label"]
        if nodes is None:
            optional += ["src_type", "dst_type"]
        else:
            require_columns(nodes, [cols.node_id], "nodes")
        for role in optional:
            name = getattr(cols, role)
            if name and name not in edges.columns:
                warnings.warn(f"edges: no {role} column '{name}', continuing without it", stacklevel=2)
                cols = replace(cols, **{role: None})
        self.edges = edges
        self.nodes = nodes
        self.cols = cols

    @property
    def src(self):
        return self.edges[self.cols.src]

    @property
    def dst(self):
        return self.edges[self.cols.dst]
