"""Row filters and projections over an edge table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeline.functions.expressions import both_directions
from edgeline.runtime import materialize

# Agents whose rows link entities to annotations rather than to each other.
ANNOTATING_AGENTS = ("graph_topology", "ml_clustering", "statistical_analysis")
HIGH_CONFIDENCE = 0.8


def min_confidence(df: DataFrame, threshold: float) -> DataFrame:
    """Confidence floor that keeps rows of unknown confidence."""
    score = F.col("confidence")
    return df.filter(score.isNull() | (score >= threshold))


def high_confidence(df: DataFrame, threshold: float = HIGH_CONFIDENCE) -> DataFrame:
    """Confidence floor that drops rows of unknown confidence."""
    return df.filter(F.col("confidence") >= threshold)


def exclude_agents(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop rows of the named agents. Rows without an agent go too, unless no name is given."""
    return df.filter(~F.col("source_agent").isin(list(names))) if names else df


def with_endpoints(df: DataFrame) -> DataFrame:
    return df.filter(F.col("subject_id").isNotNull() & F.col("object_id").isNotNull())


def structural_edges(
    df: DataFrame, threshold: float = 0.0, excluded: Sequence[str] = ANNOTATING_AGENTS, with_score: bool = False
) -> DataFrame:
    """The rows algorithms run on, narrowed to the columns they read."""
    columns = ["subject_id", "subject_type", "object_id", "object_type"]
    if with_score:
        columns.append("confidence")
    kept = with_endpoints(exclude_agents(min_confidence(df, threshold), excluded))
    return kept.select(*columns)


def require_edges(df: DataFrame) -> tuple[DataFrame, int]:
    """Write the edges once for the passes to come; an empty graph is an error. Also returns the row count."""
    written, seen = materialize(df)
    if not seen["rows"]:
        raise ValueError("the structural graph has no edges: build or load triplets first")
    return written, seen["rows"]


def simple_edges(df: DataFrame) -> DataFrame:
    """Distinct directed (src, dst) pairs without self-loops."""
    pairs = df.select(F.col("subject_id").alias("src"), F.col("object_id").alias("dst"))
    return pairs.filter(F.col("src") != F.col("dst")).distinct()


def undirected(df: DataFrame) -> DataFrame:
    """Distinct (src, dst) pairs in both directions, self-loops kept."""
    return df.select(both_directions(F.col("subject_id"), F.col("object_id"))).distinct()


def with_predicate(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("predicate") == name)


def edges_between_types(enriched: DataFrame, source_type: str, dest_type: str) -> DataFrame:
    return enriched.filter((F.col("source_type") == source_type) & (F.col("dest_type") == dest_type))


def edges_of(df: DataFrame, entity: str) -> DataFrame:
    """Rows with the entity at either end."""
    return df.filter((F.col("subject_id") == entity) | (F.col("object_id") == entity))


def by_provenance(df: DataFrame, agent: str | None = None, method: str | None = None) -> DataFrame:
    """Row count and mean confidence per producing agent and method, optionally for one of them."""
    if agent is not None:
        df = df.filter(F.col("source_agent") == agent)
    if method is not None:
        df = df.filter(F.col("source_method") == method)
    return df.groupBy("source_agent", "source_method").agg(
        F.count(F.lit(1)).alias("n_edges"), F.avg("confidence").alias("avg_confidence")
    )


def find_entities(nodes: DataFrame, id_like: str | None = None, entity_type: str | None = None) -> DataFrame:
    """Nodes whose id matches a LIKE pattern and/or whose type is given."""
    if id_like is not None:
        nodes = nodes.filter(F.col("id").like(id_like))
    if entity_type is not None:
        nodes = nodes.filter(F.col("type") == entity_type)
    return nodes
