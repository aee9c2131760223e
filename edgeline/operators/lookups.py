"""Ranked and keyed reads over degrees and the two result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_central_entities(centrality: DataFrame, n: int) -> DataFrame:
    """The n entities of highest PageRank."""
    return (
        centrality.select("entity_id", "entity_type", "pagerank", "degree", "betweenness")
        .orderBy(F.desc_nulls_last("pagerank"), "entity_id")
        .limit(max(0, n))
    )


def top_hubs(degree: DataFrame, n: int = 10) -> DataFrame:
    return (
        degree.select("id", "in_degree", "out_degree", "total_degree")
        .orderBy(F.desc("total_degree"), "id")
        .limit(n)
    )


def isolated(degree: DataFrame) -> DataFrame:
    return degree.filter(F.col("total_degree") == 0)


def nearest(distances: DataFrame, n: int = 50) -> DataFrame:
    return distances.orderBy("distance", "id").limit(n)


def sample_rows(df: DataFrame, n: int = 50) -> DataFrame:
    """A repeatable handful of rows: the first n in column order."""
    return df.orderBy(*df.columns).limit(n)


def cluster_of(communities: DataFrame, entity: str) -> DataFrame:
    """One row: the community of an entity, NULL when unknown."""
    return (
        communities.filter(F.col("entity_id") == entity)
        .agg(F.min("community_id").alias("community_id"))
    )


def cluster_of_many(communities: DataFrame, ids: DataFrame) -> DataFrame:
    """(entity_id, community_id) for a table of ids; unknown ids keep a NULL."""
    return ids.select("entity_id").join(communities.select("entity_id", "community_id"), "entity_id", "left")


def members_of_cluster(communities: DataFrame, community_id: int) -> DataFrame:
    return (
        communities.filter(F.col("community_id") == community_id)
        .select("entity_id", "entity_type", "community_size")
        .orderBy("entity_id")
    )


def shared_community(communities: DataFrame, a: str, b: str) -> DataFrame:
    """One row comparing the communities of two entities."""
    # Lookups by key give one row per entity; the anchor keeps the answer when both miss.
    anchor = communities.sparkSession.range(1).select(F.lit(a).alias("entity_a"), F.lit(b).alias("entity_b"))
    left = communities.filter(F.col("entity_id") == a).select(
        F.col("entity_id").alias("entity_a"),
        F.col("community_id").alias("community_a"),
        F.col("community_size").alias("size_a"),
    )
    right = communities.filter(F.col("entity_id") == b).select(
        F.col("entity_id").alias("entity_b"), F.col("community_id").alias("community_b")
    )
    same = F.col("community_a") == F.col("community_b")
    return (
        anchor.join(left, "entity_a", "left")
        .join(right, "entity_b", "left")
        .select(
            "entity_a",
            "entity_b",
            "community_a",
            "community_b",
            (F.col("community_a").isNotNull() & same).alias("same_community"),
            F.when(same, F.col("size_a")).alias("community_size"),
        )
    )


def community_sizes(communities: DataFrame) -> DataFrame:
    return communities.groupBy("community_id").agg(F.count(F.lit(1)).alias("community_size"))


def with_community_size(communities: DataFrame) -> DataFrame:
    """Attach to each member the size of its community."""
    return communities.join(community_sizes(communities), "community_id", "left")


def largest_communities(communities: DataFrame, n: int = 10) -> DataFrame:
    return (
        communities.groupBy("community_id")
        .agg(F.max("community_size").alias("community_size"), F.count(F.lit(1)).alias("n_members"))
        .orderBy(F.desc_nulls_last("community_size"), "community_id")
        .limit(n)
    )


def component_summary(components: DataFrame) -> DataFrame:
    """Number of components, size of the largest and its share of all vertices."""
    return (
        components.groupBy("component_id")
        .agg(F.count(F.lit(1)).alias("size"))
        .agg(
            F.count(F.lit(1)).alias("n_components"),
            F.max("size").alias("giant_size"),
            (F.max("size") / F.sum("size")).alias("giant_share"),
        )
    )
