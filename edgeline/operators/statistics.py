"""Counts and distributions over edges and source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeline.functions.expressions import both_directions, confidence_bucket
from edgeline.operators.filters import edges_of, high_confidence


def _count():
    return F.count(F.lit(1))


def two_way_adjacency(edges: DataFrame) -> DataFrame:
    """Distinct (src, dst), every edge in both directions, self-loops dropped."""
    return edges.select(both_directions(F.col("src"), F.col("dst"))).where("src <> dst").distinct()


def undirected_pairs(edges: DataFrame) -> DataFrame:
    """Distinct unordered pairs (a, b): the half of the two-way adjacency that goes upwards."""
    return two_way_adjacency(edges).filter("src < dst").toDF("a", "b")


def undirected_degree(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """Number of distinct neighbours; with `vertices`, isolated ones count 0."""
    degree = two_way_adjacency(edges).groupBy(F.col("src").alias("id")).agg(F.count("dst").alias("degree"))
    if vertices is None:
        return degree
    return vertices.select("id").join(degree, "id", "left").select(
        "id", F.coalesce("degree", F.lit(0)).alias("degree")
    )


def entity_types(df: DataFrame) -> DataFrame:
    """One row per entity with its largest type name."""
    return (
        df.select(
            F.inline(
                F.array(
                    F.struct(F.col("subject_id").alias("id"), F.col("subject_type").alias("entity_type")),
                    F.struct(F.col("object_id").alias("id"), F.col("object_type").alias("entity_type")),
                )
            )
        )
        # Counted first, by hash, which leaves few rows: for the largest text Spark has to sort.
        .groupBy("id", "entity_type")
        .agg(_count().alias("n"))
        .groupBy("id")
        .agg(F.max(F.when(F.col("n") > 0, F.col("entity_type"))).alias("entity_type"))
    )


def _count_and_confidence(df: DataFrame, key: str) -> DataFrame:
    return (
        df.groupBy(key)
        .agg(_count().alias("count"), F.avg("confidence").alias("avg_confidence"))
        .orderBy(F.desc("count"), F.asc_nulls_last(key))
    )


def predicate_stats(df: DataFrame) -> DataFrame:
    return _count_and_confidence(df, "predicate")


def type_stats(df: DataFrame) -> DataFrame:
    return _count_and_confidence(df, "subject_type")


def confidence_histogram(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(confidence_bucket(F.col("confidence")).alias("confidence_bucket"))
        .agg(_count().alias("count"))
        .orderBy("confidence_bucket")
    )


def build_summary(df: DataFrame) -> DataFrame:
    """Totals and mean confidence overall and per agent, method and predicate, in one pass."""
    columns = ["source_agent", "source_method", "predicate"]
    grouped = df.groupingSets([[c] for c in columns] + [[]], *columns).agg(
        _count().alias("n"),
        F.avg("confidence").alias("avg_confidence"),
        F.grouping_id().alias("gid"),
    )
    # A column takes part in its set when its grouping bit is 0.
    names = {0b011: "source_agent", 0b101: "source_method", 0b110: "predicate"}
    dimension = F.lit("total")
    value = F.lit(None).cast("string")
    for gid, name in names.items():
        dimension = F.when(F.col("gid") == gid, name).otherwise(dimension)
        value = F.when(F.col("gid") == gid, F.col(name)).otherwise(value)
    return grouped.select(dimension.alias("dimension"), value.alias("value"), "n", "avg_confidence")


def amount_stats(df: DataFrame, flag: str, amount: str) -> DataFrame:
    return df.groupBy(flag).agg(
        _count().alias("count"), F.avg(amount).alias("avg_amount"), F.max(amount).alias("max_amount")
    )


def shared_attributes(df: DataFrame, keys: list[str]) -> DataFrame:
    """Attribute tuples carried by more than one row."""
    return df.groupBy(*keys).agg(_count().alias("n_entities")).filter(F.col("n_entities") > 1)


def shared_values(df: DataFrame, value: str, entity: str) -> DataFrame:
    """Attribute values carried by more than one distinct entity."""
    return (
        df.select(value, entity)
        .distinct()
        .groupBy(value)
        .agg(F.count(entity).alias("n_entities"))
        .filter(F.col("n_entities") > 1)
    )


def frequency(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(_count().alias("count")).orderBy(F.desc("count"), F.asc_nulls_last(column))


def entity_relations(df: DataFrame, entity: str) -> DataFrame:
    """Relationships of one entity counted per predicate."""
    return (
        edges_of(df, entity)
        .groupBy("predicate")
        .agg(_count().alias("n_edges"))
        .orderBy(F.desc("n_edges"), "predicate")
    )


def entity_profile(df: DataFrame, entity: str, threshold: float = 0.8) -> DataFrame:
    """Confident relationships of one entity per predicate, with mean confidence."""
    return (
        high_confidence(edges_of(df, entity), threshold)
        .groupBy("predicate")
        .agg(_count().alias("n_edges"), F.avg("confidence").alias("avg_confidence"))
        .orderBy(F.desc("n_edges"), "predicate")
    )


def bfs_layers(distances: DataFrame) -> DataFrame:
    return distances.groupBy("distance").agg(_count().alias("n_entities")).orderBy("distance")
