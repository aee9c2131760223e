"""Deduplicating, scoring and checking triplets before they are published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeline.schema import TRIPLET_SCHEMA, conform

# Fixed value: confidence below which a validated triplet is dropped.
MIN_CONFIDENCE = 0.3


def with_counts(properties: Column, *counts: str) -> Column:
    """A JSON object with the counts added to what it holds; anything else gives way to the counts."""
    added = F.to_json(F.struct(*counts))
    inside = F.regexp_extract(F.trim(properties), r"(?s)^\{(.*)\}$", 1)
    return F.when(F.trim(inside) == "", added).otherwise(
        F.coalesce(F.concat(F.lit("{"), inside, F.lit(","), F.substr(added, F.lit(2))), added)
    )


def validate_triplets(df: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """One row per (subject, predicate, object): the most confident one, raised by agreement.

    The best confidence c of n agreeing agents becomes 1 - (1 - c) / 2^(n - 1): each
    further agent halves the remaining doubt. Everything else, properties included, is
    that row's own, with n_agents and n_rows added; equal confidence is decided by the
    later agent, then method, in text order. Unknown confidence stays unknown and is kept;
    the rest must reach `min_confidence`. Rows are first reduced per agent, so repeats of
    one statement never meet in one group.
    """
    key = ["subject_id", "predicate", "object_id"]
    order = ["confidence", "source_agent", "source_method", "subject_type", "object_type", "properties", "created_at"]
    full = df if "properties" in df.columns else df.withColumn("properties", F.lit(None).cast("string"))
    row = F.struct(*order)
    per_agent = full.groupBy(*key, "source_agent").agg(F.max(row).alias("best"), F.count(F.lit(1)).alias("n"))
    merged = per_agent.groupBy(*key).agg(
        F.max("best").alias("best"), F.count("source_agent").alias("n_agents"), F.sum("n").alias("n_rows")
    )
    flat = merged.select(*key, "best.*", "n_agents", "n_rows")
    doubt = (1 - F.col("confidence")) / F.pow(F.lit(2.0), F.greatest(F.col("n_agents") - 1, F.lit(0)))
    scored = flat.withColumns(
        {"confidence": 1 - doubt, "properties": with_counts(F.col("properties"), "n_agents", "n_rows")}
    )
    kept = scored.filter(F.col("confidence").isNull() | (F.col("confidence") >= min_confidence))
    return conform(kept, TRIPLET_SCHEMA)


def type_conflicts(df: DataFrame) -> DataFrame:
    """Entities seen with more than one type name: (id, n_types)."""
    return (
        df.select(
            F.inline(
                F.array(
                    F.struct(F.col("subject_id").alias("id"), F.col("subject_type").alias("type")),
                    F.struct(F.col("object_id").alias("id"), F.col("object_type").alias("type")),
                )
            )
        )
        .filter(F.col("type").isNotNull())
        .distinct()
        .groupBy("id")
        .agg(F.count("type").alias("n_types"))
        .filter(F.col("n_types") > 1)
    )
