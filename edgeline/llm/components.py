"""Connected components of undirected links between long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeline.runtime import materialize


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.filter("a <> b").distinct()


def _followed(hooks: DataFrame) -> DataFrame:
    """(hook, to) with chains of hooks followed to their end, twice as far each round."""
    while True:
        onward = hooks.select(F.col("hook").alias("to"), F.col("to").alias("next"))
        further = hooks.join(onward, "to", "left").select("hook", F.coalesce("next", "to").alias("to"), "next")
        hooks, seen = materialize(further, moved=F.count_if(F.col("next").isNotNull()))
        hooks = hooks.select("hook", "to")
        if not seen["moved"]:
            return hooks


def min_labels(links: DataFrame) -> DataFrame:
    """(rep, label): the smallest id reachable over the links (a, b), for every id in a link.

    Each round hooks every id with a smaller neighbour to the smallest one, follows the
    hooks to their ends and goes on with the links between those ends. An end has no
    smaller neighbour, so at most half of the ids are left after a round. Every round is
    written as a table.
    """
    pairs, seen = materialize(_distinct_pairs(links))
    ids = links.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    labels, _ = materialize(ids.withColumn("label", F.col("rep")))
    while seen["rows"]:
        hooks, _ = materialize(pairs.groupBy(F.col("b").alias("hook")).agg(F.min("a").alias("to")))
        hooks = _followed(hooks)
        moved = labels.join(hooks.withColumnRenamed("hook", "label"), "label", "left")
        labels, _ = materialize(moved.select("rep", F.coalesce("to", "label").alias("label")))
        ends = pairs.join(hooks.toDF("a", "to_a"), "a", "left").join(hooks.toDF("b", "to_b"), "b", "left")
        ends = ends.select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"))
        pairs, seen = materialize(_distinct_pairs(ends))
    return labels
