"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds and names of the confidence buckets, and the smallest edge weight.
CONFIDENCE_BUCKETS = ((0.9, "0.9-1.0"), (0.7, "0.7-0.9"), (0.5, "0.5-0.7"))
LOWEST_BUCKET = "0.3-0.5"
MIN_WEIGHT = 0.001
PATH_SEPARATOR = " -> "


def edge_weight(confidence: Column) -> Column:
    """Confidence as a positive weight: unknown counts as 1, nothing below the floor."""
    return F.greatest(F.coalesce(confidence.try_cast("double"), F.lit(1.0)), F.lit(MIN_WEIGHT))


def confidence_bucket(confidence: Column) -> Column:
    """Name of the confidence band; NULL and low values share the lowest band."""
    branches = None
    for bound, name in CONFIDENCE_BUCKETS:
        branches = (F if branches is None else branches).when(confidence >= bound, name)
    return branches.otherwise(LOWEST_BUCKET)


def edge_property(properties: Column, path: str) -> Column:
    """Value at a JSON path of the edge properties, as text."""
    return F.get_json_object(properties, path)


def path_text(*nodes: Column) -> Column:
    return F.concat_ws(PATH_SEPARATOR, *nodes)


def both_directions(src: Column, dst: Column) -> Column:
    """Generator of (src, dst) and (dst, src): one scan yields the undirected pairs."""
    return F.inline(
        F.array(
            F.struct(src.alias("src"), dst.alias("dst")),
            F.struct(dst.alias("src"), src.alias("dst")),
        )
    )
