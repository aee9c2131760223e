"""The registry of onboarded graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeline.schema import conform_registry


def registry_upsert(registry: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """The registry after an upsert on `dataset_key`.

    A known key only has `updated_at` set to `now`; an unknown key is inserted as
    given. Two incoming rows with one key are ambiguous and rejected. Write the
    result to a new location: a Parquet table can't be overwritten while it is read.
    """
    incoming = conform_registry(incoming)
    duplicated = incoming.groupBy("dataset_key").count().filter("count > 1")
    if not duplicated.isEmpty():
        raise ValueError("several incoming rows share one dataset_key")
    keys = incoming.select("dataset_key", F.lit(True).alias("matched"))
    touched = (
        registry.join(keys, "dataset_key", "left")
        .withColumn("updated_at", F.when(F.col("matched"), now).otherwise(F.col("updated_at")))
        .select(*incoming.columns)
    )
    added = incoming.join(registry.select("dataset_key"), "dataset_key", "left_anti")
    return touched.unionByName(added)


def enabled_datasets(registry: DataFrame) -> DataFrame:
    """Registered graphs that are not switched off; an unset switch counts as on."""
    return registry.filter("enabled IS DISTINCT FROM false")
