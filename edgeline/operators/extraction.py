"""Turning source tables into triplets.

Every function returns rows of the triplet contract. Groups are never paired up
member by member: entities link to a node standing for what they share, or to one
of those equal to them, so that the number of triplets stays linear in the input; only
similarity lists pairs, between distinct vectors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeline.operators.similarity import BUCKET_ROWS, distinct_vectors, similar_entities, sound_vectors
from edgeline.runtime import broadcast_if_small, lookup, materialize
from edgeline.schema import TRIPLET_SCHEMA, conform

# Fixed value: off-hours run from midnight up to, not including, this hour.
OFF_HOURS_END = 5


def make_triplets(
    df: DataFrame,
    subject: Column,
    subject_type: str,
    predicate: str,
    object: Column,
    object_type: str,
    confidence: Column,
    agent: str,
    method: str,
    properties: Column | None = None,
) -> DataFrame:
    """Rows of the triplet contract from expressions over `df`."""
    return conform(
        df.select(
            subject.alias("subject_id"),
            F.lit(subject_type).alias("subject_type"),
            F.lit(predicate).alias("predicate"),
            object.alias("object_id"),
            F.lit(object_type).alias("object_type"),
            confidence.alias("confidence"),
            F.lit(agent).alias("source_agent"),
            F.lit(method).alias("source_method"),
            (F.lit(None) if properties is None else properties).alias("properties"),
        ),
        TRIPLET_SCHEMA,
        optional=("created_at",),
    )


@dataclass(frozen=True)
class ForeignKey:
    """How a foreign key becomes a relationship: child row -> parent row."""

    child_key: str
    child_type: str
    foreign_key: str
    parent_key: str
    parent_type: str
    predicate: str
    child_prefix: str = ""
    parent_prefix: str = ""


def fk_triplets(child: DataFrame, parent: DataFrame, spec: ForeignKey) -> DataFrame:
    """One certain relationship per distinct (child, parent) pair whose parent row exists."""
    pairs = (
        child.select(F.col(spec.child_key).alias("child"), F.col(spec.foreign_key).alias("parent"))
        .filter(F.col("child").isNotNull() & F.col("parent").isNotNull())
        .distinct()
    )
    known = parent.select(F.col(spec.parent_key).alias("parent")).distinct()
    linked = lookup(pairs, "parent", known, by=F.col("child"), how="left_semi")
    return make_triplets(
        linked,
        F.concat(F.lit(spec.child_prefix), F.col("child").cast("string")),
        spec.child_type,
        spec.predicate,
        F.concat(F.lit(spec.parent_prefix), F.col("parent").cast("string")),
        spec.parent_type,
        F.lit(1.0),
        "relationship",
        "fk_join",
    )


def shared_attribute_triplets(
    df: DataFrame, id: Column, id_type: str, keys: Sequence[Column], attribute: str
) -> DataFrame:
    """Entities linked to each attribute value that more than one of them carries.

    A value shared by n entities gives n rows, and any two of those entities are two
    hops apart. Several key columns form one value, written as a JSON array.
    """
    value = keys[0].cast("string") if len(keys) == 1 else F.to_json(F.array(*[k.cast("string") for k in keys]))
    filled = reduce(lambda a, b: a & b, [k.isNotNull() for k in keys])
    pairs = df.filter(filled).select(id.cast("string").alias("entity"), value.alias("value")).distinct()
    shared = pairs.groupBy("value").agg(F.count("entity").alias("n_entities")).filter(F.col("n_entities") > 1)
    linked = lookup(pairs, "value", shared, by=F.col("entity"), how="inner")
    return make_triplets(
        linked,
        F.col("entity"),
        id_type,
        f"SHARES_{attribute.upper()}",
        F.col("value"),
        attribute,
        F.lit(1.0),
        "relationship",
        "shared_attribute",
        F.to_json(F.struct("n_entities")),
    )


def outlier_triplets(
    df: DataFrame, id: Column, id_type: str, group: str, amount: str, threshold: float = 3.0
) -> DataFrame:
    """Entities whose amount lies at least `threshold` standard deviations from their group's mean.

    Confidence is 1 - 1/z^2, the share no distribution exceeds at that distance.
    """
    stats = df.groupBy(group).agg(F.avg(amount).alias("mean"), F.stddev_samp(amount).alias("spread"))
    rows = df.select(id.cast("string").alias("entity"), group, amount).filter(F.col(amount).isNotNull())
    scored = (
        lookup(rows, group, stats.filter(F.col("spread") > 0), by=F.col("entity"), how="inner")
        .withColumn("z", F.abs(F.col(amount) - F.col("mean")) / F.col("spread"))
        .filter(F.col("z") >= threshold)
    )
    return make_triplets(
        scored,
        F.col("entity"),
        id_type,
        "HAS_OUTLIER",
        F.concat(F.lit("OUTLIER:"), F.col(group).cast("string")),
        "Pattern",
        F.greatest(F.lit(0.0), 1 - 1 / (F.col("z") * F.col("z"))),
        "statistical_analysis",
        "z_score",
        F.to_json(F.struct(F.round("z", 4).alias("z"))),
    )


def peak_rate(df: DataFrame, entity: str, ts: str, window_seconds: int) -> DataFrame:
    """(entity, peak): the most events of an entity in any span of `window_seconds` ending at an event.

    Time is cut into buckets one window long and each counted instant is also shown
    to the next bucket, so a window never looks beyond its own (entity, bucket) group:
    a very busy entity is spread over as many groups as it has active buckets.
    """
    span = window_seconds * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    instants = df.select(F.col(entity).alias("entity"), micros.alias("at")).groupBy("entity", "at").agg(
        F.count(F.lit(1)).alias("n")
    )
    bucket = F.floor(F.col("at") / F.lit(span))
    shown = instants.select(
        "entity",
        "at",
        "n",
        F.inline(
            F.array(
                F.struct(bucket.alias("bucket"), F.lit(True).alias("own")),
                F.struct((bucket + 1).alias("bucket"), F.lit(False).alias("own")),
            )
        ),
    )
    recent = Window.partitionBy("entity", "bucket").orderBy("at").rangeBetween(-span, Window.currentRow)
    return (
        shown.withColumn("in_window", F.sum("n").over(recent))
        .filter("own")
        .groupBy("entity")
        .agg(F.max("in_window").alias("peak"))
    )


def velocity_triplets(
    df: DataFrame, entity: str, entity_type: str, ts: str, window_seconds: int, min_events: int, prefix: str = ""
) -> DataFrame:
    """Entities with at least `min_events` events inside one sliding window."""
    busy = peak_rate(df, entity, ts, window_seconds).filter(F.col("peak") >= min_events)
    return make_triplets(
        busy,
        F.concat(F.lit(prefix), F.col("entity").cast("string")),
        entity_type,
        "HAS_PATTERN",
        F.lit("PATTERN:velocity"),
        "Pattern",
        1 - F.lit(min_events) / (2 * F.col("peak")),
        "statistical_analysis",
        "velocity",
        F.to_json(F.struct("peak")),
    )


def _share_triplets(df, entity, entity_type, hit, min_share, min_events, pattern, prefix):
    per_entity = (
        df.groupBy(F.col(entity).alias("entity"))
        .agg(F.count(F.lit(1)).alias("n_events"), F.count_if(hit).alias("n_hits"))
        .withColumn("share", F.col("n_hits") / F.col("n_events"))
        .filter((F.col("n_events") >= min_events) & (F.col("share") >= min_share))
    )
    return make_triplets(
        per_entity,
        F.concat(F.lit(prefix), F.col("entity").cast("string")),
        entity_type,
        "HAS_PATTERN",
        F.lit(f"PATTERN:{pattern}"),
        "Pattern",
        F.col("share"),
        "statistical_analysis",
        pattern,
        F.to_json(F.struct("n_events", "n_hits")),
    )


def off_hours_triplets(
    df: DataFrame, entity: str, entity_type: str, ts: str, min_share: float = 0.5, min_events: int = 5, prefix: str = ""
) -> DataFrame:
    """Entities with a large share of their events between midnight and five."""
    hit = F.hour(F.col(ts)) < OFF_HOURS_END
    return _share_triplets(df, entity, entity_type, hit, min_share, min_events, "off_hours", prefix)


def concentration_triplets(
    df: DataFrame,
    entity: str,
    entity_type: str,
    category: str,
    risky: Sequence[str],
    min_share: float = 0.5,
    min_events: int = 5,
    prefix: str = "",
) -> DataFrame:
    """Entities with a large share of their events in high-risk categories."""
    hit = F.col(category).isin(list(risky))
    return _share_triplets(df, entity, entity_type, hit, min_share, min_events, "concentration", prefix)


def _norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    return dot / (_norm(a) * _norm(b))


def cluster_triplets(
    df: DataFrame, id: Column, id_type: str, vector: str, k: int, seed: int = 42, max_iter: int = 20
) -> DataFrame:
    """Each entity linked to its k-means cluster; confidence is the cosine to the cluster centre, at least 0."""
    rows = df.select(
        id.cast("string").alias("entity"), array_to_vector(F.col(vector).cast("array<double>")).alias("features")
    )
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster").fit(rows)
    # k centres: a parameter-sized table.
    centres = df.sparkSession.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster int, centre array<double>"
    )
    placed = (
        model.transform(rows)
        .join(F.broadcast(centres), "cluster")
        .withColumn("cosine", cosine(vector_to_array("features"), F.col("centre")))
    )
    return make_triplets(
        placed,
        F.col("entity"),
        id_type,
        "IN_CLUSTER",
        F.concat(F.lit("CLUSTER:"), F.col("cluster").cast("string")),
        "Cluster",
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("cosine", F.lit(0.0)))),
        "ml_clustering",
        "kmeans",
    )


def group_centres(df: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, centre): the mean vector per group."""
    features = array_to_vector(F.col(vector).cast("array<double>"))
    means = df.filter(F.col(vector).isNotNull()).groupBy(group).agg(Summarizer.mean(features).alias("mean"))
    return means.select(group, vector_to_array("mean").alias("centre"))


def _unit(vector: Column) -> Column:
    length = _norm(vector)
    return F.when(length > 0, F.transform(vector, lambda x: x / length))


CENTRES_PER_BLOCK = 200


def cosine_triplets(
    df: DataFrame, id: Column, id_type: str, vector: str, group: str, threshold: float
) -> DataFrame:
    """Each entity linked to every group whose mean vector is within the cosine threshold.

    Comparing with group centres rather than with every other entity keeps the work
    at entities x groups. Both sides are scaled to unit length once. The centres are met in
    blocks, which are broadcast only if they are small together.
    """
    centres, seen = materialize(
        group_centres(df, group, vector).select(F.col(group).alias("group"), _unit(F.col("centre")).alias("centre"))
    )
    n_blocks = max(1, -(-seen["rows"] // CENTRES_PER_BLOCK))
    block = F.pmod(F.xxhash64("group"), F.lit(n_blocks)).cast("int")
    packed = centres.groupBy(block.alias("block")).agg(F.collect_list(F.struct("group", "centre")).alias("centres"))
    rows = df.select(id.cast("string").alias("entity"), F.col(vector).cast("array<double>").alias("raw"))
    rows = rows.withColumn("length", _norm(F.col("raw"))).filter(F.col("length") > 0)
    rows = rows.withColumn("v", F.transform("raw", lambda x: x / F.col("length"))).select("entity", "v")
    met = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    dot = F.aggregate(F.zip_with("v", "centre", lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    similar = (
        met.join(broadcast_if_small(packed, seen["bytes"]), "block")
        .select("entity", "v", F.inline("centres"))
        .withColumn("cosine", dot)
        .filter(F.col("cosine") >= threshold)
    )
    return make_triplets(
        similar,
        F.col("entity"),
        id_type,
        "SIMILAR_TO",
        F.concat(F.lit("GROUP:"), F.col("group").cast("string")),
        "Cluster",
        F.least(F.lit(1.0), F.col("cosine")),
        "ml_clustering",
        "cosine_similarity",
    )


def similar_pair_triplets(
    df: DataFrame, id: Column, id_type: str, vector: str, threshold: float, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Pairs of entities whose vectors reach the cosine threshold, and entities with equal vectors.

    Pairs link the smallest entity of each distinct vector (SIMILAR_TO, the smaller one as
    subject); every other entity is linked to the one whose vector it has (SAME_VECTOR), so a
    group of equal vectors has a row for each member, not for each pair. Only vectors of
    one length are compared; those that are null, zero or not finite take no part.
    """
    vectors, copies, n = distinct_vectors(sound_vectors(df, id, vector))
    links = similar_entities(vectors, n, threshold, bucket_rows).select(
        F.least("one", "two").alias("subject"), F.greatest("one", "two").alias("object"),
        F.lit("SIMILAR_TO").alias("predicate"), F.least(F.lit(1.0), "cosine").alias("cosine"),
    )
    same = copies.select(
        F.col("same_as").alias("subject"), F.col("entity").alias("object"), F.lit("SAME_VECTOR").alias("predicate"), F.lit(1.0).alias("cosine")
    )
    rows = links.unionByName(same)
    return make_triplets(
        rows, F.col("subject"), id_type, F.col("predicate"), F.col("object"), id_type, F.col("cosine"), "ml_clustering", "cosine_similarity"
    )


def placed_triplets(df: DataFrame, id: Column, id_type: str, vector: str, centres: DataFrame) -> DataFrame:
    """Each entity linked to the nearest of the given centres (cluster, centre); equally near ones by the smaller cluster.

    Confidence is the cosine to the centre, at least 0. The centres are a table of a
    clustering's size, met by every entity.
    """
    listed = centres.agg(F.collect_list(F.struct("cluster", "centre")).alias("centres"))
    rows = df.filter(F.col(vector).isNotNull()).select(id.cast("string").alias("entity"), F.col(vector).cast("array<double>").alias("v"))
    one = F.lit(1).alias("one")
    # One row with all centres, met by an equality.
    met = rows.select("*", one).join(F.broadcast(listed.select("*", one)), "one")

    def far(centre: Column) -> Column:
        return F.aggregate(F.zip_with("v", centre, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, x: acc + x)

    best = F.array_min(F.transform("centres", lambda c: F.struct(far(c["centre"]).alias("far"), c["cluster"].alias("cluster"), c["centre"].alias("centre"))))
    placed = met.withColumn("best", best).select("entity", "v", "best.cluster", "best.centre")
    best = placed.withColumn("cosine", cosine(F.col("v"), F.col("centre")))
    return make_triplets(
        best, F.col("entity"), id_type, "IN_CLUSTER", F.concat(F.lit("CLUSTER:"), F.col("cluster").cast("string")), "Cluster",
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("cosine", F.lit(0.0)))), "ml_clustering", "nearest_centre",
    )


def all_fk_triplets(
    tables: dict[str, DataFrame], keys: DataFrame, found: DataFrame, types: dict[str, str] | None = None
) -> DataFrame:
    """Triplets for every foreign key that was found, out of the tables' own keys.

    `keys` is the result of `entity_keys`, `found` that of `foreign_keys`. A table with a key
    links each of its rows to the rows its foreign keys name; one without (an association) links what its
    first foreign key names to what the others name. Entities are `<table>:<key>`, typed by
    `types` or the table's name, and predicates the foreign key's column in capitals.
    """
    # Both have a row per column (pair) of the schema.
    own = {}
    for r in keys.orderBy(F.desc("id_like"), "table_name", "column_name").collect():
        own.setdefault(r["table_name"], r["column_name"])
    links: dict[str, list] = {}
    for r in found.collect():
        links.setdefault(r["child_table"], []).append(r)
    parts = []
    for child, rows in sorted(links.items()):
        order = {c: i for i, c in enumerate(tables[child].columns)}
        rows.sort(key=lambda r: (order[r["child_column"]], r["parent_table"], r["parent_column"]))
        if child in own:
            subject, subject_of, targets = own[child], child, [r for r in rows if r["child_column"] != own[child]]
        else:
            subject, subject_of, targets = rows[0]["child_column"], rows[0]["parent_table"], rows[1:]
        for r in targets:
            spec = ForeignKey(
                subject, (types or {}).get(subject_of, subject_of), r["child_column"], r["parent_column"],
                (types or {}).get(r["parent_table"], r["parent_table"]), r["child_column"].upper(),
                f"{subject_of}:", f"{r['parent_table']}:",
            )
            parts.append(fk_triplets(tables[child], tables[r["parent_table"]], spec))
    if not parts:
        raise ValueError("no foreign keys")
    return reduce(DataFrame.unionByName, parts)


def topology_triplets(centrality: DataFrame, communities: DataFrame, n: int = 10) -> DataFrame:
    """The n best connected and the n most bridging entities, and everyone's community."""

    def leaders(score, predicate, role):
        top = centrality.filter(F.col(score) > 0).orderBy(F.desc(score), "entity_id").limit(n)
        # At most n rows are left, so a window over all of them is small.
        best = F.max(score).over(Window.partitionBy(F.lit(0)))
        return top.select(
            F.col("entity_id").alias("subject_id"),
            F.col("entity_type").alias("subject_type"),
            F.lit(predicate).alias("predicate"),
            F.lit(f"ROLE:{role}").alias("object_id"),
            F.lit("Role").alias("object_type"),
            (F.col(score) / best).alias("confidence"),
            F.lit(score).alias("source_method"),
        )

    members = communities.filter(F.col("community_id").isNotNull()).select(
        F.col("entity_id").alias("subject_id"),
        F.col("entity_type").alias("subject_type"),
        F.lit("MEMBER_OF").alias("predicate"),
        F.concat(F.lit("COMMUNITY:"), F.col("community_id").cast("string")).alias("object_id"),
        F.lit("Community").alias("object_type"),
        F.lit(1.0).alias("confidence"),
        F.lit("community").alias("source_method"),
    )
    found = leaders("degree", "IS_HUB", "hub").unionByName(leaders("betweenness", "IS_BRIDGE", "bridge"))
    rows = found.unionByName(members).withColumn("source_agent", F.lit("graph_topology"))
    return conform(rows, TRIPLET_SCHEMA, optional=("properties", "created_at"))
