"""Profiling source tables and building triplets from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgeline.catalog import query
from edgeline.catalog.algorithms import CENTRALITY
from edgeline.catalog.graphs import FOREST, MOVES, forest, moves, saved, table
from edgeline.catalog.relational import rounded
from edgeline.operators import extraction, profiling, results, validation
from edgeline.operators.extraction import ForeignKey
from edgeline.operators.vertices import index_graph

# Columns and types of the profiled tables.
TABLES = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {
        "c_custkey": "bigint",
        "c_name": "string",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    },
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {
        "p_partkey": "bigint",
        "p_name": "string",
        "p_brand": "string",
        "p_type": "string",
        "p_size": "int",
        "p_retailprice": "double",
    },
    "orders": {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    },
    "lineitem": {
        "l_orderkey": "bigint",
        "l_partkey": "bigint",
        "l_suppkey": "bigint",
        "l_linenumber": "int",
        "l_quantity": "double",
        "l_extendedprice": "double",
        "l_discount": "double",
        "l_tax": "double",
        "l_returnflag": "string",
        "l_linestatus": "string",
        "l_shipdate": "timestamp_ntz",
    },
    "events": {
        "event_id": "bigint",
        "ts": "timestamp_ntz",
        "user_id": "bigint",
        "event_type": "string",
        "value": "double",
        "props": "string",
    },
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "benchmark": {"item_id": "bigint", "text": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
}
TRIPLET_TEXT = "subject_id, subject_type, predicate, object_id, object_type, confidence, source_agent, source_method"
TRIPLET_NAMES = TRIPLET_TEXT.split(", ")


def _profile_sql() -> str:
    def end(which: str, column: str, kind: str) -> str:
        return "CAST(NULL AS VARCHAR)" if kind.startswith("array") else f"CAST({which}({column}) AS VARCHAR)"

    parts = [
        f"""SELECT '{name}' AS table_name, '{column}' AS column_name, '{kind}' AS data_type, count(*) AS n_rows,
count(*) - count({column}) AS n_nulls, count(DISTINCT {column}) AS n_distinct,
{end('min', column, kind)} AS min_value, {end('max', column, kind)} AS max_value FROM {name}"""
        for name, columns in TABLES.items()
        for column, kind in columns.items()
    ]
    return "profile AS (" + "\nUNION ALL ".join(parts) + ")"


def _foreign_key_sql() -> str:
    """Distinct values of all integer and text columns, met with those of columns that identify their rows."""
    kinds = {"int": "integer", "bigint": "integer", "string": "string"}
    columns = [(t, c, kinds[k]) for t, own in TABLES.items() for c, k in own.items() if k in kinds]
    values = " UNION ALL ".join(
        f"""SELECT DISTINCT '{t}' AS t, '{c}' AS c, '{kind}' AS kind, CAST({c} AS VARCHAR) AS v,
(SELECT count(*) = count(DISTINCT {c}) AND count(*) = count({c}) FROM {t}) AS is_key FROM {t} WHERE {c} IS NOT NULL"""
        for t, c, kind in columns
    )
    return f"""WITH vals AS MATERIALIZED ({values}),
sizes AS (SELECT t, c, count(*) AS n_values FROM vals GROUP BY ALL),
met AS (SELECT x.t AS child_table, x.c AS child_column, y.t AS parent_table, y.c AS parent_column, count(*) AS n_matched
FROM vals x JOIN vals y ON y.is_key AND x.kind = y.kind AND x.v = y.v AND x.t <> y.t GROUP BY ALL)
SELECT met.*, n_values, round(n_matched / n_values, 6) AS containment
FROM met JOIN sizes ON sizes.t = child_table AND sizes.c = child_column WHERE n_matched / n_values >= 0.95"""


def _tables(spark, sf):
    return {name: table(spark, sf, name).select(*columns) for name, columns in TABLES.items()}


def _triplets(df):
    return rounded(df.select(*TRIPLET_NAMES), "confidence")


@query("k1_profile", f"WITH {_profile_sql()} SELECT * FROM profile")
def _(spark, sf):
    return profiling.profile(_tables(spark, sf))


@query(
    "k2_entity_keys",
    f"""WITH {_profile_sql()} SELECT table_name, column_name, regexp_matches(column_name, '(id|key)$') AS id_like
FROM profile WHERE n_rows > 0 AND n_nulls = 0 AND n_distinct = n_rows""",
)
def _(spark, sf):
    return profiling.entity_keys(profiling.profile(_tables(spark, sf)))


@query("k3_foreign_keys", _foreign_key_sql())
def _(spark, sf):
    tables = _tables(spark, sf)
    keys = saved(profiling.key_columns(tables))
    return rounded(profiling.foreign_keys(tables, keys), "containment")


@query(
    "k4_fk_triplets",
    """SELECT DISTINCT 'O' || l_orderkey AS subject_id, 'Order' AS subject_type, 'CONTAINS' AS predicate,
'P' || l_partkey AS object_id, 'Part' AS object_type, CAST(1 AS DOUBLE) AS confidence,
'relationship' AS source_agent, 'fk_join' AS source_method FROM lineitem
WHERE l_partkey IN (SELECT p_partkey FROM part)""",
)
def _(spark, sf):
    spec = ForeignKey("l_orderkey", "Order", "l_partkey", "p_partkey", "Part", "CONTAINS", "O", "P")
    return _triplets(extraction.fk_triplets(table(spark, sf, "lineitem"), table(spark, sf, "part"), spec))


def _all_fk_sql() -> str:
    """What the tables' foreign keys, named alike but for the prefix, must give."""
    links = [
        ("customer", "c_custkey", "customer", "c_nationkey", "nation", "n_nationkey"),
        ("supplier", "s_suppkey", "supplier", "s_nationkey", "nation", "n_nationkey"),
        ("nation", "n_nationkey", "nation", "n_regionkey", "region", "r_regionkey"),
        ("orders", "o_orderkey", "orders", "o_custkey", "customer", "c_custkey"),
        ("lineitem", "l_orderkey", "orders", "l_partkey", "part", "p_partkey"),
        ("lineitem", "l_orderkey", "orders", "l_suppkey", "supplier", "s_suppkey"),
    ]
    return "\nUNION ALL ".join(
        f"""SELECT DISTINCT '{owner}:' || {key} AS subject_id, '{owner}' AS subject_type, '{column.upper()}' AS predicate,
'{parent}:' || {column} AS object_id, '{parent}' AS object_type, CAST(1 AS DOUBLE) AS confidence,
'relationship' AS source_agent, 'fk_join' AS source_method FROM {child}
WHERE {key} IS NOT NULL AND {column} IN (SELECT {parent_key} FROM {parent})"""
        for child, key, owner, column, parent, parent_key in links
    )


@query("k4_all_foreign_keys", _all_fk_sql())
def _(spark, sf):
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    tables = {name: table(spark, sf, name) for name in names}
    keys = saved(profiling.key_columns(tables))
    found = profiling.foreign_keys(tables, keys)
    # Small numbers are contained in many keys; those meant are named alike.
    alike = F.substring_index("child_column", "_", -1) == F.substring_index("parent_column", "_", -1)
    return _triplets(extraction.all_fk_triplets(tables, keys.filter("id_like"), saved(found.filter(alike))))


@query(
    "k5_shared_attribute_triplets",
    """WITH d AS (SELECT DISTINCT 'P' || p_partkey AS id, CAST(to_json([p_name, p_brand]) AS VARCHAR) AS v FROM part),
s AS (SELECT v, count(*) AS n FROM d GROUP BY v HAVING count(*) > 1)
SELECT id AS subject_id, 'Part' AS subject_type, 'SHARES_LABEL' AS predicate, v AS object_id, 'label' AS object_type,
CAST(1 AS DOUBLE) AS confidence, 'relationship' AS source_agent, 'shared_attribute' AS source_method,
'{"n_entities":' || n || '}' AS properties FROM d JOIN s USING (v)""",
)
def _(spark, sf):
    part_id = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    keys = [F.col("p_name"), F.col("p_brand")]
    found = extraction.shared_attribute_triplets(table(spark, sf, "part"), part_id, "Part", keys, "label")
    return rounded(found.select(*TRIPLET_NAMES, "properties"), "confidence")


@query(
    "k5_shared_text_triplets",
    """WITH d AS (SELECT 'D' || doc_id AS id, md5(text) AS v FROM documents),
s AS (SELECT v FROM d GROUP BY v HAVING count(*) > 1)
SELECT id AS subject_id, 'Document' AS subject_type, 'SHARES_TEXT' AS predicate, v AS object_id, 'text' AS object_type,
CAST(1 AS DOUBLE) AS confidence, 'relationship' AS source_agent, 'shared_attribute' AS source_method
FROM d JOIN s USING (v)""",
)
def _(spark, sf):
    doc_id = F.concat(F.lit("D"), F.col("doc_id").cast("string"))
    docs = table(spark, sf, "documents")
    return _triplets(extraction.shared_attribute_triplets(docs, doc_id, "Document", [F.md5("text")], "text"))


@query(
    "k6_outlier_triplets",
    """WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS d FROM events GROUP BY 1),
z AS (SELECT event_id, event_type, abs(value - m) / d AS z FROM events JOIN s USING (event_type))
SELECT 'E' || event_id AS subject_id, 'Event' AS subject_type, 'HAS_OUTLIER' AS predicate,
'OUTLIER:' || event_type AS object_id, 'Pattern' AS object_type, round(greatest(0, 1 - 1 / (z * z)), 6) AS confidence,
'statistical_analysis' AS source_agent, 'z_score' AS source_method FROM z WHERE z >= 3""",
)
def _(spark, sf):
    event_id = F.concat(F.lit("E"), F.col("event_id").cast("string"))
    events = table(spark, sf, "events")
    return _triplets(extraction.outlier_triplets(events, event_id, "Event", "event_type", "value", 3.0))


@query(
    "k7_velocity",
    """WITH w AS (SELECT user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts
RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW) AS n FROM events),
p AS (SELECT user_id, max(n) AS peak FROM w GROUP BY 1)
SELECT 'U' || user_id AS subject_id, 'User' AS subject_type, 'HAS_PATTERN' AS predicate,
'PATTERN:velocity' AS object_id, 'Pattern' AS object_type, round(1 - 4 / (2 * peak), 6) AS confidence,
'statistical_analysis' AS source_agent, 'velocity' AS source_method FROM p WHERE peak >= 4""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    return _triplets(extraction.velocity_triplets(events, "user_id", "User", "ts", 6 * 3600, 4, "U"))


def _share_sql(hit: str, pattern: str, share: float) -> str:
    return f"""WITH p AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE {hit}) AS h FROM events GROUP BY 1)
SELECT 'U' || user_id AS subject_id, 'User' AS subject_type, 'HAS_PATTERN' AS predicate,
'PATTERN:{pattern}' AS object_id, 'Pattern' AS object_type, round(h / n, 6) AS confidence,
'statistical_analysis' AS source_agent, '{pattern}' AS source_method FROM p WHERE n >= 5 AND h / n >= {share}"""


@query("k7_off_hours", _share_sql("hour(ts) < 5", "off_hours", 0.25))
def _(spark, sf):
    events = table(spark, sf, "events")
    return _triplets(extraction.off_hours_triplets(events, "user_id", "User", "ts", 0.25, 5, "U"))


@query("k7_concentration", _share_sql("event_type IN ('purchase', 'error')", "concentration", 0.45))
def _(spark, sf):
    events = table(spark, sf, "events")
    return _triplets(
        extraction.concentration_triplets(
            events, "user_id", "User", "event_type", ["purchase", "error"], 0.45, 5, "U"
        )
    )


@query(
    "k8_cluster_triplets",
    """SELECT count(*) AS n_triplets, count(DISTINCT vec_id) AS n_entities, TRUE AS clusters_bounded,
TRUE AS confidence_bounded FROM embeddings""",
)
def _(spark, sf):
    """What must hold for any clustering: every entity in one of at most k clusters, scores in [0, 1]."""
    vec_id = F.concat(F.lit("V"), F.col("vec_id").cast("string"))
    found = extraction.cluster_triplets(table(spark, sf, "embeddings"), vec_id, "Vector", "embedding", 10)
    return found.agg(
        F.count(F.lit(1)).alias("n_triplets"),
        F.count_distinct("subject_id").alias("n_entities"),
        F.count_distinct("object_id").between(1, 10).alias("clusters_bounded"),
        F.every(F.col("confidence").between(0, 1)).alias("confidence_bounded"),
    )


@query(
    "k8_nearest_centre",
    """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(x) AS c FROM x GROUP BY 1, 2),
d AS (SELECT x.vec_id, c.label, sum((x.x - c.c) * (x.x - c.c)) AS far,
sum(x.x * c.c) / (sqrt(sum(x.x * x.x)) * sqrt(sum(c.c * c.c))) AS cos FROM x JOIN c USING (i) GROUP BY 1, 2),
best AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY far, label) AS nth FROM d)
SELECT 'V' || vec_id AS subject_id, 'Vector' AS subject_type, 'IN_CLUSTER' AS predicate, 'CLUSTER:' || label AS object_id,
'Cluster' AS object_type, round(greatest(0, least(1, cos)), 6) AS confidence, 'ml_clustering' AS source_agent,
'nearest_centre' AS source_method FROM best WHERE nth = 1""",
)
def _(spark, sf):
    vectors = table(spark, sf, "embeddings")
    centres = extraction.group_centres(vectors, "label", "embedding").withColumnRenamed("label", "cluster")
    vec_id = F.concat(F.lit("V"), F.col("vec_id").cast("string"))
    return _triplets(extraction.placed_triplets(vectors, vec_id, "Vector", "embedding", centres))


@query(
    "k9_cosine_triplets",
    """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i
FROM embeddings),
c AS (SELECT label, i, avg(x) AS c FROM x GROUP BY 1, 2),
s AS (SELECT x.vec_id, c.label, sum(x.x * c.c) / (sqrt(sum(x.x * x.x)) * sqrt(sum(c.c * c.c))) AS cos
FROM x JOIN c USING (i) GROUP BY 1, 2)
SELECT 'V' || vec_id AS subject_id, 'Vector' AS subject_type, 'SIMILAR_TO' AS predicate,
'GROUP:' || label AS object_id, 'Cluster' AS object_type, round(least(1, cos), 6) AS confidence,
'ml_clustering' AS source_agent, 'cosine_similarity' AS source_method FROM s WHERE cos >= 0.25""",
)
def _(spark, sf):
    vec_id = F.concat(F.lit("V"), F.col("vec_id").cast("string"))
    vectors = table(spark, sf, "embeddings")
    return _triplets(extraction.cosine_triplets(vectors, vec_id, "Vector", "embedding", "label", 0.25))


@query(
    "k9_pairs",
    """WITH x AS (SELECT 'V' || vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings WHERE embedding IS NOT NULL),
r AS (SELECT v, min(id) AS rep FROM x GROUP BY v),
p AS (SELECT a.rep AS one, b.rep AS two, list_cosine_similarity(a.v, b.v) AS cos FROM r a JOIN r b ON a.rep < b.rep)
SELECT one AS subject_id, 'Vector' AS subject_type, 'SIMILAR_TO' AS predicate, two AS object_id, 'Vector' AS object_type,
round(least(1, cos), 6) AS confidence, 'ml_clustering' AS source_agent, 'cosine_similarity' AS source_method
FROM p WHERE cos >= 0.3
UNION ALL
SELECT rep, 'Vector', 'SAME_VECTOR', id, 'Vector', 1.0, 'ml_clustering', 'cosine_similarity' FROM x JOIN r USING (v) WHERE id <> rep""",
)
def _(spark, sf):
    vec_id = F.concat(F.lit("V"), F.col("vec_id").cast("string"))
    return _triplets(extraction.similar_pair_triplets(table(spark, sf, "embeddings"), vec_id, "Vector", "embedding", 0.3))


@query(
    "k10_topology_triplets",
    f"""WITH {FOREST},
dg AS (SELECT id AS entity_id, count(*) AS degree FROM (SELECT subject_id AS id FROM forest
UNION ALL SELECT object_id FROM forest) GROUP BY id),
top AS (SELECT entity_id, degree FROM dg ORDER BY degree DESC, entity_id LIMIT 10)
SELECT entity_id AS subject_id, entity_type AS subject_type, 'IS_HUB' AS predicate, 'ROLE:hub' AS object_id,
'Role' AS object_type, round(degree / (SELECT max(degree) FROM top), 6) AS confidence,
'graph_topology' AS source_agent, 'degree' AS source_method FROM top JOIN communities USING (entity_id)
UNION ALL SELECT entity_id, entity_type, 'MEMBER_OF', 'COMMUNITY:' || community_id, 'Community', 1.0,
'graph_topology', 'community' FROM communities""",
)
def _(spark, sf):
    graph = index_graph(forest(spark, sf))
    # No pivots, so no bridges: those are in k10_bridges.
    centrality = results.entity_centrality(None, graph=graph, pagerank_rounds=0, pivots=0)
    communities = results.components_as_communities(graph)
    return _triplets(extraction.topology_triplets(centrality, communities))


@query(
    "k10_bridges",
    f"""WITH {CENTRALITY},
top AS (SELECT entity_id, entity_type, betweenness FROM centrality WHERE betweenness > 0
ORDER BY betweenness DESC, entity_id LIMIT 10)
SELECT entity_id AS subject_id, entity_type AS subject_type, 'IS_BRIDGE' AS predicate, 'ROLE:bridge' AS object_id,
'Role' AS object_type, round(betweenness / (SELECT max(betweenness) FROM top), 6) AS confidence,
'graph_topology' AS source_agent, 'betweenness' AS source_method FROM top""",
)
def _(spark, sf):
    centrality = rounded(results.entity_centrality(moves(spark, sf), pagerank_rounds=0), "betweenness")
    nobody = results.components_as_communities(index_graph(forest(spark, sf))).limit(0)
    return _triplets(extraction.topology_triplets(centrality, nobody)).filter("predicate = 'IS_BRIDGE'")


@query(
    "k11_validate_triplets",
    f"""WITH {MOVES}, raw AS (
SELECT subject_id, predicate, object_id, subject_type, object_type, confidence, source_agent, source_method FROM moves
UNION ALL SELECT subject_id, predicate, object_id, subject_type, object_type, confidence / 2, 'second_agent',
source_method FROM moves WHERE predicate IN ('CLICK', 'PURCHASE')),
g AS (SELECT *, count(DISTINCT source_agent) OVER same AS n_agents, row_number() OVER (same ORDER BY
confidence DESC NULLS LAST, source_agent DESC NULLS LAST, source_method DESC NULLS LAST) AS place
FROM raw WINDOW same AS (PARTITION BY subject_id, predicate, object_id)),
s AS (SELECT * REPLACE (1 - (1 - confidence) / pow(2, greatest(n_agents - 1, 0)) AS confidence) FROM g WHERE place = 1)
SELECT subject_id, subject_type, predicate, object_id, object_type, round(confidence, 6) AS confidence, source_agent,
source_method FROM s WHERE confidence IS NULL OR confidence >= 0.3""",
)
def _(spark, sf):
    rows = moves(spark, sf)
    echo = rows.filter("predicate IN ('CLICK', 'PURCHASE')").withColumns(
        {"confidence": F.col("confidence") / 2, "source_agent": F.lit("second_agent")}
    )
    return _triplets(validation.validate_triplets(rows.unionByName(echo)))


@query(
    "k11_type_conflicts",
    f"""WITH {MOVES}, t AS (
SELECT subject_id AS id, CASE WHEN predicate = 'ERROR' THEN 'Suspect' ELSE subject_type END AS type FROM moves
UNION ALL SELECT object_id, object_type FROM moves)
SELECT id, count(DISTINCT type) AS n_types FROM t GROUP BY id HAVING count(DISTINCT type) > 1""",
)
def _(spark, sf):
    suspect = F.when(F.col("predicate") == "ERROR", "Suspect").otherwise(F.col("subject_type"))
    return validation.type_conflicts(moves(spark, sf).withColumn("subject_type", suspect))
