"""Contracts, checks, filters, joins, aggregations, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeline.catalog import query
from edgeline.catalog.graphs import (
    FOREST,
    MOVES,
    ORDERS_GRAPH,
    STRUCTURAL,
    forest,
    moves,
    orders_graph,
    table,
)
from edgeline.functions.expressions import confidence_bucket, edge_property, edge_weight, path_text
from edgeline.operators import filters, lookups, results, statistics, traversal, views
from edgeline.operators.vertices import index_graph
from edgeline.runtime import scratch_path
from edgeline.schema import Graph, GraphColumns, conform_registry, conform_triplets, empty_results
from edgeline.sources import registry as reg
from edgeline.sources.tables import append_triplets, load_graph, read_table, write_result
from edgeline.streaming import incremental

BRIEF = ("subject_id", "predicate", "object_id", "confidence")
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
NOW = "2030-01-01 00:00:00"
SINCE = "2024-01-15 00:00:00"


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def as_text(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.date_format(name, MICROS) for name in names})


# --- contracts, sources, sinks ---------------------------------------------------------


@query(
    "s1_triplet_contract",
    f"""WITH {MOVES}
SELECT subject_id, CAST(NULL AS VARCHAR) AS subject_type, predicate, object_id, CAST(NULL AS VARCHAR) AS object_type,
       confidence, source_agent, source_method, CAST(NULL AS VARCHAR) AS properties,
       strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at FROM moves""",
)
def _(spark, sf):
    rows = moves(spark, sf).drop("properties").withColumns(
        {"subject_type": F.lit(None), "object_type": F.lit(None), "extra": F.lit(1)}
    )
    return as_text(conform_triplets(rows), "created_at")


def _registry(spark, sf):
    """One registered graph per document language and source."""
    return conform_registry(
        table(spark, sf, "documents")
        .groupBy("lang", "source")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.concat_ws("_", "lang", "source").alias("dataset_key"),
            F.concat(F.initcap("source"), F.lit(" graph")).alias("display_name"),
            F.concat_ws(".", F.lit("main"), "lang", "source").alias("triplet_table"),
            F.format_string("%d documents", "n").alias("description"),
            F.array(F.lit("Which entities are hubs?"), F.concat(F.lit("What is in "), F.col("source"))).alias(
                "sample_prompts"
            ),
            F.lit("owner@example.com").alias("owner"),
            F.lit(None).alias("agent_endpoint"),
            F.when(F.col("n") % 3 == 0, False).when(F.col("n") % 3 == 1, True).alias("enabled"),
            F.lit("2024-01-01 00:00:00").alias("created_at"),
            F.lit("2024-01-01 00:00:00").alias("updated_at"),
        )
    )


REGISTRY = """
registry AS (
  SELECT lang || '_' || source AS dataset_key, upper(source[1]) || lower(source[2:]) || ' graph' AS display_name,
         'main.' || lang || '.' || source AS triplet_table, count(*) || ' documents' AS description,
         'Which entities are hubs?|What is in ' || source AS sample_prompts, 'owner@example.com' AS owner,
         CAST(NULL AS VARCHAR) AS agent_endpoint,
         CASE count(*) % 3 WHEN 0 THEN FALSE WHEN 1 THEN TRUE END AS enabled,
         '2024-01-01 00:00:00.000000' AS created_at, '2024-01-01 00:00:00.000000' AS updated_at
  FROM documents GROUP BY lang, source
)"""


def _registry_text(df):
    return as_text(df.withColumn("sample_prompts", F.array_join("sample_prompts", "|")), "created_at", "updated_at")


@query("s2_registry_contract", f"WITH {REGISTRY} SELECT * FROM registry")
def _(spark, sf):
    return _registry_text(_registry(spark, sf))


@query(
    "s3_registry_upsert",
    f"""WITH {REGISTRY}
SELECT * REPLACE (CASE WHEN dataset_key LIKE 'en%' AND description <> '1 documents' THEN '{NOW}.000000'
                  ELSE updated_at END AS updated_at)
FROM registry WHERE description <> '1 documents'
UNION ALL SELECT * REPLACE ('{NOW}.000000' AS updated_at) FROM registry
WHERE dataset_key LIKE 'en%' AND description = '1 documents'
UNION ALL
SELECT * REPLACE (dataset_key || '_v2' AS dataset_key) FROM registry WHERE dataset_key LIKE 'en%'""",
)
def _(spark, sf):
    known = _registry(spark, sf).filter("NOT (dataset_key NOT LIKE 'en%' AND description = '1 documents')")
    english = known.filter("dataset_key LIKE 'en%'")
    incoming = english.withColumn("owner", F.lit("ignored@example.com")).unionByName(
        english.withColumn("dataset_key", F.concat("dataset_key", F.lit("_v2")))
    )
    return _registry_text(reg.registry_upsert(known, incoming, F.lit(NOW).cast("timestamp")))


@query(
    "s4_enabled_datasets",
    f"WITH {REGISTRY} SELECT dataset_key, triplet_table, enabled FROM registry WHERE enabled IS DISTINCT FROM FALSE",
)
def _(spark, sf):
    return reg.enabled_datasets(_registry(spark, sf)).select("dataset_key", "triplet_table", "enabled")


@query(
    "s5_load_graph",
    """SELECT CAST(n_nationkey AS VARCHAR) AS src, CAST(n_regionkey AS VARCHAR) AS dst, count(*) AS n
FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""",
)
def _(spark, sf):
    cols = GraphColumns(
        src="n_nationkey", dst="n_regionkey", label="n_name", src_type=None, dst_type=None, node_id="c_nationkey"
    )
    graph = load_graph(spark, f"{sf}/nation.parquet", f"{sf}/customer.parquet", cols)
    members = graph.nodes.groupBy(cols.node_id).agg(F.count(F.lit(1)).alias("n"))
    return graph.edges.join(members, F.col(cols.src) == F.col(cols.node_id)).select(
        graph.src.cast("string").alias("src"), graph.dst.cast("string").alias("dst"), "n"
    )


@query(
    "s6_own_columns",
    """SELECT o_orderkey AS start_id, o_custkey AS reached_id, 1 AS hop, o_orderpriority AS predicates
FROM orders WHERE o_orderkey <> o_custkey""",
)
def _(spark, sf):
    cols = GraphColumns(src="o_orderkey", dst="o_custkey", label="o_orderpriority", src_type=None, dst_type=None)
    graph = Graph(table(spark, sf, "orders"), cols=cols)
    return views.downstream(graph, graph.edges.select(F.col("o_orderkey").alias("start_id")), 1).select(
        "start_id", "reached_id", "hop", F.array_join("predicates", ",").alias("predicates")
    )


@query("s7_write_result", f"WITH {FOREST} SELECT entity_id, community_id, community_size FROM communities")
def _(spark, sf):
    target = scratch_path(spark, "result")
    communities = results.components_as_communities(index_graph(forest(spark, sf)))
    write_result(communities.select("entity_id"), target)
    write_result(communities, target)
    return read_table(spark, target).select("entity_id", "community_id", "community_size")


@query(
    "s8_append_triplets",
    f"""WITH {FOREST} SELECT subject_id, predicate, object_id, object_type FROM forest WHERE predicate = 'IN_REGION'
UNION ALL SELECT subject_id, predicate, object_id, object_type FROM forest WHERE predicate = 'IN_NATION'""",
)
def _(spark, sf):
    target = scratch_path(spark, "triplets")
    rows = forest(spark, sf)
    append_triplets(rows.filter("predicate = 'IN_REGION'"), target)
    append_triplets(rows.filter("predicate = 'IN_NATION'"), target)
    return spark.read.parquet(target).select("subject_id", "predicate", "object_id", "object_type")


@query(
    "s9_empty_results",
    f"""WITH {MOVES} SELECT DISTINCT subject_id AS entity_id, CAST(NULL AS BIGINT) AS community_id,
CAST(NULL AS DOUBLE) AS pagerank FROM moves""",
)
def _(spark, sf):
    centrality, communities = empty_results(spark)
    ids = moves(spark, sf).select(F.col("subject_id").alias("entity_id")).distinct()
    return lookups.cluster_of_many(communities, ids).join(
        centrality.select("entity_id", "pagerank"), "entity_id", "left"
    )


# --- checks ------------------------------------------------------------------------------


@query(
    "v1_check_triplets",
    f"""WITH {MOVES}, bad AS (SELECT * REPLACE (nullif(predicate, 'VIEW') AS predicate,
  CAST(length(object_id) - 3 AS DOUBLE) AS confidence) FROM moves)
SELECT 'subject_id is null' AS rule, count(*) FILTER (WHERE subject_id IS NULL) AS n_bad FROM bad
UNION ALL SELECT 'predicate is null', count(*) FILTER (WHERE predicate IS NULL) FROM bad
UNION ALL SELECT 'object_id is null', count(*) FILTER (WHERE object_id IS NULL) FROM bad
UNION ALL SELECT 'confidence outside [0, 1]', count(*) FILTER (WHERE confidence < 0 OR confidence > 1) FROM bad""",
)
def _(spark, sf):
    rows = moves(spark, sf).withColumns(
        {
            "predicate": F.nullif("predicate", F.lit("VIEW")),
            "confidence": (F.length("object_id") - 3).cast("double"),
        }
    )
    return views.check_triplets(rows)


@query(
    "v2_missing_optional_columns",
    f"""WITH {MOVES} SELECT id, CAST(NULL AS VARCHAR) AS type, CAST(sum(o) AS BIGINT) AS out_degree
FROM (SELECT subject_id AS id, 1 AS o FROM moves UNION ALL SELECT object_id, 0 FROM moves) GROUP BY id""",
)
def _(spark, sf):
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        graph = Graph(moves(spark, sf).select("subject_id", "object_id"))
    return views.derive_nodes(graph).select("id", "type", "out_degree")


ORPHANS = f"""WITH {ORDERS_GRAPH}
SELECT 'source' AS side, count(*) AS n_orphans
FROM (SELECT DISTINCT subject_id AS id FROM placed) WHERE id NOT IN (SELECT id FROM known)
UNION ALL SELECT 'dest', count(*)
FROM (SELECT DISTINCT object_id AS id FROM placed) WHERE id NOT IN (SELECT id FROM known)"""


@query("v3_orphans", ORPHANS)
def _(spark, sf):
    return views.orphans(orders_graph(spark, sf))


@query("v4_require_edges", f"WITH {MOVES} SELECT count(*) AS n_edges, TRUE AS empty_rejected FROM moves")
def _(spark, sf):
    rows = moves(spark, sf)
    try:
        filters.require_edges(rows.filter("confidence > 2"))
        rejected = False
    except ValueError:
        rejected = True
    kept, _ = filters.require_edges(rows)
    return kept.agg(F.count(F.lit(1)).alias("n_edges")).withColumn(
        "empty_rejected", F.lit(rejected)
    )


@query(
    "v5_smoke_report",
    f"""WITH {FOREST},
hop1 AS (SELECT object_id AS reached FROM forest WHERE subject_id = 'C1'),
hop2 AS (SELECT f.object_id FROM hop1 JOIN forest f ON f.subject_id = hop1.reached)
SELECT 'nodes' AS object, count(*) AS n_rows FROM member
UNION ALL SELECT 'edges_enriched', count(*) FROM forest
UNION ALL SELECT 'node_degree', count(*) FROM member
UNION ALL SELECT 'downstream_khop', (SELECT count(*) FROM hop1) + (SELECT count(*) FROM hop2)
UNION ALL SELECT 'upstream_khop', 0""",
)
def _(spark, sf):
    return views.smoke_report(Graph(forest(spark, sf)), "C1")


# --- filters and projections ---------------------------------------------------------------


@query(
    "p1_min_confidence",
    f"WITH {MOVES} SELECT {', '.join(BRIEF)} FROM moves WHERE confidence IS NULL OR confidence >= 0.5",
)
def _(spark, sf):
    return filters.min_confidence(moves(spark, sf), 0.5).select(*BRIEF)


@query(
    "p2_exclude_agents",
    f"""WITH {MOVES} SELECT {', '.join(BRIEF)}, source_agent FROM moves
WHERE source_agent NOT IN ('graph_topology', 'ml_clustering', 'statistical_analysis')""",
)
def _(spark, sf):
    return filters.exclude_agents(moves(spark, sf), filters.ANNOTATING_AGENTS).select(*BRIEF, "source_agent")


@query(
    "p3_with_endpoints",
    f"""WITH {MOVES} SELECT subject_id, predicate, nullif(object_id, 'U1') AS object_id FROM moves
WHERE nullif(object_id, 'U1') IS NOT NULL""",
)
def _(spark, sf):
    holes = moves(spark, sf).withColumn("object_id", F.nullif("object_id", F.lit("U1")))
    return filters.with_endpoints(holes).select("subject_id", "predicate", "object_id")


@query(
    "p4_structural_edges",
    f"WITH {STRUCTURAL} SELECT subject_id, subject_type, object_id, object_type FROM structural",
)
def _(spark, sf):
    return filters.structural_edges(moves(spark, sf))


@query("p5_simple_edges", f"WITH {STRUCTURAL} SELECT src, dst FROM e")
def _(spark, sf):
    return filters.simple_edges(filters.structural_edges(moves(spark, sf)))


@query(
    "p6_edge_weight",
    f"""WITH {MOVES} SELECT subject_id, object_id, confidence,
round(greatest(coalesce(confidence, 1), 0.001), 6) AS weight FROM moves""",
)
def _(spark, sf):
    return rounded(
        moves(spark, sf).select(
            "subject_id", "object_id", "confidence", edge_weight(F.col("confidence")).alias("weight")
        ),
        "weight",
    )


@query("p7_high_confidence", f"WITH {MOVES} SELECT {', '.join(BRIEF)} FROM moves WHERE confidence >= 0.8")
def _(spark, sf):
    return filters.high_confidence(moves(spark, sf)).select(*BRIEF)


@query(
    "p8_edge_property",
    f"""WITH {MOVES} SELECT subject_id, object_id, properties ->> '$.k' AS k FROM moves
WHERE CAST(properties ->> '$.k' AS INTEGER) >= 50""",
)
def _(spark, sf):
    k = edge_property(F.col("properties"), "$.k")
    return moves(spark, sf).filter(k.cast("int") >= 50).select("subject_id", "object_id", k.alias("k"))


ENRICHED = """
ends AS (UNPIVOT (SELECT row_number() OVER () AS edge, subject_id, object_id FROM moves)
         ON subject_id, object_id INTO NAME side VALUE id),
deg AS (
  SELECT id, 'User' AS type, count(*) FILTER (side = 'subject_id') AS out_degree,
         count(*) FILTER (side = 'object_id') AS in_degree, count(*) AS degree
  FROM ends GROUP BY id
)"""


@query(
    "p9_prefixed_projection",
    f"""WITH {ORDERS_GRAPH}
SELECT p.subject_id, p.predicate, p.object_id, s.id AS source_id, s.type AS source_type, d.id AS dest_id,
       d.type AS dest_type
FROM placed p JOIN known s ON p.subject_id = s.id JOIN known d ON p.object_id = d.id""",
)
def _(spark, sf):
    return views.enriched_edges(orders_graph(spark, sf)).select(
        "subject_id", "predicate", "object_id", "source_id", "source_type", "dest_id", "dest_type"
    )


BUCKET = """CASE WHEN confidence >= 0.9 THEN '0.9-1.0' WHEN confidence >= 0.7 THEN '0.7-0.9'
WHEN confidence >= 0.5 THEN '0.5-0.7' ELSE '0.3-0.5' END"""


@query("p10_confidence_bucket", f"WITH {MOVES} SELECT subject_id, object_id, confidence, {BUCKET} AS bucket FROM moves")
def _(spark, sf):
    return moves(spark, sf).select(
        "subject_id", "object_id", "confidence", confidence_bucket(F.col("confidence")).alias("bucket")
    )


@query("p11_with_predicate", f"WITH {MOVES} SELECT {', '.join(BRIEF)} FROM moves WHERE predicate = 'PURCHASE'")
def _(spark, sf):
    return filters.with_predicate(moves(spark, sf), "PURCHASE").select(*BRIEF)


@query(
    "p12_edges_between_types",
    f"""WITH {FOREST} SELECT subject_id, object_id FROM forest
WHERE subject_type = 'Supplier' AND object_type = 'Nation'""",
)
def _(spark, sf):
    enriched = views.enriched_edges(Graph(forest(spark, sf)))
    return filters.edges_between_types(enriched, "Supplier", "Nation").select("subject_id", "object_id")


@query(
    "p13_edges_of",
    f"WITH {MOVES} SELECT {', '.join(BRIEF)} FROM moves WHERE subject_id = 'U1' OR object_id = 'U1'",
)
def _(spark, sf):
    return filters.edges_of(moves(spark, sf), "U1").select(*BRIEF)


@query(
    "p14_by_provenance",
    f"""WITH {MOVES} SELECT source_agent, source_method, count(*) AS n_edges,
round(avg(confidence), 6) AS avg_confidence FROM moves GROUP BY source_agent, source_method""",
)
def _(spark, sf):
    return rounded(filters.by_provenance(moves(spark, sf)), "avg_confidence")


@query(
    "p15_find_entities",
    f"""WITH {FOREST} SELECT id, entity_type AS type FROM member WHERE id LIKE '%1%' AND entity_type = 'Customer'""",
)
def _(spark, sf):
    nodes = views.derive_nodes(Graph(forest(spark, sf)))
    return filters.find_entities(nodes, "%1%", "Customer").select("id", "type")


# --- joins -------------------------------------------------------------------------------


@query(
    "j1_enriched_edges",
    f"""WITH {MOVES}, {ENRICHED}
SELECT m.subject_id, m.predicate, m.object_id, m.confidence,
       s.id AS source_id, s.type AS source_type, s.out_degree AS source_out_degree, s.in_degree AS source_in_degree,
       s.degree AS source_degree, d.id AS dest_id, d.type AS dest_type, d.out_degree AS dest_out_degree,
       d.in_degree AS dest_in_degree, d.degree AS dest_degree
FROM moves m JOIN deg s ON m.subject_id = s.id JOIN deg d ON m.object_id = d.id""",
)
def _(spark, sf):
    return views.enriched_edges(Graph(moves(spark, sf))).drop(
        "subject_type", "object_type", "source_agent", "source_method", "properties", "created_at"
    )


@query(
    "j2_fixed_hop_chain",
    f"""WITH {FOREST} SELECT a.subject_id AS start_id, b.object_id AS reached_id FROM forest a
JOIN forest b ON a.object_id = b.subject_id""",
)
def _(spark, sf):
    rows = forest(spark, sf)
    walks = views.downstream(Graph(rows), rows.select(F.col("subject_id").alias("start_id")), 2)
    return walks.filter("hop = 2").select("start_id", "reached_id")


@query(
    "j3_edges_touching",
    f"""WITH {MOVES}, ids AS (SELECT DISTINCT object_id AS id FROM moves WHERE subject_id = 'U1' AND confidence >= 0.7)
SELECT DISTINCT {', '.join(BRIEF)} FROM moves
WHERE subject_id IN (SELECT id FROM ids) OR object_id IN (SELECT id FROM ids)""",
)
def _(spark, sf):
    rows = moves(spark, sf).select(*BRIEF)
    ids = rows.filter("subject_id = 'U1' AND confidence >= 0.7").select(F.col("object_id").alias("node_id"))
    return traversal.edges_touching(rows, ids)


DEGREE_OWN_NODES = f"""WITH {ORDERS_GRAPH},
ends AS (UNPIVOT placed ON subject_id, object_id INTO NAME side VALUE id)
SELECT known.id, count(side) FILTER (side = 'subject_id') AS out_degree,
       count(side) FILTER (side = 'object_id') AS in_degree, count(side) AS total_degree
FROM known LEFT JOIN ends USING (id) GROUP BY known.id"""


@query("j4_left_join_to_zero", f"SELECT id, total_degree FROM ({DEGREE_OWN_NODES})")
def _(spark, sf):
    return views.node_degree(orders_graph(spark, sf)).select("id", "total_degree")


@query(
    "j5_left_anti",
    f"WITH {ORDERS_GRAPH} SELECT DISTINCT object_id AS id FROM placed WHERE object_id NOT IN (SELECT id FROM known)",
)
def _(spark, sf):
    graph = orders_graph(spark, sf)
    ends = graph.edges.select(graph.dst.alias("id")).distinct()
    return ends.join(graph.nodes.select("id"), "id", "left_anti")


@query(
    "j6_anchor_with_left_joins",
    f"""WITH {FOREST}
SELECT 'C1' AS entity_a, 'nobody' AS entity_b, community_id AS community_a, CAST(NULL AS BIGINT) AS community_b,
       CAST(NULL AS BOOLEAN) AS same_community, CAST(NULL AS BIGINT) AS community_size
FROM communities WHERE entity_id = 'C1'""",
)
def _(spark, sf):
    return lookups.shared_community(_forest_communities(spark, sf), "C1", "nobody")


def _forest_communities(spark, sf):
    return results.components_as_communities(index_graph(forest(spark, sf)))


@query("j7_result_assembly", f"WITH {FOREST} SELECT * FROM communities")
def _(spark, sf):
    return _forest_communities(spark, sf)


# --- aggregations ----------------------------------------------------------------------------


@query("a1_derive_nodes", f"WITH {MOVES}, {ENRICHED} SELECT * FROM deg")
def _(spark, sf):
    return views.derive_nodes(Graph(moves(spark, sf)))


@query(
    "a2_node_degree",
    f"WITH {MOVES}, {ENRICHED} SELECT id, out_degree, in_degree, degree AS total_degree FROM deg",
)
def _(spark, sf):
    return views.node_degree(Graph(moves(spark, sf)))


@query("a3_node_degree_own_nodes", DEGREE_OWN_NODES)
def _(spark, sf):
    return views.node_degree(orders_graph(spark, sf))


@query(
    "a4_undirected_degree",
    f"""WITH {STRUCTURAL}
SELECT v.id, count(und.dst) AS degree FROM v LEFT JOIN und ON v.id = und.src GROUP BY v.id""",
)
def _(spark, sf):
    rows = filters.structural_edges(moves(spark, sf))
    return statistics.undirected_degree(filters.simple_edges(rows), statistics.entity_types(rows))


@query("a5_entity_types", f"WITH {FOREST} SELECT id, entity_type FROM member")
def _(spark, sf):
    return statistics.entity_types(forest(spark, sf))


PREDICATE_STATS = f"""WITH {MOVES}
SELECT predicate, count(*) AS count, round(avg(confidence), 6) AS avg_confidence FROM moves GROUP BY predicate"""


@query("a6_predicate_stats", PREDICATE_STATS)
def _(spark, sf):
    return rounded(statistics.predicate_stats(moves(spark, sf)), "avg_confidence")


@query(
    "a7_type_stats",
    f"""WITH {FOREST} SELECT subject_type, count(*) AS count, CAST(1 AS DOUBLE) AS avg_confidence
FROM forest GROUP BY subject_type""",
)
def _(spark, sf):
    return rounded(statistics.type_stats(forest(spark, sf)), "avg_confidence")


@query(
    "a8_confidence_histogram",
    f"WITH {MOVES} SELECT {BUCKET} AS confidence_bucket, count(*) AS count FROM moves GROUP BY 1",
)
def _(spark, sf):
    return statistics.confidence_histogram(moves(spark, sf))


@query(
    "a9_build_summary",
    f"""WITH {MOVES}, s AS (
SELECT 'total' AS dimension, CAST(NULL AS VARCHAR) AS value, count(*) AS n, avg(confidence) AS a FROM moves
UNION ALL SELECT 'source_agent', source_agent, count(*), avg(confidence) FROM moves GROUP BY source_agent
UNION ALL SELECT 'source_method', source_method, count(*), avg(confidence) FROM moves GROUP BY source_method
UNION ALL SELECT 'predicate', predicate, count(*), avg(confidence) FROM moves GROUP BY predicate)
SELECT dimension, value, n, round(a, 6) AS avg_confidence FROM s""",
)
def _(spark, sf):
    return rounded(statistics.build_summary(moves(spark, sf)), "avg_confidence")


@query("a10_community_sizes", f"WITH {FOREST} SELECT entity_id, community_id, community_size FROM communities")
def _(spark, sf):
    members = _forest_communities(spark, sf).select("entity_id", "community_id")
    return lookups.with_community_size(members).select("entity_id", "community_id", "community_size")


LARGEST = f"""WITH {FOREST}
SELECT community_id, max(community_size) AS community_size, count(*) AS n_members FROM communities
GROUP BY community_id ORDER BY 2 DESC, 1 LIMIT 10"""


@query("a11_largest_communities", LARGEST)
def _(spark, sf):
    return lookups.largest_communities(_forest_communities(spark, sf))


@query(
    "a12_component_summary",
    f"""WITH {FOREST} SELECT count(*) AS n_components, max(size) AS giant_size,
round(max(size) / sum(size), 6) AS giant_share FROM grouped""",
)
def _(spark, sf):
    return rounded(lookups.component_summary(_forest_communities(spark, sf)), "giant_share")


@query(
    "a14_amount_stats",
    """SELECT o_orderpriority, count(*) AS count, round(avg(o_totalprice), 6) AS avg_amount,
max(o_totalprice) AS max_amount FROM orders GROUP BY 1""",
)
def _(spark, sf):
    return rounded(statistics.amount_stats(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice"), "avg_amount")


@query(
    "a15_shared_attributes",
    "SELECT p_name, p_brand, p_type, count(*) AS n_entities FROM part GROUP BY ALL HAVING count(*) > 1",
)
def _(spark, sf):
    return statistics.shared_attributes(table(spark, sf, "part"), ["p_name", "p_brand", "p_type"])


@query(
    "a16_shared_values",
    "SELECT props, count(DISTINCT user_id) AS n_entities FROM events GROUP BY 1 HAVING count(DISTINCT user_id) > 1",
)
def _(spark, sf):
    return statistics.shared_values(table(spark, sf, "events"), "props", "user_id")


@query("a17_frequency", "SELECT p_brand, count(*) AS count FROM part GROUP BY 1")
def _(spark, sf):
    return statistics.frequency(table(spark, sf, "part"), "p_brand")


PROFILE_U1 = f"""WITH {MOVES}
SELECT predicate, count(*) AS n_edges, round(avg(confidence), 6) AS avg_confidence FROM moves
WHERE (subject_id = 'U1' OR object_id = 'U1') AND confidence >= 0.3 GROUP BY predicate"""
RELATIONS_U1 = f"""WITH {MOVES}
SELECT predicate, count(*) AS n_edges FROM moves WHERE subject_id = 'U1' OR object_id = 'U1' GROUP BY predicate"""


@query("a18_entity_profile", PROFILE_U1)
def _(spark, sf):
    return rounded(statistics.entity_profile(moves(spark, sf), "U1", 0.3), "avg_confidence")


@query("a19_entity_relations", RELATIONS_U1)
def _(spark, sf):
    return statistics.entity_relations(moves(spark, sf), "U1")


# --- top-k -----------------------------------------------------------------------------------

TOP_HUBS = f"""WITH {MOVES}, {ENRICHED}
SELECT id, in_degree, out_degree, degree AS total_degree FROM deg ORDER BY degree DESC, id LIMIT 10"""


@query("w2_top_hubs", TOP_HUBS)
def _(spark, sf):
    return lookups.top_hubs(views.node_degree(Graph(moves(spark, sf))))


ISOLATED = f"SELECT * FROM ({DEGREE_OWN_NODES}) WHERE total_degree = 0"


@query("w3_isolated", ISOLATED)
def _(spark, sf):
    return lookups.isolated(views.node_degree(orders_graph(spark, sf)))


@query(
    "w4_ordered_limits",
    f"""WITH {MOVES}, n AS (
SELECT predicate, object_id AS neighbor_id, object_type AS neighbor_type, 'out' AS direction, confidence
FROM moves WHERE subject_id = 'U2'
UNION ALL SELECT predicate, subject_id, subject_type, 'in', confidence FROM moves WHERE object_id = 'U2')
SELECT * FROM n ORDER BY confidence DESC NULLS LAST, predicate, neighbor_id, direction, neighbor_type LIMIT 500""",
)
def _(spark, sf):
    return traversal.neighbors(moves(spark, sf), "U2")


@query(
    "w7_sample_rows",
    f"WITH {MOVES} SELECT {', '.join(BRIEF)} FROM moves ORDER BY 1, 2, 3, 4 NULLS FIRST LIMIT 50",
)
def _(spark, sf):
    return lookups.sample_rows(moves(spark, sf).select(*BRIEF))


# --- set operations ----------------------------------------------------------------------------


@query(
    "u1_undirected",
    f"WITH {MOVES} SELECT subject_id AS src, object_id AS dst FROM moves UNION SELECT object_id, subject_id FROM moves",
)
def _(spark, sf):
    return filters.undirected(moves(spark, sf))


@query(
    "u2_union_of_edge_rows",
    f"""WITH {MOVES}
SELECT subject_id, subject_type, predicate, object_id, object_type, confidence, 1 AS hop FROM moves
WHERE subject_id = 'U3' OR object_id = 'U3'
UNION SELECT subject_id, subject_type, predicate, object_id, object_type, confidence, 1 AS hop FROM moves
WHERE subject_id = 'U3'""",
)
def _(spark, sf):
    return traversal.subgraph_edges(moves(spark, sf), "U3", 1)


@query(
    "u3_union_all_of_endpoints",
    f"""WITH {MOVES} SELECT id, count(*) AS n
FROM (SELECT subject_id AS id FROM moves UNION ALL SELECT object_id FROM moves) GROUP BY id""",
)
def _(spark, sf):
    return views.derive_nodes(Graph(moves(spark, sf))).select("id", F.col("degree").alias("n"))


@query(
    "u4_distinct_pairs",
    f"""WITH {STRUCTURAL} SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM e""",
)
def _(spark, sf):
    return statistics.undirected_pairs(filters.simple_edges(filters.structural_edges(moves(spark, sf))))


# --- scalar functions ----------------------------------------------------------------------------


@query(
    "f1_concat_ws",
    f"WITH {MOVES} SELECT concat_ws(' -> ', subject_id, source_agent, object_id) AS path FROM moves",
)
def _(spark, sf):
    return moves(spark, sf).select(path_text(F.col("subject_id"), F.col("source_agent"), F.col("object_id")).alias("path"))


@query(
    "f2_array",
    f"WITH {MOVES} SELECT array_to_string([subject_id, object_id], '|') AS nodes FROM moves",
)
def _(spark, sf):
    return moves(spark, sf).select(F.array_join(F.array("subject_id", "object_id"), "|").alias("nodes"))


@query(
    "f3_array_append",
    f"WITH {MOVES} SELECT array_to_string(list_append([subject_id, object_id], predicate), '|') AS nodes FROM moves",
)
def _(spark, sf):
    nodes = F.array_append(F.array("subject_id", "object_id"), F.col("predicate"))
    return moves(spark, sf).select(F.array_join(nodes, "|").alias("nodes"))


@query(
    "f4_array_contains",
    f"""WITH {MOVES} SELECT subject_id, object_id FROM moves
WHERE NOT list_contains(['U1', 'U2', subject_id], object_id)""",
)
def _(spark, sf):
    seen = F.array(F.lit("U1"), F.lit("U2"), F.col("subject_id"))
    return moves(spark, sf).filter(~F.array_contains(seen, F.col("object_id"))).select("subject_id", "object_id")


@query(
    "f5_least_greatest",
    f"""WITH {MOVES} SELECT least(subject_id, object_id) AS a, greatest(subject_id, object_id) AS b,
least(confidence, 0.5) AS capped FROM moves""",
)
def _(spark, sf):
    return moves(spark, sf).select(
        F.least("subject_id", "object_id").alias("a"),
        F.greatest("subject_id", "object_id").alias("b"),
        F.least("confidence", F.lit(0.5)).alias("capped"),
    )


@query(
    "f6_coalesce_cast",
    f"""WITH {MOVES} SELECT subject_id, coalesce(source_agent, 'none') AS agent,
CAST(coalesce(properties ->> '$.k', '0') AS BIGINT) AS k FROM moves""",
)
def _(spark, sf):
    return moves(spark, sf).select(
        "subject_id",
        F.coalesce("source_agent", F.lit("none")).alias("agent"),
        F.coalesce(edge_property(F.col("properties"), "$.k"), F.lit("0")).cast("long").alias("k"),
    )


@query(
    "f7_case_when",
    f"""WITH {MOVES} SELECT object_id, CASE WHEN subject_id = 'U1' THEN object_id ELSE subject_id END AS other
FROM moves WHERE subject_id = 'U1' OR object_id = 'U1'""",
)
def _(spark, sf):
    return filters.edges_of(moves(spark, sf), "U1").select(
        "object_id", F.when(F.col("subject_id") == "U1", F.col("object_id")).otherwise(F.col("subject_id")).alias("other")
    )


@query(
    "f8_in_not_in",
    f"""WITH {MOVES} SELECT subject_id, object_id, source_agent FROM moves
WHERE subject_id IN ('U1', 'U2', 'U3') AND source_agent NOT IN ('relationship') AND object_id <> 'U4'""",
)
def _(spark, sf):
    kept = F.col("subject_id").isin("U1", "U2", "U3") & ~F.col("source_agent").isin("relationship")
    return moves(spark, sf).filter(kept & (F.col("object_id") != "U4")).select("subject_id", "object_id", "source_agent")


@query(
    "f9_json",
    f"WITH {MOVES} SELECT subject_id, CAST(properties ->> '$.k' AS BIGINT) AS k FROM moves",
)
def _(spark, sf):
    return moves(spark, sf).select("subject_id", F.from_json("properties", "k BIGINT")["k"].alias("k"))


@query(
    "f10_fixed_now",
    f"""WITH {MOVES} SELECT subject_id,
CAST(date_diff('day', CAST(created_at AS DATE), DATE '2030-01-01') AS INTEGER) AS age_days FROM moves""",
)
def _(spark, sf):
    now = F.lit(NOW).cast("timestamp")
    return moves(spark, sf).select("subject_id", F.date_diff(now, F.col("created_at")).alias("age_days"))


@query(
    "f11_numeric_coercion",
    f"""WITH {MOVES} SELECT predicate, greatest(coalesce(TRY_CAST(source_method AS DOUBLE), 1), 0.001) AS weight
FROM moves""",
)
def _(spark, sf):
    return moves(spark, sf).select("predicate", edge_weight(F.col("source_method")).alias("weight"))


@query(
    "f12_hour",
    f"WITH {MOVES} SELECT CAST(hour(created_at) AS INTEGER) AS hour, count(*) AS n FROM moves GROUP BY 1",
)
def _(spark, sf):
    return moves(spark, sf).groupBy(F.hour("created_at").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


# --- incremental -----------------------------------------------------------------------------------


@query(
    "i1_new_triplets",
    f"""WITH {MOVES} SELECT subject_id, predicate, object_id, strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at,
(SELECT strftime(max(created_at), '%Y-%m-%d %H:%M:%S.%f') FROM moves) AS next_since
FROM moves WHERE created_at > TIMESTAMP '{SINCE}'""",
)
def _(spark, sf):
    rows = moves(spark, sf)
    fresh = incremental.new_triplets(rows, F.lit(SINCE).cast("timestamp"))
    mark = incremental.high_water_mark(fresh).withColumn("one", F.lit(1))
    # The mark is one row.
    marked = fresh.withColumn("one", F.lit(1)).join(F.broadcast(mark), "one")
    return as_text(
        marked.select("subject_id", "predicate", "object_id", "created_at", "next_since"), "created_at", "next_since"
    )


@query(
    "i2_stream_triplets",
    f"""WITH {MOVES} SELECT subject_id, predicate, object_id, confidence,
strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at FROM moves""",
)
def _(spark, sf):
    source, target, state = (scratch_path(spark, name) for name in ("arriving", "streamed", "stream-state"))
    rows = moves(spark, sf)
    newer = F.col("event_hour") >= 12
    halves = rows.withColumn("event_hour", F.hour("created_at"))
    append_triplets(halves.filter(newer).drop("event_hour"), source)
    incremental.stream_triplets(spark, source, target, state).awaitTermination()
    # The second run brings older rows than any seen before, and all others once more.
    append_triplets(halves.filter(~newer).drop("event_hour").unionByName(rows), source)
    incremental.stream_triplets(spark, source, target, state).awaitTermination()
    return as_text(spark.read.parquet(target).select(*BRIEF, "created_at"), "created_at")
