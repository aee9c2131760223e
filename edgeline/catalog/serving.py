"""SQL functions, result lookups and the analyst questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgeline.catalog import query
from edgeline.catalog.algorithms import CENTRALITY
from edgeline.catalog.graphs import FK, FOREST, MOVES, fk, forest, moves, orders_graph, saved
from edgeline.catalog.relational import (
    ISOLATED,
    LARGEST,
    PREDICATE_STATS,
    PROFILE_U1,
    RELATIONS_U1,
    TOP_HUBS,
    rounded,
)
from edgeline.catalog.traversal import (
    connects_sql,
    khop_sql,
    neighbors_sql,
    paths_sql,
    subgraph_sql,
    walks_sql,
    walks_text,
)
from edgeline.functions.sql_functions import register_functions
from edgeline.operators import lookups, results
from edgeline.operators.vertices import index_graph
from edgeline.plans import analyst
from edgeline.schema import Graph


def _call(spark, statement, triplets, centrality=None, communities=None):
    register_functions(spark, saved(triplets), centrality, communities)
    return spark.sql(statement)


def _communities(spark, sf):
    return results.components_as_communities(index_graph(forest(spark, sf)))


def _centrality(spark, sf):
    return rounded(results.entity_centrality(moves(spark, sf)), "pagerank", "betweenness")


@query("t1_neighbors", neighbors_sql("U5"))
def _(spark, sf):
    return _call(spark, "SELECT * FROM neighbors('U5')", moves(spark, sf))


@query("t2_khop", khop_sql(MOVES, "moves", "U5", 2))
def _(spark, sf):
    return _call(spark, "SELECT * FROM khop('U5', 2)", moves(spark, sf))


@query("t3_connection_path", paths_sql(FK, "fk", "C2", "S2"))
def _(spark, sf):
    return _call(spark, "SELECT * FROM connection_path('C2', 'S2')", fk(spark, sf))


@query("t4_subgraph_edges", subgraph_sql("U5", 2))
def _(spark, sf):
    return _call(spark, "SELECT * FROM subgraph_edges('U5', 2)", moves(spark, sf))


@query("t2_khop_five", khop_sql(FK, "fk", "S2", 5))
def _(spark, sf):
    return _call(spark, "SELECT * FROM khop('S2', 5)", fk(spark, sf))


NATIONS_KHOP = f"""WITH RECURSIVE {FOREST},
und AS (SELECT subject_id AS src, object_id AS dst FROM forest UNION SELECT object_id, subject_id FROM forest),
near AS (
  SELECT id AS entity_id, id AS node, 0 AS hops FROM member WHERE entity_type = 'Nation'
  UNION SELECT entity_id, dst, hops + 1 FROM near JOIN und ON src = node WHERE hops < 3
)
"""


@query(
    "t2_khop_lateral",
    NATIONS_KHOP
    + """SELECT entity_id, node AS neighbor_id, CAST(min(hops) AS INTEGER) AS hops FROM near
WHERE node <> entity_id GROUP BY ALL""",
)
def _(spark, sf):
    statement = """SELECT n.id AS entity_id, k.neighbor_id, k.hops
FROM (SELECT id FROM kg_nodes WHERE type = 'Nation') n, LATERAL khop(n.id, 3) k"""
    return _call(spark, statement, forest(spark, sf))


@query(
    "t3_connection_path_lateral",
    f"""WITH {FOREST}
SELECT f.subject_id AS a, g.object_id AS b, CAST(2 AS INTEGER) AS hops,
f.subject_id || ' -> ' || f.object_id || ' -> ' || g.object_id AS path
FROM forest f JOIN forest g ON g.subject_id = f.object_id WHERE f.subject_id LIKE 'S%'""",
)
def _(spark, sf):
    statement = """SELECT p.a, p.b, c.hops, c.path
FROM (SELECT f.subject_id AS a, g.object_id AS b FROM kg_triplets f JOIN kg_triplets g ON g.subject_id = f.object_id
      WHERE f.subject_id LIKE 'S%') p, LATERAL connection_path(p.a, p.b) c"""
    return _call(spark, statement, forest(spark, sf))


@query(
    "t4_subgraph_lateral",
    NATIONS_KHOP
    + """SELECT entity_id, subject_id, predicate, object_id, CAST(min(hops) + 1 AS INTEGER) AS hop
FROM near JOIN forest ON node IN (subject_id, object_id) WHERE hops < 2 GROUP BY ALL""",
)
def _(spark, sf):
    statement = """SELECT n.id AS entity_id, e.subject_id, e.predicate, e.object_id, e.hop
FROM (SELECT id FROM kg_nodes WHERE type = 'Nation') n, LATERAL subgraph_edges(n.id, 2) e"""
    return _call(spark, statement, forest(spark, sf))


@query(
    "t5_cluster_of",
    f"WITH {FOREST} SELECT entity_id, community_id FROM communities WHERE entity_type = 'Supplier'",
)
def _(spark, sf):
    communities = saved(_communities(spark, sf))
    register_functions(spark, forest(spark, sf), None, communities)
    return spark.sql(
        "SELECT s.entity_id, cluster_of(s.entity_id) AS community_id FROM kg_communities s WHERE s.entity_type = 'Supplier'"
    )


@query(
    "t5_cluster_of_many",
    f"""WITH {FOREST} SELECT i.id AS entity_id, community_id
FROM (SELECT 'S' || s_suppkey AS id FROM supplier UNION ALL SELECT 'X' || s_suppkey FROM supplier) i
LEFT JOIN communities ON entity_id = i.id""",
)
def _(spark, sf):
    suppliers = spark.read.parquet(f"{sf}/supplier.parquet")
    ids = suppliers.select(F.explode(F.array(*[F.concat(F.lit(p), "s_suppkey") for p in "SX"])).alias("entity_id"))
    return lookups.cluster_of_many(_communities(spark, sf), ids)


MEMBERS = f"""WITH {FOREST} SELECT entity_id, entity_type, community_size FROM communities WHERE community_id = %s"""


@query("t6_members_of_cluster", MEMBERS % 0)
def _(spark, sf):
    return _call(
        spark, "SELECT * FROM members_of_cluster(CAST(0 AS BIGINT))", forest(spark, sf), None, _communities(spark, sf)
    )


TOP_CENTRAL = f"WITH {CENTRALITY} SELECT * FROM centrality ORDER BY pagerank DESC, entity_id LIMIT %d"


@query("t7_top_central_entities", TOP_CENTRAL % 25)
def _(spark, sf):
    return _call(spark, "SELECT * FROM top_central_entities(25)", moves(spark, sf), _centrality(spark, sf))


@query("w1_top_central", TOP_CENTRAL % 1000)
def _(spark, sf):
    return lookups.top_central_entities(_centrality(spark, sf), 1000)


@query(
    "t8_shared_community",
    f"""WITH {FOREST} SELECT a.entity_id AS entity_a, 'R0' AS entity_b, a.community_id AS community_a,
b.community_id AS community_b, a.community_id = b.community_id AS same_community,
CASE WHEN a.community_id = b.community_id THEN a.community_size END AS community_size
FROM communities a, communities b WHERE b.entity_id = 'R0' AND a.entity_type = 'Nation'""",
)
def _(spark, sf):
    communities = saved(_communities(spark, sf))
    statement = """SELECT s.* FROM kg_communities c, LATERAL shared_community(c.entity_id, 'R0') s
WHERE c.entity_type = 'Nation'"""
    return _call(spark, statement, forest(spark, sf), None, communities)


@query(
    "t1_neighbors_lateral",
    f"""WITH {FOREST}, nb AS (SELECT subject_id AS id, predicate, object_id AS neighbor_id, object_type AS neighbor_type,
'out' AS direction FROM forest UNION ALL SELECT object_id, predicate, subject_id, subject_type, 'in' FROM forest)
SELECT nb.* FROM nb JOIN member USING (id) WHERE entity_type = 'Nation'""",
)
def _(spark, sf):
    statement = """SELECT c.entity_id AS id, n.predicate, n.neighbor_id, n.neighbor_type, n.direction
FROM kg_communities c, LATERAL neighbors(c.entity_id) n WHERE c.entity_type = 'Nation'"""
    return _call(spark, statement, forest(spark, sf), None, saved(_communities(spark, sf)))


@query(
    "t6_members_of_own_cluster",
    f"""WITH {FOREST} SELECT s.entity_id AS asked, m.entity_id, m.entity_type FROM communities s
JOIN communities m USING (community_id) WHERE s.entity_type = 'Nation'""",
)
def _(spark, sf):
    statement = """SELECT c.entity_id AS asked, m.entity_id, m.entity_type
FROM kg_communities c, LATERAL members_of_cluster(c.community_id) m WHERE c.entity_type = 'Nation'"""
    return _call(spark, statement, forest(spark, sf), None, saved(_communities(spark, sf)))


@query(
    "t9_downstream",
    walks_sql("subject_id", "object_id", "U5", 3)
    + """SELECT start_id, reached_id, hop, array_to_string(path, ' -> ') AS path, array_to_string(predicates, ',') AS predicates
FROM walks WHERE hop > 0""",
)
def _(spark, sf):
    return walks_text(_call(spark, "SELECT * FROM downstream('U5')", moves(spark, sf)))


@query("t9_hubs_by_view", TOP_HUBS)
def _(spark, sf):
    statement = """SELECT id, in_degree, out_degree, total_degree FROM kg_node_degree
ORDER BY total_degree DESC, id LIMIT 10"""
    return _call(spark, statement, moves(spark, sf))


@query(
    "t9_edges_by_view",
    f"""WITH {FOREST} SELECT f.subject_id, s.entity_type AS source_type, f.object_id, d.entity_type AS dest_type
FROM forest f JOIN member s ON s.id = f.subject_id JOIN member d ON d.id = f.object_id""",
)
def _(spark, sf):
    return _call(spark, "SELECT subject_id, source_type, object_id, dest_type FROM kg_edges_enriched", forest(spark, sf))


# --- analyst questions -------------------------------------------------------------------------


@query("x1_biggest_hubs", TOP_HUBS)
def _(spark, sf):
    return analyst.biggest_hubs(Graph(moves(spark, sf)))


@query(
    "x2_reachable_from",
    walks_sql("subject_id", "object_id", "U7", 3)
    + "SELECT reached_id, hop, array_to_string(path, ' -> ') AS path FROM walks WHERE hop > 0",
)
def _(spark, sf):
    walks = analyst.reachable_from(Graph(saved(moves(spark, sf))), "U7")
    return walks.withColumn("path", F.array_join("path", " -> "))


@query("x3_what_connects", connects_sql("U1", "U2", 3))
def _(spark, sf):
    found = analyst.what_connects(Graph(saved(moves(spark, sf))), "U1", "U2")
    return found.select(
        "start_id",
        "reached_id",
        "hop",
        F.array_join("path", " -> ").alias("path"),
        F.array_join("predicates", ",").alias("predicates"),
        "direction",
    )


@query("x4_relations_by_predicate", RELATIONS_U1)
def _(spark, sf):
    return analyst.relations_by_predicate(Graph(moves(spark, sf)), "U1")


@query("x5_predicate_overview", PREDICATE_STATS)
def _(spark, sf):
    return rounded(analyst.predicate_overview(Graph(moves(spark, sf))), "avg_confidence")


@query("x6_isolated_entities", ISOLATED)
def _(spark, sf):
    return analyst.isolated_entities(orders_graph(spark, sf))


@query("x7_confident_relations", PROFILE_U1)
def _(spark, sf):
    return rounded(analyst.confident_relations(Graph(moves(spark, sf)), "U1", 0.3), "avg_confidence")


@query("x8_largest_communities", LARGEST)
def _(spark, sf):
    return analyst.largest_communities(_communities(spark, sf))


@query("x9_most_central", TOP_CENTRAL % 10)
def _(spark, sf):
    return analyst.most_central(_centrality(spark, sf))


@query(
    "x10_same_cluster",
    f"""WITH {FOREST} SELECT entity_id, entity_type, community_size FROM communities
WHERE community_id = (SELECT community_id FROM communities WHERE entity_id = 'S1')""",
)
def _(spark, sf):
    return analyst.same_cluster(_communities(spark, sf), "S1")
