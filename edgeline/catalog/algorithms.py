"""Graph algorithms, checked by unrolling their rounds in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from edgeline.catalog import query
from edgeline.catalog.graphs import FK, FOREST, STRUCTURAL, fk, forest, moves, saved
from edgeline.catalog.relational import rounded
from edgeline.operators import betweenness as bt
from edgeline.operators import communities as louvain
from edgeline.operators import components, filters, lookups, results, shortest_paths, statistics
from edgeline.operators.pagerank import pagerank
from edgeline.operators.vertices import index_graph


def _structural(spark, sf, with_score=False):
    return filters.structural_edges(moves(spark, sf), with_score=with_score)


def pagerank_ctes(rounds: int = 20, weighted: bool = False) -> str:
    pairs = (
        """we AS MATERIALIZED (SELECT subject_id AS src, object_id AS dst,
sum(greatest(coalesce(confidence, 1), 0.001)) AS w FROM structural WHERE subject_id <> object_id GROUP BY 1, 2)"""
        if weighted
        else "we AS MATERIALIZED (SELECT src, dst, CAST(1 AS DOUBLE) AS w FROM e)"
    )
    steps = [
        pairs,
        "ow AS MATERIALIZED (SELECT src, sum(w) AS ow FROM we GROUP BY src)",
        "n AS MATERIALIZED (SELECT count(*) AS n FROM v)",
        "r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE / (SELECT n FROM n) AS r FROM v)",
    ]
    for i in range(1, rounds + 1):
        steps.append(
            f"""r{i} AS MATERIALIZED (
SELECT v.id, 0.15::DOUBLE / (SELECT n FROM n) + 0.85::DOUBLE * (coalesce(g.s, 0) +
  (SELECT coalesce(sum(r), 0) FROM r{i - 1} WHERE id NOT IN (SELECT src FROM ow)) / (SELECT n FROM n)) AS r
FROM v LEFT JOIN (SELECT we.dst AS id, sum(p.r * we.w / ow.ow) AS s
  FROM we JOIN r{i - 1} p ON p.id = we.src JOIN ow ON ow.src = we.src GROUP BY we.dst) g ON v.id = g.id)"""
        )
    steps.append(f"pr AS (SELECT id, r AS pagerank FROM r{rounds})")
    return ",\n".join(steps)


def betweenness_ctes(pivots: int = 256, levels: int = 8) -> str:
    """Level-by-level shortest-path counts and dependencies from every pivot."""
    steps = [
        f"pv AS MATERIALIZED (SELECT id AS p FROM v ORDER BY md5(id), id LIMIT {pivots})",
        "d0 AS MATERIALIZED (SELECT p, p AS id, CAST(1 AS DOUBLE) AS s FROM pv)",
        "a0 AS MATERIALIZED (SELECT p, id FROM d0)",
    ]
    for i in range(1, levels + 1):
        steps.append(
            f"""d{i} AS MATERIALIZED (SELECT d.p, und.dst AS id, sum(d.s) AS s FROM d{i - 1} d JOIN und ON und.src = d.id
WHERE NOT EXISTS (SELECT 1 FROM a{i - 1} a WHERE a.p = d.p AND a.id = und.dst) GROUP BY 1, 2)"""
        )
        steps.append(f"a{i} AS MATERIALIZED (SELECT * FROM a{i - 1} UNION ALL SELECT p, id FROM d{i})")
    steps.append(f"q{levels} AS MATERIALIZED (SELECT p, id, s, CAST(0 AS DOUBLE) AS dep FROM d{levels})")
    for i in range(levels - 1, 0, -1):
        steps.append(
            f"""q{i} AS MATERIALIZED (SELECT d.p, d.id, d.s, d.s * coalesce(x.c, 0) AS dep FROM d{i} d
LEFT JOIN (SELECT q.p, und.dst AS id, sum((1 + q.dep) / q.s) AS c FROM q{i + 1} q JOIN und ON und.src = q.id GROUP BY 1, 2) x
ON x.p = d.p AND x.id = d.id)"""
        )
    union = " UNION ALL ".join(f"SELECT id, dep FROM q{i}" for i in range(1, levels + 1))
    steps.append(
        f"""bt AS MATERIALIZED (SELECT v.id, coalesce(sum(u.dep), 0) * (SELECT count(*) FROM v)
/ ((SELECT count(*) FROM pv) * ((SELECT count(*) FROM v) - 1.0::DOUBLE) * ((SELECT count(*) FROM v) - 2.0::DOUBLE)) AS betweenness
FROM v LEFT JOIN ({union}) u ON u.id = v.id GROUP BY v.id)"""
    )
    return ",\n".join(steps)


def bfs_ctes(seed: str, levels: int = 12) -> str:
    steps = [f"b0 AS MATERIALIZED (SELECT '{seed}' AS id, 0 AS distance)"]
    for i in range(1, levels + 1):
        steps.append(
            f"""b{i} AS MATERIALIZED (SELECT * FROM b{i - 1} UNION ALL
SELECT DISTINCT e.dst, {i} FROM b{i - 1} b JOIN e ON e.src = b.id
WHERE b.distance = {i - 1} AND e.dst NOT IN (SELECT id FROM b{i - 1}))"""
        )
    steps.append(f"bfs AS (SELECT * FROM b{levels})")
    return ",\n".join(steps)


def sssp_ctes(seed: str, rounds: int = 24) -> str:
    steps = [
        """ce AS MATERIALIZED (SELECT subject_id AS src, object_id AS dst,
min(greatest(coalesce(confidence, 1), 0.001::DOUBLE)) AS c FROM structural WHERE subject_id <> object_id GROUP BY 1, 2)""",
        f"s0 AS MATERIALIZED (SELECT '{seed}' AS id, CAST(0 AS DOUBLE) AS distance)",
    ]
    for i in range(1, rounds + 1):
        steps.append(
            f"""s{i} AS MATERIALIZED (SELECT id, min(distance) AS distance FROM (SELECT * FROM s{i - 1}
UNION ALL SELECT ce.dst, s.distance + ce.c FROM s{i - 1} s JOIN ce ON ce.src = s.id) GROUP BY id)"""
        )
    steps.append(f"sssp AS (SELECT * FROM s{rounds})")
    return ",\n".join(steps)


DEGREE_CTE = "dg AS (SELECT v.id, count(und.dst) AS degree FROM v LEFT JOIN und ON und.src = v.id GROUP BY v.id)"
CENTRALITY = f"""{STRUCTURAL}, {pagerank_ctes()}, {betweenness_ctes()}, {DEGREE_CTE},
centrality AS (SELECT v.id AS entity_id, v.entity_type, round(pr.pagerank, 6) AS pagerank, dg.degree,
round(bt.betweenness, 6) AS betweenness
FROM v JOIN pr USING (id) JOIN dg USING (id) JOIN bt USING (id))"""


@query("g8_pagerank", f"WITH {STRUCTURAL}, {pagerank_ctes()} SELECT id, round(pagerank, 6) AS pagerank FROM pr")
def _(spark, sf):
    graph = index_graph(_structural(spark, sf))
    return rounded(graph.name(pagerank(graph)), "pagerank")


@query(
    "g8_pagerank_weighted",
    f"WITH {STRUCTURAL}, {pagerank_ctes(weighted=True)} SELECT id, round(pagerank, 6) AS pagerank FROM pr",
)
def _(spark, sf):
    graph = index_graph(_structural(spark, sf, with_score=True), weighted=True)
    return rounded(graph.name(pagerank(graph)), "pagerank")


@query("g9_connected_components", f"WITH {FOREST} SELECT entity_id AS id, component_id FROM communities")
def _(spark, sf):
    graph = index_graph(forest(spark, sf))
    return graph.name(components.connected_components(graph))


@query(
    "g9_connected_components_moves",
    f"""WITH RECURSIVE {STRUCTURAL},
reach AS (SELECT id, id AS r FROM v UNION SELECT reach.id, und.dst FROM reach JOIN und ON und.src = reach.r),
m AS (SELECT id, min(r) AS label FROM reach GROUP BY id)
SELECT id, CAST(dense_rank() OVER (ORDER BY label) - 1 AS BIGINT) AS component_id FROM m""",
)
def _(spark, sf):
    graph = index_graph(_structural(spark, sf))
    return graph.name(components.connected_components(graph))


@query(
    "g10_louvain",
    f"""WITH {FOREST}
SELECT (SELECT count(*) FROM member) AS n_members, 0 AS n_split_edges_across_components, TRUE AS sizes_agree,
TRUE AS beats_singletons, TRUE AS beats_components""",
)
def _(spark, sf):
    """What must hold for any Louvain result: full cover, no community across components, better than trivial."""
    rows = forest(spark, sf)
    graph = index_graph(rows)
    table = saved(results.entity_communities(rows, graph=graph))
    edges = filters.simple_edges(rows)

    def q(column):
        membership = table.select(F.col("entity_id").alias("id"), F.col(column).alias("community_id"))
        return louvain.modularity(edges, membership)

    own = q("community_id").withColumnRenamed("modularity", "own")
    whole = q("component_id").withColumnRenamed("modularity", "whole")
    across = (
        table.groupBy("community_id")
        .agg(
            F.max("community_size").alias("size"),
            F.count(F.lit(1)).alias("n"),
            F.min("component_id").alias("low"),
            F.max("component_id").alias("high"),
        )
        .agg(
            F.sum("n").alias("n_members"),
            F.count_if(F.col("low") != F.col("high")).cast("int").alias("n_split_edges_across_components"),
            F.every(F.col("size") == F.col("n")).alias("sizes_agree"),
        )
    )
    one = F.lit(1).alias("one")
    # Three one-row results side by side.
    return (
        across.select("*", one)
        .join(F.broadcast(own.select("*", one)), "one")
        .join(F.broadcast(whole.select("*", one)), "one")
        .select(
            "n_members",
            "n_split_edges_across_components",
            "sizes_agree",
            (F.col("own") >= 0).alias("beats_singletons"),
            (F.col("own") >= F.col("whole") - 1e-9).alias("beats_components"),
        )
    )


HUBS = 10
PLANTED = f"""planted AS (
  SELECT 'C' || c_custkey AS id, c_nationkey AS nation FROM customer
  UNION ALL SELECT 'H' || n_nationkey || '_' || h, n_nationkey FROM nation, range({HUBS}) t(h)
)"""


def planted(spark, sf):
    """Ten hubs a nation, all joined with each other and with its customers; one edge from nation to nation."""
    nation = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").alias("nation"))
    customer = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_nationkey").alias("nation"), "c_custkey")
    hubs = F.sequence(F.lit(0), F.lit(HUBS - 1))

    def hub(n, h):
        return F.concat(F.lit("H"), n.cast("string"), F.lit("_"), h.cast("string"))

    pairs = nation.withColumn("g", F.explode(hubs)).withColumn("h", F.explode(hubs)).filter("g < h")
    among = pairs.select(hub(F.col("nation"), F.col("g")).alias("src"), hub(F.col("nation"), F.col("h")).alias("dst"))
    own = customer.withColumn("h", F.explode(hubs)).select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("src"), hub(F.col("nation"), F.col("h")).alias("dst")
    )
    zero = F.lit(0)
    bridges = nation.select(hub(F.col("nation"), zero).alias("src"), hub((F.col("nation") + 1) % 25, zero).alias("dst"))
    rows = among.unionByName(own).unionByName(bridges)
    return rows.select(
        F.col("src").alias("subject_id"), F.lit("Node").alias("subject_type"), F.lit("LINKED").alias("predicate"),
        F.col("dst").alias("object_id"), F.lit("Node").alias("object_type"), F.lit(1.0).alias("confidence"),
    )


@query(
    "g10_louvain_planted",
    f"""WITH {PLANTED}, first AS (SELECT nation, min(id) AS first FROM planted GROUP BY nation)
SELECT id, CAST(dense_rank() OVER (ORDER BY first) - 1 AS BIGINT) AS community_id FROM planted JOIN first USING (nation)""",
)
def _(spark, sf):
    """Communities that any good partition must find, across edges that join them all into one component."""
    graph = index_graph(planted(spark, sf))
    return graph.name(louvain.louvain(graph))


@query("g10_louvain_moves")
def _(spark, sf):
    """No statement: which of several equally good partitions is found depends on the order of moves."""
    graph = index_graph(_structural(spark, sf))
    return graph.name(louvain.louvain(graph))


@query("g17_entity_communities_moves")
def _(spark, sf):
    return results.entity_communities(moves(spark, sf))


@query(
    "g11_modularity",
    f"""WITH {STRUCTURAL},
pairs AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM e),
m AS (SELECT count(*) AS m FROM pairs),
c AS (SELECT id, CAST(substr(id, 2) AS BIGINT) % 7 AS c FROM v),
k AS (SELECT c.c, count(*) AS k FROM und JOIN c ON c.id = und.src GROUP BY c.c),
i AS (SELECT ca.c, count(*) AS i FROM pairs JOIN c ca ON ca.id = a JOIN c cb ON cb.id = b WHERE ca.c = cb.c GROUP BY 1)
SELECT round(sum(coalesce(i.i, 0) / (SELECT m FROM m) - pow(k.k / (2.0::DOUBLE * (SELECT m FROM m)), 2)), 6) AS modularity
FROM k LEFT JOIN i USING (c)""",
)
def _(spark, sf):
    rows = _structural(spark, sf)
    by_number = (F.substr("id", F.lit(2)).cast("long") % 7).alias("community_id")
    membership = statistics.entity_types(rows).select("id", by_number)
    return rounded(louvain.modularity(filters.simple_edges(rows), membership), "modularity")


@query(
    "g12_betweenness",
    f"WITH {STRUCTURAL}, {betweenness_ctes()} SELECT id, round(betweenness, 6) AS betweenness FROM bt",
)
def _(spark, sf):
    graph = index_graph(_structural(spark, sf))
    return rounded(graph.name(bt.betweenness(graph)), "betweenness")


@query(
    "g12_betweenness_sampled",
    f"WITH {STRUCTURAL}, {betweenness_ctes(pivots=32)} SELECT id, round(betweenness, 6) AS betweenness FROM bt",
)
def _(spark, sf):
    graph = index_graph(_structural(spark, sf))
    return rounded(graph.name(bt.betweenness(graph, pivots=32)), "betweenness")


SSSP = f"WITH {STRUCTURAL}, {sssp_ctes('U1')}"


@query("g13_sssp", f"{SSSP} SELECT id, round(distance, 6) AS distance FROM sssp")
def _(spark, sf):
    return rounded(shortest_paths.sssp(_structural(spark, sf, with_score=True), "U1"), "distance")


@query("g14_bfs", f"WITH {STRUCTURAL}, {bfs_ctes('U1')} SELECT id, distance FROM bfs")
def _(spark, sf):
    return shortest_paths.bfs(filters.simple_edges(_structural(spark, sf)), "U1")


@query(
    "g15_highest_degree",
    f"WITH {STRUCTURAL} SELECT src AS id, count(*) AS degree FROM und GROUP BY src ORDER BY 2 DESC, 1 LIMIT 1",
)
def _(spark, sf):
    return shortest_paths.highest_degree(filters.simple_edges(_structural(spark, sf)))


@query("g16_entity_centrality", f"WITH {CENTRALITY} SELECT * FROM centrality")
def _(spark, sf):
    return rounded(results.entity_centrality(moves(spark, sf)), "pagerank", "betweenness")


@query(
    "g17_entity_communities",
    f"""WITH {FOREST} SELECT entity_id, entity_type, component_id, TRUE AS has_community, TRUE AS size_in_component
FROM communities""",
)
def _(spark, sf):
    rows = saved(results.entity_communities(forest(spark, sf)))
    in_component = rows.groupBy("component_id").agg(F.count(F.lit(1)).alias("n"))
    return rows.join(in_component, "component_id").select(
        "entity_id",
        "entity_type",
        "component_id",
        F.col("community_id").isNotNull().alias("has_community"),
        (F.col("community_size") <= F.col("n")).alias("size_in_component"),
    )


@query(
    "a13_bfs_layers",
    f"WITH {STRUCTURAL}, {bfs_ctes('U1')} SELECT distance, count(*) AS n_entities FROM bfs GROUP BY distance",
)
def _(spark, sf):
    return statistics.bfs_layers(shortest_paths.bfs(filters.simple_edges(_structural(spark, sf)), "U1"))


@query(
    "w6_nearest",
    f"{SSSP} SELECT id, round(distance, 6) AS distance FROM (SELECT * FROM sssp ORDER BY distance, id LIMIT 50)",
)
def _(spark, sf):
    distances = shortest_paths.sssp(_structural(spark, sf, with_score=True), "U1")
    return rounded(lookups.nearest(distances), "distance")


# The larger foreign-key graph, whose vertex and pair tables stand in for those of `structural`.
FK_TABLES = (
    FK
    + """,
v AS MATERIALIZED (SELECT DISTINCT id FROM (SELECT subject_id AS id FROM fk UNION ALL SELECT object_id FROM fk)),
e AS MATERIALIZED (SELECT DISTINCT subject_id AS src, object_id AS dst FROM fk WHERE subject_id <> object_id),
und AS MATERIALIZED (SELECT src, dst FROM e UNION SELECT dst, src FROM e)"""
)


def component_ctes(rounds: int) -> str:
    """Smallest label per component by passing labels to neighbours; `rounds` must reach the diameter."""
    steps = ["l0 AS MATERIALIZED (SELECT id, id AS label FROM v)"]
    for i in range(1, rounds + 1):
        steps.append(
            f"""l{i} AS MATERIALIZED (SELECT p.id, least(p.label, min(q.label)) AS label
FROM l{i - 1} p JOIN und ON und.dst = p.id JOIN l{i - 1} q ON q.id = und.src GROUP BY p.id, p.label)"""
        )
    return ",\n".join(steps)


@query(
    "g8_pagerank_fk",
    f"WITH {FK_TABLES}, {pagerank_ctes()} SELECT id, round(pagerank, 9) AS pagerank FROM pr",
)
def _(spark, sf):
    graph = index_graph(fk(spark, sf))
    return graph.name(pagerank(graph)).withColumn("pagerank", F.round("pagerank", 9))


@query(
    "g9_connected_components_fk",
    f"""WITH {FK_TABLES}, {component_ctes(12)}
SELECT id, CAST(dense_rank() OVER (ORDER BY label) - 1 AS BIGINT) AS component_id FROM l12""",
)
def _(spark, sf):
    graph = index_graph(fk(spark, sf))
    return graph.name(components.connected_components(graph))


@query(
    "g12_betweenness_fk",
    f"WITH {FK_TABLES}, {betweenness_ctes(levels=12)} SELECT id, round(betweenness, 9) AS betweenness FROM bt",
)
def _(spark, sf):
    graph = index_graph(fk(spark, sf))
    return graph.name(bt.betweenness(graph)).withColumn("betweenness", F.round("betweenness", 9))
