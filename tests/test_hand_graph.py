"""Every operator's result on the hand graph, worked out by hand."""

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from edgeline.functions.sql_functions import FUNCTION_NAMES, register_functions
from edgeline.operators import filters, lookups, results, shortest_paths, statistics, traversal, views
from edgeline.operators.betweenness import betweenness
from edgeline.operators.communities import louvain_labels, modularity
from edgeline.operators.components import connected_components
from edgeline.operators.pagerank import pagerank
from edgeline.operators.vertices import index_graph
from edgeline.schema import Graph


@pytest.fixture(scope="module")
def indexed(hand):
    return index_graph(filters.structural_edges(hand))


def test_derived_nodes(hand):
    nodes = views.derive_nodes(Graph(hand)).select("id", "type", "out_degree", "in_degree", "degree")
    assert sorted(tuples(nodes)) == [
        ("a", "P", 3, 1, 4),
        ("b", "P", 2, 2, 4),
        ("c", "P", 3, 2, 5),
        ("d", "P", 1, 1, 2),
        ("g1", "Cluster", 0, 1, 1),
        ("m", "P", 1, 1, 2),
        ("n", "Q", 1, 1, 2),
        ("x", "A", 0, 2, 2),
    ]


def test_structural_edges_drop_annotations_and_unknown_agents(hand):
    assert filters.structural_edges(hand).count() == 9
    assert filters.structural_edges(hand, excluded=()).count() == 11


def test_confidence_floors_differ_on_unknown(hand):
    assert filters.min_confidence(hand, 0.8).count() == 5
    assert filters.high_confidence(hand, 0.8).count() == 4


def test_neighbors(hand):
    assert tuples(traversal.neighbors(hand, "c")) == [
        ("SELF", "c", "P", "in", 0.8),
        ("SELF", "c", "P", "out", 0.8),
        ("KNOWS", "b", "P", "in", 0.7),
        ("KNOWS", "a", "P", "out", 0.5),
        ("KNOWS", "d", "P", "out", 0.29),
    ]


ONE = [("b", 1), ("c", 1), ("x", 1)]
THREE = [*ONE, ("d", 2), ("g1", 3)]


@pytest.mark.parametrize(("k", "expected"), [(0, []), (1, ONE), (2, THREE[:-1]), (3, THREE), (9, THREE), (None, THREE)])
def test_khop(spark, hand, k, expected):
    assert tuples(traversal.khop(hand, "a", k)) == expected
    register_functions(spark, hand)
    call = "SELECT * FROM khop('a', %s) ORDER BY hops, neighbor_id" % ("NULL" if k is None else k)
    if k == 9:
        with pytest.raises(Exception, match="registered for 6 hops"):
            spark.sql(call).collect()
        register_functions(spark, hand, max_hops=9)
        assert tuples(spark.sql(call)) == expected
    else:
        assert tuples(spark.sql(call)) == expected


def test_khop_of_many_anchors(spark, hand):
    ids = spark.createDataFrame([("a",), ("m",), ("nobody",)], "entity_id string")
    expected = sorted([("a", *r) for r in THREE] + [("m", "n", 1)])
    assert sorted(tuples(traversal.khop_of(hand, ids, 3))) == expected


PATHS = [(2, "a -> c -> d"), (3, "a -> b -> c -> d"), (4, "a -> x -> b -> c -> d")]


def test_connection_paths(spark, hand):
    assert tuples(traversal.connection_paths(hand, "a", "d")) == PATHS
    assert tuples(traversal.connection_paths(hand, "a", "m")) == []
    assert tuples(traversal.connection_paths(hand, "c", "c", 1)) == [(1, "c -> c")]
    loops = tuples(traversal.connection_paths(hand, "a", "a", 2))
    assert loops == [(2, "a -> b -> a"), (2, "a -> c -> a"), (2, "a -> x -> a")]
    register_functions(spark, hand)
    for a, b in ("ad", "aa", "cc", "am"):
        by_sql = tuples(spark.sql(f"SELECT * FROM connection_path('{a}', '{b}') ORDER BY hops, path"))
        assert by_sql == tuples(traversal.connection_paths(hand, a, b))


def test_functions_take_columns(spark, hand):
    register_functions(spark, hand, max_path_hops=5)
    ids = spark.createDataFrame([("a",), ("m",), ("d",), ("nobody",)], "entity_id string")
    ids.createOrReplaceTempView("asked")
    for k in (1, 3, 5):
        got = spark.sql(f"SELECT i.entity_id, n.* FROM asked i, LATERAL khop(i.entity_id, {k}) n")
        assert sorted(tuples(got)) == sorted(tuples(traversal.khop_of(hand, ids, k)))
        got = spark.sql(f"SELECT i.entity_id, n.* FROM asked i, LATERAL subgraph_edges(i.entity_id, {k}) n")
        assert sorted(tuples(got), key=str) == sorted(tuples(traversal.subgraph_edges_of(hand, ids, k)), key=str)
    pairs = spark.createDataFrame([("a", "d"), ("a", "m"), ("c", "c"), ("x", "g1")], "a string, b string")
    pairs.createOrReplaceTempView("pairs")
    got = spark.sql("SELECT p.a, p.b, n.* FROM pairs p, LATERAL connection_path(p.a, p.b) n")
    assert sorted(tuples(got)) == sorted(tuples(traversal.connection_paths_of(hand, pairs, 5)))
    spark.sql("SELECT entity_id, IF(entity_id = 'a', 2, 1) AS k FROM asked").createOrReplaceTempView("depths")
    got = spark.sql("SELECT i.entity_id, n.* FROM depths i, LATERAL khop(i.entity_id, i.k) n WHERE i.entity_id IN ('a', 'm')")
    assert sorted(tuples(got)) == sorted([("a", *r) for r in THREE[:-1]] + [("m", "n", 1)])


def test_longer_paths_and_many_pairs(spark, hand):
    chain = spark.createDataFrame([(f"p{i}", f"p{i + 1}") for i in range(6)], "subject_id string, object_id string")
    assert tuples(traversal.connection_paths(chain, "p0", "p5", 5)) == [(5, " -> ".join(f"p{i}" for i in range(6)))]
    assert tuples(traversal.connection_paths(chain, "p0", "p6", 5)) == []
    assert tuples(traversal.khop(chain, "p0", 5))[-1] == ("p5", 5)
    assert tuples(traversal.connection_paths(hand, "a", "d", limit=2)) == PATHS[:2]
    pairs = spark.createDataFrame([("a", "d"), ("a", "m"), ("c", "c"), ("a", "d")], "a string, b string")
    got = sorted(tuples(traversal.connection_paths_of(hand, pairs)))
    assert got == sorted([("a", "d", *r) for r in PATHS] + [("c", "c", *tuple(r)) for r in tuples(traversal.connection_paths(hand, "c", "c"))])


def test_subgraphs_of_many(spark, hand):
    ids = spark.createDataFrame([("a",), ("m",)], "entity_id string")
    got = tuples(traversal.subgraph_edges_of(hand, ids, None).select("entity_id", "subject_id", "object_id", "hop"))
    assert ("a", "d", "g1", 3) in got and ("m", "m", "n", 1) in got
    assert sorted(r[1:] for r in got if r[0] == "a") == sorted(
        tuples(traversal.subgraph_edges(hand, "a", None).select("subject_id", "object_id", "hop"))
    )


def test_downstream(hand):
    walks = views.downstream(Graph(hand), "a", 3).select("hop", F.array_join("path", ">").alias("path"))
    expected = [(1, "a>b")] * 2 + [(1, "a>x")] + [(2, "a>b>c")] * 2 + [(2, "a>b>x")] * 2 + [(3, "a>b>c>d")] * 2
    assert sorted(tuples(walks)) == expected


def test_upstream_is_downstream_of_the_reversed_graph(hand):
    swapped = hand.withColumns({"subject_id": F.col("object_id"), "object_id": F.col("subject_id")})
    up = views.upstream(Graph(hand), "c", 2).select("start_id", "reached_id", "hop", "path", "predicates")
    down = views.downstream(Graph(swapped), "c", 2).select("start_id", "reached_id", "hop", "path", "predicates")
    assert sorted(tuples(up), key=str) == sorted(tuples(down), key=str)


def test_subgraph(spark, hand):
    one = tuples(traversal.subgraph_edges(hand, "a", 1).select("subject_id", "object_id", "hop"))
    assert one == [("a", "b", 1), ("a", "b", 1), ("a", "x", 1), ("c", "a", 1)]
    assert tuples(traversal.subgraph_edges(hand, "a", 0).select("subject_id", "object_id", "hop")) == one
    two = tuples(traversal.subgraph_edges(hand, "a", 2).select("subject_id", "object_id", "hop"))
    assert two == one + [("b", "c", 2), ("b", "x", 2), ("c", "c", 2), ("c", "d", 2)]
    register_functions(spark, hand)
    by_sql = spark.sql("SELECT subject_id, object_id, hop FROM subgraph_edges('a', NULL) ORDER BY ALL")
    assert sorted(tuples(by_sql)) == sorted(two)


def test_connects_falls_back_to_the_other_direction(hand):
    found = traversal.connects(Graph(hand), "d", "a").select("direction", F.array_join("path", ">").alias("path"))
    assert tuples(found) == [("reverse", "a>b>c>d")] * 2


def test_undirected_degree(hand):
    rows = filters.structural_edges(hand)
    degree = statistics.undirected_degree(filters.simple_edges(rows), statistics.entity_types(rows))
    expected = [("a", 2), ("b", 3), ("c", 2), ("d", 1), ("m", 1), ("n", 1), ("x", 2)]
    assert sorted(tuples(degree.select("id", "degree"))) == expected


def test_pagerank(indexed):
    ranks = {i: r for i, r in tuples(indexed.name(pagerank(indexed)).select("id", "pagerank"))}
    expected = dict(a=0.045997, b=0.065552, c=0.073868, d=0.108811, m=0.306175, n=0.306175, x=0.093423)
    assert ranks == pytest.approx(expected, abs=1e-6)
    assert sum(ranks.values()) == pytest.approx(1.0)


def test_components_and_modularity(hand, indexed):
    components = indexed.name(connected_components(indexed))
    assert dict(tuples(components.select("id", "component_id"))) == dict(a=0, b=0, c=0, d=0, x=0, m=1, n=1)
    edges = filters.simple_edges(filters.structural_edges(hand))
    score = modularity(edges, components.withColumnRenamed("component_id", "community_id")).first()[0]
    assert score == pytest.approx(0.277778, abs=1e-6)


def test_louvain_finds_the_best_partition(hand, indexed):
    labels, quality = louvain_labels(indexed)
    named = tuples(indexed.name(labels).groupBy("label").agg(F.array_join(F.sort_array(F.collect_list("id")), "")))
    assert sorted(n[1] for n in named) == ["abx", "cd", "mn"]
    assert quality == pytest.approx(0.402778, abs=1e-6)


def test_betweenness(indexed):
    scores = dict(tuples(indexed.name(betweenness(indexed)).select("id", "betweenness")))
    expected = dict(a=0.0, b=0.266667, c=0.2, d=0.0, m=0.0, n=0.0, x=0.0)
    assert scores == pytest.approx(expected, abs=1e-6)
    batched = dict(tuples(indexed.name(betweenness(indexed, batch=3)).select("id", "betweenness")))
    assert batched == pytest.approx(expected, abs=1e-6)


def test_distances(hand):
    rows = filters.structural_edges(hand, with_score=True)
    assert dict(tuples(shortest_paths.bfs(filters.simple_edges(rows), "a"))) == dict(a=0, b=1, x=1, c=2, d=3)
    costs = dict(tuples(shortest_paths.sssp(rows, "a")))
    assert costs == pytest.approx(dict(a=0.0, b=0.4, x=0.9, c=1.1, d=1.39))
    assert shortest_paths.default_seed(filters.simple_edges(rows)) == "b"


def test_shared_community_keeps_unknowns(spark, hand, indexed):
    communities = results.components_as_communities(indexed).persist()
    register_functions(spark, hand, None, communities)
    expected = {
        ("a", "b"): ("a", "b", 0, 0, True, 5),
        ("a", "m"): ("a", "m", 0, 1, False, None),
        ("a", "zz"): ("a", "zz", 0, None, None, None),
        ("zz", "a"): ("zz", "a", None, 0, False, None),
    }
    for (a, b), row in expected.items():
        assert tuples(lookups.shared_community(communities, a, b)) == [row]
        assert tuples(spark.sql(f"SELECT * FROM shared_community('{a}', '{b}')")) == [row]
    assert spark.sql("SELECT cluster_of('zz')").first()[0] is None
    assert spark.sql("SELECT cluster_of('m')").first()[0] == 1


def test_top_central(spark, hand):
    rows = [(f"e{i}", "P", i / 5, i, None) for i in range(5)]
    columns = "entity_id string, entity_type string, pagerank double, degree bigint, betweenness double"
    centrality = spark.createDataFrame(rows, columns)
    register_functions(spark, hand, centrality)
    for n, size in ((2, 2), (0, 0), (-1, 0), (5000, 5)):
        assert lookups.top_central_entities(centrality, n).count() == size
        assert spark.sql(f"SELECT * FROM top_central_entities({n})").count() == size


def test_functions_answer_before_any_result_exists(spark, hand):
    assert register_functions(spark, hand) == FUNCTION_NAMES
    assert spark.sql("SELECT * FROM top_central_entities(5)").count() == 0
    assert spark.sql("SELECT * FROM members_of_cluster(CAST(-1 AS BIGINT))").count() == 0
    assert spark.sql("SELECT * FROM neighbors('nobody')").count() == 0
    lateral = spark.sql(
        "SELECT i.id, n.neighbor_id FROM VALUES ('m'), ('d') i(id), LATERAL neighbors(i.id) n ORDER BY 1, 2"
    )
    assert tuples(lateral) == [("d", "c"), ("d", "g1"), ("m", "n"), ("m", "n")]


def test_empty_structural_graph_is_an_error(hand):
    with pytest.raises(ValueError):
        index_graph(hand.filter("confidence > 5"))


@pytest.mark.parametrize("delta", [None, 0.05, 100.0])
def test_shortest_paths_agree_at_any_step(spark, delta):
    import heapq
    import random

    rng = random.Random(4)
    rows = [(f"v{rng.randrange(40)}", f"v{rng.randrange(40)}", rng.choice([0.05, 0.3, 0.9, 1.0])) for _ in range(160)]
    df = spark.createDataFrame(rows, "subject_id string, object_id string, confidence double")
    best, heap = {}, [(0.0, "v0")]
    while heap:
        d, v = heapq.heappop(heap)
        if v not in best:
            best[v] = d
            heap += [(d + w, b) for a, b, w in rows if a == v and b != v]
            heapq.heapify(heap)
    got = dict(tuples(shortest_paths.sssp(df, "v0", delta=delta)))
    assert {v: round(d, 9) for v, d in got.items()} == {v: round(d, 9) for v, d in best.items()}
