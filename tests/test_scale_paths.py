"""The code paths for hot keys and large frontiers, forced on small data and compared with plain results."""

import random
import sys

import pytest
from conftest import SF, tuples
from pyspark.sql import functions as F

import __spark_entry__ as entry
from edgeline import runtime
from edgeline.operators import communities, components, extraction, traversal, vertices, views
from edgeline.operators.betweenness import betweenness
from edgeline.operators.pagerank import pagerank
from edgeline.operators.vertices import index_vertices_edges
from edgeline.schema import Graph


@pytest.fixture(scope="module")
def hub_graph(spark):
    """A hub with a third of all edges, chains, and random pairs."""
    rng = random.Random(7)
    pairs = {("hub", f"v{i:03d}") for i in range(60)}
    pairs |= {(f"v{i:03d}", f"v{i + 1:03d}") for i in range(60, 100)}
    while len(pairs) < 180:
        a, b = rng.sample(range(110), 2)
        pairs.add((f"v{a:03d}", f"v{b:03d}"))
    edges = spark.createDataFrame(sorted(pairs), "src string, dst string").withColumn("weight", F.lit(1.0))
    ids = sorted({x for p in pairs for x in p} | {"alone"})
    nodes = spark.createDataFrame([(i, "T") for i in ids], "id string, entity_type string")
    return nodes, edges, ids, pairs


@pytest.fixture
def tiny_slices(monkeypatch):
    for module in (runtime, vertices):
        monkeypatch.setattr(module, "SLICE_ROWS", 7)
    monkeypatch.setattr(runtime.hot_keys, "__defaults__", (7,))
    monkeypatch.setattr(vertices.Adjacency.__init__, "__defaults__", (7,))


def expected_components(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def expected_pagerank(ids, pairs, rounds):
    n = len(ids)
    out = {i: [b for a, b in pairs if a == i] for i in ids}
    rank = dict.fromkeys(ids, 1 / n)
    for _ in range(rounds):
        dangling = sum(rank[i] for i in ids if not out[i])
        new = dict.fromkeys(ids, 0.15 / n + 0.85 * dangling / n)
        for i in ids:
            for b in out[i]:
                new[b] += 0.85 * rank[i] / len(out[i])
        rank = new
    return rank


def test_lookup_spreads_hot_keys(spark, tiny_slices):
    rows = spark.range(100).select(F.when(F.col("id") < 40, 0).otherwise(F.col("id")).alias("k"), "id")
    table = spark.range(0, 100, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("value"))
    assert tuples(runtime.hot_keys(rows, "k")) == [(0, 6)]
    for how in ("left", "inner", "left_semi"):
        got = runtime.lookup(rows, "k", table, by=F.col("id"), how=how)
        want = rows.join(table, "k", how)
        assert sorted(tuples(got), key=str) == sorted(tuples(want.select(*got.columns)), key=str)


def test_dense_index(spark):
    words = [f"w{i:04d}" for i in range(500)]
    random.Random(1).shuffle(words)
    numbered, n = runtime.dense_index(spark.createDataFrame([(w,) for w in words], "w string"), "w", "i")
    assert n == 500
    assert sorted((i, w) for w, i in tuples(numbered.select("w", "i"))) == list(enumerate(sorted(words)))


def test_algorithms_with_sliced_hub(hub_graph, tiny_slices):
    nodes, edges, ids, pairs = hub_graph
    graph = index_vertices_edges(nodes, edges)
    sliced = vertices.Adjacency(graph.edges, graph.n_edges, "src", "dst")
    assert sliced.hot is not None
    got = dict(tuples(graph.name(pagerank(graph, rounds=5)).select("id", "pagerank")))
    assert got == pytest.approx(expected_pagerank(ids, pairs, 5))
    labels = graph.name(components.smallest_member(graph)).join(
        graph.vertices.select(F.col("vid").alias("label"), F.col("id").alias("first")), "label"
    )
    assert dict(tuples(labels.select("id", "first"))) == expected_components(ids, pairs)


def test_louvain_invariants(hub_graph):
    nodes, edges, ids, pairs = hub_graph
    graph = index_vertices_edges(nodes, edges)
    labels, quality = communities.louvain_labels(graph)
    named = graph.name(labels).withColumnRenamed("label", "community_id")
    assert named.count() == len(ids)
    own = communities.modularity(edges, named).first()[0]
    assert own == pytest.approx(quality)
    whole = expected_components(ids, pairs)
    members = {}
    for i, c in tuples(named.select("id", "community_id")):
        members.setdefault(c, set()).add(whole[i])
    assert all(len(roots) == 1 for roots in members.values())
    assert quality > 0.3


def test_betweenness_against_counting_paths(hub_graph):
    nodes, edges, ids, pairs = hub_graph
    graph = index_vertices_edges(nodes, edges)
    near = {i: set() for i in ids}
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    score = dict.fromkeys(ids, 0.0)
    for s in ids:
        dist, paths, order = {s: 0}, {s: 1.0}, [s]
        for u in order:
            for w in near[u]:
                if w not in dist:
                    dist[w], paths[w] = dist[u] + 1, 0.0
                    order.append(w)
                if dist[w] == dist[u] + 1:
                    paths[w] += paths[u]
        dep = dict.fromkeys(order, 0.0)
        for w in reversed(order):
            for u in near[w]:
                if dist[u] == dist[w] - 1:
                    dep[u] += paths[u] / paths[w] * (1 + dep[w])
            if w != s:
                score[w] += dep[w]
    n = len(ids)
    want = {i: v / ((n - 1) * (n - 2)) for i, v in score.items()}
    got = dict(tuples(graph.name(betweenness(graph)).select("id", "betweenness")))
    assert got == pytest.approx(want)


def test_large_frontiers_shuffle_to_the_same_result(spark, hub_graph, monkeypatch):
    _, edges, _, _ = hub_graph
    triplets = edges.select(
        F.col("src").alias("subject_id"),
        F.lit("T").alias("subject_type"),
        F.lit("L").alias("predicate"),
        F.col("dst").alias("object_id"),
        F.lit("T").alias("object_type"),
        F.col("weight").alias("confidence"),
    ).persist()

    def run():
        return [
            tuples(traversal.khop(triplets, "v060", 3)),
            tuples(traversal.connection_paths(triplets, "hub", "v070")),
            tuples(traversal.subgraph_edges(triplets, "v061", 2)),
            sorted(tuples(views.downstream(Graph(triplets), "hub")), key=str),
        ]

    small = run()
    monkeypatch.setattr(runtime.broadcast_if_small, "__defaults__", (-1,))
    monkeypatch.setattr(traversal, "BROADCAST_BYTES", -1)
    assert run() == small
    khop = dict(small[0])
    assert set(dict(tuples(traversal.khop(triplets, "v060", 2)))) <= set(khop)


def test_peak_rate_against_brute_force(spark):
    rng = random.Random(3)
    events = [(rng.choice("aaab"), rng.randrange(0, 4000)) for _ in range(300)]
    df = spark.createDataFrame(events, "who string, second int").select("who", F.timestamp_seconds("second").alias("ts"))
    want = {
        w: max(sum(1 for x, s in events if x == w and t - 60 <= s <= t) for v, t in events if v == w)
        for w in {w for w, _ in events}
    }
    assert dict(tuples(extraction.peak_rate(df, "who", "ts", 60))) == want


def test_shared_attributes_stay_linear(spark):
    df = spark.createDataFrame([(i, "same" if i < 50 else f"own{i}") for i in range(80)], "id int, address string")
    links = extraction.shared_attribute_triplets(df, F.col("id"), "Person", [F.col("address")], "address")
    assert links.count() == 50
    assert {r[0] for r in tuples(links.select("object_id"))} == {"same"}


def test_small_graphs_are_kept_in_few_partitions(spark):
    """rounds over a few edges started a task for every shuffle partition."""
    edges = spark.range(100).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit(1.0).alias("weight"))
    few = vertices.Adjacency(edges, 100, "src", "dst")
    assert few.edges.rdd.getNumPartitions() == 1
    many = vertices.Adjacency(edges, 100, "src", "dst", slice_rows=100)
    assert many.edges.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.fixture
def written_rows(monkeypatch):
    """The rows of every table the traversal operators write."""
    rows, write = [], traversal.materialize

    def counted(df, **metrics):
        table, seen = write(df, **metrics)
        rows.append(seen["rows"])
        return table, seen

    monkeypatch.setattr(traversal, "materialize", counted)
    return rows


@pytest.fixture(scope="module")
def two_hubs(spark):
    """Two hubs with 60 leaves each under one top, a chord that gives two leaves a second way, and a parallel edge."""
    rows = [(f"{h}{i}", h) for h in "xy" for i in range(60)] + [("x", "top"), ("y", "top"), ("x1", "y1"), ("x1", "x")]
    return spark.createDataFrame(rows, "subject_id string, object_id string"), rows


def _simple_paths(rows, a, b, k):
    near = {}
    for s, o in rows:
        near.setdefault(s, set()).add(o)
        near.setdefault(o, set()).add(s)
    grown, found = [[a]], set()
    for _ in range(k):
        grown = [[*p, n] for p in grown for n in near[p[-1]] if n not in p or (n == b == a and len(p) > 1)]
        found |= {(a, b, len(p) - 1, " -> ".join(p)) for p in grown if p[-1] == b}
        grown = [p for p in grown if p[-1] != b]
    return found


@pytest.mark.parametrize("k", [2, 3, 4, 5])
def test_paths_of_many_pairs_leave_out_dead_ends(spark, two_hubs, written_rows, k):
    """every pair wrote all leaves of the hubs it met."""
    edges, rows = two_hubs
    asked = [(f"{h}{i}", "y") for h in "xy" for i in range(60)] + [("x1", "y1"), ("y", "x2"), ("x", "x")]
    for pairs in (asked, [(b, a) for a, b in asked]):
        written_rows.clear()
        got = tuples(traversal.connection_paths_of(edges, spark.createDataFrame(pairs, "a string, b string"), k))
        want = set().union(*[_simple_paths(rows, a, b, k) for a, b in pairs])
        assert len(got) == len(set(got)) and set(got) == want
        assert k > 4 or max(written_rows) < 1500


def test_khop_of_alike_anchors_searches_once(spark, two_hubs, written_rows):
    """every anchor wrote all it reaches, also where the next one reaches the same."""
    edges, rows = two_hubs
    ids = [f"{h}{i}" for h in "xy" for i in range(60)]
    got = tuples(traversal.khop_of(edges, spark.createDataFrame([(i,) for i in ids], "entity_id string"), 3))
    assert max(written_rows) < 1000
    want = set()
    for i in ids:
        for node, hops in tuples(traversal.khop(edges, i, 3)):
            want.add((i, node, hops))
        if i in ("x3", "y1"):
            assert {(n, h) for e, n, h in got if e == i} == {(n, h) for e, n, h in want if e == i}
        if i == "x5":
            break
    assert {g for g in got if g[0] in {w[0] for w in want}} == want and len(got) == len(set(got))


@pytest.mark.parametrize("name", ["t2_khop_lateral", "t4_subgraph_lateral"])
def test_lateral_calls_search_from_the_asked_nodes_only(spark, name):
    """the filter stood above the call, which was worked out for every node."""
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("= Nation)") >= 2


def test_pagerank_ends_with_the_longest_walk(spark, monkeypatch):
    """Graphs without long walks take a step for each edge of the longest; the others take all rounds."""
    ids = [f"v{i}" for i in range(12)]
    pairs = {(f"v{i}", f"v{j}") for i in range(8) for j in (8, 9)} | {("v8", "v10"), ("v10", "v11")}
    nodes = spark.createDataFrame([(i, "T") for i in ids], "id string, entity_type string")
    edges = spark.createDataFrame(sorted(pairs), "src string, dst string").withColumn("weight", F.lit(1.0))
    graph = index_vertices_edges(nodes, edges)
    module, written = sys.modules[pagerank.__module__], []
    write = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, **metrics: written.append(1) or write(df, **metrics))
    got = {r["id"]: r["pagerank"] for r in graph.name(pagerank(graph, rounds=20)).collect()}
    assert len(written) <= 6
    assert got == pytest.approx(expected_pagerank(ids, pairs, 20), abs=1e-12)


@pytest.mark.parametrize("order", ["line", "mixed"])
def test_components_halve_each_round(spark, monkeypatch, order):
    """Long lines are joined in few rounds, and a graph that one round joins has no other."""
    n = 200
    at = list(range(n))
    if order == "mixed":
        random.Random(3).shuffle(at)
    pairs = {(f"v{at[i]:03d}", f"v{at[i + 1]:03d}") for i in range(n - 1) if i != 120}
    ids = [f"v{i:03d}" for i in range(n)] + ["x"]
    nodes = spark.createDataFrame([(i, "T") for i in ids], "id string, entity_type string")
    edges = spark.createDataFrame(sorted(pairs), "src string, dst string").withColumn("weight", F.lit(1.0))
    rounds = []
    roots = components._roots

    def counted(between, n_edges):
        rounds.append(n_edges)
        return roots(between, n_edges)

    monkeypatch.setattr(components, "_roots", counted)
    graph = index_vertices_edges(nodes, edges)
    named = graph.vertices.select("vid", "id")
    label = named.toDF("label", "smallest")
    got = dict(tuples(graph.name(components.smallest_member(graph)).join(label, "label").select("id", "smallest")))
    assert got == expected_components(ids, pairs)
    assert rounds[0] == len(pairs) and all(2 * b <= a for a, b in zip(rounds, rounds[1:]))
    assert len(rounds) == 1 if order == "line" else len(rounds) <= 8


def test_hops_with_large_frontiers_shuffle_the_pairs_once(spark, hub_graph, monkeypatch):
    """Two or more hops left over a frontier that is not broadcast share one copy of the pairs, kept by node."""
    nodes, edges, ids, pairs = hub_graph
    rows = edges.select(F.col("src").alias("subject_id"), F.col("dst").alias("object_id"))
    rows = rows.unionByName(spark.createDataFrame([("v070", None), (None, "v070")], "subject_id string, object_id string"))
    want = sorted(tuples(traversal.khop(rows, "v099", 6)))
    made = []
    keep = traversal.Adjacency

    def counted(*args):
        made.append(args[1])
        return keep(*args)

    monkeypatch.setattr(traversal, "Adjacency", counted)
    for module in (runtime, traversal):
        monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(runtime.broadcast_if_small, "__defaults__", (0,))
    assert sorted(tuples(traversal.khop(rows, "v099", 6))) == want
    assert made == [2 * len(pairs)]
    made.clear()
    traversal.khop(rows, "v099", 2)
    assert made == []
