"""Pivots are searched inside tasks, without rounds, where a task can hold the vertices."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from edgeline.operators import betweenness as bt
from edgeline.operators.vertices import index_vertices_edges


def graph_of(spark, n, pairs):
    vertices = spark.createDataFrame([(f"v{i:03d}", "T") for i in range(n)], "id string, entity_type string")
    rows = [(f"v{a:03d}", f"v{b:03d}", 1.0) for a, b in pairs]
    return index_vertices_edges(vertices, spark.createDataFrame(rows, "src string, dst string, weight double"))


def brute(n, pairs):
    """Betweenness from all vertices by counting paths to every end, without dependencies."""
    near = {i: set() for i in range(n)}
    for a, b in pairs:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    far, ways = {}, {}
    for s in range(n):
        far[s], ways[s], here = {s: 0}, {s: 1}, [s]
        while here:
            below = []
            for v in here:
                for w in near[v]:
                    if w not in far[s]:
                        far[s][w], ways[s][w] = far[s][v] + 1, 0
                        below.append(w)
                    if far[s][w] == far[s][v] + 1:
                        ways[s][w] += ways[s][v]
            here = below
    out = {}
    for v in range(n):
        through = (
            ways[s][v] * ways[v][t] / ways[s][t]
            for s in far[v] for t in far[v] if v not in (s, t) and s != t and far[s][v] + far[v][t] == far[s][t]
        )
        out[v] = sum(through) / ((n - 1) * (n - 2))
    return out


@pytest.mark.parametrize("kind", ["line", "mixed"])
def test_wide_graphs_take_no_rounds(spark, monkeypatch, kind):
    """a line of 90 vertices took a round for each of its levels, twice."""
    n = 90
    pairs = [(i, i + 1) for i in range(n - 1) if i != 60]
    if kind == "mixed":
        random.seed(5)
        pairs = [(0, i) for i in range(1, 50)] + [(random.randrange(n - 2), random.randrange(n - 2)) for _ in range(150)]
    want = brute(n, pairs)
    graph = graph_of(spark, n, pairs)
    rounds = []
    monkeypatch.setattr(bt, "SEARCH_FROM", 0)
    monkeypatch.setattr(bt, "PIECE", 7)
    monkeypatch.setattr(bt, "STEP", 5)
    monkeypatch.setattr(bt, "BLOCK", 32)
    monkeypatch.setattr(bt, "EDGES_BYTES", 0 if kind == "line" else 1 << 20)
    write = bt.materialize
    monkeypatch.setattr(bt, "materialize", lambda df, **metrics: rounds.append(1) or write(df, **metrics))
    got = {int(r["id"][1:]): r["betweenness"] for r in graph.name(bt.betweenness(graph)).collect()}
    assert got == pytest.approx(want)
    assert len(rounds) == 2


def test_vertices_beyond_a_task_go_by_rounds(spark, monkeypatch):
    pairs = [(i, i // 2) for i in range(1, 40)]
    graph = graph_of(spark, 40, pairs)
    monkeypatch.setattr(bt, "SEARCH_FROM", 0)
    monkeypatch.setattr(bt, "VERTICES_BYTES", 39 * bt.VERTEX_BYTES)
    monkeypatch.setattr(bt, "_searched_in_tasks", None)
    got = {int(r["id"][1:]): r["betweenness"] for r in graph.name(bt.betweenness(graph)).collect()}
    assert got == pytest.approx(brute(40, pairs))


def test_foreign_keys_are_searched_from_as_many_pivots_as_any_graph(spark, monkeypatch, tmp_path):
    """the query searched from 2 pivots."""
    tables = {
        "customer": ("c_custkey long, c_nationkey int", [(1, 1), (2, 1), (3, 2)]),
        "supplier": ("s_suppkey long, s_nationkey int", [(1, 2)]),
        "nation": ("n_nationkey int, n_regionkey int", [(1, 1), (2, 1)]),
        "orders": ("o_orderkey long, o_custkey long", [(1, 1), (2, 3)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long", [(1, 1, 1), (2, 1, 1), (2, 2, 1)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    pairs = [("C1", "N1"), ("C2", "N1"), ("C3", "N2"), ("S1", "N2"), ("N1", "R1"), ("N2", "R1"), ("O1", "C1"), ("O2", "C3"),
             ("O1", "P1"), ("O2", "P1"), ("O2", "P2"), ("P1", "S1"), ("P2", "S1")]
    names = sorted({x for p in pairs for x in p})
    want = brute(len(names), [(names.index(a), names.index(b)) for a, b in pairs])
    got = entry.queries()["g12_betweenness_fk"](spark, str(tmp_path)).select("id", F.col("betweenness")).collect()
    assert {r["id"]: r["betweenness"] for r in got} == pytest.approx({names[i]: x for i, x in want.items()}, abs=1e-8)
    assert "LIMIT 256" in entry.oracle_sql()["g12_betweenness_fk"]
