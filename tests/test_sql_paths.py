"""The SQL walks on graphs with a hub: the rows of brute force, without rows for dead ends."""

import itertools
import random

import pytest
from conftest import HAND_ROWS, SF, tuples

import __spark_entry__ as entry
from edgeline.functions.sql_functions import register_functions
from edgeline.schema import conform_triplets


def triplets(spark, pairs):
    rows = [(a, "T", "LINKED", b, "T", 1.0, "relationship", "test") for a, b in pairs]
    columns = (
        "subject_id string, subject_type string, predicate string, object_id string, object_type string, "
        "confidence double, source_agent string, source_method string"
    )
    return conform_triplets(spark.createDataFrame(rows, columns)).persist()


def simple_paths(pairs, a, b, hops):
    near = {}
    for x, y in pairs:
        near.setdefault(x, set()).add(y)
        near.setdefault(y, set()).add(x)
    found, open_paths = set(), [[a]]
    for n in range(1, hops + 1):
        grown = [[*p, x] for p in open_paths for x in near.get(p[-1], ())]
        found |= {(a, b, n, " -> ".join(p)) for p in grown if p[-1] == b}
        open_paths = [p for p in grown if p[-1] not in (a, b) and len(set(p)) == len(p)]
    return found


def most_rows(df):
    """The rows that the operator with most of them put out while `df` was collected."""
    df.collect()

    def walk(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            yield from walk(plan.executedPlan())
        elif kind.endswith("QueryStageExec"):
            yield from walk(plan.plan())
        else:
            metric = plan.metrics().get("numOutputRows")
            if metric.isDefined():
                yield metric.get().value()
            for i in range(plan.children().size()):
                yield from walk(plan.children().apply(i))

    return max(walk(df._jdf.queryExecution().executedPlan()))


@pytest.mark.parametrize("hops", [1, 2, 3, 4, 5])
def test_paths_are_those_of_brute_force(spark, hops):
    rng = random.Random(hops)
    ids = [f"v{i}" for i in range(9)]
    pairs = [tuple(rng.choices(ids, k=2)) for _ in range(14)] + [("v0", "v0"), ("v1", "v1"), ("v0", "v1"), ("v0", "v1")]
    register_functions(spark, triplets(spark, pairs), max_path_hops=hops)
    asked = list(itertools.product(["v0", "v1", "v2", "v3"], [*ids, "nowhere"]))
    spark.createDataFrame([*asked, (None, "v1"), ("v1", None)], "a string, b string").createOrReplaceTempView("asked")
    found = tuples(spark.sql("SELECT p.a, p.b, c.hops, c.path FROM asked p, LATERAL connection_path(p.a, p.b) c"))
    assert len(found) == len(set(found))
    assert set(found) == set().union(*(simple_paths(pairs, a, b, hops) for a, b in asked))
    alone = tuples(spark.sql("SELECT * FROM connection_path('v0', 'v1')"))
    assert sorted(alone) == sorted(row[2:] for row in simple_paths(pairs, "v0", "v1", hops))


def test_paths_past_a_hub_leave_out_dead_ends(spark):
    pairs = [(f"leaf{i}", "hub") for i in range(300)] + [("hub", "root")]
    register_functions(spark, triplets(spark, pairs))
    statement = """SELECT p.id, c.path FROM (SELECT id FROM kg_nodes WHERE id LIKE 'leaf%') p,
LATERAL connection_path(p.id, 'root') c"""
    df = spark.sql(statement)
    assert most_rows(df) < 20 * len(pairs)
    assert set(tuples(df)) == {(f"leaf{i}", f"leaf{i} -> hub -> root") for i in range(300)}


def test_known_nodes_do_not_meet_in_one_task(spark):
    """Nodes that a level does not go on from keep their own key; without one they would all be in one partition."""
    register_functions(spark, conform_triplets(spark.createDataFrame(
        [(*r, "test") for r in HAND_ROWS],
        "subject_id string, subject_type string, predicate string, object_id string, object_type string, "
        "confidence double, source_agent string, source_method string",
    )))
    df = spark.sql("SELECT * FROM khop('a', 5)")
    assert "tip" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(tuples(df)) == [("b", 1), ("c", 1), ("d", 2), ("g1", 3), ("x", 1)]


def test_levels_do_not_broadcast_the_pairs(spark):
    """by the size of its files the planner took the table of pairs for small, at any number of rows."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        plan = entry.queries()["t2_khop_lateral"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("SortMergeJoin") >= 3
    assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "LeftOuter" in line]
