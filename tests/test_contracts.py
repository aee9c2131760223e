"""Contracts, sources, registry, streaming and plan shapes."""

import json
import os
import threading
import uuid

import pytest
from conftest import SF, tuples
from pyspark.sql import functions as F

from edgeline.functions.sql_functions import register_functions, register_persistent_functions
from edgeline.operators import profiling, traversal, views
from edgeline.operators.validation import validate_triplets
from edgeline.plans.batch import refresh_results
from edgeline.runtime import broadcast_if_small, ensure_checkpoint_dir, lookup, materialize, scratch_path
from edgeline.schema import TRIPLET_SCHEMA, Graph, GraphColumns, conform_triplets
from edgeline.sources.registry import enabled_datasets, registry_upsert
from edgeline.sources.tables import append_triplets, load_graph, read_table, write_result
from edgeline.streaming.incremental import stream_triplets

REGISTRY = (
    "dataset_key string, display_name string, triplet_table string, description string, sample_prompts array<string>, "
    "owner string, agent_endpoint string, enabled boolean, created_at timestamp, updated_at timestamp"
)


def registry(spark, *rows):
    filled = [(key, "n", "t", "d", ["q"], "o", None, enabled, None, None) for key, enabled in rows]
    return spark.createDataFrame(filled, REGISTRY)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_conform_fills_optional_columns(hand):
    assert hand.schema.names == TRIPLET_SCHEMA.names
    with pytest.raises(ValueError):
        conform_triplets(hand.drop("predicate"))


def test_missing_columns(hand):
    with pytest.raises(ValueError):
        Graph(hand, cols=GraphColumns(src="nope"))
    with pytest.warns(UserWarning):
        graph = Graph(hand.drop("predicate", "subject_type", "object_type"))
    assert "predicates" not in views.downstream(graph, "a", 2).columns
    assert views.derive_nodes(graph).filter("type IS NULL").count() == 8


def test_enriched_edges_reject_name_collisions(hand):
    with pytest.raises(ValueError):
        views.enriched_edges(Graph(hand.withColumn("source_id", F.lit(1))))


def test_check_and_append(spark, hand, tmp_path):
    target = str(tmp_path / "triplets")
    append_triplets(hand, target)
    append_triplets(hand, target)
    assert load_graph(spark, target).edges.count() == 22
    with pytest.raises(ValueError):
        append_triplets(hand.withColumn("confidence", F.lit(2.0)), target)
    with pytest.raises(ValueError):
        append_triplets(hand.withColumn("object_id", F.lit(None).cast("string")), target)


def test_orphans_count_null_ends(spark, hand):
    holes = hand.withColumn("object_id", F.nullif("object_id", F.lit("x")))
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    assert sorted(tuples(views.orphans(Graph(holes, nodes)))) == [("dest", 5), ("source", 3)]


def test_registry(spark):
    known = registry(spark, ("a", True), ("b", False), ("c", None))
    now = F.lit("2030-01-01").cast("timestamp")
    merged = registry_upsert(known, registry(spark, ("a", False), ("d", True)), now)
    assert sorted(tuples(merged.selectExpr("dataset_key", "enabled", "updated_at IS NOT NULL"))) == [
        ("a", True, True),
        ("b", False, False),
        ("c", None, False),
        ("d", True, False),
    ]
    assert sorted(r[0] for r in tuples(enabled_datasets(merged))) == ["a", "c", "d"]
    with pytest.raises(ValueError):
        registry_upsert(known, registry(spark, ("d", True), ("d", True)), now)


def test_stream_drops_repeats(spark, hand, tmp_path):
    source, target, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    rows = hand.withColumn("created_at", F.lit("2024-01-01").cast("timestamp"))
    append_triplets(rows.unionByName(rows), source)
    stream_triplets(spark, source, target, state).awaitTermination()
    assert spark.read.parquet(target).count() == 11
    append_triplets(rows.limit(0), source)
    stream_triplets(spark, source, target, state).awaitTermination()
    assert spark.read.parquet(target).count() == 11


def test_batch_run(spark, hand, tmp_path):
    centrality, communities = str(tmp_path / "centrality"), str(tmp_path / "communities")
    refresh_results(hand, centrality, communities)
    assert read_table(spark, centrality).filter("entity_id = 'b' AND degree = 3").count() == 1
    sizes = tuples(read_table(spark, communities).select("community_id", "community_size").distinct())
    assert sorted(sizes) == [(0, 3), (1, 2), (2, 2)]


def test_materialize_reports_rows(spark):
    assert ensure_checkpoint_dir(spark)
    for n in (0, 10):
        written, seen = materialize(spark.range(n), high=F.max("id"))
        assert seen["rows"] == written.count() == n


def test_no_pairwise_joins(spark, hand):
    ids = spark.createDataFrame([("a",)], "node_id string")
    graph = Graph(hand)
    for df in (
        views.enriched_edges(graph),
        views.downstream(graph, "a", 3),
        traversal.edges_touching(hand, ids),
        traversal.khop(hand, "a", 3),
        traversal.connection_paths(hand, "a", "d"),
        traversal.subgraph_edges(hand, "a", 2),
    ):
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def test_start_filter_reaches_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    cols = GraphColumns(src="o_orderkey", dst="o_custkey", label=None, src_type=None, dst_type=None)
    text = plan(views.downstream(Graph(orders, cols=cols), 5, 1))
    assert "EqualTo(o_orderkey,5)" in text
    assert "o_totalprice" not in text


def test_functions_join_by_equality_under_lateral(spark, hand):
    communities = spark.createDataFrame(
        [("a", "P", 0, 2, 0), ("b", "P", 0, 2, 0), ("m", "P", 1, 1, 1)],
        "entity_id string, entity_type string, community_id long, community_size long, component_id long",
    )
    register_functions(spark, hand, None, communities)
    calls = ("neighbors(i.id)", "members_of_cluster(i.c)", "shared_community(i.id, i.id)")
    for call in (*calls, "khop(i.id, 5)", "subgraph_edges(i.id, 2)", "connection_path(i.id, i.other)"):
        asked = spark.sql(f"SELECT i.id, f.* FROM (SELECT entity_id id, community_id c, entity_id other FROM kg_communities) i, LATERAL {call} f")
        assert asked.count() > 0
        assert "NestedLoop" not in plan(asked) and "Cartesian" not in plan(asked), call


def test_two_chained_lookups_read_their_input_once(spark):
    spark.range(100).withColumn("k", F.col("id") % 3).write.mode("overwrite").parquet(path := scratch_path(spark))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = spark.read.parquet(path).mapInArrow(counted, "id long, k long")
    table = spark.range(3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    again = table.toDF("v", "w")
    joined = lookup(lookup(rows, "k", table, by=F.col("id")), "v", again, by=F.col("id"))
    assert joined.count() == 100
    assert reads.value == 100


def test_wide_rows_are_not_broadcast(spark):
    wide = spark.range(4).withColumn("text", F.repeat(F.lit("x"), 1000))
    _, seen = materialize(wide)
    assert 4000 < seen["bytes"] < 5000
    rows = spark.range(10)
    assert "Broadcast" not in str(rows.join(broadcast_if_small(wide, seen["bytes"], 3000), "id")._jdf.queryExecution().analyzed())


def test_late_and_undated_rows_are_streamed(spark, hand, tmp_path):
    source, target, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    new = hand.withColumn("created_at", F.lit("2024-01-05").cast("timestamp"))
    old = hand.withColumns({"created_at": F.lit("2024-01-01").cast("timestamp"), "source_method": F.lit("late")})
    undated = hand.withColumns({"created_at": F.lit(None).cast("timestamp"), "source_method": F.lit("undated")})
    append_triplets(new, source)
    stream_triplets(spark, source, target, state).awaitTermination()
    append_triplets(old.unionByName(undated).unionByName(new), source)
    stream_triplets(spark, source, target, state).awaitTermination()
    assert spark.read.parquet(target).count() == 33


def test_validation_keeps_whole_rows(spark, hand):
    rows = hand.limit(1).select("subject_id", "subject_type", "predicate", "object_id", "object_type", "created_at")
    both = rows.withColumns(
        {"confidence": F.lit(0.9), "source_agent": F.lit("zeta"), "source_method": F.lit("alpha_method"), "properties": F.lit('{"k": 1}')}
    ).unionByName(
        rows.withColumns(
            {"confidence": F.lit(0.5), "source_agent": F.lit("alpha"), "source_method": F.lit("zz_method"), "properties": F.lit(None).cast("string")}
        )
    )
    row = validate_triplets(both).first()
    assert (row["source_agent"], row["source_method"]) == ("zeta", "alpha_method")
    assert json.loads(row["properties"]) == {"k": 1, "n_agents": 2, "n_rows": 2}
    assert row["confidence"] == pytest.approx(0.95)


def test_foreign_keys_need_no_names(spark):
    tables = {
        "p": spark.createDataFrame([(f"x{i}",) for i in range(9)], "code string"),
        "c": spark.createDataFrame([(f"x{i % 4}",) for i in range(20)], "owner string"),
    }
    keys = profiling.entity_keys(profiling.profile(tables))
    found = profiling.foreign_keys(tables, keys).select("child_table", "child_column", "parent_table", "parent_column")
    assert tuples(found) == [("c", "owner", "p", "code")]


def test_a_failed_refresh_leaves_the_old_table(spark, tmp_path):
    target = str(tmp_path / "table")
    write_result(spark.range(3), target)
    with pytest.raises(Exception):
        write_result(spark.range(3).withColumn("x", F.raise_error(F.lit("stop"))), target)
    assert read_table(spark, target).count() == 3
    write_result(spark.range(5), target)
    assert read_table(spark, target).count() == 5


def test_persistent_functions_over_published_tables(spark, hand):
    triplets, centrality, communities = (f"{name}_{uuid.uuid4().hex[:8]}" for name in ("triplets", "centrality", "communities"))
    names = ()
    try:
        hand.write.saveAsTable(triplets)
        refresh_results(hand, centrality, communities)
        names = register_persistent_functions(spark, triplets, centrality, communities)
        for name in names:  # those of other tests come first
            spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
        top = spark.sql("SELECT entity_id, pagerank FROM top_central_entities(2)").collect()
        best = spark.table(centrality).orderBy(F.desc("pagerank"), "entity_id").limit(2)
        assert sorted(tuple(r) for r in top) == sorted(tuples(best.select("entity_id", "pagerank")))
        assert spark.sql("SELECT * FROM khop('a', 2)").count() == 4
        asked = "SELECT f.* FROM (SELECT DISTINCT subject_id AS id FROM %s) i, LATERAL shared_community(i.id, 'b') f"
        assert spark.sql(asked % triplets).count() == 6
    finally:
        for name in names:
            spark.sql(f"DROP FUNCTION IF EXISTS default.{name}")
        for t in spark.catalog.listTables():
            if any(t.name.startswith(x) for x in (triplets, centrality, communities)):
                spark.sql(f"DROP {'VIEW' if t.tableType == 'VIEW' else 'TABLE'} IF EXISTS {t.name}")


def test_a_reader_finds_one_whole_table_through_refreshes(spark, tmp_path):
    """Readers that begin at any moment, and one that began before the refresh."""
    target = str(tmp_path / "table")
    write_result(spark.range(10).withColumn("round", F.lit(0)), target)
    begun = read_table(spark, target)
    stop, found = threading.Event(), []

    def read():
        while not stop.is_set():
            rows = read_table(spark, target).groupBy("round").count().collect()
            found.append([(r["round"], r["count"]) for r in rows])

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 6):
        write_result(spark.range(10 + n).withColumn("round", F.lit(n)), target, keep=3)
        if n == 1:
            assert begun.count() == 10
    stop.set()
    reader.join()
    assert found and all(len(rows) == 1 and rows[0][1] == 10 + rows[0][0] for rows in found)
    assert len(os.listdir(target)) - len([f for f in os.listdir(target) if f.startswith((".", "_"))]) == 3


def test_published_tables_are_views_of_versions(spark):
    name = f"published_{uuid.uuid4().hex[:8]}"
    try:
        spark.range(2).write.saveAsTable(name)  # from before versions
        for n in (3, 4, 5):
            write_result(spark.range(n).withColumn("n", F.lit(n)), name)
            assert read_table(spark, name).count() == n
        assert len([t for t in spark.catalog.listTables() if t.name.startswith(f"{name}_v")]) == 2
    finally:
        spark.sql(f"DROP VIEW IF EXISTS {name}")
        for t in spark.catalog.listTables():
            if t.name.startswith(f"{name}_v"):
                spark.sql(f"DROP TABLE {t.name}")


def test_stream_keeps_its_state_over_restarts(spark, hand, tmp_path):
    source, target, state = (str(tmp_path / name) for name in ("in", "out", "state"))

    def dated(day, method):
        return hand.withColumns({"created_at": F.lit(day).cast("timestamp"), "source_method": F.lit(method)})

    before, new, late = dated("2024-01-01", "before"), dated("2024-01-05", "new"), dated("2023-01-01", "late")
    undated = dated(None, "undated")
    append_triplets(before, target)
    append_triplets(new.unionByName(before), source)
    stream_triplets(spark, source, target, state).awaitTermination()
    assert spark.read.parquet(target).count() == 22
    # The state, not the target, knows what came: take the target away.
    os.rename(target, target + "_away")
    append_triplets(new.unionByName(late).unionByName(undated).unionByName(undated).unionByName(before), source)
    stream_triplets(spark, source, target, state).awaitTermination()
    assert spark.read.parquet(target).count() == 22
    assert sorted(r[0] for r in spark.read.parquet(target).select("source_method").distinct().collect()) == ["late", "undated"]


def test_a_batch_that_is_run_again_adds_nothing_twice(spark, hand, tmp_path):
    source, target, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    rows = hand.withColumn("created_at", F.lit("2024-01-01").cast("timestamp"))
    append_triplets(rows, source)
    stream_triplets(spark, source, target, state).awaitTermination()
    assert spark.read.parquet(target).count() == 11
    # As after a failure between writing and committing.
    os.remove(f"{state}/commits/0")
    if os.path.exists(f"{state}/commits/.0.crc"):
        os.remove(f"{state}/commits/.0.crc")
    stream_triplets(spark, source, target, state).awaitTermination()
    assert spark.read.parquet(target).count() == 11


def test_foreign_keys_take_no_smallest_values(spark, monkeypatch):
    """Only keys are asked for; sketches hold the same part of the values whatever the width of the integers."""
    parent = spark.range(2000).select(F.col("id").cast("int").alias("p_key"), F.col("id").cast("string").alias("p_name"))
    child = spark.range(4000).select((F.col("id") % 1990).alias("c_ref"), (F.col("id") % 1990).cast("string").alias("c_text"))
    tables = {"parent": parent, "child": child}

    def refuse(column):
        raise AssertionError("asked for a smallest value")

    monkeypatch.setattr(profiling.F, "min", refuse)
    keys = profiling.key_columns(tables)
    found = profiling.foreign_keys(tables, keys).select("child_column", "parent_column", "n_matched").collect()
    assert sorted(map(tuple, found)) == [("c_ref", "p_key", 1990), ("c_text", "p_name", 1990)]
    sketches = {
        c: {r["value"] for r in profiling._typed_values(tables, {t: [(c, "integer")]}, part=True).collect()}
        for t, c in (("parent", "p_key"), ("child", "c_ref"))
    }
    assert sketches["c_ref"] <= sketches["p_key"] and 60 < len(sketches["c_ref"]) < 200
