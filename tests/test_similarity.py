"""Similar pairs against brute force, with one bucket, many buckets, and blocks of large ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from edgeline.operators import extraction, similarity


def vectors(n, dims=16, seed=2):
    """Vectors in families around a few directions, with copies of some."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 12, dims))
    points = centres[rng.integers(len(centres), size=n)] + 0.25 * rng.normal(size=(n, dims))
    points[n - 10 :] = points[:10]
    return [(f"e{i:05d}", [float(x) for x in p]) for i, p in enumerate(points)]


def brute(rows, threshold):
    first = {}
    for name, v in sorted(rows):
        first.setdefault(tuple(v), name)
    names, points = list(first.values()), np.array(list(first))
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    i, j = np.nonzero(np.triu(unit @ unit.T >= threshold, 1))
    return {tuple(sorted((names[a], names[b]))) for a, b in zip(i, j)}, {(first[tuple(v)], n) for n, v in rows if first[tuple(v)] != n}


def found(spark, rows, threshold, **how):
    df = spark.createDataFrame(rows, "id string, v array<double>")
    got = extraction.similar_pair_triplets(df, F.col("id"), "Vector", "v", threshold, **how).collect()
    pairs = [(r["subject_id"], r["object_id"]) for r in got if r["predicate"] == "SIMILAR_TO"]
    assert len(pairs) == len(set(pairs))
    return set(pairs), {(r["subject_id"], r["object_id"]) for r in got if r["predicate"] == "SAME_VECTOR"}


@pytest.mark.parametrize("bucket_rows", [2000, 60])
def test_against_brute_force(spark, bucket_rows):
    rows = vectors(600)
    pairs, copies = found(spark, rows, 0.9, bucket_rows=bucket_rows)
    want, same = brute(rows, 0.9)
    assert copies == same and pairs <= want
    assert len(want) > 1000
    if bucket_rows == 2000:
        assert pairs == want
    else:
        assert similarity.plan_tables(590, 0.9, 60)[1] > 3
        assert len(pairs) >= 0.999 * len(want)


def test_blocks_of_large_buckets_miss_nothing(spark):
    rows = vectors(300, seed=5)
    df = spark.createDataFrame([(i, v) for i, (_, v) in enumerate(rows[:280])], "vid long, v array<double>")
    # So low a threshold has no use for projections: one bucket, cut into many blocks.
    assert similarity.plan_tables(280, -0.99, 20) == (0, 1)
    got = {(r["a"], r["b"]) for r in similarity.similar_vectors(df, 280, 0.5, bucket_rows=20, max_tables=0).collect()}
    unit = np.array([v for _, v in rows[:280]])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    i, j = np.nonzero(np.triu(unit @ unit.T >= 0.5, 1))
    assert got == set(zip(i.tolist(), j.tolist()))


def test_odd_vectors_take_no_part(spark):
    rows = [("a", [1.0, 0.0]), ("b", [2.0, 0.0]), ("c", None), ("d", [0.0, 0.0]), ("e", [float("nan"), 1.0]), ("f", [1.0, None]),
            ("g", [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), ("h", []), ("a", [1.0, 0.0])]
    assert found(spark, rows, 0.9) == ({("a", "b")}, set())
    assert found(spark, [], 0.9) == (set(), set())


def test_more_bits_take_more_tables():
    plans = [similarity.plan_tables(n, 0.9, 2000) for n in (10, 10_000, 1_000_000, 10**9)]
    assert plans[0] == (0, 1) and [p[0] for p in plans] == sorted(p[0] for p in plans)
    assert all(tables <= similarity.MAX_TABLES for _, tables in plans)


def test_projections_never_compare_more_pairs_than_none(spark):
    """at 0.3 three bits take 39 tables, so 8 buckets of 39 tables were written and compared in place of one."""
    for threshold in (0.1, 0.3, 0.6, 0.9, 0.99):
        for n in (10, 30_000, 600_000, 10**8):
            bits, tables = similarity.plan_tables(n, threshold, 2000)
            assert tables < 2**bits or (bits, tables) == (0, 1)
    assert similarity.plan_tables(600_000, 0.3, 2000) == (0, 1)


def test_large_blocks_go_by_steps(spark, monkeypatch):
    """a vector was copied for each 2000 others, and pairs were written before they got their names."""
    rows = vectors(500, seed=9)
    written, copied = [], []
    write = similarity.materialize
    monkeypatch.setattr(similarity, "materialize", lambda df, **metrics: written.append(df.columns) or write(df, **metrics))
    kind = type(spark.range(1))
    grouped = kind.groupBy
    monkeypatch.setattr(kind, "groupBy", lambda df, *by: copied.append(df) or grouped(df, *by))
    pairs, copies = found(spark, rows, 0.3, bucket_rows=10)
    assert (pairs, copies) == brute(rows, 0.3)
    assert not any({"a", "b"} & set(columns) for columns in written)
    blocks = [df for df in copied if "met" in df.columns]
    assert len(blocks) == 1 and blocks[0].count() <= 17 * len(rows)
