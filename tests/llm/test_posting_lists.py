import numpy as np
import pytest
from helpers import clashing
from pyspark.sql import types as T

from edgeline.llm import posting_lists

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def brute(rows, k=20):
    """{query: [(vec_id, score)]} over ids that 20 divides, an id by its best score."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any() and len(v) == 8]
    out = {}
    for q in {i for i, _ in good if i % 20 == 0}:
        best = {}
        for own in (v for i, v in good if i == q):
            for i, v in good:
                if i != q:
                    best[i] = max(best.get(i, -np.inf), float(own @ v))
        out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def found(spark, rows, **how):
    df = clashing(spark.createDataFrame(rows, VECTORS))
    got = {}
    for r in posting_lists.nearest(df, df.filter("vec_id % 20 = 0"), **how).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def vectors(n, seed=0, dims=8):
    return [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(seed).normal(size=(n, dims)).astype(np.float32))]


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in best}) / len(best) for q, best in want.items()])


def test_recall_and_exact_scores(spark):
    rows = vectors(3000)
    got, want = found(spark, rows, block_rows=300), brute(rows)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    assert got[0][0][1] == pytest.approx(want[0][0][1], abs=1e-12)


def families(n, dims=64, centres=80, spread=0.35, seed=4):
    """Unit vectors around centres, and a quarter of them between two."""
    rng = np.random.default_rng(seed)
    means = rng.normal(size=(centres, dims))
    one, two = rng.integers(centres, size=(2, n))
    part = np.where(rng.random(n) < 0.25, rng.uniform(0.3, 0.5, n), 0)[:, None]
    points = means[one] * (1 - part) + means[two] * part + spread * rng.normal(size=(n, dims))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    return [(i, [float(x) for x in v]) for i, v in enumerate(points.astype(np.float32))]


def check_64(spark, rows):
    report = {}
    got = found(spark, rows, report=report)
    points = np.array([v for _, v in rows])
    queries = np.arange(0, len(rows), 20)
    scores = points[queries] @ points.T
    scores[np.arange(len(queries)), queries] = -np.inf
    truth = np.argsort(-scores, axis=1)[:, :20]
    hits = [len({i for i, _ in got[int(q)]} & set(best.tolist())) / 20 for q, best in zip(queries, truth)]
    return np.mean(hits), report


def test_64_dimensions_read_a_tenth(spark):
    share, report = check_64(spark, families(20_000))
    assert share >= 0.9 and report["share_read"] <= 0.1 and report["replicas"] > 1.5, (share, report)


def test_64_dimensions_without_families(spark):
    """Independent directions: no list tells much about a neighbour, so more are read for the same recall."""
    rows = vectors(4000, 7, 64)
    share, report = check_64(spark, rows)
    assert share >= 0.9 and report["replicas"] > 1.5 and report["probes"] < report["lists"], (share, report)


def test_odd_vectors_and_ties(spark):
    rows = vectors(60, 1)
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, None), (103, [0.0] * 8), (104, [float("nan")] * 8), (105, []), (106, [1.0])]
    rows += [(107, [None, *[1.0] * 7]), (108, [float("inf")] * 8), (None, rows[0][1]), (5, rows[5][1]), (20, rows[20][1])]
    got, want = found(spark, rows), brute(rows)
    assert set(got) == set(want)
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]


def test_few_and_no_rows(spark):
    rows = vectors(5, 2)
    assert {q: [i for i, _ in v] for q, v in found(spark, rows).items()} == {q: [i for i, _ in v] for q, v in brute(rows).items()}
    assert found(spark, []) == {}
    assert found(spark, [(0, None)]) == {}


def test_graph_search_finds_the_nearest_centroids():
    points = np.random.default_rng(3).normal(size=(4000, 8))
    index = posting_lists.fit(points, 40_000, float(np.sqrt((points**2).sum(axis=1).max())))
    queries = index.lift_queries(points[:100])
    found_, far = index.search(queries, 10)
    exact = np.sqrt(((queries[:, None] - index.centroids[None]) ** 2).sum(axis=2))
    hits = [len(set(found_[i]) & set(np.argsort(exact[i])[:10])) / 10 for i in range(100)]
    assert np.mean(hits) > 0.95
    assert np.allclose(far, np.take_along_axis(exact, found_, 1), atol=1e-6)
    assert 1.5 < np.mean([len(x) for x in index.postings(points)]) < 2.5
    groups = np.bincount([x[0] for x in index.postings(points)], minlength=len(index.centroids))
    assert groups.max() < 6 * groups.mean()


def test_rows_are_handed_on_in_small_batches(spark, monkeypatch):
    """a thousand queries with all their lists left in one batch, a copy of the vector for each."""
    rows = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(50)], "vec_id long, vector array<double>").coalesce(1)
    sizes = []

    class Rows:
        def mapInArrow(self, deal, schema):
            sizes.extend(b.num_rows for b in deal(iter([rows.toArrow().combine_chunks().to_batches()[0]])))
            return rows.mapInArrow(deal, schema)

    monkeypatch.setattr(posting_lists, "BATCH_ROWS", 64)
    got = posting_lists.dealt(Rows(), lambda v: [list(range(7))] * len(v), 2).collect()
    assert sorted((r["list"], r["vec_id"], r["vector"][1]) for r in got) == [(c, i, float(i)) for c in range(7) for i in range(50)]
    assert sum(sizes) == 350 and max(sizes) <= 64


def test_wide_searches_look_at_all_centroids():
    """The walk widened step by step, sorting all that it had found for each list more."""
    rows = np.array([v for _, v in vectors(6000, dims=24)])
    index = posting_lists.fit(rows, 200_000, float(np.sqrt((rows**2).sum(axis=1).max())))
    index.search_ratio = 1.2
    walked = []
    search = index.search
    index.search = lambda points, width: walked.append(width) or search(points, width)
    got = index.probes(rows[:40])
    assert len(index.centroids) > 2 * posting_lists.WALKED and max(walked) <= posting_lists.WALKED
    points = index.lift_queries(rows[:40])
    far = np.sqrt(((points[:, None] - index.centroids[None]) ** 2).sum(axis=2))
    want = [set(np.flatnonzero(f <= 1.2 * f.min()).tolist()) for f in far]
    assert max(map(len, want)) > posting_lists.WALKED
    assert all(set(g) <= w and len(g) >= 0.95 * len(w) for g, w in zip(got, want))
