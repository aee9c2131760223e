import random

import pytest
from helpers import EMPTY, ODD, clashing, documents

from edgeline.llm import components, similarity_join


def slow_components(rows, size):
    sets = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        n = min(size, len(words))
        sets[doc] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {(doc, len(sets[doc]), root(doc), doc == root(doc)) for doc in sets}


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    while len(rows) < n:
        base = rng.choices(vocabulary, k=rng.choice([1, 2, 5, 30, 120]))
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 3, 8])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy) if rng.random() < 0.8 else "  ".join(copy).upper()))
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_against_all_pairs(spark, size):
    rows = corpus(size)
    got = similarity_join.near_duplicates(documents(spark, rows), shingle_words=size).collect()
    assert {tuple(r) for r in got} == slow_components(rows, size)


def test_large_nodes_branch_and_end_in_stars(spark, monkeypatch):
    monkeypatch.setattr(similarity_join, "SMALL_NODE", 8)
    monkeypatch.setattr(similarity_join, "LEVELS", 3)
    base = [f"x{i}" for i in range(200)]
    near = [(i, " ".join(base[:k] + [f"y{i}"] + base[k + 1 :])) for i, k in enumerate(range(0, 200, 4))]
    rows = near + [(1000 + i, t) for i, t in corpus(9, 60)]
    got = similarity_join.near_duplicates(documents(spark, rows), shingle_words=2).collect()
    assert {tuple(r) for r in got} == slow_components(rows, 2)


def test_members_of_a_large_node_meet_without_its_smallest(spark, monkeypatch):
    monkeypatch.setattr(similarity_join, "SMALL_NODE", 8)
    monkeypatch.setattr(similarity_join, "LEVELS", 1)
    rng = random.Random(5)
    base = [f"x{i}" for i in range(300)]

    def changed(places):
        return " ".join(f"y{rng.random()}" if i in places else w for i, w in enumerate(base))

    # The smallest id is far from all others, which change one block of 25 words each and link with near ones only.
    rows = [(0, changed(range(0, 90)))]
    rows += [(i, changed(range(100 + 5 * i, 125 + 5 * i))) for i in range(1, 31)]
    got = similarity_join.near_duplicates(documents(spark, rows), shingle_words=2).collect()
    want = slow_components(rows, 2)
    assert any(label not in (0, doc) for doc, _, label, _ in want)
    assert {tuple(r) for r in got} == want


def test_members_outside_the_main_component_meet_all(spark, monkeypatch):
    monkeypatch.setattr(similarity_join, "SMALL_NODE", 8)
    label = {rep: 0 if rep % 3 else rep for rep in range(30)}
    rows = [(7, rep, label[rep], 5, b"x") for rep in range(30)] + [(8, rep, 0, 5, b"x") for rep in range(30)]
    large = spark.createDataFrame(rows, "node long, rep long, label long, size long, sketch binary")
    nodes = {}
    for r in similarity_join.in_blocks(large).collect():
        assert r["rep"] not in nodes.setdefault(r["node"], set())
        nodes[r["node"]].add(r["rep"])
    met = {(a, b) for n in nodes.values() for a in n for b in n}
    assert met >= {(a, b) for a in range(30) for b in range(30) if label[a] != label[b]}
    assert max(map(len, nodes.values())) < 20  # and the second node, of one component, is left out


def test_sketches_count_agreeing_slots():
    import numpy as np

    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 1 << 32, (2, 50, similarity_join.SLOTS), dtype=np.uint32)
    b[:, :90] = a[:, :90]
    want = ((a & 3) == (b & 3)).sum(axis=1)
    one, two = (np.frombuffer(b"".join(map(similarity_join.sketched, x)), np.uint64).reshape(50, -1) for x in (a, b))
    assert (similarity_join.same_slots(one, two) == want).all()


def near_sets(seed, n, size):
    import numpy as np

    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 64, size, dtype=np.uint64)
    changes = [(rng.choice(size, k, replace=False), rng.integers(0, 1 << 64, k, dtype=np.uint64)) for k in rng.integers(1, size // 6, n)]
    return [np.unique(np.concatenate([np.delete(base, at), new])) for at, new in changes]


def peak_bytes(work):
    import tracemalloc

    tracemalloc.start()
    work()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


@pytest.mark.parametrize("at_once", [50, 1_000_000])
def test_links_among_sets_taken_in_ranges(monkeypatch, at_once):
    import numpy as np

    monkeypatch.setattr(similarity_join, "ELEMENTS_AT_ONCE", at_once)
    sets = near_sets(1, 40, 90) + near_sets(2, 5, 60) + [np.array([7], np.uint64)] * 2
    plain = [set(s.tolist()) for s in sets]
    got = similarity_join.shared_sizes(sets)
    assert all(got[i, j] == len(a & b) for i, a in enumerate(plain) for j, b in enumerate(plain) if i != j)
    labels = np.arange(len(sets)) // 2
    parent = list(range(len(sets)))

    def joined(pairs, top):
        top = list(top)
        for i, j in pairs:
            top = [top[i] if x == top[j] else x for x in top]
        return top

    links = [
        (i, j)
        for i, a in enumerate(plain)
        for j, b in enumerate(plain)
        if i < j and 100 * len(a & b) >= 80 * len(a | b)
    ]
    found = similarity_join.links_among(sets, labels, 80)
    assert set(found) <= set(links) and all(labels[i] != labels[j] for i, j in found)
    inside = [(i, j) for i in parent for j in parent if i < j and labels[i] == labels[j]]
    want, got = (joined(pairs + inside, parent) for pairs in (links, found))
    assert [want.index(x) for x in want] == [got.index(x) for x in got]


def test_longer_sets_of_a_cluster_take_no_more_memory(monkeypatch):
    import numpy as np

    monkeypatch.setattr(similarity_join, "ELEMENTS_AT_ONCE", 20_000, raising=False)
    short, long = (peak_bytes(lambda s=near_sets(3, 60, size): similarity_join.links_among(s, np.arange(60), 80)) for size in (1_000, 8_000))
    assert long < 1.5 * short


def test_pairs_of_a_node_are_tried_likely_ones_first_in_little_memory():
    import numpy as np

    rng = np.random.default_rng(4)
    n = 900
    slots = np.tile(rng.integers(0, 1 << 32, similarity_join.SLOTS, dtype=np.uint32), (n, 1))
    for row in slots:
        row[rng.choice(similarity_join.SLOTS, 15, replace=False)] = rng.integers(0, 1 << 32, 15)
    sketches = np.frombuffer(b"".join(similarity_join.sketched(r[None]) for r in slots), np.uint64).reshape(n, -1)
    labels, found = np.arange(n) % 450, []

    def work():
        left, right, score = similarity_join.agreeing(sketches, np.full(n, 50), labels, 0.8)
        found.append((left, right, score, similarity_join.ends_among(left, right, n)))

    assert peak_bytes(work) < 13 * n * (n - 1) / 2
    left, right, score, ends = found[0]
    same = similarity_join.same_slots(sketches[left], sketches[right])
    assert (same == score).all() and (labels[left] != labels[right]).all() and (left < right).all()
    assert len(left) == sum(
        int(((similarity_join.same_slots(sketches[i + 1 :], sketches[i]) >= similarity_join.LEAST_AGREEING) & (labels[i + 1 :] != labels[i])).sum())
        for i in range(n)
    )
    assert ends.tolist() == sorted({*left.tolist(), *right.tolist()})
    likely = score >= similarity_join.LIKELY_AGREEING
    rest = np.flatnonzero(~likely)
    want = [*np.flatnonzero(likely).tolist(), *rest[np.argsort(-score[rest].astype(int), kind="stable")].tolist()]
    assert np.concatenate(list(similarity_join.likely_first(score))).tolist() == want
    assert 0 < likely.sum() < len(score)


def long_text(key, n=60):
    return " ".join(f"{key}{i}" for i in range(n))


def test_repeated_ids_are_told_apart(spark):
    a, b = long_text("a"), long_text("b")
    rows = [(3, a + " more"), (5, a), (5, b), (7, a), (9, b + " more"), (5, a), (None, a), (5, None), (5, "")]
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in similarity_join.near_duplicates(documents(spark, rows)).collect())
    assert [g[::2] + g[3:] for g in got] == [
        (0, None, True), (3, 3, True), (5, 5, True), (5, 5, True), (5, 3, False), (5, 3, False), (5, 5, True), (7, 3, False), (9, 5, False),
    ]


def test_one_row_of_each_group_stays(spark):
    a, b = long_text("a"), long_text("b")
    rows = [(3, a + " more"), (5, a), (5, b), (7, a), (9, b + " more"), (5, b), (None, a), (None, a), (5, ""), (5, None), (5, None)]
    left = similarity_join.drop_near_duplicates(clashing(documents(spark, rows)))
    want = [(3, a + " more"), (5, b), (None, a), (None, a), (5, ""), (5, None), (5, None)]
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in left.collect()))) == sorted(map(repr, want))


def test_deeper_nodes_take_more_trees():
    assert similarity_join.trees_for(1) <= similarity_join.trees_for(2) <= similarity_join.TREES
    assert similarity_join.trees_for(12) > 3 * similarity_join.TREES


def test_copies_and_drop(spark):
    text = " ".join(f"t{i}" for i in range(50))
    rows = [(i, text) for i in range(5, 300)] + [(400, text + " more")]
    df = clashing(documents(spark, rows))
    left = similarity_join.drop_near_duplicates(df)
    assert [r["doc_id"] for r in left.collect()] == [5]
    assert left.columns == df.columns


@pytest.mark.parametrize("rows", [ODD, EMPTY])
def test_odd_rows(spark, rows):
    got = similarity_join.near_duplicates(clashing(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    assert all(r["component_id"] == r["doc_id"] and r["kept"] for r in got)


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 950)], "a long, b long")
    got = {r["rep"]: r["label"] for r in components.min_labels(links).collect()}
    assert got == {i: 0 for i in range(301)} | {900: 900, 950: 900}
    order = list(range(200))
    random.Random(4).shuffle(order)
    links = spark.createDataFrame([*zip(order, order[1:]), (order[3], order[3])], "a long, b long")
    assert {r["label"] for r in components.min_labels(links).collect()} == {0}
