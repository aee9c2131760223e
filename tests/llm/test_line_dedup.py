import random

import pytest
from helpers import EMPTY, ODD, clashing, documents

from edgeline.llm import line_dedup


def slow_dedup(rows, least):
    """Deletes whatever lies in a run of `least` words that stands earlier, and what the run shares on both sides."""
    lines = {}
    for doc, text in rows:
        places, hashes, sizes = line_dedup.line_hashes(text or "")
        lines[doc] = (places, hashes, sizes)
    first, out = {}, {}
    for doc in sorted(lines):
        _, hashes, sizes = lines[doc]
        ends = line_dedup.run_ends(sizes, least)
        for s, e in enumerate(ends):
            if e < len(sizes):
                first.setdefault(tuple(hashes[s : e + 1]), (doc, s, e))
    for doc in sorted(lines):
        _, hashes, sizes = lines[doc]
        gone = set()
        for s, e in enumerate(line_dedup.run_ends(sizes, least)):
            if e == len(sizes):
                continue
            other, os, oe = first[tuple(hashes[s : e + 1])]
            if (other, os) == (doc, s):
                continue
            theirs = lines[other][1]
            # The window's neighbours of at most `least` words are looked at, as further ones lie in windows.
            left = right = 0
            near = line_dedup.context(hashes, sizes, s - 1, -1, least)
            far = line_dedup.context(theirs, lines[other][2], os - 1, -1, least)
            while left < min(len(near), len(far)) and near[left] == far[left]:
                left += 1
            near = line_dedup.context(hashes, sizes, e + 1, 1, least)
            far = line_dedup.context(theirs, lines[other][2], oe + 1, 1, least)
            while right < min(len(near), len(far)) and near[right] == far[right]:
                right += 1
            begin = s - left
            if other == doc:
                begin = max(begin, oe + right + 1)
            gone |= set(range(begin, e + right + 1))
        out[doc] = gone
    return out


def runs(spark, rows, **how):
    found = line_dedup.repeated_runs(documents(spark, rows), **how).collect()
    return {r["doc"]: {i for run in r["runs"] for i in range(run["first"], run["last"] + 1)} for r in found}


@pytest.mark.parametrize("seed", range(4))
def test_against_all_windows(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.choice([1, 3, 8, 20, 60]))) for _ in range(25)]
    passages = [rng.choices(pool, k=rng.randint(1, 8)) for _ in range(8)]
    rows = []
    for doc in range(40):
        body = []
        for _ in range(rng.randint(1, 5)):
            body += rng.choice(passages) if rng.random() < 0.5 else rng.choices(pool, k=rng.randint(1, 4))
            if rng.random() < 0.3:
                body.append("")
        rows.append((doc, "\n".join(body)))
    want = {doc: gone for doc, gone in slow_dedup(rows, 50).items() if gone}
    assert runs(spark, rows) == want


def every_run(rows, least):
    """Deletes every run of `least` words or more that stands earlier, by comparing all runs with all places."""
    texts = {doc: line_dedup.line_hashes(text or "") for doc, text in rows}

    def runs_of(doc):
        _, hashes, sizes = texts[doc]
        for s in range(len(sizes)):
            for e in range(s, len(sizes)):
                if sum(sizes[s : e + 1]) >= least:
                    yield tuple(hashes[s : e + 1]), s, e

    first, out = {}, {}
    for doc in sorted(texts):
        for run, s, e in runs_of(doc):
            first.setdefault(run, (doc, s, e))
    for doc in sorted(texts):
        gone = set()
        for run, s, e in runs_of(doc):
            other, os, oe = first[run]
            if (other, os) != (doc, s):
                gone |= set(range(max(s, oe + 1) if other == doc else s, e + 1))
        out[doc] = gone
    return out


@pytest.mark.parametrize("seed", range(3))
def test_against_all_earlier_places(spark, seed):
    rng = random.Random(100 + seed)
    pool = [" ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.choice([3, 8, 20, 60]))) for _ in range(12)]
    passages = [rng.choices(pool, k=rng.randint(2, 8)) for _ in range(6)]
    rows = []
    for doc in range(30):
        body = []
        for _ in range(rng.randint(1, 4)):
            body += rng.choice(passages) if rng.random() < 0.6 else rng.choices(pool, k=rng.randint(1, 3))
        rows.append((doc, "\n".join(body)))
    want = {doc: gone for doc, gone in every_run(rows, 50).items() if gone}
    found = line_dedup.all_repeated_runs(documents(spark, rows)).collect()
    assert {r["doc"]: {i for run in r["runs"] for i in range(run["first"], run["last"] + 1)} for r in found} == want


def test_a_longer_run_that_only_a_later_text_has(spark):
    five = [" ".join(f"{c}{i}" for i in range(10)) for c in "abcde"]
    rows = [(1, [*five, "one two"]), (2, [*five, "x y z", "two goes on"]), (3, [*five, "x y z", "three too"])]
    done = line_dedup.dedup_lines(documents(spark, [(i, "\n".join(lines)) for i, lines in rows])).collect()
    assert {r["doc_id"]: r["text"] for r in done}[3] == "three too"


PASSAGE = " ".join(f"p{i}" for i in range(51))


def test_passages_go_but_the_first(spark):
    rows = [(i, f"own words of {i}\n{PASSAGE}\n\nmore of {i}") for i in range(30)]
    done = {r["doc_id"]: r for r in line_dedup.dedup_lines(documents(spark, rows)).collect()}
    assert done[0]["text"] == rows[0][1] and done[0]["removed_lines"] == 0
    for i in range(1, 30):
        assert done[i]["text"] == f"own words of {i}\n\nmore of {i}"
        assert done[i]["removed_words"] == 51


def test_repeats_inside_a_text(spark):
    lines = [" ".join(f"{c}{i}" for i in range(20)) for c in "abc"]
    rows = [(1, "\n".join([*lines, "x", *lines, *lines]))]
    done = line_dedup.dedup_lines(documents(spark, rows)).first()
    assert done["text"] == "\n".join([*lines, "x"])


def test_short_repeats_stay(spark):
    rows = [(i, "a license line of ten words that all of them have\n" + " ".join(f"{i}u{k}" for k in range(70))) for i in range(5)]
    assert all(r["removed_lines"] == 0 for r in line_dedup.dedup_lines(documents(spark, rows)).collect())


@pytest.mark.parametrize("rows", [ODD, EMPTY])
def test_odd_rows(spark, rows):
    df = clashing(documents(spark, rows))
    done = line_dedup.dedup_lines(df)
    assert set(df.columns) <= set(done.columns)
    got = done.select("doc_id", "text", "source").collect()
    key = lambda r: repr(tuple(r))
    want = df.select("doc_id", "text", "source").collect()
    assert sorted(got, key=key) == sorted(want, key=key)


def test_rows_with_equal_id_and_text_are_one(spark):
    rows = [(1, PASSAGE), (1, PASSAGE), (2, PASSAGE), (None, PASSAGE)]
    got = sorted((repr(r["doc_id"]), r["text"]) for r in line_dedup.dedup_lines(documents(spark, rows)).collect())
    assert got == [("1", ""), ("1", ""), ("2", ""), ("None", PASSAGE)]
