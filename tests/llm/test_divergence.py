import random
import re
from collections import Counter

import duckdb
import pytest
from helpers import EMPTY, clashing, documents

from edgeline.llm import divergence


def rows(n=120, seed=11):
    """(text, lang, source) with a source that holds a third of all rows."""
    pick = random.Random(seed)
    words = ["The", "the", "über", "ÜBER", "a", "b2c", "日本", "x_y", "naïve", "zebra", "Zebra", "I", "it's", "🙂ok", "q"]
    out = [(None, None, None), ("", "en", ""), (None, "en", "s1"), ("1 2 3 _", "xx", "only"), ("rare words here", "yy", "one")]
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{i % 11}"
        text = " ".join(pick.choices(words, k=pick.randint(0, 12))) + f" solo{chr(97 + i % 26)}"
        out.append((text, pick.choice(["en", "de", None, "EN"]), source))
    out += [("zz", "", ""), ("zz", "", "b"), ("zz", None, "ü"), ("ZZ" * 3000 + " zz", "", "c")] * 2
    return out


def frame(spark, data):
    df = documents(spark, [(i // 2, t, s) for i, (t, _, s) in enumerate(data)])
    full = [(i // 2, t, lang, s, None) for i, (t, lang, s) in enumerate(data)]
    return spark.createDataFrame(full, df.schema)


def slow(data, least=3, top=200):
    docs = [(lang or "", source or "", ["".join(c.lower() if "A" <= c <= "Z" else c for c in m) for m in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for text, lang, source in data]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for _, _, terms in own for t in set(terms))
        kept = {t for t, n in df.items() if n >= least}
        sources = {d[1] for d in own}
        counts = {s: Counter(t for _, x, terms in own if x == s for t in terms if t in kept) for s in sources}
        counts[None] = sum(counts.values(), Counter())
        total = {s: sum(c.values()) for s, c in counts.items()}
        p = {s: {t: 1 + 1_000_000_000 * (c[t] + 1) // (total[s] + len(kept)) for t in kept} for s, c in counts.items()}
        for s in sources:
            listed = [("pair", o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept)) for o in sources - {s}]
            terms = [("term", t, (p[s][t] - p[None][t]) ** 2 // p[None][t]) for t in kept if counts[s][t] and p[s][t] > p[None][t]]
            for part in (listed, sorted(terms, key=lambda x: (-x[2], x[1].encode()))[:top]):
                ranked = sorted(part, key=lambda x: (-x[2], x[1].encode()))
                out += [(lang, s, kind, item, value, i + 1) for i, (kind, item, value) in enumerate(ranked)]
    return sorted(out)


# Digests of few bits are shared by many terms, small blocks and buckets meet each other.
@pytest.mark.parametrize("options", [{}, {"digest_bits": 2}, {"digest_bits": 5, "source_block": 3, "bucket_rows": 7}, {"top": 2}])
def test_against_brute_force(spark, options):
    data = rows()
    got = divergence.divergence(clashing(frame(spark, data)).repartition(3), **options)
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "string", "string", "string", "bigint", "int"]
    assert sorted(map(tuple, got.collect())) == slow(data, top=options.get("top", 200))


def test_against_sql(spark):
    df = frame(spark, rows(300, 5))
    documents_ = df.toPandas()  # noqa: F841
    sql = duckdb.connect().execute(divergence.ORACLE.replace("FROM documents", "FROM documents_")).fetchall()
    assert sorted(map(tuple, divergence.divergence(df).collect())) == sorted(sql)


def test_counts_beyond_a_long():
    assert divergence.term_digest(b"x", 64) != divergence.term_digest(b"y", 64)
    assert {divergence.term_digest(str(i).encode(), 1) for i in range(50)} == {0, 1}


def test_large_counts_stay_exact(spark):
    from pyspark.sql import functions as F

    df = spark.sql("SELECT 9000000000000 AS n, 10000000000000 AS total, 17L AS v")
    assert df.select(divergence.share("n", "total", "v")).first()[0] == 1 + 10**9 * (9 * 10**12 + 1) // (10**13 + 17)
    assert df.select(F.lit(3).alias("p"), F.lit(2).alias("q")).select(divergence.gap("p", "q")).first()[0] == 0


@pytest.mark.parametrize("data", [EMPTY, [(None, None, None)] * 2, [("word " * 30_000, "en", "s")] * 3])
def test_odd_tables(spark, data):
    got = sorted(map(tuple, divergence.divergence(frame(spark, data)).collect()))
    assert got == slow(data)


def test_texts_of_a_task_are_handed_on_in_parts(monkeypatch):
    monkeypatch.setattr(divergence, "ENTRIES", 5)
    counts, found = divergence.TermCounts(64, False), Counter()
    for i in range(40):
        counts.add((1, 2), f"common t{chr(97 + i % 20)} t{chr(97 + i % 20)}")
        if counts.entries > divergence.ENTRIES:
            for batch in counts.flush():
                for r in batch.to_pylist():
                    found[r["digest"]] += r["n"]
    for batch in counts.flush():
        for r in batch.to_pylist():
            found[r["digest"]] += r["n"]
    assert found[divergence.term_digest(b"common", 64)] == 40 and found[divergence.term_digest(b"ta", 64)] == 4
