"""How the term frequencies of sources differ: between the sources of a language, and from the language as a whole."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeline.runtime import broadcast_if_small, dense_index, lookup, materialize

# Parts of a whole that probabilities are given in.
SCALE = 1_000_000_000
# Distinct (group, term) entries a task holds before it hands them on.
ENTRIES = 400_000
# Sources are compared in blocks of so many, over buckets of about so many counts.
SOURCE_BLOCK = 256
BUCKET_ROWS = 200_000
# Terms times sources held at once while a bucket is compared.
CELLS = 1 << 20

# A to Z become small, other ASCII characters but a to z part terms, all further bytes stay.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


def term_digest(term: bytes, bits: int) -> int:
    """The low `bits` of a 64-bit hash, as a signed number."""
    value = xxhash.xxh3_64_intdigest(term) & ((1 << bits) - 1)
    return value - (1 << 64) if value >> 63 else value


PARTIALS = "ld long, gd long, digest long, n long, df long, term string"


class TermCounts:
    """Counts of (group, term) for the documents of a task, handed on whenever they are too many to hold."""

    def __init__(self, bits: int, every_term: bool):
        self.bits, self.every_term = bits, every_term
        self.occurrences: dict[tuple[int, int], Counter] = defaultdict(Counter)
        self.documents: dict[tuple[int, int], Counter] = defaultdict(Counter)
        self.digests: dict[bytes, int] = {}
        self.entries = 0

    def add(self, group: tuple[int, int], text: str) -> None:
        terms = terms_of(text)
        counts = self.occurrences[group]
        before = len(counts)
        counts.update(terms)
        self.documents[group].update(set(terms))
        self.entries += len(counts) - before

    def flush(self) -> Iterator[pa.RecordBatch]:
        """A row per (group, term); a term's text stands in the first row that has it."""
        for (ld, gd), counts in self.occurrences.items():
            if not counts:
                continue
            terms, digests, texts = list(counts), [], []
            for term in terms:
                known = self.digests.get(term)
                if known is None:
                    known = self.digests[term] = term_digest(term, self.bits)
                    texts.append(term)
                else:
                    texts.append(term if self.every_term else None)
                digests.append(known)
            n = len(terms)
            df = self.documents[ld, gd]
            columns = [
                pa.array(np.full(n, ld, np.int64)), pa.array(np.full(n, gd, np.int64)), pa.array(digests, pa.int64()),
                pa.array(list(counts.values()), pa.int64()), pa.array(list(map(df.__getitem__, terms)), pa.int64()),
                pa.array(texts, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PARTIALS.split(", ")])
        self.occurrences.clear()
        self.documents.clear()
        self.entries = 0
        if len(self.digests) > ENTRIES:
            self.digests.clear()


def partial_counts(rows: DataFrame, bits: int, every_term: bool = False) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = TermCounts(bits, every_term)
        for batch in batches:
            for ld, gd, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                counts.add((ld, gd), text)
                if counts.entries > ENTRIES:
                    yield from counts.flush()
        yield from counts.flush()

    return rows.select("ld", "gd", "text").mapInArrow(count, PARTIALS)


def share(n: Column | str, total: str, vocabulary: str) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + vocabulary)), in whole numbers of up to 38 digits."""
    count = F.lit(0) if n is None else F.col(n)
    above = (count.cast("decimal(20,0)") + F.lit(1)) * F.lit(SCALE).cast("decimal(10,0)")
    below = (F.col(total) + F.col(vocabulary)).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", above, below)


def gap(p: str, q: str) -> Column:
    """floor((p - q)^2 / q); the square of two shares fits in a long."""
    return F.call_function("div", (F.col(p) - F.col(q)) * (F.col(p) - F.col(q)), F.col(q))


def keyed_groups(rows: DataFrame) -> tuple[DataFrame, int]:
    """(lang, source, ld, gd): the groups that occur with digests of 8 bytes, and the seed under which none are shared."""
    found, _ = materialize(rows.select("lang", "source").distinct())
    seed = 0
    while True:
        keyed, seen = materialize(
            found.withColumns({"ld": F.xxhash64(F.lit(seed), "lang"), "gd": F.xxhash64(F.lit(seed), "lang", "source")})
        )
        langs = keyed.groupBy("ld").agg(F.count_distinct("lang").alias("n")).filter("n > 1")
        groups = keyed.groupBy("gd").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        if langs.isEmpty() and groups.isEmpty():
            return keyed, seed
        seed += 1


def compare_bucket(terms: pa.Table, sources: pa.Table, left: int, right: int) -> tuple[np.ndarray, int]:
    """Sums over the terms of a bucket of every ordered pair's gap, and how many terms they are."""
    gd, p0 = sources.column("gd").to_numpy(), sources.column("p0").to_numpy()
    digest = terms.column("digest").to_numpy()
    split = terms.column("split").to_pylist()
    if any(split):
        number: dict[tuple[int, str], int] = {}
        at = np.array([number.setdefault(k, len(number)) for k in zip(digest.tolist(), split)], np.int64)
        n_terms = len(number)
    else:
        distinct, at = np.unique(digest, return_inverse=True)
        n_terms = len(distinct)
    order = np.argsort(gd)
    column = order[np.searchsorted(gd[order], terms.column("gd").to_numpy())]
    by_term = np.argsort(at, kind="stable")
    at, column, p = at[by_term], column[by_term], terms.column("p").to_numpy()[by_term]
    block = sources.column("block").to_numpy()
    sums = np.zeros((len(gd), len(gd)), np.int64)
    step = max(CELLS // max(len(gd), 1), 1)
    for start in range(0, n_terms, step):
        rows = slice(*np.searchsorted(at, [start, start + step]))
        shares = np.tile(p0, (min(step, n_terms - start), 1))
        shares[at[rows] - start, column[rows]] = p[rows]
        for i in range(len(gd)):
            # Within one block all ordered pairs are wanted, between two those across.
            others = np.flatnonzero((block == (right if block[i] == left else left)) if left != right else np.ones(len(gd), bool))
            q = shares[:, others]
            d = shares[:, [i]] - q
            sums[i, others] += (d * d // q).sum(axis=0)
    return sums, n_terms


def pair_sums(shares: DataFrame, groups: DataFrame, langs: DataFrame, langs_bytes: int) -> DataFrame:
    """(gd, other, total, present): per ordered pair of a language's sources the gaps of all terms that one of their blocks has."""
    per_lang = broadcast_if_small(langs.select("ld", "buckets", "blocks"), langs_bytes)
    # Each block meets each block of its language, itself included.
    met = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    ends = {"left": F.least("block", "met"), "right": F.greatest("block", "met")}
    bucket = F.pmod(F.xxhash64("digest"), F.col("buckets")).cast("int")
    terms = shares.join(per_lang, "ld").withColumn("bucket", bucket).withColumn("met", met).withColumns(ends)
    sources = groups.join(per_lang, "ld").withColumn("met", met).withColumns(ends)
    sources = sources.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)))

    def compare(key, terms, sources):
        left, right = key[1].as_py(), key[2].as_py()
        sums, n_terms = compare_bucket(terms, sources, left, right)
        gd, block = sources.column("gd").to_numpy(), sources.column("block").to_numpy()
        wanted = ~np.eye(len(gd), dtype=bool)
        if left != right:
            wanted &= block[:, None] != block[None, :]
        i, j = np.nonzero(wanted)
        columns = [pa.array(gd[i]), pa.array(gd[j]), pa.array(sums[i, j]), pa.array(np.full(len(i), n_terms, np.int64))]
        return pa.table(columns, ["gd", "other", "total", "present"])

    keys = ["ld", "left", "right", "bucket"]
    one = terms.select(*keys, "gd", "digest", "split", "p").groupBy(*keys)
    two = sources.select(*keys, "gd", "block", "p0").groupBy(*keys)
    parts = one.cogroup(two).applyInArrow(compare, "gd long, other long, total long, present long")
    return parts.groupBy("gd", "other").agg(F.sum("total").alias("total"), F.sum("present").alias("present"))


def divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = 3,
    top: int = 200,
    digest_bits: int = 64,
    source_block: int = SOURCE_BLOCK,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """lang, source, part, item, value, rank: every source against the others of its language, and against the language.

    Terms are stretches of letters A to Z and of anything beyond ASCII, A to Z made small;
    a language keeps those of at least `min_docs` of its rows. Shares are smoothed by one
    occurrence of each kept term. Part `pair` has every other source of the language with
    the gaps of the two sources' shares summed over all kept terms; part `term` the `top`
    terms that are more frequent in the source than in the language. Null texts, languages
    and sources count as empty; a group without terms has equal shares of all terms, and a
    language that keeps none has pairs of value 0. Each row is a document, whatever its id;
    other columns are ignored.

    Tasks count the terms of their documents first; what is shuffled then are 8-byte digests
    of groups and terms with counts. The smallest and largest text of every digest that is
    kept tell whether terms share it; those digests (none, as a rule) are counted once more
    by text. Terms of the result get their texts back by a join of just those digests.
    Sources are compared in blocks over buckets of terms, each of bounded size; a group's
    top terms go through one task only as the first `top` of every other task.
    """
    rows = docs.select(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
    )
    groups, seed = keyed_groups(rows)
    rows = rows.withColumns({"ld": F.xxhash64(F.lit(seed), "lang"), "gd": F.xxhash64(F.lit(seed), "lang", "source")})
    partials, _ = materialize(partial_counts(rows, digest_bits))
    totals = [F.sum("n").alias("n"), F.sum("df").alias("df")]
    counts, _ = materialize(partials.groupBy("ld", "gd", "digest").agg(*totals).withColumn("split", F.lit("")))

    def kept_of(counts: DataFrame) -> DataFrame:
        found = counts.groupBy("ld", "digest", "split").agg(F.sum("n").alias("n_lang"), F.sum("df").alias("df"))
        return found.filter(F.col("df") >= min_docs).drop("df")

    kept, _ = materialize(kept_of(counts))
    texts = partials.filter("term IS NOT NULL").select("digest", "term").join(kept.select("digest").distinct(), "digest", "left_semi")
    clash = F.col("first") != F.col("last")
    texts, seen = materialize(
        texts.groupBy("digest").agg(F.min("term").alias("first"), F.max("term").alias("last")), clashes=F.count_if(clash)
    )
    if seen["clashes"]:
        # Digests that several terms share: count them by text.
        shared, size = materialize(texts.filter(clash).select("digest"))
        shared = broadcast_if_small(shared, size["bytes"])
        exact = partial_counts(rows, digest_bits, every_term=True).join(shared, "digest", "left_semi")
        exact = exact.groupBy("ld", "gd", "digest", F.col("term").alias("split")).agg(*totals)
        clean = counts.join(shared, "digest", "left_anti")
        counts, _ = materialize(clean.unionByName(exact))
        kept, _ = materialize(kept_of(counts))
        texts = texts.filter(~clash)

    shares, _ = materialize(counts.drop("df").join(kept, ["ld", "digest", "split"]))
    sums = shares.groupBy("ld", "gd").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows"))
    groups = groups.join(sums, ["ld", "gd"], "left").withColumns(
        {"total": F.coalesce("total", F.lit(0).cast("long")), "key": F.struct("lang", "source")}
    )
    groups, _ = dense_index(groups, "key", "number")
    vocabulary = kept.groupBy("ld").agg(F.count(F.lit(1)).alias("vocabulary"))
    of_lang = groups.groupBy("ld").agg(
        F.min("number").alias("first"),
        F.sum("total").alias("lang_total"),
        F.greatest(F.ceil(F.sum("rows") / F.lit(bucket_rows)).cast("int"), F.lit(1)).alias("buckets"),
        F.ceil(F.count(F.lit(1)) / F.lit(source_block)).cast("int").alias("blocks"),
    )
    langs, size = materialize(
        of_lang.join(vocabulary, "ld", "left").withColumn("vocabulary", F.coalesce("vocabulary", F.lit(0).cast("long")))
    )
    langs_bytes = size["bytes"]
    groups = groups.drop("key", "rows").join(broadcast_if_small(langs.drop("buckets", "blocks"), langs_bytes), "ld")
    p0 = F.when(F.col("vocabulary") > 0, share(None, "total", "vocabulary"))
    block = F.floor((F.col("number") - F.col("first")) / F.lit(source_block)).cast("int")
    groups, size = materialize(groups.withColumns({"p0": p0, "block": block}).drop("number", "first"))
    about = groups.select("gd", "total", "lang_total", "vocabulary", "block")
    if size["bytes"] <= 64_000_000:
        shares = shares.join(F.broadcast(about), "gd")
    else:
        shares = lookup(shares, "gd", about, F.col("digest"))
    shares = shares.withColumns(
        {"p": share("n", "total", "vocabulary"), "q": share("n_lang", "lang_total", "vocabulary")}
    )
    shares, _ = materialize(shares.select("ld", "gd", "block", "digest", "split", "p", "q"))
    small = size["bytes"]

    compared, _ = materialize(pair_sums(shares, groups.filter("vocabulary > 0"), langs.filter("vocabulary > 0"), langs_bytes))
    pairs = _paired(groups, langs, langs_bytes).join(compared, ["gd", "other"], "left")
    unseen = F.col("vocabulary") - F.coalesce("present", F.lit(0))
    value = F.coalesce("total", F.lit(0)) + F.when(unseen > 0, unseen * gap("p0", "q0")).otherwise(F.lit(0))
    order = Window.partitionBy("gd").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("value", value.cast("long")).withColumn("rank", F.row_number().over(order))
    part_pair = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")

    above = shares.filter("p > q").select("gd", "digest", "split", gap("p", "q").alias("value"))
    leading = above.withColumn("rank", F.row_number().over(Window.partitionBy("gd").orderBy(F.desc("value")))).filter(F.col("rank") <= top)
    least, seen = materialize(leading.groupBy("gd").agg(F.min("value").alias("least")))
    if seen["bytes"] <= 64_000_000:
        likely = above.join(F.broadcast(least), "gd")
    else:
        likely = lookup(above, "gd", least, F.col("digest"))
    likely, seen = materialize(likely.filter("value >= least").drop("least"))
    named = likely.join(texts.select("digest", "first"), "digest", "left").withColumn(
        "item", F.when(F.col("split") != "", F.col("split")).otherwise(F.col("first"))
    )
    order = Window.partitionBy("gd").orderBy(F.desc("value"), "item")
    named = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    names = broadcast_if_small(groups.select("gd", "lang", "source"), small)
    part_term = named.join(names, "gd").select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return part_pair.unionByName(part_term)


def _paired(groups: DataFrame, langs: DataFrame, langs_bytes: int) -> DataFrame:
    """Each group with each other of its language, which is what the result lists; met by blocks of sources."""
    blocks = broadcast_if_small(langs.select("ld", "blocks"), langs_bytes)
    one = groups.select("ld", "gd", "lang", "source", "p0", "vocabulary").join(blocks, "ld")
    one = one.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    two = groups.select("ld", "block", F.col("gd").alias("other"), F.col("source").alias("item"), F.col("p0").alias("q0"))
    return one.join(two, ["ld", "block"]).filter("gd <> other")


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
),
terms AS (
  SELECT row_id, lang, source,
         translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM docs
),
kept AS (SELECT lang, term, count(*) AS n FROM terms GROUP BY lang, term HAVING count(DISTINCT row_id) >= 3),
langs AS (
  SELECT lang, count(term) AS v, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang
),
counts AS (SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN counts USING (lang, source) GROUP BY lang, source
),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (g.total + v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 1)) // (l.total + v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
),
listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM shares WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
  FROM listed
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
