"""Line dedup by winnowing: window minima over line hashes find repeated runs, which are then extended both ways."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeline.runtime import lookup, materialize

# Every repeated run of whole lines with this many words is found and deleted.
MIN_WORDS = 50
# A fingerprint covers the fewest lines from its first one on that hold this many words.
GRAM_WORDS = 25
ADDED = ("n_lines", "removed_lines", "removed_words")
KEPT = "__kept"
LEFT_BITS = (1 << 63) - 1
NO_ID = -(1 << 63)

WINDOW = "struct<key: long, first: int, last: int, left: array<long>, right: array<long>, longer: array<long>>"


def line_hashes(text: str) -> tuple[list[int], list[int], list[int]]:
    """Of each line with a word: its place among all lines, its hash and its number of words.

    Lines are equal if their words are, whatever the case and the white space around them.
    """
    places, hashes, sizes = [], [], []
    for place, line in enumerate(text.split("\n")):
        words = line.lower().split()
        if words:
            places.append(place)
            hashes.append(xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass")) & LEFT_BITS)
            sizes.append(len(words))
    return places, hashes, sizes


def run_ends(sizes: list[int], least: int) -> list[int]:
    """For each line the last line of the shortest run from it that has `least` words; len(sizes) if none has."""
    ends, end, total = [], -1, 0
    for start, size in enumerate(sizes):
        while total < least and end + 1 < len(sizes):
            end += 1
            total += sizes[end]
        ends.append(end if total >= least else len(sizes))
        total -= size
    return ends


def hash_of(hashes: list[int]) -> int:
    return xxhash.xxh3_64_intdigest(b"".join(h.to_bytes(8, "little") for h in hashes)) & LEFT_BITS


def winnow(hashes: list[int], sizes: list[int], gram_words: int, min_words: int) -> list[tuple[int, list[int]]]:
    """(fingerprint, first lines of the windows that chose it): in each window the gram of least hash, the last of equals.

    A window is the shortest run from a line on that has `min_words` words, so equal runs
    of that size choose equal fingerprints at equal places.
    """
    n = len(hashes)
    grams, windows = run_ends(sizes, gram_words), run_ends(sizes, min_words)
    codes = [hash_of(hashes[i : e + 1]) if e < n else -1 for i, e in enumerate(grams)]
    chosen: dict[int, list[int]] = {}
    for start, end in enumerate(windows):
        if end == n:
            break
        inside = [i for i in range(start, end + 1) if grams[i] <= end]
        best = min(inside, key=lambda i: (codes[i], -i))
        chosen.setdefault(best, []).append(start)
    return [(codes[i], starts) for i, starts in chosen.items()]


def context(hashes: list[int], sizes: list[int], at: int, step: int, words: int) -> list[int]:
    """Line hashes from `at` on, away from a window, until they have `words` words."""
    out, total = [], 0
    while 0 <= at < len(hashes) and total < words:
        out.append(hashes[at])
        total += sizes[at]
        at += step
    return out


def longer_keys(key: int, right: list[int]) -> list[int]:
    """Hashes of a window with the first, the first two, ... of the lines after it."""
    out = []
    for h in right:
        key = hash_of([key, h])
        out.append(key)
    return out


def row_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """Rows with equal id and text are one document."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, gram_words: int, min_words: int) -> DataFrame:
    """doc, version, fingerprint and its windows: their hash, first and last line among lines with words, and neighbours."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, versions, codes, found = [], [], [], []
            for doc, version, text in zip(*(c.to_pylist() for c in batch.columns)):
                _, hashes, sizes = line_hashes(text or "")
                ends = run_ends(sizes, min_words)
                for code, starts in winnow(hashes, sizes, gram_words, min_words):
                    docs_.append(doc)
                    versions.append(version)
                    codes.append(code)
                    windows = []
                    for s in starts:
                        key = hash_of(hashes[s : ends[s] + 1])
                        right = context(hashes, sizes, ends[s] + 1, 1, min_words)
                        left = context(hashes, sizes, s - 1, -1, min_words)
                        longer = longer_keys(key, right)
                        windows.append({"key": key, "first": s, "last": ends[s], "left": left, "right": right, "longer": longer})
                    found.append(windows)
            kind = pa.struct(
                [("key", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
                 ("left", pa.list_(pa.int64())), ("right", pa.list_(pa.int64())), ("longer", pa.list_(pa.int64()))]
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs_, pa.int64()), pa.array(versions, pa.int64()), pa.array(codes, pa.int64()), pa.array(found, pa.list_(kind))],
                names=["doc", "version", "fingerprint", "windows"],
            )

    doc, version = row_key(id_col, text_col)
    rows = docs.select(doc.alias("doc"), version.alias("version"), F.col(text_col).alias("text"))
    return rows.mapInArrow(find, f"doc long, version long, fingerprint long, windows array<{WINDOW}>")


def shared_lines(a: str, b: str) -> Column:
    """How many lines two neighbourhoods share from the window outwards."""
    n = F.least(F.size(a), F.size(b))
    differ = F.array_position(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x == y), False)
    return F.when(differ > 0, differ.cast("int") - 1).otherwise(n)


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, gram_words: int, min_words: int) -> DataFrame:
    """The windows of fingerprints that occur more than once, each with the place it has."""
    found, _ = materialize(fingerprints(docs, id_col, text_col, gram_words, min_words))
    often = found.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("fingerprint")
    windows = found.join(often, "fingerprint", "left_semi").select("doc", "version", F.explode("windows").alias("w"))
    return materialize(windows.select("doc", "version", "w.*").distinct())[0]


def by_document(runs: DataFrame) -> DataFrame:
    return runs.groupBy("doc", "version").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"))


def repeated_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram_words: int = GRAM_WORDS, min_words: int = MIN_WORDS
) -> DataFrame:
    """doc, version, runs: the runs of lines with words that stand earlier, in order of id, version and line.

    A fingerprint that occurs once ends there. The windows of the others are grouped by
    their whole content; each later one is joined with the first of its group only, so a
    passage in a third of all documents gives a row for each of its places. Matches grow
    line by line while both sides agree; beyond the window that takes under `min_words`
    words on either side, since further lines lie in windows of their own.
    """
    return by_document(runs_of_firsts(repeated_windows(docs, id_col, text_col, gram_words, min_words)))


def runs_of_firsts(windows: DataFrame) -> DataFrame:
    """(doc, version, first, last) of what later windows share with the first place of their content."""
    place = F.struct("doc", "version", "first", "last", "left", "right")
    firsts = windows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "version", "first")).alias("o"))
    firsts = firsts.filter("n > 1").select("key", "o.*")
    # Written before the join, which can then split the rows of a passage that very many documents have.
    source, _ = materialize(windows.join(firsts, ["key", "doc", "version", "first"]).select("key", place.alias("o")))
    pairs = lookup(windows, "key", source.hint("merge"), by=F.col("doc"), how="inner").filter(
        (F.col("doc") != F.col("o.doc")) | (F.col("version") != F.col("o.version")) | (F.col("first") != F.col("o.first"))
    )
    pairs = pairs.withColumns({"up": shared_lines("left", "o.left"), "down": shared_lines("right", "o.right")})
    own = (F.col("doc") == F.col("o.doc")) & (F.col("version") == F.col("o.version"))
    start = F.col("first") - F.col("up")
    # Inside one text the earlier run itself stays.
    start = F.when(own, F.greatest(start, F.col("o.last") + F.col("down") + 1)).otherwise(start)
    runs = pairs.select("doc", "version", start.alias("first"), (F.col("last") + F.col("down")).alias("last"))
    return runs.filter("first <= last").distinct()


def runs_elsewhere(windows: DataFrame) -> DataFrame:
    """(doc, version, first, last) of longer runs that stand earlier, but not at the first place of their window.

    Only windows with three places or more can have such runs. Each is taken with each
    number of lines after it; what of that has an earlier place goes. Lines before a
    window belong to windows of their own.
    """
    many = windows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 2").select("key")
    grown = windows.join(many, "key", "left_semi").select(
        "doc", "version", "first", "last", F.posexplode("longer").alias("lines", "key")
    )
    grown = grown.select("key", "doc", "version", "first", (F.col("last") + F.col("lines") + 1).alias("last"))
    grown, seen = materialize(grown)
    firsts = grown.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "version", "first", "last")).alias("o")
    )
    firsts, _ = materialize(firsts.filter("n > 1").select("key", "o"))
    pairs = lookup(grown, "key", firsts.hint("merge"), by=F.col("doc"), rows=seen["rows"], how="inner")
    own = (F.col("doc") == F.col("o.doc")) & (F.col("version") == F.col("o.version"))
    pairs = pairs.filter(~(own & (F.col("first") == F.col("o.first"))))
    # Inside one text the earlier run itself stays.
    start = F.when(own, F.greatest(F.col("first"), F.col("o.last") + 1)).otherwise(F.col("first"))
    runs = pairs.select("doc", "version", start.alias("first"), "last").filter("first <= last")
    return runs.groupBy("doc", "version", "first").agg(F.max("last").alias("last"))


def all_repeated_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram_words: int = GRAM_WORDS, min_words: int = MIN_WORDS
) -> DataFrame:
    """Defined as `repeated_runs`, with the runs that stand at any earlier place of a window, the first or another."""
    windows = repeated_windows(docs, id_col, text_col, gram_words, min_words)
    columns = ("doc", "version", "first", "last")
    runs = runs_of_firsts(windows).select(*columns).unionByName(runs_elsewhere(windows).select(*columns))
    return by_document(runs)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram_words: int = GRAM_WORDS, min_words: int = MIN_WORDS
) -> DataFrame:
    """The rows of `docs` with repeated runs deleted from the text, and n_lines, removed_lines and removed_words.

    A run of whole lines goes if it has at least `min_words` words and the same run stands
    in a document of smaller id, or earlier in its own text; of a run the first place
    stays. Lines are compared without regard to case and white space; lines without words
    neither count nor part a run, and go only between two deleted lines. Rows with equal
    id and text are one document, and all of them keep what it keeps; a null id comes
    before all others. A null text stays null. Other columns stay, but for those named like the added ones.
    """
    names = docs.columns
    runs, _ = materialize(all_repeated_runs(docs, id_col, text_col, gram_words, min_words))
    doc, version = row_key(id_col, text_col)
    rows = docs.select(*(F.col(f"`{c}`") for c in names), doc.alias("__doc"), version.alias("__version"))
    runs = runs.select(F.col("doc").alias("__doc"), F.col("version").alias("__version"), F.col("runs").alias("__runs"))
    # Texts and runs both grow with the input, so neither is broadcast, however small it is here.
    joined = rows.join(runs.hint("merge"), ["__doc", "__version"], "left")
    added = [T.StructField(c, T.LongType()) for c in ADDED] + [T.StructField(KEPT, T.StringType())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, words, kept = [], [], [], []
            for text, found in zip(batch.column("__cut").to_pylist(), batch.column("__runs").to_pylist()):
                result = cut_runs(text, [(r["first"], r["last"]) for r in found or ()])
                for column, value in zip((counts, gone, words, kept), result):
                    column.append(value)
            new = [pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(words, pa.int64()), pa.array(kept, pa.string())]
            old = [batch.column(c) for c in passed]
            yield pa.RecordBatch.from_arrays(old + new, names=[*passed, *ADDED, KEPT])

    passed = [c for c in names if c not in (text_col, *ADDED)]
    schema = T.StructType([f for f in docs.schema.fields if f.name in passed] + added)
    cut_rows = joined.select(*(F.col(f"`{c}`") for c in passed), F.col(f"`{text_col}`").alias("__cut"), "__runs")
    return cut_rows.mapInArrow(cut, schema).withColumnRenamed(KEPT, text_col)


def cut_runs(text: str | None, runs: list[tuple[int, int]]) -> tuple[int, int, int, str | None]:
    """Lines with words, lines and words deleted, and what is left of the text."""
    if text is None:
        return 0, 0, 0, None
    places, _, sizes = line_hashes(text)
    if not runs:
        return len(places), 0, 0, text
    gone = {i for first, last in runs for i in range(first, last + 1)}
    lines = text.split("\n")
    drop = {places[i] for i in gone}
    for i in gone:
        if i + 1 in gone:
            drop.update(range(places[i] + 1, places[i + 1]))
    kept = "\n".join(line for k, line in enumerate(lines) if k not in drop)
    return len(places), len(gone), sum(sizes[i] for i in gone), kept
