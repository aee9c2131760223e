"""Quality rules: counts inside each text, and lines that too many of a host's documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeline.runtime import BROADCAST_BYTES, lookup, materialize

# White space between words, and the symbols counted.
SPACE = r"\x20\x09-\x0D"
SYMBOLS = r"#*$%&|<>"
WINDOW = 5


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def normal_lines(text: Column) -> Column:
    """Lines in lower case with single spaces and no white space around them; lines without a word are left out."""
    plain = F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.array_remove(F.split(F.trim(plain), " ?\n ?"), "")


def with_text_counts(docs: DataFrame, text: str) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the column `text`, which has no nulls.

    Every step stands in a projection of its own, since what a lambda refers to would
    otherwise be worked out anew for each element.
    """
    counted = docs.withColumn("__words", words_of(F.col(text))).withColumn("__n", F.size("__words"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    counted = counted.withColumn("__lines", lines)
    window = F.transform(
        F.sequence(F.lit(0), F.col("__n") - WINDOW),
        lambda i: F.xxhash64(*(F.get("__words", i + k) for k in range(WINDOW))),
    )
    counted = counted.withColumn("__windows", F.when(F.col("__n") >= WINDOW, window))
    counted = counted.withColumns(
        {
            "n_words": F.col("__n").cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            # Only texts with a repeated window go on.
            "__windows": F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), F.col("__windows")),
        }
    )
    order = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    counted = counted.withColumn("__order", order)
    repeated = F.filter(
        "__order",
        lambda x, i: (F.get("__order", i - 1)["h"] == x["h"]) | (F.get("__order", i + 1)["h"] == x["h"]),
    )
    counted = counted.withColumn("__at", F.sort_array(F.transform(repeated, lambda x: x["at"])))
    new = F.transform(
        "__at", lambda at, i: F.when(i == 0, F.lit(WINDOW)).otherwise(F.least(F.lit(WINDOW), at - F.get("__at", i - 1)))
    )
    total = F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x)
    return counted.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).drop(
        "__words", "__n", "__lines", "__windows", "__order", "__at"
    )


# A line of over so many percent of a host's distinct texts, and of at least so many of them, is common there.
MAX_PERCENT = 2
MIN_DOCS = 10


def common_lines(lines: DataFrame, max_percent: int = MAX_PERCENT, min_docs: int = MIN_DOCS) -> tuple[DataFrame, dict]:
    """(host, line): hashes of lines that over `max_percent` of a host's distinct texts and at least `min_docs` have.

    `lines` has host, text_hash and line_hashes. Exact copies count as one document, so a
    group of copies does not make its own lines common. Written as a table, with its size.
    """
    single = lines.select("host", "text_hash", F.explode(F.array_distinct("line_hashes")).alias("line"))
    counts = (
        single.groupBy("host", "line", "text_hash")
        .agg(F.lit(1).alias("one"))
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("docs"))
        .filter(F.col("docs") >= min_docs)
    )
    counts, seen = materialize(counts)
    hosts, size = materialize(lines.groupBy("host").agg(F.count_distinct("text_hash").alias("host_docs")))
    if size["bytes"] <= BROADCAST_BYTES:
        joined = counts.join(F.broadcast(hosts), "host")
    else:
        joined = lookup(counts, "host", hosts, F.col("line"), rows=seen["rows"])
    return materialize(joined.filter(100 * F.col("docs") > max_percent * F.col("host_docs")).select("host", "line"))


def with_common(lines: DataFrame, common: DataFrame, size: dict) -> DataFrame:
    """The rows of `lines` (host, line and others) whose line is common for the host.

    The table of common lines is broadcast behind its size; beyond it, a line that very
    many texts have is spread over slices.
    """
    if size["bytes"] <= BROADCAST_BYTES:
        return lines.join(F.broadcast(common), ["host", "line"])
    keyed = lines.withColumn("key", F.struct("host", "line")).drop("host", "line")
    known = common.select(F.struct("host", "line").alias("key"))
    rest = [F.col(c) for c in keyed.columns if c != "key"]
    found = lookup(keyed, "key", known, F.xxhash64(*rest), how="inner")
    return found.select("key.host", "key.line", *rest)


def hashed_lines(docs: DataFrame, text: str, host: str) -> DataFrame:
    """Add host, text_hash, line_hashes and line_words to the rows of `docs`."""
    kept = docs.withColumn("__lines", normal_lines(F.col(text)))
    return kept.withColumns(
        {
            "host": F.coalesce(F.col(host).cast("string"), F.lit("")),
            "text_hash": F.xxhash64(text),
            "line_hashes": F.transform("__lines", lambda line: F.xxhash64(line)),
            "line_words": F.transform("__lines", lambda line: F.size(F.split(line, " "))),
        }
    ).drop("__lines")


def base_failed(min_words: int = 10, max_repeat_percent: int = 20) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def depleted(min_words: int = 10, min_left_percent: int = 50) -> Column:
    """Whether removing its host's common lines leaves a text too short or without most of its words."""
    left = F.col("n_words") - F.col("removed_words")
    return (F.col("removed_words") > 0) & ((left < min_words) | (100 * left < min_left_percent * F.col("n_words")))


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_percent: int = MAX_PERCENT,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """One row per row of `docs`: the counts, the words its host's common lines hold, and the verdict.

    A document goes if it has under 10 words, if words in repeated 5-word windows are over
    20 % of its words, or if removing common lines leaves under 10 words or under half of
    them. A null or empty text has no words and fails. A null host counts as the empty
    name. Rows with null or repeated ids are each judged by their own text; other columns
    are ignored. The texts are read once; counts and line hashes are written as a table
    with numbered rows, and only hashes are shuffled. One host may hold most rows: hashes
    are counted by host and line, lines meet the common ones by both, and what a row loses
    comes back to it by its number.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("__text"),
        F.col(host_col).alias("__host"),
    )
    counted = hashed_lines(with_text_counts(rows, "__text"), "__text", "__host").drop("__text", "__host")
    written, _ = materialize(counted.withColumn("row", F.monotonically_increasing_id()))
    common, size = common_lines(written.select("host", "text_hash", "line_hashes"), max_percent, min_docs)
    verdict = written.drop("host", "text_hash", "line_hashes", "line_words")
    if size["rows"]:
        lines = written.select("row", "host", F.inline(F.arrays_zip("line_hashes", "line_words")).alias("line", "words"))
        removed = with_common(lines, common, size).groupBy("row").agg(F.sum("words").alias("removed_words"))
        verdict = verdict.join(removed, "row", "left")
        verdict = verdict.withColumn("removed_words", F.coalesce("removed_words", F.lit(0).cast("long")))
    else:
        verdict = verdict.withColumn("removed_words", F.lit(0).cast("long"))
    return verdict.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words",
        base_failed().alias("base_failed"), (~base_failed() & ~depleted()).alias("kept"),
    )


def clean(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    max_percent: int = MAX_PERCENT,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns, without their hosts' common lines.

    Defined as `judge`; other lines of a text stay as they are. The texts are read twice,
    once for the common lines and once to take them out. Each distinct text of a host has a
    list of those of its own lines that are common; the lists are broadcast behind their
    size, and beyond it texts of which there are very many copies are spread over slices.
    """
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"),
        F.coalesce(F.col(text_col), F.lit("")).alias("__text"),
        F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
    )
    hashes = hashed_lines(rows.select("__text", "host"), "__text", "host")
    written, _ = materialize(hashes.select("host", "text_hash", "line_hashes"))
    common, size = common_lines(written, max_percent, min_docs)
    single = written.select("host", "text_hash", F.explode("line_hashes").alias("line")).distinct()
    own = with_common(single, common, size).groupBy(F.struct("host", "text_hash").alias("__key"))
    lists, size = materialize(own.agg(F.collect_list("line").alias("common")))
    rows = rows.withColumn("__key", F.struct("host", F.xxhash64("__text").alias("text_hash")))
    if size["bytes"] <= BROADCAST_BYTES:
        listed = rows.join(F.broadcast(lists), "__key", "left")
    else:
        listed = lookup(rows, "__key", lists, F.monotonically_increasing_id())
    judged = with_text_counts(listed, "__text").withColumn("__own", F.split("__text", "\n"))

    def is_common(line: Column) -> Column:
        return F.array_contains("common", F.xxhash64(F.trim(F.regexp_replace(F.lower(line), f"[{SPACE}]+", " "))))

    left = F.array_join(F.filter("__own", lambda line: ~is_common(line)), "\n")
    judged = judged.withColumn("__left", F.when(F.col("common").isNull(), F.col("__text")).otherwise(left))
    removed = F.col("n_words") - F.size(words_of(F.col("__left")))
    judged = judged.withColumn("removed_words", F.when(F.col("common").isNull(), 0).otherwise(removed).cast("long"))
    # The row number keeps the filter above the counts, which would else be worked out inside its condition.
    judged = judged.withColumn("__number", F.monotonically_increasing_id())
    kept = judged.filter(~base_failed() & ~depleted() & (F.col("__number") >= 0))
    return kept.select(*((F.col("__left") if c == text_col else F.col("__row")[c]).alias(c) for c in docs.columns))


ORACLE = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents),
words AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word,
         generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS pos
  FROM docs
),
windows AS (
  SELECT doc_id, pos, word,
         CASE WHEN lead(pos, 4) OVER w IS NOT NULL THEN
           concat_ws(' ', word, lead(word) OVER w, lead(word, 2) OVER w, lead(word, 3) OVER w, lead(word, 4) OVER w) END AS win
  FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
),
flagged AS (
  SELECT doc_id, pos, word,
         CASE WHEN win IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, win) > 1 THEN 1 ELSE 0 END AS repeated
  FROM windows
),
covered AS (
  SELECT doc_id, word,
         max(repeated) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit
  FROM flagged
),
by_words AS (
  SELECT doc_id, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS word_chars,
         CAST(sum(hit) AS BIGINT) AS n_repeat_words
  FROM covered GROUP BY doc_id
),
lines AS (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM docs),
worded AS (
  SELECT doc_id, host, line, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) AS normal,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS line_words
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
by_lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY doc_id),
texts AS (SELECT host, count(DISTINCT text) AS host_docs FROM docs GROUP BY host),
common AS (
  SELECT host, normal FROM worded JOIN docs USING (doc_id, host) JOIN texts USING (host)
  GROUP BY host, normal, host_docs
  HAVING count(DISTINCT text) >= 10 AND 100 * count(DISTINCT text) > 2 * host_docs
),
removed AS (
  SELECT doc_id, CAST(sum(line_words) AS BIGINT) AS removed_words FROM worded SEMI JOIN common USING (host, normal)
  GROUP BY doc_id
),
counts AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(removed_words, 0) AS removed_words
  FROM docs LEFT JOIN by_words USING (doc_id) LEFT JOIN by_lines USING (doc_id) LEFT JOIN removed USING (doc_id)
),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         removed_words > 0 AND (n_words - removed_words < 10 OR 2 * (n_words - removed_words) < n_words) AS depleted
  FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_words, base_failed,
       NOT base_failed AND NOT depleted AS kept
FROM judged
"""
