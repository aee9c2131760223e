"""Quotation linking: quoted passages find the messages they come from, and conversations lose their quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeline.runtime import lookup, materialize

SPACE = r"\x20\x09-\x0D"
# How a quoted line begins, and the line that announces a quotation.
QUOTE = r"^(\x20*>)+"
ANNOUNCED = r"^On .+ wrote:[\x20\x09-\x0D]*$"


def normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), f"[{SPACE}]+", " "))


def with_lines(messages: DataFrame, text: str) -> DataFrame:
    """Add `__lines`: each line's quote level, what follows the quote marks, and whether it is the message's own.

    A line that announces the quotation right below it belongs to the quotation.
    """
    lines = F.transform(
        F.split(text, "\n"),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, QUOTE, 0), " ", "")).alias("level"),
            F.regexp_replace(line, QUOTE + r"\x20?", "").alias("body"),
        ),
    )
    split = messages.withColumn("__split", lines)
    marked = F.transform(
        "__split",
        lambda x, i: F.struct(
            x["level"].alias("level"),
            x["body"].alias("body"),
            (
                (x["level"] == 0)
                & ~(x["body"].rlike(ANNOUNCED) & (F.coalesce(F.get("__split", i + 1)["level"], F.lit(0)) > 0))
            ).alias("own"),
        ),
    )
    return split.withColumn("__lines", marked).drop("__split")


# Turns of a conversation that are put in order together.
RANGE_TURNS = 1024


def with_passages(messages: DataFrame) -> DataFrame:
    """Add `own`, the hashes of a message's own lines, and `passages`: quote level and line hashes of each quotation.

    A passage is a run of lines of one level; lines without words are left out of it. Every
    step stands in a projection of its own, since what a lambda refers to would otherwise
    be worked out anew for each element.
    """
    normal_lines = F.transform("__lines", lambda x: F.struct(x["level"].alias("level"), x["own"].alias("own"), normal(x["body"]).alias("line")))
    hashed = F.transform(
        "__normal",
        lambda x: F.struct(
            x["level"].alias("level"),
            x["own"].alias("own"),
            F.when((x["line"] != "") & (x["own"] | (x["level"] > 0)), F.xxhash64(x["line"])).alias("hash"),
        ),
    )
    begins = F.filter(
        F.sequence(F.lit(0), F.size("__hashed") - 1),
        lambda i: (i == 0) | (F.get("__hashed", i)["level"] != F.get("__hashed", i - 1)["level"]),
    )

    def run(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get("__begins", k + 1), F.size("__hashed"))
        worded = F.filter(F.slice("__hashed", start + 1, end - start), lambda x: x["hash"].isNotNull())
        return F.struct(F.get("__hashed", start)["level"].alias("level"), F.transform(worded, lambda x: x["hash"]).alias("lines"))

    own = F.transform(F.filter("__hashed", lambda x: x["own"] & x["hash"].isNotNull()), lambda x: x["hash"])
    keyed = messages.withColumn("__normal", normal_lines).withColumn("__hashed", hashed).withColumn("__begins", begins)
    keyed = keyed.withColumns({"own": own, "__runs": F.transform("__begins", run)})
    passages = F.filter("__runs", lambda x: (x["level"] > 0) & (F.size(x["lines"]) > 0))
    return keyed.withColumn("passages", passages).drop("__normal", "__hashed", "__begins", "__runs")


def last_before(keyed: DataFrame) -> DataFrame:
    """(conv, turn, level, n, key, lines, source): for each quoted key the latest earlier turn that has it as its own, or null.

    `keyed` has conv, turn, key, own, level, n and lines. Own and quoted rows of one key are
    put in order of turn, and each quoted one takes the last own one before it, so no pairs
    are made. The turns of a conversation are ordered by ranges, and what earlier ranges end
    with is carried over, so a key that most of its messages have is dealt over tasks.
    """
    ranged = keyed.withColumn("range", F.floor(F.col("turn") / RANGE_TURNS))
    place = ["conv", "key", "range"]
    inside = Window.partitionBy(*place).orderBy("turn", "own").rowsBetween(Window.unboundedPreceding, -1)
    ranged = ranged.withColumn("near", F.max(F.when(F.col("own"), F.col("turn"))).over(inside))
    ends = ranged.filter("own").groupBy(*place).agg(F.max("turn").alias("end"))
    wanted = ranged.filter(~F.col("own")).select(*place).distinct().withColumn("end", F.lit(None).cast("long"))
    # One row per key and range.
    steps = ends.unionByName(wanted).groupBy(*place).agg(F.max("end").alias("end"))
    earlier = Window.partitionBy("conv", "key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried, _ = materialize(steps.select(*place, F.max("end").over(earlier).alias("carried")).filter("carried IS NOT NULL"))
    quoted = ranged.filter(~F.col("own")).join(carried, place, "left")
    return quoted.select("conv", "turn", "level", "n", "key", "lines", F.coalesce("near", "carried").alias("source"))


def linked_passages(messages: DataFrame) -> DataFrame:
    """(conv, turn, level, n, source): numbers of quoted lines by the latest earlier turn that they come from, or null.

    `messages` has conv, turn, own and passages, written. A passage comes from a message whose
    own lines hold it in one piece; the messages of a conversation give the hashes of
    their runs of just the lengths that its passages have. The lines of a passage that is
    found nowhere are looked up one by one.
    """
    blank = F.lit(None).cast("array<long>")
    passages = messages.select("conv", "turn", F.inline("passages").alias("level", "lines"))
    counted = passages.groupBy("conv", "turn", "level", "lines").agg(F.count(F.lit(1)).alias("times"))
    quoted = counted.select(
        "conv", "turn", F.xxhash64("lines").alias("key"), F.lit(False).alias("own"), "level",
        (F.col("times") * F.size("lines")).alias("n"), "lines",
    )
    quoted, _ = materialize(quoted)
    # One row per conversation, with the different lengths of its passages.
    lengths, _ = materialize(quoted.groupBy("conv").agg(F.collect_set(F.size("lines")).alias("lengths")))
    texts = messages.filter(F.size("own") > 0).select("conv", "turn", F.col("own").alias("whole"))
    met = lookup(texts, "conv", lengths, by=F.col("turn"), how="inner")
    each = met.select("conv", "turn", "whole", F.explode("lengths").alias("m")).filter(F.size("whole") >= F.col("m"))
    keys = F.transform(F.sequence(F.lit(1), F.size("whole") - F.col("m") + 1), lambda i: F.xxhash64(F.slice("whole", i, F.col("m"))))
    zero = F.lit(0)
    windows = each.select("conv", "turn", F.explode(keys).alias("key")).distinct()
    windows = windows.select("conv", "turn", "key", F.lit(True).alias("own"), zero.alias("level"), zero.cast("long").alias("n"), blank.alias("lines"))
    found, seen = materialize(last_before(windows.unionByName(quoted)), left=F.count_if(F.col("source").isNull()))
    linked = found.filter("source IS NOT NULL").select("conv", "turn", "level", "n", "source")
    if not seen["left"]:
        return linked
    times = F.col("n") / F.size("lines")
    lost = found.filter("source IS NULL").select("conv", "turn", "level", times.cast("long").alias("times"), F.explode("lines").alias("key"))
    lost = lost.groupBy("conv", "turn", "level", "key").agg(F.sum("times").alias("n"))
    lost = lost.select("conv", "turn", "key", F.lit(False).alias("own"), "level", "n", blank.alias("lines"))
    singles = texts.select("conv", "turn", F.explode("whole").alias("key")).distinct()
    singles = singles.join(lost.select("conv", "key").distinct(), ["conv", "key"], "left_semi")
    singles = singles.select("conv", "turn", "key", F.lit(True).alias("own"), zero.alias("level"), zero.cast("long").alias("n"), blank.alias("lines"))
    by_line = last_before(singles.unionByName(lost)).select("conv", "turn", "level", "n", "source")
    return linked.unionByName(by_line)


def thread_places(parents: DataFrame) -> DataFrame:
    """(conv, turn, root, depth) of replies (conv, turn, parent), by pointers that double their reach each round."""
    tops = parents.select("conv", F.col("parent").alias("turn")).distinct().join(parents, ["conv", "turn"], "left_anti")
    start = parents.select("conv", "turn", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth"))
    start = start.unionByName(tops.select("conv", "turn", F.col("turn").alias("root"), F.lit(0).cast("long").alias("depth")))
    state, seen = materialize(start, moved=F.count_if(F.col("depth") > 0))
    while seen["moved"]:
        above = state.select("conv", F.col("turn").alias("root"), F.col("root").alias("up"), F.col("depth").alias("more"))
        further = state.join(above, ["conv", "root"]).select(
            "conv", "turn", F.col("up").alias("root"), (F.col("depth") + F.col("more")).alias("depth"), "more"
        )
        state, seen = materialize(further, moved=F.count_if(F.col("more") > 0))
        state = state.drop("more")
    return state


def link_quotes(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per row of `messages`: where it stands in its thread, and its text without quotes.

    conv_id, turn, role; parent_turn: the earlier message it quotes, by its outermost level
    with a passage or line that is known, then by most lines, then the latest; root_turn and depth:
    the start of its thread and its distance from it; n_quoted_lines and n_linked_lines;
    text: its own lines, without announcements of quotations and outer white space; chat:
    the text after its role's mark. In order of conv_id, root_turn, depth and turn every
    message follows the one it replies to.

    Quoted passages are looked up by hash within their conversation, without regard to case,
    white space and lines without words; lines by themselves only where no message has the
    whole passage. A null or empty text has no lines. Rows with a null conversation or
    turn, and messages that quote nothing known, start threads. Rows that share a
    conversation and turn are one place in the thread, whose lines count together; each
    keeps its own text. Further columns are ignored.
    """
    rows = messages.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.col(role_col).cast("string").alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    parsed = with_lines(rows, "text")
    hashed = with_passages(parsed.filter("conv IS NOT NULL AND turn IS NOT NULL")).select("conv", "turn", "own", "passages")
    hashed, _ = materialize(hashed)
    links, _ = materialize(linked_passages(hashed))
    by_source = links.groupBy("conv", "turn", "level", "source").agg(F.sum("n").alias("n"))
    best = F.max_by("source", F.when(F.col("source").isNotNull(), F.struct(-F.col("level"), F.col("n"), F.col("source"))))
    found = by_source.groupBy("conv", "turn").agg(
        best.alias("parent"),
        F.sum("n").alias("n_quoted"),
        F.sum(F.when(F.col("source").isNotNull(), F.col("n")).otherwise(0)).alias("n_linked"),
    )
    found, _ = materialize(found)
    places = thread_places(found.filter("parent IS NOT NULL").select("conv", "turn", "parent"))
    own = F.array_join(F.transform(F.filter("__lines", lambda x: x["own"]), lambda x: x["body"]), "\n")
    text = F.regexp_replace(own, f"^[{SPACE}]+|[{SPACE}]+$", "")
    placed = parsed.withColumn("clean", text).drop("__lines", "text")
    placed = placed.join(found, ["conv", "turn"], "left").join(places, ["conv", "turn"], "left")
    zero = F.lit(0).cast("long")
    return placed.select(
        F.col("conv").alias("conv_id"),
        "turn",
        "role",
        F.col("parent").alias("parent_turn"),
        F.coalesce("root", "turn").alias("root_turn"),
        F.coalesce("depth", zero).alias("depth"),
        F.coalesce("n_quoted", zero).alias("n_quoted_lines"),
        F.coalesce("n_linked", zero).alias("n_linked_lines"),
        F.col("clean").alias("text"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), F.col("clean")).alias("chat"),
    )


def reply_ordered(linked: DataFrame) -> DataFrame:
    """The rows of `link_quotes` dealt out and sorted by conversation and reply, a long conversation over several tasks."""
    order = ("conv_id", "root_turn", "depth", "turn")
    return linked.repartitionByRange(*order).sortWithinPartitions(*order)


ORACLE = r"""
WITH RECURSIVE messages AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, coalesce(text, '') AS text,
         row_number() OVER () AS r
  FROM conversations
),
raw AS (
  SELECT r, conv_id, turn, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM messages
),
split AS (
  SELECT r, conv_id, turn, i,
         length(replace(regexp_extract(line, '^(\x20*>)+'), ' ', '')) AS level,
         regexp_replace(line, '^(\x20*>)+\x20?', '') AS body
  FROM raw
),
lines AS (
  SELECT *, level = 0 AND NOT (regexp_matches(body, '^On .+ wrote:[\x20\x09-\x0D]*$')
            AND coalesce(lead(level) OVER (PARTITION BY r ORDER BY i), 0) > 0) AS own,
         trim(regexp_replace(lower(body), '[\x20\x09-\x0D]+', ' ', 'g')) AS normal
  FROM split
),
known AS (SELECT * FROM lines WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
runs AS (
  SELECT *, sum(starts) OVER (PARTITION BY r ORDER BY i) AS run
  FROM (SELECT *, CASE WHEN level = lag(level) OVER (PARTITION BY r ORDER BY i) THEN 0 ELSE 1 END AS starts FROM known)
),
passages AS (
  SELECT r, run, conv_id, turn, level, list(normal ORDER BY i) AS normals
  FROM runs WHERE level > 0 AND normal <> '' GROUP BY ALL
),
wholes AS (SELECT r, conv_id, turn, list(normal ORDER BY i) AS normals FROM known WHERE own AND normal <> '' GROUP BY ALL),
lengths AS (SELECT DISTINCT conv_id, len(normals) AS m FROM passages),
pieces AS (
  SELECT DISTINCT conv_id, turn, normals[s:s + m - 1] AS normals
  FROM (SELECT w.conv_id, w.turn, w.normals, m, unnest(range(1, len(w.normals) - m + 2)) AS s FROM wholes w JOIN lengths USING (conv_id))
),
placed AS (
  SELECT q.r, q.run, q.conv_id, q.turn, q.level, q.normals, max(o.turn) AS source
  FROM passages q LEFT JOIN pieces o ON o.conv_id = q.conv_id AND o.normals = q.normals AND o.turn < q.turn GROUP BY ALL
),
singles AS (
  SELECT r, run, conv_id, turn, level, unnest(normals) AS normal, generate_subscripts(normals, 1) AS at FROM placed WHERE source IS NULL
),
sources AS (
  SELECT q.r, q.run, q.at, q.conv_id, q.turn, q.level, max(o.turn) AS source
  FROM singles q LEFT JOIN known o
    ON o.own AND o.conv_id = q.conv_id AND o.normal = q.normal AND o.turn < q.turn
  GROUP BY ALL
),
votes AS (
  SELECT conv_id, turn, level, source, sum(n) AS n FROM (
    SELECT conv_id, turn, level, source, len(normals) AS n FROM placed WHERE source IS NOT NULL
    UNION ALL SELECT conv_id, turn, level, source, 1 FROM sources
  ) GROUP BY ALL
),
chosen AS (
  SELECT conv_id, turn, source AS parent FROM votes WHERE source IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, n DESC, source DESC) = 1
),
counts AS (
  SELECT conv_id, turn, CAST(sum(n) AS BIGINT) AS n_quoted,
         CAST(sum(CASE WHEN source IS NULL THEN 0 ELSE n END) AS BIGINT) AS n_linked
  FROM votes GROUP BY ALL
),
walk AS (
  SELECT conv_id, turn, parent AS root, CAST(1 AS BIGINT) AS depth FROM chosen
  UNION ALL
  SELECT w.conv_id, w.turn, c.parent, w.depth + 1 FROM walk w JOIN chosen c ON c.conv_id = w.conv_id AND c.turn = w.root
),
tops AS (SELECT conv_id, turn, arg_max(root, depth) AS root, max(depth) AS depth FROM walk GROUP BY ALL),
clean AS (
  SELECT r, regexp_replace(coalesce(string_agg(body, chr(10) ORDER BY i) FILTER (WHERE own), ''),
                           '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS text
  FROM lines GROUP BY r
)
SELECT m.conv_id, m.turn, m.role, c.parent AS parent_turn, coalesce(t.root, m.turn) AS root_turn,
       coalesce(t.depth, 0) AS depth, coalesce(n.n_quoted, 0) AS n_quoted_lines, coalesce(n.n_linked, 0) AS n_linked_lines,
       k.text, '<|' || coalesce(m.role, '') || '|>' || chr(10) || k.text AS chat
FROM messages m JOIN clean k USING (r)
LEFT JOIN chosen c ON c.conv_id = m.conv_id AND c.turn = m.turn
LEFT JOIN counts n ON n.conv_id = m.conv_id AND n.turn = m.turn
LEFT JOIN tops t ON t.conv_id = m.conv_id AND t.turn = m.turn
"""
