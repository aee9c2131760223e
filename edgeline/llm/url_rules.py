"""URL filters: host and path rules met by short hash prefixes of a URL's own expressions."""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeline.runtime import BROADCAST_BYTES, lookup, materialize

# Hexadecimal digits of the hash prefix that expressions and rules are joined on: four bytes.
PREFIX = 8
RULES_SCHEMA = "host string, path string, verdict string"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between the first `://` and `/`, `?`, `#` or the end, and from there to `?`, `#` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def digest(host: Column, path: Column) -> Column:
    """Of a host with a path; `#` stands in neither."""
    return F.sha2(F.concat(host, F.lit("#"), path), 256)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULES_SCHEMA)


def hashed_rules(rules: DataFrame) -> DataFrame:
    """One row per rule with its full digest and the shape of the expressions that can equal it."""
    host, path = lower_ascii(F.col("host")), F.coalesce(F.col("path"), F.lit(""))
    shaped = rules.select(host.alias("host"), path.alias("path"), F.col("verdict").cast("string").alias("verdict"))
    fitting = (F.col("host") != "") & ~F.col("host").rlike("[/?#]") & ~F.col("path").rlike("[?#]")
    # Of equal rules with different verdicts the one first in the alphabet but `allow` wins.
    first = F.coalesce(F.min(F.when(F.col("verdict") != "allow", F.col("verdict"))), F.min("verdict"))
    return (
        shaped.filter(fitting)
        .groupBy("host", "path")
        .agg(first.alias("verdict"))
        .filter("verdict IS NOT NULL")
        .select(
            F.concat("host", "path").alias("rule"),
            "verdict",
            digest(F.col("host"), F.col("path")).alias("digest"),
            F.size(F.split("host", r"\.")).alias("labels"),
            (F.size(F.split("path", "/")) - 1).alias("depth"),
            F.length(F.substring_index("path", "/", -1)).alias("beyond"),
        )
    )


def expressions(host: Column, path: Column, labels: int, depth: int, beyond: list[int]) -> Column:
    """Digests of all host suffixes with all path prefixes that a rule of such shapes can equal.

    Suffixes begin the host or follow a dot. Prefixes end with a slash, or go on behind it
    for one of the numbers of characters in `beyond` without meeting the next slash.
    """
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(F.split(host, r"\.")), F.lit(labels))),
        lambda k: F.call_function("substring_index", host, F.lit("."), -k),
    )
    slashes = F.least(F.size(F.split(path, "/")) - 1, F.lit(depth))

    def prefixes(k: Column) -> Column:
        start = F.when(k == 0, F.lit("")).otherwise(F.concat(F.call_function("substring_index", path, F.lit("/"), k), F.lit("/")))
        part = F.get(F.split(path, "/"), k)
        longer = F.filter(F.array(*(F.lit(n) for n in beyond)), lambda n: n <= F.length(part))
        return F.transform(longer, lambda n: F.concat(start, F.substring(part, F.lit(1), n)))

    paths = F.flatten(F.transform(F.sequence(F.lit(0), slashes), prefixes))
    pairs = F.transform(suffixes, lambda h: F.transform(paths, lambda p: digest(h, p)))
    return F.when(host != "", F.array_distinct(F.flatten(pairs)))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of `pages`: page_id, host, path, the rule that decides and the verdict.

    A rule (host, path, verdict) fits its host and every subdomain if the path begins with
    the rule's, at any character. Of the rules that fit the longest one (host and path
    together, then the host alone) decides; without any, `rule` is null and the verdict is
    `default`. Equal rules count once, and a verdict other than `allow` wins over it. Rules
    without host or verdict, or with `?` or `#`, fit nothing. Null or other URLs without
    `://` have an empty host and path and meet no rule. Rows with null or repeated ids are
    each judged by themselves; other columns are ignored.

    Rows are numbered in a written table. Each gives the digests of its expressions, of the
    shapes that occur among the rules; they meet the rules on the first four bytes and the
    full digest confirms. Rules are broadcast behind their size; a larger set is joined by
    shuffle, with prefixes of frequent expressions (`com/`) spread over slices. Only rows
    that a rule fits are shuffled after that, by their number.
    """
    host, path = host_and_path(F.col(url_col))
    numbered = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows, seen = materialize(numbered.withColumn("row", F.monotonically_increasing_id()))
    known, sizes = materialize(
        hashed_rules(rules),
        labels=F.coalesce(F.max("labels"), F.lit(0)),
        depth=F.coalesce(F.max("depth"), F.lit(0)),
        beyond=F.sort_array(F.collect_set("beyond")),
    )
    if not sizes["rows"]:
        return rows.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    digests = expressions(F.col("host"), F.col("path"), sizes["labels"], sizes["depth"], list(sizes["beyond"]))
    own = rows.select("row", F.explode(digests).alias("own"))
    own = own.withColumn("prefix", F.substring("own", 1, PREFIX))
    # Few rules share a prefix, since equal ones are one: digests spread evenly over four bytes.
    met = F.collect_list(F.struct("digest", "rule", "verdict", (F.length("rule")).alias("length"), "labels"))
    by_prefix = known.groupBy(F.substring("digest", 1, PREFIX).alias("prefix")).agg(met.alias("rules"))
    if sizes["bytes"] <= broadcast_bytes:
        joined = own.join(F.broadcast(by_prefix), "prefix")
    else:
        joined = lookup(own, "prefix", by_prefix, F.col("row"), how="inner")
    confirmed = joined.select("row", "own", F.inline("rules")).filter("own = digest")
    best = confirmed.groupBy("row").agg(F.max(F.struct("length", "labels", "rule", "verdict")).alias("best"))
    return rows.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )


# The rules of the registered query.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

ORACLE = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
behind AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
         row_number() OVER () AS row_id
  FROM pages
),
parts AS (
  SELECT row_id, page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM behind
),
fitting AS (
  SELECT row_id, rule_host || rule_path AS rule, rule_verdict,
         row_number() OVER (PARTITION BY row_id ORDER BY length(rule_host || rule_path) DESC) AS nth
  FROM parts JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fitting WHERE nth = 1) USING (row_id)
"""
