import random

import duckdb
import pytest

from edgeline import runtime
from edgeline.llm import url_rules

URLS = [
    "http://www.example.com/en/1?x=/fr/#top",
    "https://Shop.EXAMPLE.com/en/",
    "https://example.com/en",
    "https://example.com/EN/",
    "https://notexample.com/en/5",
    "ftp://a.b.net/es/x/y/z.html",
    "http://net/fr/?a",
    "http://net#/fr/",
    "http://com",
    "http://com/",
    "http://a.com.?b",
    "http://www.example.com:80/en/",
    "//example.com/en/",
    "example.com/en/://net/es/",
    "http://",
    "",
    None,
    "HTTP://x.www.example.com/en/a\nb?c",
    "http://ünï.日本.net/fr/é",
    "http://" + "a." * 3000 + "net/" + "fr/" * 3000,
]


def pages(spark, urls):
    rows = [(None if i % 7 == 6 else i // 2, u, "h", "x", "y") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, rule string, row string")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:end], rest[end:].split("?")[0].split("#")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def slow(url, rules):
    host, path = parts(url)
    fitting = [
        (len(h + p), len(h), h + p, v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fitting, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_given_rules_and_sql(spark):
    df = pages(spark, URLS)
    got = sorted(map(tuple, url_rules.judge_urls(df, url_rules.rule_table(spark, url_rules.RULES)).collect()), key=repr)
    want = sorted(((r[0], *slow(r[1], url_rules.RULES)) for r in df.collect()), key=repr)
    assert got == want
    pages_ = df.toPandas()  # noqa: F841
    pages_["page_id"] = pages_["page_id"].astype("Int64")
    sql = duckdb.connect().execute(url_rules.ORACLE.replace("FROM pages", "FROM pages_")).fetchall()
    assert got == sorted(sql, key=repr)


@pytest.mark.parametrize("limit", [runtime.BROADCAST_BYTES, -1])
def test_random_rules(spark, monkeypatch, limit):
    monkeypatch.setattr(runtime, "SLICE_ROWS", 20)
    pick = random.Random(5)
    label, part = ["a", "b", "com", "x.y"], ["", "a", "ab", "abc", "b"]
    rules = {
        (".".join(pick.choices(label, k=pick.randint(1, 3))), pick.choice(["", "/"]) + "/".join(pick.choices(part, k=pick.randint(1, 4)))): pick.choice(
            ["allow", "block"]
        )
        for _ in range(150)
    }
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [
        "http://" + ".".join(pick.choices(label, k=pick.randint(1, 5))) + pick.choice(["", "/"]) + "/".join(pick.choices(part, k=pick.randint(0, 5)))
        for _ in range(400)
    ]
    df = pages(spark, urls)
    got = url_rules.judge_urls(df, url_rules.rule_table(spark, rules), broadcast_bytes=limit).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], *slow(r[1], rules)) for r in df.collect()), key=repr)
    assert sum(r["rule"] is not None for r in got) > 100


def test_odd_rules(spark):
    rules = [(None, "/", "block"), ("", "", "block"), ("a/b", "/", "block"), ("b", None, "block"), ("b", "", "allow"), ("c", "/", None), ("D", "/", "block")]
    df = pages(spark, ["http://b", "http://x.b/y", "http://c/", "http://a/b/", "http://d/"])
    got = url_rules.judge_urls(df, url_rules.rule_table(spark, rules)).collect()
    assert sorted((r["host"], r["rule"], r["verdict"]) for r in got if r["rule"]) == [("b", "b", "block"), ("d", "d/", "block"), ("x.b", "b", "block")]
    assert len(got) == 5


def test_empty_tables(spark):
    rules = url_rules.rule_table(spark, url_rules.RULES)
    assert url_rules.judge_urls(pages(spark, []), rules).count() == 0
    got = url_rules.judge_urls(pages(spark, URLS), rules.limit(0)).collect()
    assert {r["verdict"] for r in got} == {"allow"} and len(got) == len(URLS)


def test_equal_keys_meet_by_prefix_only(spark):
    plan = url_rules.judge_urls(pages(spark, URLS), url_rules.rule_table(spark, url_rules.RULES))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
