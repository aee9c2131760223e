import duckdb
import pytest
from helpers import clashing
from pyspark.sql import types as T

from edgeline.llm import quotes

MESSAGES = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

THREAD = [
    (1, 0, "user", "How do I\nsplit a Table?\n\nThanks"),
    (1, 1, "assistant", "> split a   table?\n\nUse two files.\nThen join."),
    (1, 2, "user", "On Monday, Bot wrote:\n> Use two files.\n>> split a table?\nIt works"),
    (1, 3, "user", "> > How do I\n> unknown line\nWhat about this? 3 > 2"),
    (1, 4, "assistant", ">It works\n>Then join.\n>Use two files.\nSure\nOn time, he wrote:"),
    (1, 5, "user", "> Thanks\n> Sure"),
    (1, 5, "user", "> Thanks\n> Sure"),
    (2, 0, "user", "> Sure\nthanks"),
    (2, 1, "user", "thanks"),
    (2, 2, "user", "> THANKS"),
    (None, 0, "user", "> thanks"),
    (3, None, "user", "> thanks\nno turn"),
    (3, 1, None, None),
    (3, 2, "user", ""),
    (4, 7, "user", ">" * 50 + "deep\n> \n>\n \n"),
    (4, 8, "user", "word " * 30_000 + "\n" + "> x\n" * 2000),
]


@pytest.mark.parametrize("rows", [THREAD, []])
def test_against_sql(spark, rows):
    df = spark.createDataFrame(rows, MESSAGES)
    got = sorted(map(repr, (tuple(r) for r in quotes.link_quotes(clashing(df)).collect())))
    conversations = df.toPandas()  # noqa: F841
    want = duckdb.connect().execute(quotes.ORACLE).fetchall() if rows else []
    assert got == sorted(map(repr, want))


def test_thread(spark):
    linked = quotes.link_quotes(spark.createDataFrame(THREAD, MESSAGES))
    rows = {(r["conv_id"], r["turn"]): r for r in linked.collect()}
    place = lambda *k: tuple(rows[k][c] for c in ("parent_turn", "root_turn", "depth"))
    assert place(1, 1) == (0, 0, 1)
    assert place(1, 2) == (1, 0, 2)
    assert place(1, 3) == (0, 0, 1)
    assert place(1, 4) == (1, 0, 2)  # two lines of turn 1 against one of turn 2
    assert place(1, 5) == (4, 0, 3)
    assert place(2, 0) == (None, 0, 0)
    assert place(2, 2) == (1, 1, 1)
    assert rows[1, 2]["text"] == "It works"
    assert rows[1, 4]["text"] == "Sure\nOn time, he wrote:"
    assert rows[1, 3]["text"] == "What about this? 3 > 2"
    assert rows[1, 1]["chat"] == "<|assistant|>\nUse two files.\nThen join."


PASSAGES = [
    (1, 0, "user", "ok\nfirst point\nsecond point\n\nthird point"),
    (1, 1, "assistant", "ok\nsomething else"),
    (1, 2, "user", "second point\nok"),
    (1, 3, "user", "> ok\n> First  point\n>\n> second point\nreply to the first"),  # not the latest ok
    (1, 4, "user", "> second point\n> ok\n\n> something else\nboth"),
    (1, 5, "user", "> third point\n> ok\n>> ok\nnowhere in one piece"),
    (1, 2000, "user", "> ok\nfar away"),
    (1, 5000, "user", "> first point\n> second point\n> third point\nfarther"),
]


def test_passages_come_before_lines(spark, monkeypatch):
    df = spark.createDataFrame(PASSAGES, MESSAGES)
    conversations = df.toPandas()  # noqa: F841
    want = sorted(map(repr, duckdb.connect().execute(quotes.ORACLE).fetchall()))
    for turns in (quotes.RANGE_TURNS, 2):
        monkeypatch.setattr(quotes, "RANGE_TURNS", turns)
        rows = quotes.link_quotes(df).collect()
        assert sorted(map(repr, map(tuple, rows))) == want
    parents = {r["turn"]: (r["parent_turn"], r["n_linked_lines"]) for r in rows}
    assert parents == {0: (None, 0), 1: (None, 0), 2: (None, 0), 3: (0, 3), 4: (2, 3), 5: (2, 3), 2000: (2, 1), 5000: (0, 3)}


def test_long_chain(spark):
    rows = [(1, i, "user", f"> line {i - 1}\nline {i}") for i in range(70)]
    got = {r["turn"]: (r["root_turn"], r["depth"]) for r in quotes.link_quotes(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert got == {i: (0, i) for i in range(70)}


def test_reply_order(spark):
    ordered = quotes.reply_ordered(quotes.link_quotes(spark.createDataFrame(THREAD, MESSAGES))).collect()
    turns = [r["turn"] for r in ordered if r["conv_id"] == 1]
    assert turns == [0, 1, 3, 2, 4, 5, 5]


def test_main_path_has_no_python(spark):
    plan = quotes.link_quotes(spark.createDataFrame(THREAD, MESSAGES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
