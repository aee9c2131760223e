import duckdb
import pytest
from helpers import EMPTY, ODD, clashing, documents
from pyspark.sql import functions as F

from edgeline import runtime
from edgeline.llm import quality


def words(n, start=0):
    return " ".join(f"w{i}" for i in range(start, start + n))


BOILER = "Cookies help us and you agree to all of them by reading on\nHome  About CONTACT"
ROWS = [
    *((i, f"{BOILER}\n{words(40, 100 * i)}", "shop") for i in range(30)),
    *((100 + i, f"home about contact\n{words(3, 100 * i)}\n{BOILER}", "shop") for i in range(3)),
    *((200 + i, words(60), "copies") for i in range(40)),
    (300, "of the end of " * 20, "shop"),
    (301, f"{words(30)}\n{words(3)}\n{words(3)}\n \n#*$ %&|<> x", "other"),
    (302, BOILER, "other"),
]


def same(spark, rows):
    df = documents(spark, rows)
    got = {tuple(r) for r in quality.judge(clashing(df)).collect()}
    documents_ = df.toPandas()  # noqa: F841
    want = duckdb.connect().execute(quality.ORACLE.replace("FROM documents", "FROM documents_")).fetchall()
    assert got == set(want)
    return got


def test_against_sql(spark):
    got = {r[0]: r[-1] for r in same(spark, ROWS)}
    assert all(got[i] for i in range(30))
    assert not any(got[100 + i] for i in range(3))
    assert all(got[200 + i] for i in range(40))  # exact copies do not make their own lines common
    assert not got[300] and got[301] and got[302]


def hot_host():
    """A host with two thirds of all rows; a tenth and 40 % of its texts have lines of their own kind."""
    rows = []
    for i in range(300):
        text = words(30, 100 * i)
        text += "\nShare this page with friends" if i % 10 == 0 else ""
        text = ("All rights reserved by us\n" if i % 5 < 2 else "") + text
        rows.append((i, text, "hot" if i % 3 else f"h{i % 7}"))
    rows += [(1000 + i, "all  rights reserved by us\na few words", "hot") for i in range(5)]
    return rows


@pytest.mark.parametrize("limit", [None, -1])
def test_common_lines_of_a_hot_host(spark, monkeypatch, limit):
    if limit is not None:  # joined by shuffle, with slices
        monkeypatch.setattr(quality, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(runtime, "SLICE_ROWS", 10)
    rows = hot_host()
    got = {r[0]: r for r in same(spark, rows)}
    assert got[10][6] == 10 and got[1][6] == 5 and got[4][6] == 0
    assert not any(got[1000 + i][-1] for i in range(5))
    left = {r["doc_id"]: r["text"] for r in quality.clean(documents(spark, rows)).collect()}
    assert left[10] == words(30, 1000) and left[1] == words(30, 100) and left[4] == words(30, 400)
    assert set(left) == {d for d, r in got.items() if r[-1]}


def test_clean_removes_common_lines(spark):
    kept = quality.clean(clashing(documents(spark, ROWS)))
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert rows[3]["text"] == words(40, 300)
    assert 100 not in rows and 300 not in rows
    assert rows[301]["text"] == ROWS[-2][1]
    assert kept.columns == clashing(documents(spark, [])).columns
    assert rows[3]["host"] == "x"


@pytest.mark.parametrize("rows", [ODD, EMPTY])
def test_odd_rows(spark, rows):
    got = quality.judge(clashing(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["n_words"] == 0:
            assert r["base_failed"] and not r["kept"]
    assert quality.clean(documents(spark, rows)).filter(F.col("text").isNull()).count() == 0


def test_main_path_has_no_python(spark):
    plan = quality.judge(documents(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
