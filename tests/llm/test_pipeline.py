"""The stages together, against plain versions of each on a small table."""

from collections import defaultdict

import duckdb
from helpers import documents
from test_line_dedup import PASSAGE
from test_packing import ids_of
from test_similarity_join import slow_components
from tokenizers import Tokenizer

import corpus_pipeline
from edgeline.llm import quality, tokenizer


def prose(key, n=120):
    return "\n".join(" ".join(f"{key}w{i * 7 % 90}x{i // 12}" for i in range(at, at + 30)) for at in range(0, n, 30))


ROWS = [
    *((i, prose(f"d{i}")) for i in range(40)),
    *((50 + i, prose(f"own{i}", 60) + "\n" + PASSAGE) for i in range(5)),
    *((60 + i, prose("copy")) for i in range(5)),
    *((70 + i, " ".join(f"n{k}" if k != 9 * i else f"z{i}" for k in range(90))) for i in range(6)),
    (80, prose("s") + "\npassword: hunter2hunter2 and more"),
    (90, "too short"),
    (91, "again and again it says " * 30),
    (92, None),
]


def test_each_stage_takes_effect(spark, tmp_path):
    docs = documents(spark, ROWS)
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    documents_ = documents(spark, ROWS).toPandas()  # noqa: F841
    judged = duckdb.connect().execute(quality.ORACLE.replace("FROM documents", "FROM documents_")).fetchall()
    assert set(kept["quality rules"]) == {r[0] for r in judged if r[-1]} == {r[0] for r in ROWS} - {90, 91, 92}
    lines = kept["line dedup"]
    assert set(kept["quality rules"]) - set(lines) == {61, 62, 63, 64}
    assert PASSAGE in lines[50] and not any(PASSAGE in lines[i] for i in range(51, 55))
    left = {doc for doc, _, _, stays in slow_components(sorted(lines.items()), 5) if stays}
    assert set(kept["near dedup"]) == left and 70 in left and 71 not in left
    assert kept["secret scans"][80].endswith("[SECRET] and more")
    assert all(text == kept["near dedup"][doc] for doc, text in kept["secret scans"].items() if doc != 80)
    library = Tokenizer.from_file(tokenizer.BYTE_BPE)
    lengths = defaultdict(int)
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, "").collect():
        lengths[r["doc_id"]] += r["length"]
    assert lengths == {doc: len(ids_of(library, text)) for doc, text in kept["secret scans"].items()}


def test_run_on_a_folder(spark, tmp_path):
    documents(spark, ROWS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 40


def test_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
