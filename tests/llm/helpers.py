"""Small tables for the training-data operators."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def documents(spark, rows):
    """Rows of (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df):
    """The same rows with further columns, named like those that operators use inside."""
    from pyspark.sql import functions as F

    names = (
        "host common n_words kept removed_words label rep node members key fingerprint windows runs version doc "
        "length piece start sequence_id offset slots set_key size spans ids decoded n_tokens word n line text_hash"
    ).split()
    return df.withColumns({name: F.lit("x") for name in names})


ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (None, "a row without id and with some words in it"),
    (5, "twice the same row with the same id"),
    (5, "twice the same row with the same id"),
    (6, "Grüße, 日本 🙂 é " * 40),
    (7, "word " * 30_000),
    (8, "x" * 20_000),
    (None, None, None),
]
EMPTY = []
