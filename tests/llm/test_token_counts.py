import random

import pytest
from helpers import EMPTY, ODD, clashing, documents
from tokenizers import Tokenizer

from edgeline.llm import token_counts, tokenizer

PARTS = [
    "a", "b", " ", "  ", "\n", "\n\n", "'re", "'ll", "'s", "'", "<|endoftext|>", "<|end", "é", "ß", "日本", "🙂", "12",
    "!!", "...", "the", "Hello", " world", "\t", "\x1c", "\x85", " ", " ", "aaaa", "é", "\r\n", "|>",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer.BYTE_BPE)


def count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix_against_the_library(library):
    rng = random.Random(7)
    counter = token_counts.PrefixCounter(tokenizer.BYTE_BPE)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 9))) for _ in range(400)]
    for text, counts in zip(texts, counter.count_texts(texts)):
        assert counts.tolist() == [count(library, text[:i]) for i in range(len(text) + 1)], repr(text)


def test_long_word(library):
    word = "abcde" * 300
    counts = token_counts.PrefixCounter(tokenizer.BYTE_BPE).count_text(word)
    assert counts[-1] == count(library, word)
    assert counts[777] == count(library, word[:777])


def test_stored_prefixes_answer_questions(spark, library):
    text = "The quick brown foxes jump over lazy dogs, don't they?  Yes."
    stored = token_counts.prefix_counts(documents(spark, [(1, text)]))
    row = stored.select(
        token_counts.tokens_at(stored["prefix_tokens"], 20).alias("at"),
        token_counts.tokens_at(stored["prefix_tokens"], 9999).alias("beyond"),
        token_counts.longest_within(stored["prefix_tokens"], 7).alias("within"),
    ).first()
    assert row["at"] == count(library, text[:20])
    assert row["beyond"] == count(library, text)
    assert row["within"] == max(i for i in range(len(text) + 1) if count(library, text[:i]) <= 7)


@pytest.mark.parametrize("rows", [ODD, EMPTY])
def test_odd_rows(spark, library, rows):
    got = token_counts.count_digest(clashing(documents(spark, rows))).collect()
    want = sorted((len((r[1] or "").encode()), count(library, r[1] or "")) for r in rows)
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)
    assert all(r["fits_512"] > 0 or r["n_bytes"] == 0 for r in got)
