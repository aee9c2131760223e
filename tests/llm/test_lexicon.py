import hashlib
import random

import numpy as np
import pytest
from helpers import EMPTY, ODD, clashing, documents
from tokenizers import Tokenizer

from edgeline.llm import lexicon, tokenizer

PARTS = [
    "a", "b", " ", "\n", "'re", "'ll", "'S", "'", "<|endoftext|>", "<|startoftext|>", "<|end", "É", "é", "ß", "日本",
    "🙂", "12", "!!", "The", "HELLO", " world", "\x1c", "\x85", " ", "aaaa", "Σ", "ΑΣ", "İ", "ﬁ", "x" * 60, "½", "\x00",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer.WORD_BPE)


@pytest.fixture(scope="module")
def merger():
    return lexicon.Merger(tokenizer.WORD_BPE)


def test_automaton_numbers_words_and_shares_suffixes(merger, tmp_path):
    words = sorted({"taps", "tops", "tap", "top", "stop", "stops", "a", "zebra", "é"})
    path = tmp_path / "lexicon"
    path.write_bytes(lexicon.pack_lexicon(words, merger))
    packed = lexicon.Lexicon(str(path))
    assert isinstance(packed.shards[0].key, np.memmap)
    coded = [w.encode() for w in words]
    assert packed.find(coded) == [merger.merge(w) for w in coded]
    assert packed.find([b"", b"ta", b"tapsx", b"zz"]) == [None] * 4
    trie = {w[:i] for w in coded for i in range(len(w) + 1)}
    assert len(packed.shards[0].final) < len(trie)


def test_shards_hold_all_words(merger, tmp_path):
    words = [f"w{i}é" for i in range(500)]
    path = tmp_path / "lexicon"
    path.write_bytes(lexicon.pack_lexicon(words, merger, shards=7))
    packed = lexicon.Lexicon(str(path))
    coded = [w.encode() for w in words] + [b"w1", b"x"]
    assert packed.find(coded) == [merger.merge(w) for w in coded[:-2]] + [None, None]
    assert len(packed.shards) == 7


def test_ascii_words_are_split_alike():
    rng = random.Random(8)
    chars = "".join(map(chr, range(128))).lower() + "'" * 4 + "stredvmll  "
    both = lexicon.regex.compile(lexicon.WORD).findall
    for _ in range(3000):
        text = "".join(rng.choices(chars, k=rng.randint(1, 30)))
        assert lexicon.splitter()(text) == both(text)


def test_memory_lets_its_older_half_go(spark, library, monkeypatch):
    monkeypatch.setattr(lexicon, "WORDS_KEPT", 20)
    name = lexicon.make_lexicon(documents(spark, [(1, "the the of of")]), limit=4, shard_words=2)
    coder = lexicon.Encoder(tokenizer.WORD_BPE, lexicon.SparkFiles.get(name))
    for i in range(40):
        text = f"the word{i} and word{i // 2} of <|endoftext|> it"
        n, ids, decoded = next(coder.encode([text]))
        want = library.encode(text, add_special_tokens=False).ids
        assert (n, ids, decoded) == (len(want), " ".join(map(str, want)), library.decode(want, skip_special_tokens=False))
    assert len(coder.words) < 40


def test_empty_lexicon(merger, tmp_path):
    path = tmp_path / "lexicon"
    path.write_bytes(lexicon.pack_lexicon([], merger))
    assert lexicon.Lexicon(str(path)).find([b"a"]) == [None]


def test_both_merges_agree(merger):
    rng = random.Random(3)
    for _ in range(200):
        word = "".join(rng.choice("abehnot") for _ in range(rng.randint(1, 40))).encode()
        letters = [merger.letter[b] for b in word]
        letters[-1] += lexicon.WORD_END
        ids = [merger.vocab[c] for c in letters]
        assert merger._short(list(ids)) == merger._long(list(ids))


def digest(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), *(hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), decoded))


@pytest.mark.parametrize("limit", [1, 50, 1000])
def test_against_the_library(spark, library, limit):
    rng = random.Random(limit)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(150)]
    rows = lexicon.encode(documents(spark, list(enumerate(texts))), limit=limit).collect()
    for row in rows:
        text = texts[row["doc_id"]]
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == digest(library, text), repr(text)
        assert row["ids"] == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("rows", [ODD, EMPTY])
def test_odd_rows(spark, library, rows):
    got = lexicon.encode_digest(clashing(documents(spark, rows))).collect()
    want = sorted(digest(library, r[1] or "") for r in rows)
    assert sorted((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
