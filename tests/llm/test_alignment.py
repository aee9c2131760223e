import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from helpers import EMPTY, ODD, clashing, documents
from tokenizers import Tokenizer

from edgeline.llm import alignment, tokenizer


def library():
    a = Tokenizer.from_file(tokenizer.BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECES)


def tokens(text, a, b):
    """(id, start, end) on both sides, from the libraries and the files' own entries."""
    if not text:
        return [], []
    as_byte = tokenizer.printable_bytes()
    out = []
    named_a = [(i, bytes(as_byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    named_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        named_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    for named in (named_a, named_b):
        if b"".join(x for _, x in named) != (" " + text).encode():
            return [], []
        at, side = 0, []
        for i, data in named:
            side.append((i, at, at + len(data)))
            at += len(data)
        out.append(side)
    return out


def slow(rows):
    a, b = library()
    docs = [(doc, *tokens(text, a, b)) for doc, text in rows]
    links = [[(x[0], y[0]) for x in left for y in right if x[1] < y[2] and y[1] < x[2]] for _, left, right in docs]
    count = Counter(pair for found in links for pair in set(found))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (doc, left, right), found in zip(docs, links):
        groups, ends = [], sorted({e for *_, e in left} & {e for *_, e in right})
        for start, end in zip([0, *ends], ends):
            inside = [",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in (left, right)]
            groups.append("|".join(inside))
        text = ";".join(groups)
        best = sum(count[p] == most[p[0]] for p in found)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        out.append((doc, len(left), len(right), len(groups), len(found), best, sum(count[p] for p in found), text, digest))
    return sorted(out, key=repr), count, most


TEXTS = [
    *ODD[:-1],
    (20, "special <|endoftext|> and <s> strings <0x0A> stay text"),
    (21, "a▁b turns into a space"),
    (22, "tabs\tand\nlines\r\n  with   runs of spaces   "),
    (23, " "),
    (24, "\x00\x01 nul \U0001f469‍\U0001f4bb 日本語 é"),
    (25, "<unk> <0x41>"),
]


def some(n, seed=3):
    pick = random.Random(seed)
    words = ["the", "token", "Straße", "über", "ing", "日本", "🙂", "x1y2", ",", "unlikely", "<|endoftext|>", "naïve", "\n"]
    return [(100 + i // 2, pick.choice([" ", "", "  "]).join(pick.choices(words, k=pick.randint(1, 40)))) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"radix": 3, "task_records": 50, "block_chars": 300}])
def test_against_brute_force(spark, options):
    rows = [r if len(r[1] or "") < 2000 else (r[0], r[1][:2000]) for r in TEXTS] + some(60)
    want, count, most = slow(rows)
    done = alignment.Alignment(clashing(documents(spark, rows)).repartition(3), with_groups=True, **options)
    assert sorted(map(tuple, done.per_document().collect()), key=repr) == want
    pairs = {(r["a_id"], r["b_id"]): (r["n_docs"], r["is_best"]) for r in done.pair_counts().collect()}
    assert pairs == {p: (n, n == most[p[0]]) for p, n in count.items()}


def test_mismatch_has_no_tokens(spark):
    rows = [(1, "a▁b"), (2, None), (3, "")]
    got = alignment.align_digest(documents(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]


@pytest.mark.parametrize("rows", [[(r[0], r[1]) for r in ODD], EMPTY])
def test_odd_rows(spark, rows):
    got = alignment.align_digest(clashing(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"]
        assert (r["groups_sha256"] == "") == (r["n_a"] == 0)


def test_merged_counts_come_in_order():
    runs = [[(3, 1), (9000, 2)], [(3, 4), (5, 1)], [(0, 1)]]
    import numpy as np
    import zstandard

    blobs = []
    for run in runs:
        keys = np.diff([k for k, _ in run], prepend=0)
        blobs.append(zstandard.ZstdCompressor().compress(np.concatenate([keys, [n for _, n in run]]).astype(np.uint32).tobytes()))
    pairs, counts = alignment.merge_runs(blobs)
    assert (list(pairs), list(counts)) == ([0, 3, 5, 9000], [1, 5, 1, 2])
