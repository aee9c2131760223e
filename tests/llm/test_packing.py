import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import EMPTY, ODD, clashing, documents
from tokenizers import Tokenizer

from edgeline.llm import best_fit, bin_slack, tokenizer


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer.BYTE_BPE)


def test_fullest_against_all_combinations():
    rng = random.Random(5)
    for _ in range(150):
        lengths = [rng.randint(1, 30) for _ in range(rng.randint(1, 9))]
        room = rng.randint(1, 60)
        stock = {n: lengths.count(n) for n in set(lengths)}
        taken = bin_slack.fullest(stock, sorted(stock, reverse=True), room)
        best = max(sum(c) for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k) if sum(c) <= room)
        assert sum(taken) == best
        assert all(taken.count(n) <= stock[n] for n in taken)


@pytest.mark.parametrize("method", [bin_slack.pack, best_fit.best_fit_decreasing])
def test_packings_are_whole_and_tight(method):
    rng = random.Random(6)
    lengths = [min(2048, int(rng.expovariate(1 / 500)) + 1) for _ in range(5000)] + [2048] * 3
    sequences = method(lengths, 2048)
    assert sorted(i for s in sequences for i in s) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in s) <= 2048 for s in sequences)
    assert len(sequences) <= -(-sum(lengths) // 2048) + 1
    assert method([], 2048) == []


def test_best_fit_takes_the_least_space():
    assert [sorted(s) for s in best_fit.best_fit_decreasing([6, 5, 4, 3, 2], 10)] == [[0, 2], [1, 3, 4]]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [0]


TEXTS = [(i, "some words here " * (i * 37 % 211) + "<|endoftext|> end") for i in range(60)] + [(99, "lang " * 9000)]


@pytest.mark.parametrize("rows", [TEXTS, ODD, EMPTY])
def test_bin_slack_rows(spark, library, rows):
    got = bin_slack.pack_documents(clashing(documents(spark, rows))).collect()
    want = []
    for row in rows:
        ids, piece, start = ids_of(library, row[1]), 0, 0
        while start < len(ids):
            size = (len(ids) - start) % 2048 or 2048
            part = np.array(ids[start : start + size], "<u4").tobytes()
            want.append((row[0], piece, start, size, zlib.crc32(part)))
            piece, start = piece + 1, start + size
    key = lambda r: tuple(-1 if x is None else x for x in r)
    mine = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got]
    assert sorted(mine, key=key) == sorted(want, key=key)
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert len(places) <= -(-total // 2048) + 1


@pytest.mark.parametrize("rows", [TEXTS, ODD, EMPTY])
@pytest.mark.parametrize("block", [3000, 4_000_000])
def test_matrices_give_documents_back(spark, library, rows, block):
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    back = defaultdict(dict)
    for r in best_fit.packed_matrices(clashing(documents(spark, rows)), block_tokens=block).collect():
        ids = np.frombuffer(r["input_ids"], "<u2")
        places = np.frombuffer(r["position_ids"], "<u2")
        bounds = r["cu_seqlens"]
        assert len(ids) == len(places) == 2048 and bounds[-1] == r["n_tokens"] <= 2048
        for k, doc in enumerate(r["doc_ids"]):
            part = slice(bounds[k], bounds[k + 1])
            assert places[part].tolist() == list(range(bounds[k + 1] - bounds[k]))
            back[doc][r["starts"][k]] = ids[part].tolist()
    assert len(back) == len(rows)
    for doc, text, *_ in rows:
        assert [i for start in sorted(back[doc]) for i in back[doc][start]] == ids_of(library, text)


def test_ids_beyond_16_bits_are_refused(spark):
    import pytest

    with pytest.raises(ValueError, match="16 bits"):
        best_fit.packed_matrices(documents(spark, [(1, "a")]), end_id=70_000)
