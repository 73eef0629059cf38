"""Packed pieces: every id in exactly one piece, gapless sequences, little padding, hot rows and odd rows."""

import random
import zlib

import numpy as np
import pytest

from sparkmart.llm.packing import CAPACITY, Bins, cut_table, cuts, digest_rows, pack, padded_length, sequences

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 1]


def test_cuts():
    for capacity in (1, 2, 7, 64, 2048):
        for n in [*range(1, 3 * capacity + 1, max(1, capacity // 300)), 50 * capacity + 1]:
            parts = cuts(n, capacity)
            assert sum(parts) == n and all(0 < p <= capacity for p in parts)
    # Every piece fills its class to 31/32, but for the lengths that the floor of the class makes shorter.
    waste = [CAPACITY - p * (CAPACITY // p) for parts in cut_table(CAPACITY) for p in parts]
    assert max(waste) <= CAPACITY / 32 + 64
    assert max(map(len, cut_table(CAPACITY))) <= 5


def test_bins_take_a_fixed_count():
    bins = Bins(12, 0)
    for i in range(5):
        bins.add(i, 0, 4, np.full(4, i, np.int32))  # class 3
    assert [r[4] for r in bins.rows] == [0, 0, 0] and [r[5] for r in bins.rows] == [0, 4, 8]
    bins.add(9, 0, 12, np.arange(12, dtype=np.int32))  # class 1: a sequence of its own
    assert bins.rows[-1][4] == 1
    bins.concatenate()
    assert [(r[0], r[4], r[5]) for r in bins.rows[-2:]] == [(3, 2, 0), (4, 2, 4)] and not bins.open


def check(rows, pieces, library, capacity=CAPACITY):
    """Pieces tile the documents, sequences are gapless; returns the share of padding."""
    docs, seqs = {}, {}
    for r in pieces:
        docs.setdefault(r["doc_id"], []).append(r)
        seqs.setdefault(r["sequence_id"], []).append(r)
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append(library(t))
    assert set(docs) == set(want)
    for i, lists in want.items():
        if len(lists) == 1:
            at = 0
            for r in sorted(docs[i], key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(lists[0]) and r["length"] > 0
                ids = lists[0][at : at + r["length"]]
                assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
                at += r["length"]
            assert at == len(lists[0])
        else:
            assert sum(r["length"] for r in docs[i]) == sum(map(len, lists))
    padding = 0
    for held in seqs.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        padding += padded_length(at, capacity) - at
    return padding / sum(r["length"] for r in pieces)


def test_documents(frame, library):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma,", "delta."]) for _ in range(int(rng.expovariate(1 / 400))))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, "long " * 60_000), (7, "twice"), (None, "no id"), (None, None), (1003, "x" * 9000)]
    rng.shuffle(rows)
    df = frame(rows).selectExpr("*", "1 as start", "'a' as ids", "0L as sequence_id").repartition(5)
    pieces = digest_rows(df).collect()
    assert check(rows, pieces, library) < 0.02
    # More than one round of leftovers.
    small = pack(df.where("length(text) < 2000").repartition(60), capacity=32, round_tokens=1).selectExpr("doc_id", "start", "length", "crc32(ids) ids_crc32", "doc_tokens", "sequence_id", "offset")
    small = small.collect()
    assert len({r["sequence_id"] >> 57 for r in small}) > 2
    assert check([r for r in rows if r[1] and len(r[1]) < 2000 or r[1] == ""], small, library, 32) < 0.05


def test_equal_rows_and_reruns(frame, library):
    rows = [(i, "the same text of every row") for i in range(3000)]
    one, two = (sorted(map(tuple, digest_rows(frame(rows).coalesce(2)).collect())) for _ in range(2))
    assert one == two and len(one) >= 3000
    assert check(rows, digest_rows(frame(rows)).collect(), library) < 0.1  # the last sequence counts


def test_sequences_and_empty(frame, library):
    rows = [(i, "some words here " * i) for i in range(40)]
    packed = pack(frame(rows)).cache()
    seqs = sequences(packed).collect()
    total = sum(len(library(t)) for _, t in rows)
    assert sum(r["n_tokens"] for r in seqs) == total and all(len(r["ids"]) == 4 * r["n_tokens"] for r in seqs)
    assert all(r["padded_to"] == padded_length(r["n_tokens"]) for r in seqs)
    first = {r["sequence_id"]: np.frombuffer(bytes(r["ids"]), "<u4") for r in seqs}
    for r in packed.collect():
        assert first[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]].tobytes() == bytes(r["ids"])
    packed.unpersist()
    assert digest_rows(frame([])).count() == 0
