"""Token shards: ids as the library gives them, exact round trip of the format."""

import random
import zlib

import numpy as np
import pytest

from sparkmart.llm.common import shared_dir
from sparkmart.llm.token_output import PieceEncoder, decode_ranks, digest_rows, encode_ranks, pack_block, read_tokens, unpack_block, write_tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_ids_as_the_library(library):
    rng = random.Random(1)
    parts = [*"ab 's'tre'll'd've'mS  \n\t\r.,!19é ñ\u00a0\u3000½日本'’", "'s", "'ll", "'re ", "<|endoftext|>", "  ", "word "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)]
    ids, counts = PieceEncoder(PATH).encode(texts)
    for t, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert got.tolist() == library(t), t


def test_control_bytes_round_trip():
    values = np.array([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], np.uint32)
    control, data = encode_ranks(values)
    assert len(control) == 3 and len(data) == 1 + 1 + 1 + 2 + 2 + 3 + 3 + 4 + 4
    assert np.array_equal(decode_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(values)), values)
    ids = np.array([7, 7, 50256, 3, 7, 2], np.int32)
    out = unpack_block(pack_block(np.array([5, 0]), np.array([True, False]), ids, np.array([4, 2])))
    assert out[0].tolist() == [5, 0] and out[1].tolist() == [True, False] and np.array_equal(out[2], ids) and out[3].tolist() == [4, 2]


def test_files(frame, llm, library):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice("abc de.\n") for _ in range(rng.randrange(200)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "long " * 100_000), (503, "x" * 50_000), (7, "again"), (None, "no id")]
    rng.shuffle(rows)
    df = frame(rows).selectExpr("*", "1 as start", "'a' as ids").repartition(5)
    got = digest_rows(df).collect()
    assert len(got) == len(rows)
    want = sorted((library(t) + [2] for i, t in rows), key=str)
    path = shared_dir(llm, "tokens-test")
    write_tokens(df, path)
    back = read_tokens(llm, path).collect()
    assert sorted((list(r["ids"]) for r in back), key=str) == want
    crc = {(r["doc_id"], r["start"]): zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in back}
    assert len({r["start"] for r in got}) == len(got)
    at, before = 0, None
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
        assert before is None or r["doc_id"] >= before
        before = r["doc_id"]
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, []).append(zlib.crc32(np.array(library(t) + [2], "<u4").tobytes()))
    for r in got:
        assert r["ids_crc32"] in by_id[r["doc_id"]]
    assert set(crc.values()) == {r["ids_crc32"] for r in got}


def test_empty(frame):
    assert digest_rows(frame([])).count() == 0
