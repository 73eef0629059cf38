"""FM-index and decontamination against plain search."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm.arrowtext import LOWER, hash_spans, shards, text_bytes, words_of
from sparkmart.llm.decontamination import IS_WORD, Block, contamination, occurrences, remove_spans
from sparkmart.llm.fm_index import FMIndex
from texts import HIT_WORD, brute_hits, lower, prose


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_every_occurrence(seed):
    rng = random.Random(seed)
    runs = [[rng.randrange(1, 4 + seed) for _ in range(rng.randrange(1, 60))] for _ in range(30)]
    sequence = np.array([x for r in runs for x in [*r, 0]])
    offset = np.array([k for r in runs for k in range(len(r) + 1)])
    index = FMIndex(sequence, offset, 4 + seed)
    patterns = [[rng.randrange(1, 4 + seed) for _ in range(rng.randrange(1, 7))] for _ in range(60)]
    grid = np.zeros((len(patterns), 6), np.int64)
    for i, p in enumerate(patterns):
        grid[i, 6 - len(p) :] = p
    which, low, high = index.search(grid, np.array([len(p) for p in patterns]))
    text = sequence.tolist()
    want = {i: [a for a in range(len(text)) if text[a : a + len(p)] == p] for i, p in enumerate(patterns)}
    got = {w: sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which.tolist(), low.tolist(), high.tolist(), strict=True)}
    assert got == {i: x for i, x in want.items() if x}


def test_words_and_shards():
    texts = ["Ab1 c", "", None, "é-x", "y" * 50, "tail "]
    batch = pa.RecordBatch.from_pydict({"t": pa.array(texts, pa.string())})
    parts = list(shards([batch, batch.slice(2, 3)], 0, 9))
    assert [x for p in parts for x in p.column(0).to_pylist()] == texts + texts[2:5]
    assert all(sum(len((x or "").encode()) for x in p.column(0).to_pylist()) <= 9 or p.num_rows <= 2 for p in parts)
    raw, off = text_bytes(batch.column(0).slice(1, 4))
    buf = LOWER[raw]
    s, e, n = words_of(buf, off, IS_WORD)
    assert [buf[a:b].tobytes().decode() for a, b in zip(s, e, strict=True)] == [w for t in texts[1:5] for w in HIT_WORD.findall(lower(t))]
    assert n.tolist() == [0, 0, 2, 1]
    assert len(np.unique(hash_spans(buf, s, e))) == 3


def cases():
    rng = random.Random(7)
    items = [(f"i{k}", prose(rng, rng.choice([3, 9, 10, 11, 40]), 60)) for k in range(30)]
    items += [("i3", items[3][1]), ("none", None), (None, items[5][1]), ("empty", " ... "), ("caps", items[4][1].upper()), ("one", "zzz")]
    docs = []
    for k in range(80):
        body = prose(rng, rng.randrange(0, 120), 60)
        if k % 3 == 0:
            src = items[rng.randrange(30)][1].split()
            a = rng.randrange(max(1, len(src) - 9))
            body = f"{body} {'; '.join(src[a : a + rng.choice([9, 10, 14])]).title()}-{prose(rng, 20, 60)}"
        docs.append((k, body))
    docs += [(200, None), (201, ""), (202, "?!"), (203, "zzz"), (204, "A zzz b"), (3, docs[3][1]), (None, items[4][1]), (205, prose(rng, 40_000, 60))]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 900])
def test_against_plain_search(frame, llm, block_bytes):
    docs, items = cases()
    bench = llm.createDataFrame(items, "item_id string, text string").withColumnRenamed("item_id", "item_id")
    df = frame(docs).selectExpr("*", "'s' as n_words", "1 as items").repartition(3)
    got = sorted((tuple(r) for r in contamination(df, bench, block_bytes=block_bytes).collect()), key=str)
    usable = [(i, t) for i, t in items if i is not None and t is not None]
    want = []
    for i, t in docs:
        n, hit, found = brute_hits(t, usable)
        want.append((i, n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0))
    assert got == sorted(want, key=str)


def test_spans_are_removed(frame, llm):
    rng = random.Random(1)
    item = prose(rng, 30)
    bench = llm.createDataFrame([(1, item), (2, "")], "item_id long, text string")
    docs = [(1, f"Before, {item.title()}. After é"), (2, "clean text"), (3, None), (4, item), (5, f"{item} x {item}")]
    df = frame(docs, langs=["en"] * 5)
    got = {r["doc_id"]: r for r in remove_spans(df, bench).collect()}
    assert [got[i]["text"] for i in (1, 2, 3, 4, 5)] == ["Before, . After é", "clean text", None, "", " x "]
    assert got[1]["n_chars"] == len(got[1]["text"]) and got[1]["lang"] == "en"
    assert all(not brute_hits(r["text"], [(1, item)])[1] for r in got.values())


def test_empty_inputs(frame, llm):
    none = llm.createDataFrame([], "item_id long, text string")
    assert contamination(frame([]), none).count() == 0
    assert [r["contaminated"] for r in contamination(frame([(1, "a b")]), none).collect()] == [False]
    assert occurrences(Block([]), np.zeros(3, np.int32), np.array([3]))[0].size == 0
