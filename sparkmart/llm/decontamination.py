"""Benchmark decontamination: FM-index per shard of training texts, searched for every benchmark window.

The benchmark's windows (ten consecutive words; a shorter item is one window)
are the query set: it is read in blocks of bounded size, each block is
broadcast and goes over all documents.  A task reads its documents shard by
shard (bounded bytes), numbers their words by the block's vocabulary, builds
the FM-index of the shard, finds all windows by backward search, locates the
occurrences by sampled suffix positions and merges them to spans of words.
Words outside the vocabulary can't be in an occurrence; they only separate the
runs that are indexed, and runs shorter than the shortest window are left out.

Defined results: null or wordless texts have no words and no hits; items
without id, text or words have no windows; repeated items count once; an empty
benchmark hits nothing; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.arrowtext import LOWER, hash_spans, shards, text_bytes, words_of
from sparkmart.llm.fm_index import FMIndex

#: Words per window.
WINDOW = 10
#: Text bytes per indexed shard, and benchmark bytes per query block.
SHARD_BYTES = 3 * 1024 * 1024
BLOCK_BYTES = 8 * 1024 * 1024

#: Word bytes after lower-casing A-Z: digits, letters, all of the non-ASCII range.
IS_WORD = np.zeros(256, np.bool_)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True


class Block:
    """Windows of a block of benchmark items, as numbers of the block's own vocabulary."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        ids = sorted({i for i, _ in items})
        place = {x: k for k, x in enumerate(ids)}
        self.ids = np.array(ids, object)
        texts = pa.array([t for _, t in items], pa.string())
        buf, offsets = text_bytes(texts)
        buf = LOWER[buf]
        starts, ends, per_text = words_of(buf, offsets, IS_WORD)
        hashes = hash_spans(buf, starts, ends)
        self.vocabulary, number = np.unique(hashes, return_inverse=True)
        rows, lengths, owners = [], [], []
        stop = np.cumsum(per_text)
        for (item, _), a, b in zip(items, stop - per_text, stop, strict=True):
            seq = number[a:b] + 1
            k = min(window, len(seq))
            if not k:
                continue
            grid = np.zeros((len(seq) - k + 1, window), np.int32)
            grid[:, window - k :] = np.lib.stride_tricks.sliding_window_view(seq, k)
            rows.append(grid)
            lengths.append(np.full(len(grid), k, np.int64))
            owners.append(np.full(len(grid), place[item], np.int64))
        grid = np.concatenate(rows) if rows else np.zeros((0, window), np.int32)
        self.patterns, back = np.unique(grid, axis=0, return_inverse=True)
        back = back.reshape(-1)
        lengths = np.concatenate(lengths) if rows else np.zeros(0, np.int64)
        self.lengths = np.zeros(len(self.patterns), np.int64)
        self.lengths[back] = lengths
        pairs = np.unique(np.stack([back, np.concatenate(owners)], 1), axis=0) if rows else np.zeros((0, 2), np.int64)
        self.owner = pairs[:, 1]
        self.owner_from = np.searchsorted(pairs[:, 0], np.arange(len(self.patterns) + 1))
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 0
        # A bit table over the hashes' upper bits drops most foreign words before the sorted lookup.
        self.maybe = np.zeros(1 << 20, np.bool_)
        self.maybe[self.vocabulary >> np.uint64(44)] = True

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary number of each word, 0 for foreign words."""
        out = np.zeros(len(hashes), np.int32)
        some = np.flatnonzero(self.maybe[hashes >> np.uint64(44)])
        at = np.searchsorted(self.vocabulary, hashes[some])
        at = np.minimum(at, len(self.vocabulary) - 1)
        hit = self.vocabulary[at] == hashes[some]
        out[some[hit]] = at[hit] + 1
        return out


def occurrences(block: Block, numbers: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, first word) of every occurrence in the shard's texts."""
    nothing = np.zeros(0, np.int64)
    if not len(block.patterns) or not len(numbers):
        return nothing, nothing
    known = numbers > 0
    head = np.zeros(len(numbers) + 1, np.bool_)
    begins = np.cumsum(per_text) - per_text
    head[begins[per_text > 0]] = True
    first = known & head[:-1]
    first[0] = known[0]
    first[1:] |= known[1:] & ~known[:-1]
    last = known.copy()
    last[:-1] &= ~known[1:] | head[1:-1]
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = b - a >= block.shortest
    a, b = a[long], b[long]
    if not len(a):
        return nothing, nothing
    size = b - a
    total = int((size + 1).sum())
    run_start = np.cumsum(size + 1) - (size + 1)
    offset = np.arange(total) - np.repeat(run_start, size + 1)
    word = np.repeat(a, size + 1) + offset  # the separator stands where the run has ended
    inside = offset < np.repeat(size, size + 1)
    sequence = np.where(inside, numbers[np.minimum(word, len(numbers) - 1)], 0).astype(np.int64)
    index = FMIndex(sequence, offset, len(block.vocabulary) + 1)
    which, low, high = index.search(block.patterns, block.lengths)
    count = high - low
    if not len(which):
        return nothing, nothing
    rows = np.repeat(low, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(which, count), word[index.locate(rows)]


def scan(batch: pa.RecordBatch, text: int, block: Block):
    """(buffer, word starts, word ends, words per text, covered words, (text, item) hits) of a shard."""
    raw, offsets = text_bytes(batch.column(text))
    buf = LOWER[raw]
    starts, ends, per_text = words_of(buf, offsets, IS_WORD)
    which, first = occurrences(block, block.numbers(hash_spans(buf, starts, ends)), per_text)
    edge = np.zeros(len(starts) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + block.lengths[which], -1)
    covered = np.cumsum(edge[:-1]) > 0
    stop = np.cumsum(per_text)
    in_text = np.searchsorted(stop, first, side="right")
    pairs = np.unique(np.stack([in_text, which], 1), axis=0)
    n = block.owner_from[pairs[:, 1] + 1] - block.owner_from[pairs[:, 1]]
    owner = block.owner[np.repeat(block.owner_from[pairs[:, 1]], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
    hits = np.unique(np.stack([np.repeat(pairs[:, 0], n), owner], 1), axis=0)
    return raw, offsets, starts, ends, per_text, covered, hits


def blocks(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES):
    """Broadcast query blocks of the benchmark, one after the other; each holds about ``block_bytes`` of text."""
    spark = benchmark.sparkSession
    items = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // block_bytes))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield spark.sparkContext.broadcast(Block([tuple(r) for r in part.collect()], window))


def _spans(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    return np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)


def find_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list]:
    """``docs`` with ``__spans`` (from, to word, flat) and ``__items`` of all query blocks but the last, and that one.

    One pass over the documents per block; the last is left to the caller's
    own pass, so an ordinary benchmark (one block) takes a single pass.
    """
    todo = list(blocks(benchmark, window, block_bytes))
    df = docs.withColumn("__spans", F.array().cast("array<int>")).withColumn("__items", F.array().cast("array<string>"))
    at = docs.columns.index("text")
    for shared in todo[:-1]:

        def run(batches, shared=shared):
            for batch in shards(batches, at, SHARD_BYTES):
                _, _, _, _, per_text, covered, hits = scan(batch, at, shared.value)
                spans, items = _merge(batch, per_text, covered, hits, shared.value)
                cols = [*batch.columns[:-2], pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, batch.schema.names)

        df = df.mapInArrow(run, df.schema)
    return df, todo[-1]


def _merge(batch, per_text, covered, hits, block) -> tuple[list, list]:
    """Per text: merged spans of words (flat) and sorted items, with those of earlier blocks."""
    stop = np.cumsum(per_text)
    spans = [list(x or ()) for x in batch.column("__spans").to_pylist()]
    items = [set(x or ()) for x in batch.column("__items").to_pylist()]
    a, b = _spans(covered)
    # A covered stretch may run on from one text into the next.
    cut = np.searchsorted(stop, a, side="right"), np.searchsorted(stop, b, side="left")
    for s, e, i, j in zip(a.tolist(), b.tolist(), *(c.tolist() for c in cut), strict=True):
        for t in range(i, j + 1):
            base = int(stop[t] - per_text[t])
            lo, hi = max(s, base), min(e, int(stop[t]))
            if lo < hi:
                spans[t] += [lo - base, hi - base]
    for t, o in hits.tolist():
        items[t].add(block.ids[o])
    out = []
    for flat in spans:
        pairs, merged = sorted(zip(flat[0::2], flat[1::2], strict=True)), []
        for s, e in pairs:
            if merged and s <= merged[-1]:
                merged[-1] = max(merged[-1], e)
            else:
                merged += [s, e]
        out.append(merged)
    return out, [sorted(x) for x in items]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    df, shared = find_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, window, block_bytes)

    def run(batches):
        for batch in shards(batches, 1, SHARD_BYTES):
            _, _, _, _, per_text, covered, hits = scan(batch, 1, shared.value)
            spans, items = _merge(batch, per_text, covered, hits, shared.value)
            n_hit = [sum(s[1::2]) - sum(s[0::2]) for s in spans]
            digest = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(per_text.astype(np.int64)), pa.array(n_hit, pa.int64()),
                    pa.array([len(x) for x in items], pa.int64()), pa.array(digest), pa.array([n > 0 for n in n_hit], pa.bool_()),
                ],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return df.mapInArrow(run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with the benchmark's occurrences cut out of ``text`` (from the first hit word to the end of the last); ``n_chars`` follows."""
    df, shared = find_spans(docs, benchmark, window, block_bytes)
    at = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches):
        for batch in shards(batches, at, SHARD_BYTES):
            raw, offsets, starts, ends, per_text, covered, hits = scan(batch, at, shared.value)
            spans, _ = _merge(batch, per_text, covered, hits, shared.value)
            cols = list(batch.columns[:-2])
            if any(spans):
                first = np.cumsum(per_text) - per_text
                texts, counts = cols[at].to_pylist(), cols[chars].to_pylist() if chars is not None else None
                for i, flat in enumerate(spans):
                    if not flat:
                        continue
                    pieces, pos = [], int(offsets[i])
                    for s, e in zip(flat[0::2], flat[1::2], strict=True):
                        pieces.append(raw[pos : starts[first[i] + s]].tobytes())
                        pos = int(ends[first[i] + e - 1])
                    pieces.append(raw[pos : offsets[i + 1]].tobytes())
                    texts[i] = b"".join(pieces).decode()
                    if counts is not None:
                        counts[i] = len(texts[i])
                cols[at] = pa.array(texts, cols[at].type)
                if counts is not None:
                    cols[chars] = pa.array(counts, cols[chars].type)
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names[:-2])

    return df.mapInArrow(run, docs.schema)
