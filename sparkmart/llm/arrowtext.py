"""Arrow batches as numpy views of their text bytes, and vectorised word tables over them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets into them; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    if not len(col) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(offsets, kind, len(col) + 1, col.offset * np.dtype(kind).itemsize).astype(np.int64)
    return np.frombuffer(data, np.uint8, off[-1] - off[0], off[0]), off - off[0]


#: Lower case of A-Z only; every other byte stays.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def _odd_powers(n: int) -> np.ndarray:
    base = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    if n:
        base[0] = 1
    return np.multiply.accumulate(base)


_POWERS: dict[str, np.ndarray] = {}
_INVERSE = pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of an odd multiplier and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _POWERS["up"] = _odd_powers(size)
        down = np.full(size, _INVERSE, np.uint64)
        down[0] = 1
        _POWERS["down"] = np.multiply.accumulate(down)
    return _POWERS["up"], _POWERS["down"]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random-looking value for every byte, so that word hashes don't follow byte sums.
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def words_of(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every maximal run of word bytes within a text, and the runs per text.

    ``is_word`` is a table of 256 Booleans.
    """
    n = len(buf)
    inside = np.zeros(n + 2, np.bool_)
    inside[1:-1] = is_word[buf]
    step = inside[1:] != inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]  # texts that meet without a separator
    edges = np.flatnonzero(step)
    starts, ends = edges[0::2], edges[1::2]
    if len(cuts):
        cuts = np.unique(cuts)
        starts = np.sort(np.concatenate([starts, cuts]))
        ends = np.sort(np.concatenate([ends, cuts]))
    per_text = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    return starts, ends, per_text


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """64-bit hash of the bytes of each span (equal bytes, equal hashes); bounded scratch memory."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = int(np.searchsorted(starts, base + block, side="left"))
        j = max(j, i + 1)
        top = int(ends[i:j].max())
        up, down = powers(top - base + 1)
        run = np.zeros(top - base + 1, np.uint64)
        np.cumsum(BYTE_VALUES[buf[base:top]] * up[: top - base], out=run[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix64((run[e] - run[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        i = j
    return out


def shards(batches, text: int, limit: int):
    """Record batches regrouped so that column ``text`` holds at most ``limit`` bytes (or one longer text)."""
    held, size = [], 0
    for batch in batches:
        _, offsets = text_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[at] + (limit - size), side="right")) - 1
            if stop <= at:
                if held:
                    yield _joined(held)
                    held, size = [], 0
                    continue
                stop = at + 1
            held.append(batch.slice(at, stop - at))
            size += int(offsets[stop] - offsets[at])
            at = stop
            if size >= limit:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(batches: list) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
