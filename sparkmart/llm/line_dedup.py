"""Line dedup: lines that recur in many documents stay in one of them.

Every line's key (stripped, A-Z lower-cased) of enough code points becomes a
128-bit hash.  The (hash, document, position) rows are dealt by *range* on
hash and document and sorted by hash, document descending, position; a
streaming pass sees each hash's documents one after the other, the first one
being the keeper.  A hash held by very many documents spans several range
partitions; each partition reports its part (documents, largest document) and
the parts are added, so no line is ever gathered in one task.  What is
returned per document is a compressed keep bitmap, never text.

Defined results: null text is one empty line; rows with null doc_id neither
count nor lose lines; repeated rows of one doc_id are one document; lines
below the length bound are never dropped; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import broadcast_checked, stored

#: Fixed values of the production rule.
MIN_CHARS = 40
MIN_DOCS = 5

_SPACE = b" \t\n\x0b\x0c\r"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_NOT_FIRST = bytes(range(0x80, 0xC0))  # UTF-8 continuation bytes


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACE).translate(_LOWER)


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.translate(None, _NOT_FIRST)) >= min_chars)


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc_id, pos) of every line whose key has at least ``min_chars`` code points."""

    def split(batches):
        for batch in batches:
            ids, positions, digests = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if doc_id is None:
                    continue
                for pos, line in enumerate(text.as_buffer().to_pybytes().split(b"\n") if text.is_valid else ()):
                    key = line_key(line)
                    if _long_enough(key, min_chars):
                        ids.append(doc_id)
                        positions.append(pos)
                        digests.append(hashlib.blake2b(key, digest_size=16).digest())
            h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(ids, pa.int64()), pa.array(positions, pa.int32())],
                ["h1", "h2", "doc_id", "pos"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(split, "h1 long, h2 long, doc_id long, pos int")


def _runs(batches):
    """Per hash of a sorted partition: its documents here and its first (largest) document."""
    last = None  # (h1, h2, document seen last, documents so far, first document)
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc = (batch.column(i).to_numpy() for i in range(3))
        new_hash = np.ones(len(h1), np.bool_)
        new_hash[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new_doc = new_hash.copy()
        new_doc[1:] |= doc[1:] != doc[:-1]
        at = np.flatnonzero(new_hash)
        counts = np.add.reduceat(new_doc.astype(np.int64), at)
        firsts = doc[at].copy()
        out = [[], [], [], []]
        if last is not None:
            if last[0] == h1[0] and last[1] == h2[0]:  # the run goes on
                counts[0] += last[3] - (last[2] == doc[0])
                firsts[0] = last[4]
            else:
                for o, v in zip(out, (last[0], last[1], last[3], last[4]), strict=True):
                    o.append(np.array([v], np.int64))
        last = (h1[-1], h2[-1], doc[-1], counts[-1], firsts[-1])
        for o, v in zip(out, (h1[at[:-1]], h2[at[:-1]], counts[:-1], firsts[:-1]), strict=True):
            o.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], ["h1", "h2", "n_docs", "keeper"])
    if last is not None:
        row = (last[0], last[1], last[3], last[4])
        yield pa.RecordBatch.from_arrays([pa.array([int(v)], pa.int64()) for v in row], ["h1", "h2", "n_docs", "keeper"])


def recurring(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, keeper) of the hashes found in at least ``min_docs`` documents."""
    rows = lines.select("h1", "h2", "doc_id")
    dealt = rows.repartitionByRange("h1", "h2", F.col("doc_id").desc())
    ordered = dealt.sortWithinPartitions("h1", "h2", F.col("doc_id").desc())
    parts = ordered.mapInArrow(_runs, "h1 long, h2 long, n_docs long, keeper long")
    # Equal (hash, document) rows share a partition, so the parts' documents add up exactly.
    whole = parts.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))
    return whole.where(F.col("n_docs") >= min_docs).select("h1", "h2", "keeper")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, n_dropped, keep) of the documents that lose lines.

    ``keep`` is a zlib-compressed bitmap, one bit per line up to the last
    dropped one; the lines after it stay.
    """
    lines = stored(line_hashes(docs, min_chars), "line-hashes")
    hot = stored(recurring(lines, min_docs), "line-recurring")
    lost = lines.join(broadcast_checked(hot, 48), ["h1", "h2"]).where(F.col("doc_id") != F.col("keeper"))
    per_doc = lost.groupBy("doc_id").agg(F.collect_set("pos").alias("lost"))

    def pack(batches):
        for batch in batches:
            maps, dropped = [], []
            for lost in batch.column(1):
                at = lost.values.to_numpy()
                keep = np.ones((int(at.max()) // 8 + 1) * 8, np.uint8)  # whole bytes: the padding stays
                keep[at] = 0
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
                dropped.append(len(at))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(dropped, pa.int64()), pa.array(maps, pa.binary())], ["doc_id", "n_dropped", "keep"]
            )

    return per_doc.mapInArrow(pack, "doc_id long, n_dropped long, keep binary")


def kept_lines(text: bytes, keep: bytes | None) -> tuple[int, bytes]:
    """Number of lines and the text without the lines whose keep bit is 0."""
    lines = text.split(b"\n")
    if keep is None:
        return len(lines), text
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))
    stay = np.ones(len(lines), np.bool_)
    n = min(len(bits), len(lines))
    stay[:n] = bits[:n] > 0
    return len(lines), b"\n".join(line for line, s in zip(lines, stay, strict=True) if s)


def dedup_digests(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""
    docs = docs.select("doc_id", "text")
    maps = stored(keep_bitmaps(docs, min_chars, min_docs), "line-bitmaps").withColumnRenamed("doc_id", "__id")
    n, size = maps.agg(F.count(F.lit(1)), F.coalesce(F.max(F.length("keep")), F.lit(0))).first()
    joined = docs.join(broadcast_checked(maps, 40 + size, rows=n), F.col("doc_id") == F.col("__id"), "left")

    def digest(batches):
        for batch in batches:
            n_lines, digests = [], []
            for text, keep in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                n, kept = kept_lines(text.as_buffer().to_pybytes() if text.is_valid else b"", keep)
                n_lines.append(n)
                digests.append(hashlib.sha256(kept).hexdigest())
            dropped = batch.column(3).fill_null(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_lines, pa.int64()), dropped, pa.array(digests)],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    rows = joined.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "keep", "n_dropped")
    return rows.mapInArrow(digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
