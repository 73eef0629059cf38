"""Token ids as binary shards.

Documents are dealt by range of doc_id and sorted; each task encodes its
documents with the public tokenizer and writes one shard.  A shard is a
sequence of blocks of bounded size; within a block the ids are replaced by
their frequency rank (the block's rank table is stored with it), and the ranks
are written in byte-aligned variable length: two bits per id in separate
control bytes tell how many data bytes (1-4) it takes.  Decoding is numpy
table lookup: control byte to four lengths, running sums to positions.

Encoding: the tokenizer's pre-tokeniser splits a text into pieces whose ids
don't depend on their neighbours.  The split is done on whole batches with
numpy, and only pieces not met before by this worker go through the
tokenizer's model.

Defined results: a null text is empty (the end id alone); rows with equal
doc_id follow each other in any order; null doc_id comes first; an empty table
gives no rows; the tokenizer's special token in a text is that token, as the
library has it.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import shared_dir
from sparkmart.llm.warc import file_system

#: Fixed values of the production output.
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2

#: Ids per block, and characters encoded at once.
BLOCK_IDS = 1 << 20
BATCH_CHARS = 1 << 20
#: Pieces a worker remembers before it starts anew (a cache: no effect on results).
CACHE_PIECES = 400_000

LETTER, NUMBER, SPACE = 1, 2, 3


def _byte_chars() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class PieceEncoder:
    """Ids of texts under a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        chars = _byte_chars()
        self.alphabet = {b: ord(c) for b, c in chars.items()}
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        points = np.frombuffer(every.encode("utf-32-le"), np.uint32)
        self.classes = np.zeros(0x110000, np.uint8)
        for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
            for m in regex.finditer(pattern, every):
                self.classes[points[m.start() : m.end()]] = kind
        self._clear()

    def _clear(self):
        self.known: dict[int, int] = {}
        self.pool = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.first = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)

    def _starts(self, cp: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Whether a piece starts at each character; ``begins``: the first characters of the texts."""
        n = len(cp)
        kind = self.classes[cp]
        head = np.zeros(n + 1, np.bool_)
        head[begins] = True
        head[n] = True
        space = kind == SPACE
        before = np.empty(n, np.uint8)
        before[0] = 0
        before[1:] = kind[:-1]
        blank_before = np.zeros(n, np.bool_)
        blank_before[1:] = cp[:-1] == 0x20
        text_start = head[:n]
        last_space = np.zeros(n, np.bool_)  # followed by something else in the same text
        last_space[:-1] = space[:-1] & ~space[1:]
        last_space &= ~head[1:]
        first_space = space & (before != SPACE)
        start = np.where(space, first_space | last_space, (kind != before) & ~blank_before)
        start |= text_start
        # 's 't 're 've 'm 'll 'd where a piece starts with the apostrophe
        at = np.flatnonzero((cp == 0x27) & start)
        at = at[at + 1 < n]
        at = at[~head[at + 1]]
        if len(at):
            one = cp[at + 1]
            two = np.where(at + 2 < n, cp[np.minimum(at + 2, n - 1)], 0)
            two[head[at + 2]] = 0
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
            for hit, k in ((short, 2), (long & ~short, 3)):
                i = at[hit]
                start[i + 1] = False
                nxt = i + k
                start[nxt[nxt < n]] = True
        return start

    def _learn(self, pieces: list[str], hashes: list[int]) -> None:
        """Ids of new pieces into the pool."""
        tokenize, alphabet = self.model.tokenize, self.alphabet
        ids = [[t.id for t in tokenize(p.encode().decode("latin-1").translate(alphabet))] for p in pieces]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.int32, int(sizes.sum()))
        k = len(self.known)
        while len(self.pool) < self.used + len(flat):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while len(self.first) < k + len(ids):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.pool[self.used : self.used + len(flat)] = flat
        self.first[k : k + len(ids)] = self.used + np.cumsum(sizes) - sizes
        self.size[k : k + len(ids)] = sizes
        self.used += len(flat)
        self.known.update(zip(hashes, range(k, k + len(ids)), strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        from sparkmart.llm.arrowtext import mix64, powers

        odd = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        plain = list(texts)
        for i in odd:
            plain[i] = ""
        joined = "".join(plain)
        lengths = np.fromiter(map(len, plain), np.int64, len(plain))
        counts = np.zeros(len(plain), np.int64)
        ids = np.zeros(0, np.int32)
        if joined:
            cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            start = self._starts(cp, offsets[:-1][lengths > 0])
            s = np.flatnonzero(start)
            e = np.append(s[1:], len(cp))
            up, down = powers(len(cp) + 1)
            run = np.zeros(len(cp) + 1, np.uint64)
            np.cumsum((cp.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03) * up[: len(cp)], out=run[1:])
            hashes = mix64((run[e] - run[s]) * down[s] + (e - s).astype(np.uint64))
            del run
            distinct, at, back = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self.known) + len(distinct) > CACHE_PIECES:
                self._clear()
            get, keys = self.known.get, distinct.tolist()
            index = np.fromiter((get(h, -1) for h in keys), np.int64, len(keys))
            new = np.flatnonzero(index < 0)
            if len(new):
                k = len(self.known)
                where = at[new]
                self._learn([joined[a:b] for a, b in zip(s[where].tolist(), e[where].tolist(), strict=True)], distinct[new].tolist())
                index[new] = np.arange(k, k + len(new))
            piece = index[back]
            size = self.size[piece]
            total = np.cumsum(size)
            ids = self.pool[np.repeat(self.first[piece] - (total - size), size) + np.arange(int(total[-1]))]
            at_text = np.searchsorted(s, offsets)
            total = np.concatenate([[0], total])
            counts = total[at_text[1:]] - total[at_text[:-1]]
        if odd:
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i in odd:
                parts[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.int32)
                counts[i] = len(parts[i])
            ids = np.concatenate(parts)
        return ids, counts


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``end_id`` after each text's ids."""
    out = np.full(len(ids) + len(counts), end_id, np.int32)
    stops = np.cumsum(counts + 1) - 1
    body = np.ones(len(out), np.bool_)
    body[stops] = False
    out[body] = ids
    return out, counts + 1


# --- the file format -------------------------------------------------------

_HEAD = struct.Struct("<4sIIII")  # magic, documents, ids, ranks, data bytes
MAGIC = b"SMT1"
#: Control byte to the four lengths it holds.
LENGTHS = ((np.arange(256)[:, None] >> (2 * np.arange(4))) & 3).astype(np.uint8) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    ranks = ranks.astype(np.uint32)
    length = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = length - 1
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    four = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = four[np.arange(4) < length[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    length = LENGTHS[control].reshape(-1)[:n].astype(np.int64)
    at = np.cumsum(length) - length
    data = np.concatenate([data, np.zeros(3, np.uint8)])
    out = data[at].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(length > k)
        if not len(more):
            break
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def pack_block(doc_ids: np.ndarray, has_id: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> bytes:
    freq = np.bincount(ids)
    present = np.flatnonzero(freq)
    by_rank = present[np.lexsort((present, -freq[present]))]
    rank = np.zeros(len(freq), np.uint32)
    rank[by_rank] = np.arange(len(by_rank))
    control, data = encode_ranks(rank[ids])
    head = _HEAD.pack(MAGIC, len(doc_ids), len(ids), len(by_rank), len(data))
    return b"".join(
        [head, by_rank.astype("<u4").tobytes(), doc_ids.astype("<i8").tobytes(), has_id.astype(np.uint8).tobytes(), counts.astype("<u4").tobytes(), control, data]
    )


def unpack_block(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, has_id, ids, counts) of a block."""
    magic, docs, n, ranks, size = _HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a token block")
    at = _HEAD.size

    def take(kind, k):
        nonlocal at
        out = np.frombuffer(block, kind, k, at)
        at += out.nbytes
        return out

    by_rank, doc_ids, has_id, counts = take("<u4", ranks), take("<i8", docs), take(np.uint8, docs), take("<u4", docs)
    control, data = take(np.uint8, -(-n // 4)), take(np.uint8, size)
    return doc_ids, has_id.astype(np.bool_), by_rank[decode_ranks(control, data, n)], counts.astype(np.int64)


def _text_groups(batches, limit: int):
    """(ids, texts) of at most ``limit`` characters, or of one longer text."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            if texts and size + len(text) > limit:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if texts:
        yield ids, texts


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Write (doc_id, text) as token shards in ascending doc_id order below ``path``."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)

    def write(batches):
        fs, place = file_system(path)
        fs.create_dir(place, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"shard-{part:06d}-{uuid.uuid4().hex}.tok"
        blocks, held, size = [], [], 0
        with fs.open_output_stream(f"{place}/{name}", compression=None) as out:

            def flush():
                nonlocal held, size
                if held:
                    doc_ids = [i for x in held for i in x[0]]
                    has_id = np.array([i is not None for i in doc_ids], np.bool_)
                    block = pack_block(
                        np.array([i or 0 for i in doc_ids], np.int64), has_id, np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held])
                    )
                    blocks.append([len(block), size])
                    out.write(block)
                held, size = [], 0

            for ids, texts in _text_groups(batches, BATCH_CHARS):
                tokens, counts = with_end(*encoder(tokenizer).encode(texts), end_id)
                if size and size + len(tokens) > BLOCK_IDS:
                    flush()
                held.append((ids, tokens, counts))
                size += len(tokens)
            flush()
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "name": [name], "blocks": [json.dumps(blocks)]})

    root, top = file_system(path)
    root.create_dir(top, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    shards = dealt.mapInArrow(write, "part int, name string, blocks string").collect()  # a row per task
    manifest = [{"name": r["name"], "blocks": json.loads(r["blocks"])} for r in sorted(shards) if r["blocks"] != "[]"]
    fs, place = file_system(path)
    with fs.open_output_stream(f"{place}/manifest.json", compression=None) as f:
        f.write(json.dumps(manifest).encode())


def _blocks(spark, path: str) -> DataFrame:
    """(name, offset, length, start) of every block; start: the ids before it."""
    fs, place = file_system(path)
    with fs.open_input_stream(f"{place}/manifest.json", compression=None) as f:
        manifest = json.loads(f.read())
    rows, start = [], 0
    for shard in manifest:
        offset = 0
        for length, ids in shard["blocks"]:
            rows.append((f"{path}/{shard['name']}", offset, length, start))
            offset += length
            start += ids
    spans = spark.createDataFrame(rows, "name string, offset long, length long, start long")
    return spans.repartition(max(1, min(len(rows), 10_000)))


def _read(batches):
    for batch in batches:
        for name, offset, length, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            fs, place = file_system(name)
            with fs.open_input_file(place) as f:
                f.seek(offset)
                yield start, unpack_block(f.read(length))


def read_tokens(spark, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document of the shards."""

    def rows(batches):
        for start, (doc_ids, has_id, ids, counts) in _read(batches):
            stops = np.cumsum(counts)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]), pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, mask=~has_id), pa.array(start + stops - counts), lists], ["doc_id", "start", "ids"]
            )

    return _blocks(spark, path).mapInArrow(rows, "doc_id long, start long, ids array<int>")


def token_digests(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of the shards."""

    def rows(batches):
        for start, (doc_ids, has_id, ids, counts) in _read(batches):
            stops = np.cumsum(counts)
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * (b - n) : 4 * b]) for b, n in zip(stops.tolist(), counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, mask=~has_id), pa.array(start + stops - counts), pa.array(counts), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return _blocks(spark, path).mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def digest_rows(docs: DataFrame) -> DataFrame:
    """Write the documents' token shards, read them back, one digest row per document."""
    spark = docs.sparkSession
    path = shared_dir(spark, "tokens")
    write_tokens(docs, path)
    return token_digests(spark, path)
