"""Harmonic packing: token pieces of documents into sequences of a fixed capacity.

A piece of ``n`` tokens belongs to the class ``k = capacity // n`` (its length
lies between ``capacity / (k + 1)`` and ``capacity / k``); a bin of class ``k``
takes exactly ``k`` pieces, whatever comes first.  So every worker fills its own
bins, one open bin per class, and never looks at another worker's.  To waste
little, documents are cut where classes end: whole sequences first, then what
is left gives the largest ``capacity // k`` it holds, and so on; a rest that
fills its class to ``1 - SLACK`` stays whole.

What is left in a worker's open bins (less than one bin per class) goes to the
next round: the leftovers of many workers are packed in the same way by fewer,
until they fit one task.  That task lays the pieces of its last open bins, at
most one bin per class, end to end and cuts them at the capacity; only the very
last sequence is then far from full.

A sequence is padded to the capacity unless its length is a power of two
(``padded_length``).  Sequence ids are unique, not consecutive.

Defined results: a null text is empty (the end id alone); every row is a
document, of a null or repeated doc_id too (its pieces then can't be told from
those of the other rows by doc_id alone); very long texts are cut like others;
an empty table gives no pieces; extra columns are ignored; the tokenizer's
special token in a text is that token, as the library has it.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import stored
from sparkmart.llm.token_output import BATCH_CHARS, TOKENIZER, _text_groups, encoder, with_end

#: Fixed values of the production packing.
CAPACITY = 2048
END_ID = 1
#: A rest this close to the longest length of its class is not cut.
SLACK = 1 / 32
#: Tokens of leftovers that one task packs; each task leaves under a bin per class.
ROUND_TOKENS = 1 << 22
#: Tokens per batch handed back to Spark.
OUT_TOKENS = 1 << 19

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


@lru_cache(maxsize=4)
def cut_table(capacity: int, slack: float = SLACK) -> tuple[tuple[int, ...], ...]:
    """The pieces of a rest of 0, 1, ... ``capacity - 1`` tokens."""
    table: list[tuple[int, ...]] = [()]
    for rest in range(1, capacity):
        k = capacity // rest
        if rest >= (1 - slack) * (capacity // k):
            table.append((rest,))
        else:
            unit = capacity // (k + 1)  # the longest length of the next class, shorter than the rest
            table.append((unit, *table[rest - unit]))
    return tuple(table)


def cuts(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens, in order."""
    whole, rest = divmod(n, capacity)
    return [capacity] * whole + list(cut_table(capacity)[rest])


def open_tokens(capacity: int) -> int:
    """At most so many tokens are in a task's open bins."""
    return capacity * len({capacity // n for n in range(1, capacity + 1)})


def padded_length(n: int, capacity: int = CAPACITY) -> int:
    """Tokens a sequence of ``n`` takes: a power of two stays, others are padded."""
    return n if n & (n - 1) == 0 else capacity


class Bins:
    """One open bin per class; full bins become rows of pieces."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list] = {}
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, doc_id, start: int, doc_tokens: int, ids: np.ndarray) -> None:
        k = self.capacity // len(ids)
        if k == 1:
            self._close([(doc_id, start, doc_tokens, ids)])
            return
        held = self.open.setdefault(k, [])
        held.append((doc_id, start, doc_tokens, ids))
        if len(held) == k:
            self._close(self.open.pop(k))

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc_id, start, doc_tokens, ids in pieces:
            self._row(doc_id, start, doc_tokens, ids, self.next_id, offset)
            offset += len(ids)
        self.next_id += 1

    def _row(self, doc_id, start, doc_tokens, ids, sequence, offset) -> None:
        self.rows.append((doc_id, start, len(ids), doc_tokens, sequence, offset, ids.astype("<u4").tobytes()))
        self.size += len(ids)

    def leave(self) -> None:
        """Pieces of open bins go out without a sequence."""
        for k in sorted(self.open):
            for piece in self.open[k]:
                self._row(*piece, None, None)
        self.open.clear()

    def concatenate(self) -> None:
        """Pieces of open bins end to end, cut at the capacity."""
        run, room = [], self.capacity
        for k in sorted(self.open):
            for doc_id, start, doc_tokens, ids in self.open[k]:
                while len(ids):
                    part = ids[:room]
                    run.append((doc_id, start, doc_tokens, part))
                    start, ids, room = start + len(part), ids[room:], room - len(part)
                    if not room:
                        self._close(run)
                        run, room = [], self.capacity
        if run:
            self._close(run)
        self.open.clear()

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True))
        self.rows, self.size = [], 0
        kinds = [pa.int64()] * 6 + [pa.binary()]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _fill(pieces, capacity: int, turn: int, last: bool):
    """Batches of rows for (doc_id, start, doc_tokens, ids) pieces packed by this task."""
    bins = Bins(capacity, turn << 57 | TaskContext.get().partitionId() << 32)
    for piece in pieces:
        bins.add(*piece)
        if bins.size >= OUT_TOKENS:
            yield bins.take()
    bins.concatenate() if last else bins.leave()
    if bins.rows:
        yield bins.take()


def _document_pieces(batches, tokenizer: str, end_id: int, capacity: int):
    for doc_ids, texts in _text_groups(batches, BATCH_CHARS):
        tokens, counts = with_end(*encoder(tokenizer).encode(texts), end_id)
        at = 0
        for doc_id, n in zip(doc_ids, counts.tolist(), strict=True):
            start = 0
            for length in cuts(n, capacity):
                yield doc_id, start, n, tokens[at + start : at + start + length]
                start += length
            at += n


def _left_pieces(batches):
    for batch in batches:
        doc_ids, starts, totals, ids = (batch.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))
        for doc_id, start, n, raw in zip(doc_ids, starts, totals, ids, strict=True):
            yield doc_id, start, n, np.frombuffer(raw, "<u4")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID, round_tokens: int = ROUND_TOKENS) -> DataFrame:
    """Pieces (``PIECES``) of all rows of ``docs`` (doc_id, text); ``ids``: little-endian unsigned 32-bit."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    round_tokens = max(round_tokens, 4 * open_tokens(capacity))  # so that a round leaves a quarter at most

    def first(batches):
        yield from _fill(_document_pieces(batches, tokenizer, end_id, capacity), capacity, 0, False)

    def later(turn: int, last: bool):
        def run(batches):
            yield from _fill(_left_pieces(batches), capacity, turn, last)

        return run

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    packed = stored(rows.mapInArrow(first, PIECES), "packed")
    done, turn, last = [packed.where("sequence_id is not null")], 0, False
    while not last:
        left = packed.where("sequence_id is null")
        tokens = left.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
        if not tokens:
            break
        turn, width, last = turn + 1, -(-tokens // round_tokens), tokens <= round_tokens
        dealt = left.select("doc_id", "start", "doc_tokens", "ids").repartition(width).sortWithinPartitions("doc_id", "start")
        packed = stored(dealt.mapInArrow(later(turn, last), PIECES), f"packed-{turn}")
        done.append(packed.where("sequence_id is not null"))
    out = done[0]
    for df in done[1:]:
        out = out.unionByName(df)
    return out


def sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, n_tokens, padded_to, ids) of packed pieces; a group is at most ``capacity`` pieces."""
    n = F.sum("length")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: F.hex(p["ids"]))
    power = F.bit_count(n) == 1
    return pieces.groupBy("sequence_id").agg(
        n.alias("n_tokens"), F.when(power, n).otherwise(F.lit(capacity).cast("long")).alias("padded_to"),
        F.unhex(F.array_join(parts, "")).alias("ids"),
    )


def digest_rows(docs: DataFrame) -> DataFrame:
    """One row per packed piece with the checksum of its ids."""
    crc = F.crc32("ids").alias("ids_crc32")
    return pack(docs).select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")
