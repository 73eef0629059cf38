"""I1 as a stream with keyed state: micro-batches write only what they change.

``sync_stream`` rewrites the target in every micro-batch.  Here a
``transformWithState`` operator remembers per key which row is the newest (its
stamp and a 128-bit fingerprint, not the row) and emits a row only if it is
new or differs; the emitted rows are appended as one run to a merge-on-read
``DeltaLog``.  Bytes written per batch follow the batch, the target is never
read.  State is kept in RocksDB below the stream's checkpoint, so a lost
executor's partitions are loaded again from there.

The marks of 1024 consecutive keys form one state entry: the state is
asked and written once per entry and batch, and numpy compares its keys at
once.  A call of the state per key would cost more than all the rest.  An entry
is stored by columns, keys as differences, so that of 32 bytes a key little
more than the 16 of the fingerprint are left.

Exactly-once: the commit that adds batch ``n``'s run also records ``n`` for
this stream; a batch that is tried again after its commit adds nothing.

Within one micro-batch the newest row per key wins and two different rows at
its stamp fail the batch.  Across batches an older row is ignored; one with the
stamp already seen and other contents is a correction and is applied.  A null
stamp is older than any other; a null key fails the batch; repeated rows
change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from sparkmart.schemas import TableSpec
from sparkmart.session import shuffles_dropped
from sparkmart.sources.delta_log import DeltaLog

#: State store that transformWithState needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: 2 to the power of this many consecutive keys form one state entry.
STATE_BITS = 10
STATE = "marks binary"
# No leading underscore: pandas would rename such columns on their way to the processor.
_ENTRY = "sm_entry"
_MARKS = ("sm_key", "sm_stamp", "sm_one", "sm_two")
_ROW = "sm_row"
_NO_STAMP = -(1 << 63)


def newest_rows() -> StatefulProcessor:
    """Per state entry: emits each key's newest row of the input if the state doesn't hold it yet.

    The marks are int64 rows (key, stamp, one, two) in key order.  The class is
    local so that it travels to the workers by value.
    """
    import zlib

    import numpy as np
    import pandas as pd

    mark_names, row_name = list(_MARKS), _ROW
    key_name, stamp_name = mark_names[:2]

    def newest(rows):
        """Per key the rows of its largest stamp, equal ones once and at most two: a second one is a clash."""
        rows = rows[rows[stamp_name] == rows.groupby(key_name)[stamp_name].transform("max")]
        return rows.drop_duplicates(mark_names).groupby(key_name).head(2)

    def packed(marks):
        """Number of marks, fingerprints, then differences of the keys and stamps, compressed; never a multiple of 32 bytes long."""
        columns = marks.astype("<i8").T
        steps = np.diff(columns[0], prepend=np.int64(0))
        held = np.int64(len(marks)).tobytes() + columns[2:].tobytes() + zlib.compress(steps.tobytes() + columns[1].tobytes(), 1)
        return held + b"\0" * (len(held) % 32 == 0)

    def unpacked(held):
        if len(held) % 32 == 0:  # as rows of 32 bytes: no entry, or one of a stream begun before entries were packed
            return np.frombuffer(held, dtype="<i8").reshape(-1, 4)
        n = int(np.frombuffer(held, dtype="<i8", count=1)[0])
        rest = np.frombuffer(zlib.decompressobj().decompress(held[8 + 16 * n :]), dtype="<i8").reshape(2, n)
        prints = np.frombuffer(held, dtype="<i8", count=2 * n, offset=8).reshape(2, n)
        return np.stack([np.cumsum(rest[0]), rest[1], prints[0], prints[1]], axis=1)

    class NewestRows(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.seen = handle.getValueState("marks", STATE)

        def _known(self):
            held = self.seen.get()
            return unpacked(bytes(held[0]) if held is not None else b"")

        def _remember(self, known, marks) -> None:
            kept = known[~np.isin(known[:, 0], marks[:, 0])]
            both = np.concatenate([kept, marks])
            self.seen.update((packed(both[np.argsort(both[:, 0], kind="stable")]),))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            best = None
            for part in rows:  # of an entry's rows, one part and the newest per key are held
                part = part[[*mark_names, row_name]]
                best = newest(part if best is None else pd.concat([best, part], ignore_index=True))
            clash = best[key_name].duplicated()
            if clash.any():
                raise ValueError(f"two different rows of key {best[key_name][clash].iloc[0]} at one stamp in a micro-batch")
            marks, known = best[mark_names].to_numpy(dtype="int64"), self._known()
            changed = np.ones(len(marks), dtype=bool)
            if len(known):
                at = np.minimum(np.searchsorted(known[:, 0], marks[:, 0]), len(known) - 1)
                old = known[at]
                met = old[:, 0] == marks[:, 0]
                changed = ~met | ((marks[:, 1] >= old[:, 1]) & (marks != old).any(axis=1))
            if changed.any():
                self._remember(known, marks[changed])
                yield pd.DataFrame({row_name: best[row_name].to_numpy()[changed]})

        def handleInitialState(self, key, initialState, timerValues) -> None:
            self._remember(self._known(), initialState[mark_names].to_numpy(dtype="int64"))

        def close(self) -> None:
            pass

    return NewestRows()


def _marked(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """State entry and marks of ``rows``: key, stamp in microseconds and two hashes of the whole row, in which nulls count."""
    every = [c for name in spec.schema.fieldNames() for c in (F.col(name).isNull(), F.col(name))]
    key = F.coalesce(F.col(spec.key[0]), F.raise_error(F.lit(f"null {spec.key[0]} in the stream"))).cast("long")
    stamp = F.coalesce(F.unix_micros(F.col(spec.ts_col).cast("timestamp")), F.lit(_NO_STAMP))
    marks = [key, stamp, F.xxhash64(F.lit(1), *every), F.xxhash64(F.lit(2), *every)]
    return rows.select(F.shiftright(key, STATE_BITS).alias(_ENTRY), *[m.alias(n) for m, n in zip(marks, _MARKS, strict=True)], "*")


def _packed(spec: TableSpec) -> Column:
    """The row as one string, which passes Python without a conversion of its values."""
    return F.to_json(F.array(*[F.col(n).cast("string") for n in spec.schema.fieldNames()]))


def _unpacked(rows: DataFrame, spec: TableSpec) -> DataFrame:
    parsed = rows.select(F.from_json(_ROW, "array<string>").alias(_ROW))
    return parsed.select(*[F.col(_ROW)[i].cast(f.dataType).alias(f.name) for i, f in enumerate(spec.schema.fields)])


def changed_rows(rows: DataFrame, spec: TableSpec, known: DataFrame | None = None) -> DataFrame:
    """The streaming ``rows`` (of the table's schema) that are new or newer than every earlier one of their key.

    ``known``: rows that count as seen before the first batch.
    """
    marked = _marked(rows, spec).select(_ENTRY, *_MARKS, _packed(spec).alias(_ROW))
    seen = None if known is None else _marked(known, spec).select(_ENTRY, *_MARKS).groupBy(_ENTRY)
    changed = marked.groupBy(_ENTRY).transformWithStateInPandas(
        statefulProcessor=newest_rows(), outputStructType=f"{_ROW} string", outputMode="append", timeMode="none", initialState=seen
    )
    return _unpacked(changed, spec)


def start_log_stream(
    spark: SparkSession,
    source_dir: str,
    log: DeltaLog,
    table: str,
    checkpoint_location: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream from the Parquet files of ``source_dir`` into ``log``'s ``table``.

    What the table holds when the stream first runs counts as seen.  The
    stream is known to the log by its checkpoint folder and must be the
    table's only writer; the commit it started from must stay readable.
    """
    spec = log.specs[table]
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    reader = spark.readStream.schema(spec.schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # The seed is part of the stream's plan, so a restart has to name the commit that the first start found.
    start = log.first_seen(checkpoint_location)
    seed = log.read(table, log.commit(start)) if start else None
    changes = changed_rows(reader.parquet(source_dir), spec, seed)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        if log.last_load(checkpoint_location) >= epoch_id:
            batch.write.format("noop").mode("overwrite").save()  # tried again: only the state has to follow
        else:
            log.append({table: batch}, writer=(checkpoint_location, epoch_id))

    writer = changes.writeStream.outputMode("append").foreachBatch(apply).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    with shuffles_dropped(spark):  # the stream's session is a copy of this one
        return writer.start()
