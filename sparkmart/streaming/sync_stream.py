"""I1 as a Structured Streaming job: keep a target copy in step with a source.

The batch sync (``sparkmart.operators.sync``) finds new rows with a
``max(last_updated)`` high-water mark.  Run continuously, the same job is a
file-source stream: Spark's own offset log replaces the watermark, so a row
stamped exactly at the previous maximum is not lost (trap G12), and every
micro-batch is upserted into a new target snapshot.

Exactly-once: micro-batch ``n`` reads target version ``n`` and writes version
``n + 1``; a retried batch finds that version complete and leaves it, or
removes an incomplete one and writes it again from the same input.  Version
``n`` missing is an error, never an empty target (but for the first batch).  Within one micro-batch the newest row per key wins; two
different rows with the same key and the same stamp fail the batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkmart.session import stored_copy
from sparkmart.sources.sinks import assert_unique, remove_incomplete, snapshot_path, upsert, versions, write_snapshot


def latest_per_key(batch: DataFrame, key: Sequence[str], ts_col: str) -> DataFrame:
    """Newest row per key; two different rows at the newest stamp raise.

    The newest stamp per key is a grouped max (partial aggregation, so a key
    updated very often in one batch is pre-reduced in every task), joined back
    on (key, stamp).
    """
    newest = batch.groupBy(*key).agg(F.max(ts_col).alias("_sm_max"))
    latest = (
        batch.join(newest, list(key), "inner")
        .where(F.col(ts_col) == F.col("_sm_max"))
        .drop("_sm_max")
        .dropDuplicates()
    )
    return assert_unique(latest, key, "micro-batch (two rows for one key at one stamp)")


def start_sync_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    target_root: str,
    table: str,
    key: Sequence[str],
    checkpoint_location: str,
    ts_col: str = "last_updated",
    initial: DataFrame | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the sync stream; ``available_now`` processes what exists and stops.

    ``initial`` seeds target version 0 (e.g. an existing copy) when the
    stream has not run yet.
    """
    key = list(key)
    if not versions(spark, target_root, table).get(0):
        seed = spark.createDataFrame([], schema) if initial is None else initial.select(*[f.name for f in schema.fields])
        remove_incomplete(spark, target_root, table, 0)
        write_snapshot(seed, target_root, table, 0)

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    changes = reader.parquet(source_dir)

    def apply(batch: DataFrame, epoch_id: int) -> None:
        if versions(spark, target_root, table).get(epoch_id + 1):
            return  # a retry after the version was written
        remove_incomplete(spark, target_root, table, epoch_id + 1)
        current = spark.read.parquet(snapshot_path(target_root, table, epoch_id))
        newest = stored_copy(latest_per_key(stored_copy(batch, "batch"), key, ts_col), "batch")
        write_snapshot(upsert(current, newest, key), target_root, table, epoch_id + 1)

    writer = changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
