"""S3 keyed upsert, S4 staging refresh, S5 snapshot rebuild.

There is no table format with MERGE in this environment, so a full refresh is
a new snapshot version ``<root>/<table>/version=<v>``; a plan never overwrites
a path it is reading, and readers pick the newest complete version (one with
Spark's ``_SUCCESS`` mark).  A failed job leaves an incomplete version that
nobody reads and the previous one untouched.  Only ``upsert_partitions``
rewrites partitions of a version in place.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.session import CODEC, shuffles_dropped, stored_copy


def assert_unique(df: DataFrame, key: Sequence[str], what: str = "batch") -> DataFrame:
    """Fail (lazily, inside the job) when ``key`` repeats in ``df``.

    A grouped count (pre-aggregated in every task, so a key that holds a large
    share of the rows never gathers in one) as a scalar subquery of a filter.
    ``df`` is read twice: pass a stored frame.
    """
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_sm_n")).where(F.col("_sm_n") > 1)
    n = repeated.agg(F.count(F.lit(1)).alias("_sm_n")).scalar()
    fail = F.raise_error(F.lit(f"duplicate key {list(key)} in {what}")).cast("boolean")
    return df.where(F.when(n > 0, fail).otherwise(F.lit(True)))


def upsert(target: DataFrame, delta: DataFrame, key: Sequence[str] | str, check_unique: bool = True) -> DataFrame:
    """S3: insert new keys, overwrite every non-key column of existing keys.

    ``target ▷ delta`` (rows whose key is not in the batch) ∪ ``delta``.  Keys
    absent from the batch are never deleted.  Idempotent: upserting the same
    batch twice gives the same table.

    Beside a batch too large to broadcast, only the target's rows within the
    batch's range of the (first) key meet it: new keys from the largest one on
    leave the target where it is.
    """
    key = [key] if isinstance(key, str) else list(key)
    # The batch is usually far smaller than the target: broadcast its keys when
    # a count proves them small, so the target is not shuffled for the anti join.
    from sparkmart.functions.joins import broadcast_if_small

    keys = delta.select(*key)
    if check_unique:
        delta = assert_unique(delta, key, "upsert batch")
    delta = delta.select(*target.columns)
    batch_keys, small = broadcast_if_small(keys)
    if small:
        return target.join(batch_keys, key, "left_anti").unionByName(delta)
    low, high = keys.agg(F.min(key[0]), F.max(key[0])).first()
    near = F.coalesce(F.col(key[0]).between(F.lit(low), F.lit(high)), F.lit(False))
    met = target.where(near).join(batch_keys, key, "left_anti")
    return met.unionByName(target.where(~near)).unionByName(delta)


def snapshot_path(root: str, table: str, version: str | int) -> str:
    return f"{root.rstrip('/')}/{table}/version={version}"


def write_snapshot(
    df: DataFrame,
    root: str,
    table: str,
    version: str | int | None = None,
    sort_by: Sequence[str] | None = None,
    partition_by: Sequence[str] | None = None,
    publish: bool = True,
) -> str:
    """Write ``df`` as a new version of ``table`` (full refresh).

    Without ``version`` it is the next free number; a version that exists is
    an error, never overwritten.

    ``partition_by`` lays the files out in one directory per value (for a
    bounded column such as the fact's ``date_key``): filters on it, and
    dynamic partition pruning from a filtered dimension, skip whole
    directories.  Rows are first clustered by the partition columns with the
    REBALANCE hint, so each task writes few files while AQE splits a hot value
    (one day holding a large share of the rows) over several tasks and merges
    small ones.  ``sort_by`` orders rows inside each file so parquet min/max
    statistics let other filters skip row groups; tasks that read stored files
    for it get at most ``SORTED_BYTES`` of them, so that their rows are sorted
    in memory.

    Without ``publish`` the version stays incomplete, so that no reader picks
    it, until ``publish_snapshot``: its rows can be checked where they lie.
    """
    if version is None:
        known = versions(df.sparkSession, root, table)
        version = max(known) + 1 if known else 0
    path = snapshot_path(root, table, version)
    out = df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    if sort_by or partition_by:
        out = out.sortWithinPartitions(*(list(partition_by or []) + list(sort_by or [])))
    writer = out.write.mode("errorifexists").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if not publish:
        writer = writer.option(_MARK_SUCCESS, "false")
    with shuffles_dropped(df.sparkSession):
        if sort_by:
            with _scans_of(df.sparkSession, SORTED_BYTES):
                writer.parquet(path)
        else:
            writer.parquet(path)
    return path


#: Packed input bytes that a task of a sorted write reads: some 1.5 million order lines, unpacked ten times as large.
SORTED_BYTES = 16 * 1024 * 1024
_SCAN_BYTES = "spark.sql.files.maxPartitionBytes"


@contextmanager
def _scans_of(spark: SparkSession, size: int) -> Iterator[None]:
    """Plans run within read files in parts of at most ``size`` bytes (less if the session says so)."""
    before = spark.conf.get(_SCAN_BYTES)
    if before.removesuffix("b").isdigit():  # a value with another unit is the user's own choice and stays
        spark.conf.set(_SCAN_BYTES, str(min(size, int(before.removesuffix("b")))))
    try:
        yield
    finally:
        spark.conf.set(_SCAN_BYTES, before)


#: Hadoop's switch for the ``_SUCCESS`` mark that a job leaves.
_MARK_SUCCESS = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def publish_snapshot(spark: SparkSession, path: str) -> None:
    """Mark the version at ``path`` as complete."""
    fs, place = _file_system(spark, f"{path}/_SUCCESS")
    fs.create(place, True).close()


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of Spark's storage layer; errors of the store are raised."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, root: str, table: str) -> dict[int, bool]:
    """Version numbers of ``table`` by a directory listing, and whether each is complete."""
    fs, place = _file_system(spark, f"{root.rstrip('/')}/{table}")
    if not fs.exists(place):
        return {}
    out = {}
    for status in fs.listStatus(place):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("version="):
            done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            out[int(name.removeprefix("version="))] = fs.exists(done)
    return out


def read_stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Read a written snapshot back with the column order and types of ``like``
    (partition columns come back last and with inferred types)."""
    stored = spark.read.parquet(path)
    return stored.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def remove_incomplete(spark: SparkSession, root: str, table: str, version: int) -> None:
    """Delete what a failed write has left of ``version``; a complete version stays."""
    if versions(spark, root, table).get(version) is False:
        fs, place = _file_system(spark, snapshot_path(root, table, version))
        fs.delete(place, True)


def latest_version(spark: SparkSession, root: str, table: str) -> str | None:
    """Newest complete version of ``table``, whether it holds rows or not."""
    complete = [v for v, done in versions(spark, root, table).items() if done]
    return str(max(complete)) if complete else None


def read_snapshot(spark: SparkSession, root: str, table: str, version: str | int | None = None) -> DataFrame:
    v = version if version is not None else latest_version(spark, root, table)
    if v is None:
        raise FileNotFoundError(f"no snapshot of {table} under {root}")
    return spark.read.parquet(snapshot_path(root, table, v))


#: Partitions one ``upsert_partitions`` call may rewrite (27 years of days).
MAX_PARTITIONS = 10_000


def upsert_partitions(
    spark: SparkSession,
    target_path: str,
    delta: DataFrame,
    key: Sequence[str] | str,
    partition_col: str,
    keys_may_move: bool = True,
    max_partitions: int = MAX_PARTITIONS,
) -> list:
    """S3 for a stored target partitioned by ``partition_col`` (e.g. the fact by
    ``date_key``): rewrite only the partitions the batch touches.

    Affected partitions are those of the batch rows plus those still holding
    one of the batch's keys (a row whose partition value changed).  Their new
    content — old rows whose key is not in the batch, plus the batch — is
    stored first (a plan may not overwrite files it reads) and then replaces
    just those directories through dynamic partition overwrite; a partition
    whose rows have all moved away is removed after it.  Every other partition
    stays untouched, so a sync costs the size of the delta's partitions, not of
    the table.  The affected values are returned; more than ``max_partitions``
    of them, or a null one, is an error (use ``upsert`` into a new version).
    ``keys_may_move=False`` skips the key scan when a row's partition value
    never changes (e.g. an order line's order date).
    """
    key = [key] if isinstance(key, str) else list(key)
    target = spark.read.parquet(target_path)
    delta = assert_unique(stored_copy(delta.select(*target.columns), "upsert-batch"), key, "upsert batch")
    affected = delta.select(partition_col)
    if keys_may_move:
        # Partitions still holding a batch key (reads key + partition columns
        # only; the batch's keys are broadcast when a count proves them small).
        from sparkmart.functions.joins import broadcast_if_small

        batch_keys, _ = broadcast_if_small(delta.select(*key))
        moved = target.select(*key, partition_col).join(batch_keys, key, "left_semi").select(partition_col)
        affected = affected.union(moved)
    values = [r[0] for r in affected.distinct().limit(max_partitions + 1).collect()]
    if len(values) > max_partitions or None in values:
        raise ValueError(f"batch touches more than {max_partitions} partitions of {partition_col}, or a null one")
    if not values:
        return []
    old = target.where(F.col(partition_col).isin(values))  # static partition pruning
    rewritten = old.join(delta.select(*key), key, "left_anti").unionByName(delta)
    rewritten = stored_copy(rewritten, "upsert-partitions")
    (
        rewritten.hint("rebalance", partition_col)
        .sortWithinPartitions(partition_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(target_path)
    )
    filled = {r[0] for r in rewritten.select(partition_col).distinct().collect()}  # among the checked values
    for value in values:
        if value not in filled:  # dynamic overwrite leaves a partition without new rows as it was
            fs, place = _file_system(spark, f"{target_path.rstrip('/')}/{partition_col}={value}")
            fs.delete(place, True)
    return values
