"""Watermark, incremental scan, upsert and the per-table sync."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError

from sparkmart import schemas
from sparkmart.operators import scd, sync
from sparkmart.sources.incremental import read_since, watermark
from sparkmart.sources.sinks import upsert

T = dt.datetime
SCHEMA = "k long, v string, last_updated timestamp_ntz"


def test_watermark_defaults_to_epoch(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert watermark(empty) == T(1970, 1, 1)
    only_unknown = scd.unknown_facility(spark, T(2024, 1, 1))
    assert watermark(only_unknown, key_col="facility_key") == T(1970, 1, 1)  # G9


def test_strict_watermark_skips_equal_timestamp(spark):
    src = spark.createDataFrame([(1, "a", T(2024, 1, 1)), (2, "b", T(2024, 1, 2))], SCHEMA)
    assert [r.k for r in read_since(src, "last_updated", T(2024, 1, 1)).collect()] == [2]
    assert sorted(r.k for r in read_since(src, "last_updated", T(2024, 1, 1), inclusive=True).collect()) == [1, 2]


def test_upsert_is_idempotent_and_never_deletes(spark):
    target = spark.createDataFrame([(1, "a", T(2024, 1, 1)), (2, "b", T(2024, 1, 1))], SCHEMA)
    delta = spark.createDataFrame([(2, "B", T(2024, 2, 1)), (3, "c", T(2024, 2, 1))], SCHEMA)
    once = upsert(target, delta, "k")
    twice = upsert(once, delta, "k")
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.k: r.v for r in once.collect()} == {1: "a", 2: "B", 3: "c"}


def test_duplicate_key_in_batch_fails(spark):
    target = spark.createDataFrame([(1, "a", T(2024, 1, 1))], SCHEMA)
    delta = spark.createDataFrame([(2, "x", T(2024, 2, 1)), (2, "y", T(2024, 2, 1))], SCHEMA)
    with pytest.raises((PySparkException, Py4JJavaError)):
        upsert(target, delta, "k").collect()


def test_sync_twice_moves_nothing_the_second_time(spark):
    src = scd.unknown_facility(spark, T(2024, 1, 1)).unionByName(
        spark.createDataFrame([(1, 10, "A", "H", "X", "R", T(2024, 3, 1))], schemas.DIM_FACILITY)
    )
    target = scd.unknown_facility(spark, T(2024, 1, 1))
    first = sync.sync_table(src, target, schemas.DIM_FACILITY_SPEC)
    # Epoch watermark: the seeded unknown member travels too (an idempotent upsert).
    assert first.watermark == T(1970, 1, 1) and first.delta.count() == 2
    second = sync.sync_table(src, first.target, schemas.DIM_FACILITY_SPEC)
    assert second.delta.count() == 0
    assert sorted(second.target.collect()) == sorted(first.target.collect())
    report = sync.sync_report(spark, [first, second]).collect()
    assert [r.rows_synced for r in report] == [2, 0]


def test_watermark_filter_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "src")
    spark.createDataFrame(
        [(i, "x", T(2024, 1, 1 + i % 28)) for i in range(100)], SCHEMA
    ).write.parquet(path)
    delta = read_since(spark.read.parquet(path), "last_updated", T(2024, 1, 20), ["k", "last_updated"])
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(last_updated), GreaterThan(last_updated," in plan
    assert "ReadSchema: struct<k:bigint,last_updated:timestamp_ntz>" in plan
    assert delta.count() == sum(1 for i in range(100) if 1 + i % 28 > 20)


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    import glob
    import os

    from sparkmart.sources.sinks import upsert_partitions

    schema = "k long, d long, v string, last_updated timestamp_ntz"
    path = str(tmp_path / "fact")
    rows = [(i, i % 4, "old", T(2024, 1, 1)) for i in range(20)]
    spark.createDataFrame(rows, schema).write.partitionBy("d").parquet(path)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/d=*/*.parquet")}
    # Update key 1 (d=1), move key 2 from d=2 to d=1, insert key 99 in d=1.
    delta = spark.createDataFrame(
        [(1, 1, "new", T(2024, 2, 1)), (2, 1, "moved", T(2024, 2, 1)), (99, 1, "ins", T(2024, 2, 1))], schema
    )
    touched = upsert_partitions(spark, path, delta, "k", "d")
    assert sorted(touched) == [1, 2]
    got = {r.k: (r.d, r.v) for r in spark.read.parquet(path).collect()}
    assert got[1] == (1, "new") and got[2] == (1, "moved") and got[99] == (1, "ins")
    assert got[3] == (3, "old") and len(got) == 21
    untouched = [f for f in before if "/d=0/" in f or "/d=3/" in f]
    assert untouched and all(os.path.exists(f) and os.path.getmtime(f) == before[f] for f in untouched)


def test_partitioned_upsert_removes_an_emptied_partition(spark, tmp_path):
    from sparkmart.sources.sinks import upsert_partitions

    schema = "k long, d long, v string, last_updated timestamp_ntz"
    path = str(tmp_path / "fact")
    spark.createDataFrame([(1, 0, "old", T(2024, 1, 1)), (2, 1, "old", T(2024, 1, 1))], schema).write.partitionBy("d").parquet(path)
    delta = spark.createDataFrame([(1, 1, "moved", T(2024, 2, 1))], schema)
    assert sorted(upsert_partitions(spark, path, delta, "k", "d")) == [0, 1]
    assert sorted((r.k, r.d, r.v) for r in spark.read.parquet(path).collect()) == [(1, 1, "moved"), (2, 1, "old")]
    with pytest.raises(ValueError):
        upsert_partitions(spark, path, delta, "k", "d", max_partitions=0)


def test_newest_complete_version_wins(spark, tmp_path):
    import os

    from sparkmart.sources.sinks import latest_version, read_snapshot, versions, write_snapshot

    root = str(tmp_path)
    one = spark.createDataFrame([(1, "a", T(2024, 1, 1))], SCHEMA)
    assert latest_version(spark, root, "t") is None
    write_snapshot(one, root, "t")
    write_snapshot(one.limit(0), root, "t")  # an empty table is a version like any other
    assert latest_version(spark, root, "t") == "1" and read_snapshot(spark, root, "t").count() == 0
    os.makedirs(f"{root}/t/version=2")  # a failed write
    assert versions(spark, root, "t") == {0: True, 1: True, 2: False} and latest_version(spark, root, "t") == "1"
    with pytest.raises(PySparkException):
        write_snapshot(one, root, "t", version=1)
    assert write_snapshot(one, root, "t").endswith("version=3")


def test_sync_stored_table_end_to_end(spark, tmp_path):
    from sparkmart.operators.sync import sync_stored_table

    spec = schemas.TableSpec("t", None, ("k",))
    schema = "k long, d long, v string, last_updated timestamp_ntz"
    path = str(tmp_path / "target")
    spark.createDataFrame([(1, 0, "a", T(2024, 1, 1))], schema).write.partitionBy("d").parquet(path)
    source = spark.createDataFrame(
        [(1, 0, "a", T(2024, 1, 1)), (2, 1, "b", T(2024, 1, 5)), (3, 1, "c", T(2024, 1, 6))], schema
    )
    wm, n, touched = sync_stored_table(spark, source, path, spec, "d")
    assert (wm, n, touched) == (T(2024, 1, 1), 2, [1])
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    assert sync_stored_table(spark, source, path, spec, "d")[1:] == (0, [])


def test_upsert_of_many_keys_meets_the_targets_rows_of_their_range_only(spark, tmp_path):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no batch is small
    try:
        spark.range(1, 1001).selectExpr("'old' as v", "id as k").unionByName(spark.sql("select 'old' as v, cast(null as long) as k")).write.parquet(f"{tmp_path}/t")
        target = spark.read.parquet(f"{tmp_path}/t")
        spark.range(1001, 1101).selectExpr("id as k", "'new' as v").write.parquet(f"{tmp_path}/d")
        later = upsert(target, spark.read.parquet(f"{tmp_path}/d"), "k")
        assert sorted((r.v, r.n) for r in later.groupBy("v").agg(F.count("*").alias("n")).collect()) == [("new", 100), ("old", 1001)]
        later.collect()
        final = later._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "LeftAnti" not in final  # the target is not shuffled for keys that lie beyond it
        spark.range(990, 1011).selectExpr("id as k", "'new' as v").write.parquet(f"{tmp_path}/e")
        mixed = upsert(target, spark.read.parquet(f"{tmp_path}/e"), "k")
        assert mixed.columns == ["k", "v"] and mixed.count() == 990 + 21
        assert sorted(r.k for r in mixed.where("v = 'new'").collect()) == list(range(990, 1011)) and mixed.where("k is null").count() == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_stored_copies_and_snapshots_are_packed_with_zstd(spark, tmp_path):
    from sparkmart.session import stored_copy
    from sparkmart.sources.sinks import read_snapshot, write_snapshot

    copy = stored_copy(spark.range(100))
    write_snapshot(copy, str(tmp_path), "t")
    for df in (copy, read_snapshot(spark, str(tmp_path), "t")):
        assert df.count() == 100 and all(f.endswith(".zstd.parquet") for f in df.inputFiles())


def test_sorted_write_reads_stored_files_in_small_parts(spark, tmp_path, monkeypatch):
    from sparkmart.sources import sinks

    scan_bytes = "spark.sql.files.maxPartitionBytes"
    before, stored = spark.conf.get(scan_bytes), str(tmp_path / "stored")
    rows = spark.range(0, 200_000, numPartitions=1).select(F.xxhash64("id").alias("v"), (F.col("id") % 50).alias("day"))
    rows.write.option("parquet.block.size", 64 * 1024).parquet(stored)
    monkeypatch.setattr(sinks, "SORTED_BYTES", 128 * 1024, raising=False)
    path = sinks.write_snapshot(spark.read.parquet(stored), str(tmp_path / "out"), "t", sort_by=["day"])
    files = [str(f) for f in (tmp_path / "out" / "t" / "version=0").glob("*.parquet")]
    assert len(files) > 4  # one task per file
    for file in files[:3]:
        days = [r.day for r in spark.read.parquet(file).coalesce(1).collect()]
        assert days == sorted(days)
    assert spark.read.parquet(path).exceptAll(rows).isEmpty() and rows.exceptAll(spark.read.parquet(path)).isEmpty()
    assert spark.conf.get(scan_bytes) == before
    failing = rows.where(F.raise_error(F.lit("no")).cast("boolean"))
    with pytest.raises(Exception, match="no"):
        sinks.write_snapshot(failing, str(tmp_path / "out"), "t", sort_by=["day"])
    assert spark.conf.get(scan_bytes) == before


def test_upsert_of_a_batch_beyond_the_counted_bound_joins_by_a_shuffle(spark, tmp_path, monkeypatch):
    from sparkmart.functions import joins

    row = "select id as k, {} as v, timestamp_ntz'2024-01-01' as last_updated from range({}, {})"
    for name, *what in (("target", "'old'", 0, 100), ("batch", "'new'", 90, 200)):
        spark.sql(row.format(*what)).write.parquet(f"{tmp_path}/{name}")
    monkeypatch.setattr(joins, "COUNTED", 1e-4)  # of the default threshold: 1 kB, the files of the batch are small beside that
    merged = upsert(spark.read.parquet(f"{tmp_path}/target"), spark.read.parquet(f"{tmp_path}/batch"), "k")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {r.k: r.v for r in merged.collect()} == {k: "old" for k in range(90)} | {k: "new" for k in range(90, 200)}
