"""Digest trees against a plain comparison of two copies."""

import datetime as dt

from pyspark.sql import functions as F

from sparkmart.operators import verify
from sparkmart.operators.verify import LEAF_KEYS, differing_leaves, differing_rows, digest_tree

N = 20 * LEAF_KEYS


def copy_of(spark, n=N):
    stamp = F.lit(dt.datetime(2000, 1, 1)).cast("timestamp_ntz")
    return spark.range(-1, n).select(
        F.col("id").alias("k"), (F.col("id") % 50).cast("int").alias("quantity"), F.when(F.col("id") % 7 > 0, F.lit("a")).alias("name"),
        F.when(F.col("id") % 5 > 0, F.lit("a")).alias("other"), stamp.alias("last_updated"),
    )


def test_equal_copies(spark):
    a = copy_of(spark, 9000)
    b = a.select(*reversed(a.columns)).orderBy(F.col("k").desc()).repartition(3).withColumn("extra_column", F.lit(1))
    assert differing_rows(a, b, "k").count() == 0
    assert differing_rows(a.limit(0), b.limit(0), "k").count() == 0
    assert differing_rows(a.where("k is null"), a.limit(0), "k").count() == 0


def test_drift_that_stamps_hide(spark):
    a = copy_of(spark)
    b = a.where("k not in (-1, 70000)").withColumn("quantity", F.when(F.col("k") == 5000, 99).otherwise(F.col("quantity")))
    b = b.withColumn("name", F.when(F.col("k") == 5001, F.lit(None)).otherwise(F.col("name")))
    # A value and a NULL that change places.
    swap = F.col("k") == 14
    b = b.withColumn("name", F.when(swap, F.col("other")).otherwise(F.col("name"))).withColumn("other", F.when(swap, F.lit(None)).otherwise(F.col("other")))
    b = b.unionByName(b.where("k = 3").withColumn("k", F.lit(10_000_000).cast("long")))
    got = {tuple(r) for r in differing_rows(a, b, "k").collect()}
    assert got == {(-1, "missing"), (70000, "missing"), (5000, "changed"), (5001, "changed"), (14, "changed"), (10_000_000, "extra")}
    whole = differing_rows(a, a.limit(0), "k").groupBy("status").count().collect()
    assert [tuple(r) for r in whole] == [("missing", N + 1)]


def test_many_runs_become_a_semi_join(spark, monkeypatch):
    a = copy_of(spark)
    b = a.withColumn("quantity", F.when(F.col("k") % (2 * LEAF_KEYS) == 9, -1).otherwise(F.col("quantity")))
    want = sorted(range(9, N, 2 * LEAF_KEYS))
    assert sorted(r["k"] for r in differing_rows(a, b, "k").collect()) == want
    monkeypatch.setattr(verify, "PUSHED_RANGES", 3)
    assert sorted(r["k"] for r in differing_rows(a, b, "k").collect()) == want


def test_only_differing_ranges_are_read(spark, tmp_path):
    a = copy_of(spark)
    b = a.withColumn("quantity", F.when(F.col("k") == 40_000, -1).otherwise(F.col("quantity")))
    stored = []
    for name, df in (("a", a), ("b", b)):
        df.repartitionByRange(20, "k").sortWithinPartitions("k").write.parquet(f"{tmp_path}/{name}")
        stored.append(spark.read.parquet(f"{tmp_path}/{name}"))
    trees = tuple(digest_tree(df, "k") for df in stored)
    leaf = 40_000 // LEAF_KEYS
    assert [r["node"] for r in differing_leaves(*trees).collect()] == [leaf]
    rows = differing_rows(*stored, "k", trees)
    assert [tuple(r) for r in rows.collect()] == [(40_000, "changed")]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # The scans of the tables get the bounds of the one leaf, and nothing else of the tables is read.
    assert plan.count(f"GreaterThanOrEqual(k,{leaf * LEAF_KEYS})") >= 2 and plan.count(f"LessThanOrEqual(k,{(leaf + 1) * LEAF_KEYS - 1})") >= 2, plan
    per_level = {r["level"]: r["count"] for r in trees[0].groupBy("level").count().collect()}
    assert per_level[0] == 21 and per_level[verify.LEVELS] == 2  # key -1 lies in leaf -1
