"""J5 as a merge of lines and versions against the equi-join form."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sparkmart.operators.asof import lookup_key_asof_merge
from sparkmart.operators.facts import lookup_key_asof

DAY = dt.date(2000, 1, 1)
LINES = "line long, product_id long, order_date date, product_key string"
VERSIONS = "product_id_source long, product_key long, row_start_date date, row_end_date date"


def day(n):
    return DAY + dt.timedelta(days=n)


def both(spark, lines, versions, parts=8):
    df, dim = spark.createDataFrame(lines, LINES), spark.createDataFrame(versions, VERSIONS)
    plain = lookup_key_asof(df, dim, "product_id", "order_date", out_col="found")
    merged = lookup_key_asof_merge(df, dim, "product_id", "order_date", out_col="found", num_partitions=parts)
    assert plain.columns == merged.columns
    return sorted(map(tuple, plain.collect()), key=str), merged


def test_edges(spark):
    versions = [
        (1, 10, day(0), day(5)), (1, 11, day(5), None), (2, 20, day(3), day(3)), (2, 21, day(4), day(6)), (2, 22, day(8), day(9)),
        (None, 30, day(0), None), (3, 31, None, None), (4, 40, day(0), None),
    ]
    lines = [(i, p, day(d), "clash") for i, (p, d) in enumerate((p, d) for p in (1, 2, 3, 4, 5) for d in range(-1, 11))]
    lines += [(100, None, day(4), None), (101, 1, None, None), (102, 4, None, None), (0, 1, day(-1), "clash")]
    want, merged = both(spark, lines, versions)
    assert sorted(map(tuple, merged.collect()), key=str) == want
    want, merged = both(spark, lines, [])
    assert {r["found"] for r in merged.collect()} == {-1} and merged.count() == len(lines)
    assert both(spark, [], versions)[1].count() == 0


def test_out_column_replaces_a_column(spark):
    df = spark.createDataFrame([(1, 1, day(1), "old")], LINES)
    dim = spark.createDataFrame([(1, 10, day(0), None)], VERSIONS)
    assert [tuple(r) for r in lookup_key_asof_merge(df, dim, "product_id", "order_date").collect()] == [(1, 1, day(1), 10)]


@pytest.mark.parametrize("parts", [1, 13])
def test_random_versions(spark, parts):
    rng = random.Random(parts)
    versions, key = [], 0
    for p in range(40):
        at = rng.randrange(-5, 5)
        for _ in range(rng.randrange(0, 12)):
            start, end = at, at + rng.randrange(0, 6)
            versions.append((p, key, day(start), None if rng.random() < 0.02 else day(end)))
            key += 1
            if versions[-1][3] is None:
                break
            at = end + rng.randrange(0, 3)
    lines = [(i, rng.randrange(45), day(rng.randrange(-10, 60)), None) for i in range(3000)]
    want, merged = both(spark, lines, versions, parts)
    assert sorted(map(tuple, merged.collect()), key=str) == want


def test_a_hot_product_of_many_versions_runs_in_even_tasks(spark):
    n, width = 60_000, 16
    product = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
    # A third of the hot product's lines fall on one day.
    at = F.when(F.col("id") % 9 == 0, F.lit(1500)).otherwise(F.pmod(F.xxhash64("id"), F.lit(4000))).cast("int")
    lines = spark.range(n).select(F.col("id").alias("line"), product.alias("product_id"), F.date_add(F.lit(DAY), at).alias("order_date"))
    dim = spark.range(4000).select(
        F.lit(7).cast("long").alias("product_id_source"), (F.col("id") + 1).alias("product_key"),
        F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("row_start_date"), F.date_add(F.lit(DAY), F.col("id").cast("int") + 1).alias("row_end_date"),
    )
    merged = lookup_key_asof_merge(lines, dim, "product_id", "order_date", num_partitions=width)
    right = F.when(F.col("product_id") == 7, F.date_diff("order_date", F.lit(DAY)).cast("long") + 1).otherwise(-1)
    assert merged.where(F.col("product_key") != right).count() == 0 and merged.count() == n
    sizes = [r["count"] for r in merged.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= width // 2 and max(sizes) < 3 * n / width, sizes
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "SortMergeJoin" not in plan


def test_the_lookup_merges_what_it_may_not_broadcast(spark):
    lines = spark.createDataFrame([(i, i % 3, day(i), None) for i in range(30)], LINES)
    dim = spark.createDataFrame([(0, 10, day(0), day(9)), (0, 11, day(9), None), (1, 12, day(5), None)], VERSIONS)
    want = sorted(map(tuple, lookup_key_asof(lines, dim, "product_id", "order_date", out_col="found").collect()), key=str)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = lookup_key_asof(lines, dim, "product_id", "order_date", out_col="found", merge=True)
        assert sorted(map(tuple, merged.collect()), key=str) == want
        assert "Window" in merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
