from sparkmart.functions.joins import broadcast_if_small, row_width


def test_broadcast_only_when_count_fits(spark):
    small = spark.range(100).withColumnRenamed("id", "k")
    big = spark.range(100000).withColumnRenamed("id", "k")
    assert row_width(small) == 16
    _, ok = broadcast_if_small(small, max_bytes=16 * 100)
    assert ok
    _, ok = broadcast_if_small(small, max_bytes=16 * 99)
    assert not ok
    side, ok = broadcast_if_small(small)
    assert ok
    plan = big.join(side, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_a_counted_side_may_exceed_the_planners_threshold(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    side = spark.range(100).withColumnRenamed("id", "k")
    try:
        for threshold, small in (("200", True), ("199", False), ("-1", False)):  # 100 rows of 16 bytes
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            assert broadcast_if_small(side)[1] == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_counted_side_beyond_the_bound_is_not_broadcast_for_its_small_files(spark, tmp_path):
    from pyspark.sql import functions as F

    side = spark.range(400_000).select((F.col("id") % 7).alias("k"))
    side.write.parquet(f"{tmp_path}/side")
    side, old = spark.read.parquet(f"{tmp_path}/side"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    big = spark.range(1_000_000).withColumnRenamed("id", "k")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "700000")  # the files fit it; 8 times as much are 350,000 counted rows
        assert "BroadcastHashJoin" in big.join(side, "k", "left")._jdf.queryExecution().executedPlan().toString()
        for how in ("left", "left_anti", "inner"):
            kept, ok = broadcast_if_small(side)
            plan = big.join(kept, "k", how)._jdf.queryExecution().executedPlan().toString()
            assert not ok and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert broadcast_if_small(side, rows=350_000)[1] and not broadcast_if_small(side, rows=350_001)[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
