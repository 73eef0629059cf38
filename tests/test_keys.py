"""K1 and the distributed ranks against single-task window functions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkmart.operators import keys
from sparkmart.operators.keys import assign_keys, global_rank, next_key


def test_sequence_matches_row_number(spark):
    df = spark.range(0, 5000, numPartitions=7).select(((F.col("id") * 7919) % 5003).alias("k"))
    got = assign_keys(df, ["k"], "key", start=10, num_partitions=5)
    expected = df.withColumn("key", F.row_number().over(Window.orderBy("k")) + 9)
    assert sorted(got.collect()) == sorted(expected.collect())
    keys = [r.key for r in got.collect()]
    assert sorted(keys) == list(range(10, 5010))


def test_adaptive_partitioning_keeps_order(spark):
    df = spark.range(0, 2000, numPartitions=4).select((F.col("id") * 37 % 2003).alias("k"))
    got = assign_keys(df, ["k"], "key")
    rows = sorted(got.collect(), key=lambda r: r.k)
    assert [r.key for r in rows] == list(range(1, 2001))


def test_columns_behind_the_last_kept_one_are_not_moved(spark, monkeypatch):
    # Ties in every prefix of the ordering, nulls, and equal rows.
    n = F.col("id")
    order = ["a", "b", "c", "d", "e"]
    df = spark.range(0, 3000, numPartitions=6).select(
        (n % 40).alias("a"), F.when(n % 7 > 0, n % 5).alias("b"), (n * 31 % 11).alias("c"),
        F.concat(F.lit("tail-"), n % 3).alias("d"), (n * 17 % 13).alias("e"),
    )
    moved = []
    monkeypatch.setattr(keys, "stored_copy", lambda frame, name: moved.append(frame) or frame.localCheckpoint())
    expected = df.withColumn("key", F.row_number().over(Window.orderBy(*order)))
    for keep, columns in ((["a", "c"], {"a", "b", "c"}), (["a", "e"], set(order))):
        got = assign_keys(df, order, "key", num_partitions=5, keep=keep)
        assert sorted(got.collect(), key=lambda r: r.key) == sorted(expected.select(*keep, "key").collect(), key=lambda r: r.key)
        plan = moved[-1]._jdf.queryExecution().optimizedPlan().toString()
        ranged = next(line for line in plan.splitlines() if "RepartitionByExpression" in line)
        below = plan[plan.index(ranged):].splitlines()[1]
        assert {c for c in order if f"AS {c}#" in below} == columns


def test_a_kept_column_outside_the_ordering_keeps_the_whole_ordering(spark):
    df = spark.createDataFrame([(1, 3, "x"), (1, 2, "y"), (1, 1, "z")], "a int, b int, other string")
    got = assign_keys(df, ["a", "b"], "key", keep=["a", "other"])
    assert {(r.other, r.key) for r in got.collect()} == {("z", 1), ("y", 2), ("x", 3)}


def test_start_frame_is_max_plus_one(spark):
    dim = spark.createDataFrame([(-1,), (3,), (7,)], "facility_key long")
    new = spark.createDataFrame([(20,), (10,)], "facility_id long")
    got = assign_keys(new, ["facility_id"], "facility_key", start=next_key(dim, "facility_key"))
    assert {(r.facility_id, r.facility_key) for r in got.collect()} == {(10, 8), (20, 9)}
    only_unknown = spark.createDataFrame([(-1,)], "facility_key long")
    assert next_key(only_unknown, "facility_key").first()[0] == 1


def test_rank_and_dense_rank_with_ties(spark):
    df = spark.createDataFrame([("a", 10), ("b", 10), ("c", 5), ("d", 7), ("e", 7)], "name string, rev int")
    rank = {r.name: r.r for r in global_rank(df, ["rev"], "r", descending=True, method="rank").collect()}
    dense = {r.name: r.r for r in global_rank(df, ["rev"], "r", descending=True, method="dense").collect()}
    assert rank == {"a": 1, "b": 1, "d": 3, "e": 3, "c": 5}
    assert dense == {"a": 1, "b": 1, "d": 2, "e": 2, "c": 3}


def test_rank_matches_window_on_many_ties(spark):
    df = spark.range(0, 3000, numPartitions=6).select(F.col("id"), (F.col("id") % 97).alias("v"))
    got = global_rank(df, ["v"], "r", descending=True, method="rank", num_partitions=4)
    expected = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc())))
    assert sorted(got.collect()) == sorted(expected.select("id", "v", "r").collect())


def test_rank_with_a_hot_tied_value(spark):
    # A third of the rows share one value: ranks stay exact.
    df = spark.range(0, 3000, numPartitions=6).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id")).alias("v")
    )
    got = global_rank(df, ["v"], "r", descending=True, method="rank", num_partitions=8)
    expected = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc())))
    assert sorted(got.collect()) == sorted(expected.select("id", "v", "r").collect())
    rn = global_rank(df, ["v"], "r", descending=True, method="row_number", num_partitions=8)
    assert sorted(r.r for r in rn.collect()) == list(range(1, 3001))
