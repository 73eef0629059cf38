"""J5 for a dimension that is not broadcast: the as-of lookup as a merge of lines and versions.

An equi-join on the product id compares every line with every version of its
product, and a product with a third of all lines and thousands of versions
lands in a few tasks.  Here lines and versions become one table, dealt by
ranges of (id, date): a version stands before the lines of its first day, so
the version of a line is the last one before it.  Range bounds may fall inside
a product, even inside one day; the last version of each partition (one row per
partition, broadcast) is carried into the partitions after it.

Defined results: versions of one id must not overlap (the Type-2 invariant); of
those that start on one day the one with the largest key counts.  Empty
intervals, versions without id or start never match; lines without id or date
get the default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.predicates import UNKNOWN_KEY, non_empty_interval
from sparkmart.operators.keys import range_width
from sparkmart.session import stored_copy

_ORDER = ("_sm_id", "_sm_at", "_sm_line", "_sm_tie")


def _merged(df: DataFrame, dim: DataFrame, on: str, date_col: str, dim_on: str, key_col: str, start_col: str, end_col: str) -> DataFrame:
    """Lines and versions in one table; ``_sm_tie`` spreads the lines of one product and day."""
    valid = non_empty_interval(start_col, end_col) & F.col(dim_on).isNotNull() & F.col(start_col).isNotNull()
    versions = dim.where(valid).select(
        F.col(dim_on).alias("_sm_id"),
        F.col(start_col).alias("_sm_at"),
        F.lit(0).alias("_sm_line"),
        F.col(key_col).cast("long").alias("_sm_tie"),
        F.struct(F.col(dim_on).alias("id"), F.col(key_col).alias("key"), F.col(end_col).alias("until")).alias("_sm_version"),
    )
    lines = df.select(
        F.col(on).alias("_sm_id"),
        F.col(date_col).alias("_sm_at"),
        F.lit(1).alias("_sm_line"),
        F.xxhash64(*[F.col(c) for c in df.columns]).alias("_sm_tie"),
        F.struct(*[F.col(c) for c in df.columns]).alias("_sm_row"),
    )
    return lines.unionByName(versions, allowMissingColumns=True)


def lookup_key_asof_merge(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    date_col: str,
    dim_on: str = "product_id_source",
    key_col: str = "product_key",
    start_col: str = "row_start_date",
    end_col: str = "row_end_date",
    out_col: str | None = None,
    default: int = UNKNOWN_KEY,
    num_partitions: int | None = None,
) -> DataFrame:
    """J5 by merging: same id and ``start <= date < end`` (open end), for versions that don't overlap."""
    out_col = out_col or key_col
    width = num_partitions or range_width(df)
    both = _merged(df, dim, on, date_col, dim_on, key_col, start_col, end_col)
    ranged = both.repartitionByRange(width, *_ORDER).sortWithinPartitions(*_ORDER)
    # monotonically_increasing_id = (partition index << 33) + position in the sorted partition.
    ranged = ranged.withColumn("_sm_pid", F.spark_partition_id()).withColumn("_sm_idx", F.monotonically_increasing_id())
    # Stored, so that both passes see the same borders even if executors are lost.
    ranged = stored_copy(ranged, "asof-merge")
    # One row per partition: the last version of the partitions before it.
    place = F.when(F.col("_sm_version").isNotNull(), F.col("_sm_idx"))
    tails = ranged.groupBy("_sm_pid").agg(F.max_by("_sm_version", place).alias("_sm_tail"))
    before = Window.orderBy("_sm_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(F.col("_sm_pid").alias("_sm_p"), F.last("_sm_tail", ignorenulls=True).over(before).alias("_sm_carry"))
    # Dealt by ranges of the partition number, so every range stays a task of its own.
    dealt = ranged.repartitionByRange(width, "_sm_pid")
    dealt = dealt.join(F.broadcast(carried), F.col("_sm_pid") == F.col("_sm_p"))
    so_far = Window.partitionBy("_sm_pid").orderBy("_sm_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dealt = dealt.withColumn("_sm_last", F.coalesce(F.last("_sm_version", ignorenulls=True).over(so_far), F.col("_sm_carry")))
    fits = (F.col("_sm_last.id") == F.col("_sm_id")) & (F.col("_sm_last.until").isNull() | (F.col("_sm_at") < F.col("_sm_last.until")))
    key = F.coalesce(F.when(fits, F.col("_sm_last.key")), F.lit(default).cast("long"))
    kept = [F.col("_sm_row")[c].alias(c) for c in df.columns if c != out_col]
    return dealt.where("_sm_line = 1").select(*kept, key.alias(out_col))
