"""K1 — dense surrogate keys and global ranks without a single-task window.

``row_number() over (order by k)`` with no partition moves every row into one
task.  Instead the rows are range-partitioned on the ordering (the partitioner
samples the keys, so a hot value of a leading column is still split by the
following columns), sorted inside each partition, and numbered there; a tiny
per-partition count gives each partition its offset.  The numbered frame is
checkpointed to the shared checkpoint directory first, so the counting pass and
the numbering pass see the same partitioning even if executors are lost and
tasks re-run; columns that only order the rows are dropped before it is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.session import stored_copy

_PID = "_sm_pid"
_IDX = "_sm_idx"
_OFF = "_sm_off"
_RN = "_sm_rn"
_TIE = "_sm_tie"

ColumnLike = str | Column


#: Input bytes per range partition.
RANGE_BYTES = 128 * 1024 * 1024


def _as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _deciding(order_by: Sequence[ColumnLike], keep: Sequence[str] | None) -> list[ColumnLike]:
    """The leading part of ``order_by`` that decides the result's rows.

    Rows equal up to the last kept column are equal in the result, whichever
    of them comes first; that needs every kept column in the ordering.
    """
    order = list(order_by)
    names = [c if isinstance(c, str) else None for c in order]
    if not keep or any(k not in names for k in keep):
        return order
    return order[: max(names.index(k) for k in keep) + 1]


def range_width(df: DataFrame) -> int:
    """Range partitions for ``df``: one per ``RANGE_BYTES`` of the files it reads, at least the session's shuffle width."""
    spark, size = df.sparkSession, 0
    for name in df.inputFiles():
        place = spark._jvm.org.apache.hadoop.fs.Path(name)
        size += place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).getLen()
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))


def sequence_number(
    df: DataFrame,
    order_by: Sequence[ColumnLike],
    out_col: str,
    start: int | Column | DataFrame = 1,
    num_partitions: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``out_col`` = start + (0-based position of the row in ``order_by``).

    Equivalent to ``start - 1 + row_number() over (order by ...)``.  Ties get
    distinct but arbitrary numbers, exactly like ``row_number``.  ``keep``: the
    input columns of the result (default all); the others only order, and
    those behind the last kept one are not needed for that (``_deciding``).
    """
    order = [_as_col(c) for c in _deciding(order_by, keep)]
    width = num_partitions or range_width(df)
    # At the session's own width AQE may merge adjacent ranges (the order stays intact).
    at_default = width == int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(*order) if at_default else df.repartitionByRange(width, *order)
    numbered = (
        ranged.sortWithinPartitions(*order)
        .withColumn(_PID, F.spark_partition_id())
        # monotonically_increasing_id = (partition index << 33) + position in
        # the (already sorted) partition; keep only the position.
        .withColumn(_IDX, F.monotonically_increasing_id() - F.col(_PID).cast("long") * F.lit(1 << 33))
    )
    numbered = stored_copy(numbered.select(*(keep if keep is not None else df.columns), _PID, _IDX), "numbered")
    # One row per partition: a proven size bound of ``n`` rows.
    offsets = (
        numbered.groupBy(_PID)
        .agg(F.count(F.lit(1)).alias("_sm_n"))
        .select(
            _PID,
            F.coalesce(
                F.sum("_sm_n").over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ).alias(_OFF),
        )
    )
    joined = numbered.join(F.broadcast(offsets), _PID)
    if isinstance(start, DataFrame):
        # A one-row frame (e.g. max(key) + 1 of the current dimension) used as
        # a scalar subquery: evaluated once, lazily, no join.
        start_col = start.select(F.col(start.columns[0])).scalar()
    else:
        start_col = start if isinstance(start, Column) else F.lit(start)
    return (
        joined.withColumn(out_col, (F.col(_OFF) + F.col(_IDX) + start_col.cast("long")).cast("long"))
        .drop(_PID, _IDX, _OFF)
    )


def assign_keys(
    new_rows: DataFrame,
    order_by: Sequence[ColumnLike],
    key_col: str,
    start: int | Column | DataFrame = 1,
    num_partitions: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """K1: dense surrogate keys ``start, start+1, ...`` in ``order_by`` order.

    Existing keys are never touched: callers pass only the rows that need a
    key and ``start = max(existing key) + 1`` (see :func:`next_key`).
    """
    return sequence_number(new_rows, order_by, key_col, start, num_partitions, keep)


def next_key(dim: DataFrame, key_col: str) -> DataFrame:
    """One-row frame: ``max(key) + 1`` over the real members (the unknown
    member is -1), 1 for an empty dimension."""
    top = F.max(F.col(key_col))
    return dim.agg(F.when(top.isNull() | (top < 1), F.lit(1)).otherwise(top + 1).cast("long").alias("next_key"))


def _ordering(names: Sequence[str], descending: bool | Sequence[bool]) -> list[Column]:
    flags = [descending] * len(names) if isinstance(descending, bool) else list(descending)
    # SQL's default for DESC is NULLS FIRST, for ASC NULLS LAST (as in the views).
    return [F.col(n).desc_nulls_first() if d else F.col(n).asc_nulls_last() for n, d in zip(names, flags)]


def global_rank(
    df: DataFrame,
    by: Sequence[str],
    out_col: str,
    descending: bool | Sequence[bool] = False,
    method: str = "rank",
    num_partitions: int | None = None,
) -> DataFrame:
    """RANK / DENSE_RANK / ROW_NUMBER over the whole frame, distributed.

    ``rank`` and ``row_number``: rows are numbered in ``by`` order with a
    deterministic row hash as the last sort column, so a value shared by a
    large part of the rows is still spread over many range partitions.  For
    ``rank`` every row then takes the smallest number of its value — a grouped
    min (partial aggregation) joined back on the value.
    ``dense``: the distinct values of ``by`` are numbered and joined back.
    """
    order = _ordering(by, descending)
    if method in ("rank", "row_number"):
        spread = df.withColumn(_TIE, F.xxhash64(*[F.col(c) for c in df.columns]))
        numbered = sequence_number(spread, order + [F.col(_TIE)], _RN, 1, num_partitions).drop(_TIE)
        if method == "row_number":
            return numbered.withColumnRenamed(_RN, out_col)
        firsts = numbered.groupBy(*by).agg(F.min(_RN).alias(out_col))
        return _join_back(numbered.drop(_RN), firsts, by, out_col)
    if method == "dense":
        ranked = sequence_number(df.select(*by).distinct(), order, out_col, 1, num_partitions)
        return _join_back(df, ranked, by, out_col)
    raise ValueError(f"unknown rank method {method!r}")


def _join_back(df: DataFrame, ranked: DataFrame, by: Sequence[str], out_col: str) -> DataFrame:
    renamed = ranked.select(*[F.col(n).alias(f"_sm_rk_{n}") for n in by], out_col)
    cond = None
    for name in by:
        c = F.col(name).eqNullSafe(F.col(f"_sm_rk_{name}"))
        cond = c if cond is None else cond & c
    return df.join(renamed, cond, "inner").select(*df.columns, out_col)
