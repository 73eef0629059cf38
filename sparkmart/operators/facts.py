"""D4 fact load with the three lookups J4 (default key), J5 (as-of) and J6 (calendar).

Join strategy: every dimension's lookup side (two to four columns; the calendar
too, its years come from the data) is counted first and broadcast only when
that count proves it small (``functions.joins``); beyond that they are sort-merge joins on the natural key, with AQE splitting a hot
key on the fact side.  The as-of lookup is an equi-join on the
product id with the validity interval as a residual condition (never a
nested-loop join); empty intervals are dropped first (G3).  Beside a product
dimension too large to broadcast whose products have more than ``FEW_VERSIONS``
versions, the fact load merges it with the lines (``operators.asof``): three
times the bytes of the equi-join, but no line meets every version.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.joins import broadcast_if_small
from sparkmart.functions.predicates import UNKNOWN_KEY, non_empty_interval, ts_literal, valid_at
from sparkmart.operators.asof import lookup_key_asof_merge

# Fixed value: so many versions of one product are compared with each of its lines.
FEW_VERSIONS = 16


def lookup_key(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    dim_on: str,
    key_col: str,
    out_col: str | None = None,
    default: int | None = UNKNOWN_KEY,
    size_check: bool = True,
) -> DataFrame:
    """Left equi-lookup of ``dim[key_col]``; misses become ``default``.

    With ``default=None`` a miss stays NULL (the calendar lookup, checked by
    :func:`require_keys`).  ``size_check`` broadcasts the lookup side only
    when a count proves it small (see ``functions.joins``).
    """
    out_col = out_col or key_col
    right = dim.select(F.col(dim_on).alias("_sm_lk"), F.col(key_col).alias("_sm_key"))
    if size_check:
        right, _ = broadcast_if_small(right)
    joined = df.join(right, df[on] == F.col("_sm_lk"), "left")
    value = F.col("_sm_key") if default is None else F.coalesce(F.col("_sm_key"), F.lit(default).cast("long"))
    return joined.withColumn(out_col, value).drop("_sm_lk", "_sm_key")


def lookup_key_asof(
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
    size_check: bool = True,
    merge: bool = False,
    few_versions: int = 0,
) -> DataFrame:
    """Point-in-time lookup: same id and ``start <= date < end`` (open end).

    With ``merge`` a dimension too large to broadcast is merged with the lines
    by ranges of (id, date), if an id has more than ``few_versions`` versions;
    its versions must not overlap.
    """
    out_col = out_col or key_col
    right = dim.where(non_empty_interval(start_col, end_col)).select(
        F.col(dim_on).alias("_sm_lk"),
        F.col(key_col).alias("_sm_key"),
        F.col(start_col).alias("_sm_s"),
        F.col(end_col).alias("_sm_e"),
    )
    if size_check:
        right, small = broadcast_if_small(right)
        if merge and not small and (not few_versions or _most_versions(right) > few_versions):
            return lookup_key_asof_merge(df, dim, on, date_col, dim_on, key_col, start_col, end_col, out_col, default)
    cond = (df[on] == F.col("_sm_lk")) & valid_at(df[date_col], F.col("_sm_s"), F.col("_sm_e"))
    joined = df.join(right, cond, "left")
    return joined.withColumn(out_col, F.coalesce(F.col("_sm_key"), F.lit(default).cast("long"))).drop(
        "_sm_lk", "_sm_key", "_sm_s", "_sm_e"
    )


def _most_versions(right: DataFrame) -> int:
    """Largest number of versions of one id."""
    return right.where(F.col("_sm_lk").isNotNull()).groupBy("_sm_lk").count().agg(F.max("count")).first()[0] or 0


def require_keys(df: DataFrame, key_col: str, message: str, show: tuple[str, ...] = ()) -> DataFrame:
    """Fail the job when a required lookup missed (NOT NULL on the fact, G17).

    The check is a filter, which a plan keeps even when a later projection
    drops the key.  The error names an offending row through the ``show``
    columns; :func:`missing_dates` lists them all.
    """
    detail = F.concat_ws(
        ", ", F.lit(message), *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("NULL"))) for c in show]
    )
    return df.where(F.when(F.col(key_col).isNull(), F.raise_error(detail).cast("boolean")).otherwise(F.lit(True)))


def missing_dates(staging_order: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The staged lines whose order date the calendar lacks (NULL dates too)."""
    days, _ = broadcast_if_small(dim_date.select("full_date"))
    return staging_order.join(days, F.col("order_date") == F.col("full_date"), "left_anti")


def load_fact(
    staging_order: DataFrame,
    dim_date: DataFrame,
    dim_facility: DataFrame,
    dim_product: DataFrame,
    now: dt.datetime | Column | None = None,
) -> DataFrame:
    """One fact row per staged order line.

    ``order_line_key`` is the line's own integer source key (re-loading the
    same lines yields the same keys, so a re-load is an idempotent upsert,
    G11).  Unknown facility / product → -1; a date outside the calendar aborts
    the load.
    """
    if isinstance(now, Column):  # a per-line load stamp (e.g. daily loads)
        staging_order = staging_order.withColumn("_sm_stamp", now)
    named = ("order_line_id", "order_id", "order_date", "facility_id", "product_id", "quantity", "unit_price_sold", "line_total", "_sm_stamp")
    lines = staging_order.select(*[c for c in named if c in staging_order.columns])
    lines = lookup_key(lines, dim_facility, "facility_id", "facility_id_source", "facility_key")
    lines = lookup_key_asof(lines, dim_product, "product_id", "order_date", merge=True, few_versions=FEW_VERSIONS)
    lines = lookup_key(lines, dim_date, "order_date", "full_date", "date_key", default=None)
    lines = require_keys(
        lines, "date_key", "order date outside the calendar (dim_date)", show=("order_id", "order_date")
    )
    key = [F.col("order_line_id").alias("order_line_key")] if "order_line_id" in lines.columns else []
    return lines.select(
        *key,
        "date_key",
        "facility_key",
        "product_key",
        "order_id",
        "quantity",
        "unit_price_sold",
        "line_total",
        _stamp(now).alias("last_updated"),
    )


def _stamp(now) -> Column:
    if isinstance(now, Column):
        return F.col("_sm_stamp").cast("timestamp_ntz")
    return ts_literal(now) if now else F.lit(None).cast("timestamp_ntz")
