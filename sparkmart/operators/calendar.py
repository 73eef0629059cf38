"""D3: calendar dimension for whole years.

``date_key`` is the day's position in the calendar (``datediff + 1``), which is
what an identity column filled in date order produces — no ranking pass.
The calendar's size is bounded by its year range (≤ 366 rows per year), which
is what lets the fact load broadcast it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.predicates import ts_literal, weekday_number

# DATEPART(WEEKDAY) numbers the reference treats as weekend.
WEEKEND_DAY_NUMBERS = (6, 7)


def _attributes(days: DataFrame, start: Column, first_day_of_week: int, now: dt.datetime | None) -> DataFrame:
    d = F.col("full_date")
    dow = weekday_number(d, first_day_of_week)
    return days.select(
        (F.datediff(d, start) + 1).cast("long").alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        dow.isin(*WEEKEND_DAY_NUMBERS).alias("is_weekend"),
        (ts_literal(now) if now else F.lit(None).cast("timestamp_ntz")).alias("last_updated"),
    )


def build_dim_date(
    spark: SparkSession,
    start_year: int,
    end_year: int,
    first_day_of_week: int = 7,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Calendar for ``[start_year-01-01, end_year-12-31]``.

    ``first_day_of_week`` follows DATEFIRST numbering; the default 7 (Sunday
    first) makes days 6 and 7 Friday and Saturday, as the reference computes.
    """
    if end_year < start_year:
        raise ValueError("end_year before start_year")
    start = dt.date(start_year, 1, 1)
    n_days = (dt.date(end_year, 12, 31) - start).days + 1
    days = spark.range(n_days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))
    return _attributes(days, F.lit(start), first_day_of_week, now)


def dim_date_for(
    dates: DataFrame, date_col: str, first_day_of_week: int = 7, now: dt.datetime | None = None
) -> DataFrame:
    """Calendar covering the whole years spanned by ``dates[date_col]``.

    The year range comes from one global min/max aggregate, so no value
    passes through the driver and the plan stays lazy.
    """
    bounds = dates.agg(
        F.make_date(F.year(F.min(date_col)), F.lit(1), F.lit(1)).alias("_start"),
        F.make_date(F.year(F.max(date_col)), F.lit(12), F.lit(31)).alias("_end"),
    )
    days = bounds.select(
        F.col("_start"), F.explode(F.sequence("_start", "_end", F.expr("interval 1 day"))).alias("full_date")
    )
    return _attributes(days, F.col("_start"), first_day_of_week, now)


def first_day(dim_date: DataFrame) -> DataFrame:
    """One-row frame holding the calendar's first date (lazy)."""
    return dim_date.agg(F.min("full_date").alias("first_day"))
