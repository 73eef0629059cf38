"""V1 monthly revenue and V2 product revenue rank (the two analytic views).

V1 aggregates first and only then applies its window: the window runs over one
row per calendar month (bounded by the calendar), so an unpartitioned LAG is
safe.  V2's rank runs over one row per product group, which grows with the
data, so it uses the distributed rank (K1 machinery) instead of a single-task
window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.joins import broadcast_if_small
from sparkmart.functions.predicates import known
from sparkmart.operators.keys import global_rank


def star_join(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Inner join of the fact to one dimension on its surrogate key; the
    dimension side is counted first and broadcast only if small."""
    dim, _ = broadcast_if_small(dim)
    return fact.join(dim, key, "inner")


def monthly_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """V1: revenue, distinct orders, units per month; previous month and growth %.

    "Previous month" is the previous month *with sales* (G1).  Growth is
    ``round((cur - prev) / nullif(prev, 0) * 100, 2)`` in exact decimal.
    """
    dates = dim_date.select("date_key", "year", "month", "month_name")
    monthly = (
        star_join(fact.select("date_key", "order_id", "quantity", "line_total"), dates, "date_key")
        .groupBy("year", "month", "month_name")
        .agg(
            F.sum("line_total").alias("revenue"),
            F.countDistinct("order_id").alias("order_count"),
            F.sum("quantity").cast("long").alias("units_sold"),
        )
    )
    prev = F.lag("revenue", 1).over(Window.orderBy("year", "month"))
    with_prev = monthly.withColumn("prev_month_revenue", prev)
    growth = F.round(
        (F.col("revenue") - F.col("prev_month_revenue"))
        / F.nullif(F.col("prev_month_revenue"), F.lit(0))
        * F.lit(100),
        2,
    )
    return with_prev.select(
        "year",
        "month",
        "month_name",
        F.col("revenue").cast("decimal(22,2)").alias("revenue"),
        F.col("order_count").cast("long").alias("order_count"),
        "units_sold",
        F.col("prev_month_revenue").cast("decimal(22,2)").alias("prev_month_revenue"),
        growth.cast("decimal(18,2)").alias("mom_growth_pct"),
    )


def product_revenue_rank(fact: DataFrame, dim_product: DataFrame, method: str = "rank") -> DataFrame:
    """V2 (and W3 with ``method="dense"``): products ranked by revenue.

    Grouped by (name, category), not by key, so versions and same-named
    products merge (G15); the unknown member is excluded (P7).
    """
    products = dim_product.where(known("product_key")).select("product_key", "product_name", "category_name")
    totals = (
        star_join(fact.select("product_key", "order_id", "quantity", "line_total"), products, "product_key")
        .groupBy("product_name", "category_name")
        .agg(
            F.sum("line_total").cast("decimal(22,2)").alias("total_revenue"),
            F.sum("quantity").cast("long").alias("total_units"),
            F.countDistinct("order_id").cast("long").alias("order_count"),
        )
    )
    ranked = global_rank(totals, ["total_revenue"], "revenue_rank", descending=True, method=method)
    return ranked.select(
        "product_name", "category_name", "total_revenue", "total_units", "order_count", "revenue_rank"
    )


def monthly_report(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """O1: V1 in month order."""
    return monthly_revenue(fact, dim_date).orderBy("year", "month")


def rank_report(fact: DataFrame, dim_product: DataFrame, method: str = "rank") -> DataFrame:
    """O2: V2 in rank order, equal ranks by name and category (a distributed sort)."""
    return product_revenue_rank(fact, dim_product, method).orderBy("revenue_rank", "product_name", "category_name")
