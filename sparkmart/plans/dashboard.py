"""The sales dashboard's measures, plus U1/A6 row counts.

Every measure is an aggregate over the fact joined to the dimensions it uses;
slicers (B0) are filters applied before aggregation, so Catalyst pushes the
date range and the geography into the dimension side of the joins (and the
calendar range into the fact's date_key via the broadcast join).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.functions.joins import broadcast_if_small
from sparkmart.functions.predicates import known


FACT_COLUMNS = ("date_key", "facility_key", "product_key", "order_id", "quantity", "unit_price_sold", "line_total")
DIM_COLUMNS = {
    "date": ("date_key", "full_date", "year", "month"),
    "facility": ("facility_key", "facility_name", "country_name", "region_name"),
    "product": ("product_key", "product_name", "category_name"),
}


def sales_star(fact: DataFrame, date: DataFrame | None = None, facility: DataFrame | None = None, product: DataFrame | None = None) -> DataFrame:
    """The fact joined (J3) to the dimensions given: those that a visual's measure or slicers use.

    Each dimension side is broadcast only when a count proves it small,
    otherwise it is a sort-merge join on the surrogate key.
    """
    star = fact.select(*FACT_COLUMNS)
    for name, dim in (("date", date), ("facility", facility), ("product", product)):
        if dim is not None:
            side, _ = broadcast_if_small(dim.select(*DIM_COLUMNS[name]))
            star = star.join(side, DIM_COLUMNS[name][0])
    return star


def apply_slicers(
    star: DataFrame,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
    facilities: Sequence[str] | None = None,
    countries: Sequence[str] | None = None,
    regions: Sequence[str] | None = None,
) -> DataFrame:
    """The report's shared slicers, inclusive date range."""
    cond = F.lit(True)
    if date_from is not None:
        cond = cond & (F.col("full_date") >= F.lit(date_from))
    if date_to is not None:
        cond = cond & (F.col("full_date") <= F.lit(date_to))
    if facilities:
        cond = cond & F.col("facility_name").isin(list(facilities))
    if countries:
        cond = cond & F.col("country_name").isin(list(countries))
    if regions:
        cond = cond & F.col("region_name").isin(list(regions))
    return star.where(cond)


def kpi_cards(star: DataFrame) -> DataFrame:
    """Total sales and distinct orders (one row)."""
    return star.agg(
        F.sum("line_total").cast("decimal(22,2)").alias("total_sales"),
        F.countDistinct("order_id").cast("long").alias("total_orders"),
    )


def revenue_over_time(star: DataFrame, grain: str = "day") -> DataFrame:
    """B2: revenue per day (monthly is V1)."""
    if grain == "day":
        keys = ["full_date"]
    elif grain == "month":
        keys = ["year", "month"]
    else:
        raise ValueError("grain must be 'day' or 'month'")
    return star.groupBy(*keys).agg(F.sum("line_total").cast("decimal(22,2)").alias("revenue"))


def sales_by_country(star: DataFrame) -> DataFrame:
    """Revenue, orders and units per country.

    The orders are counted beside the sums: a distinct count in the same
    aggregate would shuffle the sums of every order with it.
    """
    sums = star.groupBy("country_name").agg(
        F.sum("line_total").cast("decimal(22,2)").alias("revenue"),
        F.sum("quantity").cast("long").alias("units_sold"),
    )
    pairs = star.select(F.col("country_name").alias("_sm_country"), "order_id").distinct()
    orders = pairs.groupBy("_sm_country").agg(F.count("order_id").cast("long").alias("order_count"))
    joined = sums.join(orders, F.col("country_name").eqNullSafe(F.col("_sm_country")))
    return joined.select("country_name", "revenue", "order_count", "units_sold")


def revenue_by_category(star: DataFrame) -> DataFrame:
    """Revenue per category and its share of the total.

    The total is the sum of the grouped rows (one row per category); sums stay
    decimal, only the share is a double.
    """
    by_cat = star.groupBy("category_name").agg(F.sum("line_total").cast("decimal(22,2)").alias("revenue"))
    total = F.sum("revenue").over(Window.partitionBy())
    share = F.col("revenue").cast("double") / F.nullif(total.cast("double"), F.lit(0.0))
    return by_cat.select("category_name", "revenue", F.round(share, 6).alias("revenue_share"))


def top_products(star: DataFrame, n: int = 5) -> DataFrame:
    """The n products (name, category) with the highest revenue.

    Ties are broken by name then category so the cut is deterministic.  The
    limit is the feature here; Spark plans it as a per-partition top-n merged
    on the driver (TakeOrderedAndProject), never a full sort.
    """
    totals = (
        star.where(known("product_key"))
        .groupBy("product_name", "category_name")
        .agg(F.sum("line_total").cast("decimal(22,2)").alias("total_revenue"))
    )
    return totals.orderBy(
        F.col("total_revenue").desc_nulls_first(), F.col("product_name").asc(), F.col("category_name").asc()
    ).limit(n)


def units_vs_price(star: DataFrame) -> DataFrame:
    """Units sold against the average *sold* unit price, per product and category.

    The report file is not available; "unit price" is read as the average
    price actually paid on the product's lines.
    """
    return (
        star.where(known("product_key"))
        .groupBy("product_name", "category_name")
        .agg(
            F.sum("quantity").cast("long").alias("units_sold"),
            F.round(F.sum("unit_price_sold").cast("double") / F.count("unit_price_sold"), 6).alias("avg_unit_price"),
        )
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``SELECT 'name', COUNT(*) ... UNION ALL ...`` for each table."""
    parts = [
        df.agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
