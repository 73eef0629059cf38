"""Staging extracts (flatten the snowflake) and the staging edit.

Extracts are plain inner equi-joins; no broadcast is forced — Catalyst's size
estimate (and AQE's runtime statistics) turns the small reference tables into
broadcast joins and keeps a sort-merge join once they outgrow the threshold.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.predicates import ts_literal


def _load_stamp(now: dt.datetime | None) -> Column:
    return ts_literal(now) if now is not None else F.lit(None).cast("timestamp_ntz")


def extract_facility(
    facility: DataFrame, country: DataFrame, region: DataFrame, now: dt.datetime | None = None
) -> DataFrame:
    """Facility ⋈ Country ⋈ Region → raw_facility."""
    f, c, r = facility.alias("f"), country.alias("c"), region.alias("r")
    return (
        f.join(c, F.col("f.country_id") == F.col("c.country_id"), "inner")
        .join(r, F.col("c.region_id") == F.col("r.region_id"), "inner")
        .select(
            F.col("f.facility_id").alias("facility_id"),
            F.col("f.facility_name").alias("facility_name"),
            F.col("f.facility_type").alias("facility_type"),
            F.col("c.country_name").alias("country_name"),
            F.col("r.region_name").alias("region_name"),
            _load_stamp(now).alias("source_load_date"),
        )
    )


def extract_product(product: DataFrame, category: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """Product ⋈ ProductCategory → raw_product."""
    p, c = product.alias("p"), category.alias("c")
    return p.join(c, F.col("p.category_id") == F.col("c.category_id"), "inner").select(
        F.col("p.product_id").alias("product_id"),
        F.col("p.product_name").alias("product_name"),
        F.col("c.category_name").alias("category_name"),
        F.col("p.unit_price").alias("unit_price"),
        F.col("p.is_active").alias("is_active"),
        _load_stamp(now).alias("source_load_date"),
    )


def extract_order(line: DataFrame, header: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """OrderLine ⋈ PurchaseOrder → raw_order (header date and facility on each line).

    A shuffle join on ``order_id`` at scale; AQE splits a hot order's lines.
    ``order_line_id`` is carried when the line frame has it.
    """
    ln, h = line.alias("l"), header.alias("h")
    keyed = "order_line_id" in line.columns
    return ln.join(h, F.col("l.order_id") == F.col("h.order_id"), "inner").select(
        *([F.col("l.order_line_id").alias("order_line_id")] if keyed else []),
        F.col("h.order_id").alias("order_id"),
        F.col("h.order_date").alias("order_date"),
        F.col("h.facility_id").alias("facility_id"),
        F.col("l.product_id").alias("product_id"),
        F.col("l.quantity").alias("quantity"),
        F.col("l.unit_price_sold").alias("unit_price_sold"),
        F.col("l.line_total").alias("line_total"),
        _load_stamp(now).alias("source_load_date"),
    )


def apply_update(df: DataFrame, predicate: Column, assignments: Mapping[str, Column]) -> DataFrame:
    """``UPDATE df SET col = expr WHERE predicate`` as a projection.

    Each assigned value is cast back to the column's declared type, so
    ``unit_price * 1.2`` on a ``decimal(10,2)`` is rounded half-up to two
    places like a NUMERIC(10,2) assignment.
    """
    types = dict(df.dtypes)
    out = []
    for name in df.columns:
        if name in assignments:
            value = assignments[name].cast(types[name])
            out.append(F.when(predicate, value).otherwise(F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    # Rows where the predicate is NULL keep their values, as in SQL.
    return df.select(*out)


def reprice(staging_product: DataFrame, product_ids, factor: str = "1.2") -> DataFrame:
    """The reference's price edit: ``unit_price * factor`` for the given ids."""
    return apply_update(
        staging_product,
        F.col("product_id").isin(list(product_ids)),
        {"unit_price": F.col("unit_price") * F.lit(factor).cast("decimal(10,4)")},
    )


def rename_facility(staging_facility: DataFrame, facility_id: int, new_name: str) -> DataFrame:
    """The reference's rename edit on one facility."""
    return apply_update(
        staging_facility, F.col("facility_id") == F.lit(facility_id), {"facility_name": F.lit(new_name)}
    )
