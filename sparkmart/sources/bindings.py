"""Bind the driver's TPC-H-shaped parquet tables to the order-entry source model.

| model table      | built from                                                        |
| ---------------- | ----------------------------------------------------------------- |
| Region           | region (r_regionkey, r_name)                                      |
| Country          | nation (n_nationkey, n_name, n_regionkey)                         |
| Facility         | customer (c_custkey, c_name, c_mktsegment as type, c_nationkey)   |
| ProductCategory  | distinct part.p_type, id = smallest p_partkey of the type         |
| Product          | part (p_partkey, p_name, category, p_retailprice as decimal, true)  |
| PurchaseOrder    | orders (o_orderkey, o_custkey, o_orderdate as date, o_totalprice) |
| OrderLine        | lineitem, unit price sold = the part's list price (line total / quantity if the part is unknown) |

``lineitem`` has no unique line key, so ``order_line_id`` is a dense key over
every lineitem column (K1 — range partitioned, so one huge order is still split
across tasks).  Every scan goes through the declared column types of
``schemas.INPUTS``.  Everything is lazy except the key assignments, which are
stored once, and the count of the parts for the price lookup.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.functions.joins import broadcast_if_small
from sparkmart.operators.keys import assign_keys
from sparkmart.sources.tables import read_table

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Every lineitem column, in the order that numbers the lines.
LINE_ORDER = (
    "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice "
    "l_discount l_tax l_shipdate l_returnflag l_linestatus"
).split()

# The lineitem columns the model uses.
LINE_COLUMNS = "l_orderkey l_linenumber l_partkey l_quantity l_extendedprice".split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


@dataclass
class Sources:
    """The seven normalised source tables, built lazily from ``sf_dir``."""

    spark: SparkSession
    sf_dir: str

    def raw(self, name: str) -> DataFrame:
        """The driver table scanned with its declared types (a missing column is an error)."""
        cache = self.__dict__.setdefault("_raw", {})
        if name not in cache:
            cache[name] = read_table(self.spark, table_path(self.sf_dir, name), schemas.INPUTS.get(name))
        return cache[name]

    @cached_property
    def region(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").cast("long").alias("region_id"), F.col("r_name").alias("region_name")
        )

    @cached_property
    def country(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").cast("long").alias("country_id"),
            F.col("n_name").alias("country_name"),
            F.col("n_regionkey").cast("long").alias("region_id"),
        )

    @cached_property
    def facility(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").cast("long").alias("facility_id"),
            F.col("c_name").alias("facility_name"),
            F.col("c_mktsegment").alias("facility_type"),
            F.col("c_nationkey").cast("long").alias("country_id"),
        )

    @cached_property
    def category(self) -> DataFrame:
        # A stable id per category without a ranking pass: the smallest part
        # key of the type (part keys are unique, so ids are too).  A grouped
        # aggregate with map-side partial aggregation.
        return (
            self.raw("part")
            .groupBy(F.col("p_type").alias("category_name"))
            .agg(F.min("p_partkey").cast("long").alias("category_id"))
            .select("category_id", "category_name")
        )

    @cached_property
    def product(self) -> DataFrame:
        part = self.raw("part")
        return part.join(self.category, part["p_type"] == self.category["category_name"], "left").select(
            F.col("p_partkey").cast("long").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("category_id"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
            F.lit(True).alias("is_active"),
        )

    @cached_property
    def purchase_order(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").cast("long").alias("order_id"),
            F.col("o_custkey").cast("long").alias("facility_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"),
        )

    def _lines(self, keyed: bool) -> DataFrame:
        li = self.raw("lineitem").select(*LINE_ORDER)
        if keyed:
            li = assign_keys(li, LINE_ORDER, "order_line_id", keep=LINE_COLUMNS)
        price = self.raw("part").select(
            F.col("p_partkey").alias("_pk"), F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price_sold")
        )
        price, _ = broadcast_if_small(price)
        # A line whose part is unknown stays, at its own average price: the fact gives it the unknown member.
        lines = li.join(price, li["l_partkey"] == price["_pk"], "left")
        id_col = [F.col("order_line_id")] if keyed else []
        return lines.select(
            *id_col,
            F.col("l_orderkey").cast("long").alias("order_id"),
            F.col("l_linenumber").cast("long").alias("line_number"),
            F.col("l_partkey").cast("long").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.coalesce("unit_price_sold", (F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))).cast("decimal(10,2)")).alias("unit_price_sold"),
            F.col("l_extendedprice").cast("decimal(12,2)").alias("line_total"),
        )

    @cached_property
    def order_line(self) -> DataFrame:
        """OrderLine with its integer key ``order_line_id``."""
        return self._lines(keyed=True)

    @cached_property
    def order_line_unkeyed(self) -> DataFrame:
        """OrderLine without the key, for reports that never read it."""
        return self._lines(keyed=False)

    def until(self, day: dt.date) -> Sources:
        """The sources as they were before ``day``: only orders placed earlier, with their lines."""
        earlier = Sources(self.spark, self.sf_dir)
        orders = self.purchase_order.where(F.col("order_date") < F.lit(day))
        earlier.__dict__["purchase_order"] = orders
        return earlier

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "region": self.region,
            "country": self.country,
            "product_category": self.category,
            "product": self.product,
            "facility": self.facility,
            "purchase_order": self.purchase_order,
            "order_line": self.order_line,
        }
