"""Declared schemas of the source, staging and warehouse tables.

Types follow the order-entry source: integer keys become ``long``, money stays
``decimal`` (never float), flags are ``boolean``, load stamps are
``timestamp_ntz`` (wall-clock, zone-free, like the test data).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY_PRICE = T.DecimalType(10, 2)  # unit prices
MONEY_TOTAL = T.DecimalType(12, 2)  # line and order totals
MONEY_SUM = T.DecimalType(22, 2)  # sums of line totals
TS = T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# --- normalised source -----------------------------------------------------
REGION = _struct(("region_id", T.LongType(), False), ("region_name", T.StringType(), False))
COUNTRY = _struct(
    ("country_id", T.LongType(), False),
    ("country_name", T.StringType(), False),
    ("region_id", T.LongType(), True),
)
CATEGORY = _struct(("category_id", T.LongType(), False), ("category_name", T.StringType(), False))
PRODUCT = _struct(
    ("product_id", T.LongType(), False),
    ("product_name", T.StringType(), True),
    ("category_id", T.LongType(), True),
    ("unit_price", MONEY_PRICE, True),
    ("is_active", T.BooleanType(), True),
)
FACILITY = _struct(
    ("facility_id", T.LongType(), False),
    ("facility_name", T.StringType(), True),
    ("facility_type", T.StringType(), True),
    ("country_id", T.LongType(), True),
)
PURCHASE_ORDER = _struct(
    ("order_id", T.LongType(), False),
    ("facility_id", T.LongType(), True),
    ("order_date", T.DateType(), True),
    ("total_amount", MONEY_TOTAL, True),
)
ORDER_LINE = _struct(
    ("order_line_id", T.LongType(), False),
    ("order_id", T.LongType(), True),
    ("line_number", T.LongType(), True),
    ("product_id", T.LongType(), True),
    ("quantity", T.IntegerType(), True),
    ("unit_price_sold", MONEY_PRICE, True),
    ("line_total", MONEY_TOTAL, True),
)

# --- the input tables as they are scanned (S1: selected and cast by name) -------
INPUTS = {
    "region": _struct(("r_regionkey", T.LongType(), False), ("r_name", T.StringType(), False)),
    "nation": _struct(("n_nationkey", T.LongType(), False), ("n_name", T.StringType(), False), ("n_regionkey", T.LongType(), True)),
    "customer": _struct(
        ("c_custkey", T.LongType(), False),
        ("c_name", T.StringType(), True),
        ("c_nationkey", T.LongType(), True),
        ("c_mktsegment", T.StringType(), True),
    ),
    "part": _struct(
        ("p_partkey", T.LongType(), False),
        ("p_name", T.StringType(), True),
        ("p_type", T.StringType(), True),
        ("p_retailprice", T.DoubleType(), True),
    ),
    "orders": _struct(
        ("o_orderkey", T.LongType(), False),
        ("o_custkey", T.LongType(), True),
        ("o_totalprice", T.DoubleType(), True),
        ("o_orderdate", TS, True),
    ),
    "lineitem": _struct(
        ("l_orderkey", T.LongType(), False),
        ("l_partkey", T.LongType(), True),
        ("l_suppkey", T.LongType(), True),
        ("l_linenumber", T.IntegerType(), True),
        ("l_quantity", T.DoubleType(), True),
        ("l_extendedprice", T.DoubleType(), True),
        ("l_discount", T.DoubleType(), True),
        ("l_tax", T.DoubleType(), True),
        ("l_returnflag", T.StringType(), True),
        ("l_linestatus", T.StringType(), True),
        ("l_shipdate", TS, True),
    ),
}

# --- staging (every column nullable) ---------------------------------------
RAW_PRODUCT = _struct(
    ("product_id", T.LongType(), True),
    ("product_name", T.StringType(), True),
    ("category_name", T.StringType(), True),
    ("unit_price", MONEY_PRICE, True),
    ("is_active", T.BooleanType(), True),
    ("source_load_date", TS, True),
)
RAW_FACILITY = _struct(
    ("facility_id", T.LongType(), True),
    ("facility_name", T.StringType(), True),
    ("facility_type", T.StringType(), True),
    ("country_name", T.StringType(), True),
    ("region_name", T.StringType(), True),
    ("source_load_date", TS, True),
)
RAW_ORDER = _struct(
    ("order_line_id", T.LongType(), True),
    ("order_id", T.LongType(), True),
    ("order_date", T.DateType(), True),
    ("facility_id", T.LongType(), True),
    ("product_id", T.LongType(), True),
    ("quantity", T.IntegerType(), True),
    ("unit_price_sold", MONEY_PRICE, True),
    ("line_total", MONEY_TOTAL, True),
    ("source_load_date", TS, True),
)

# --- warehouse ---------------------------------------------------------------
DIM_DATE = _struct(
    ("date_key", T.LongType(), False),
    ("full_date", T.DateType(), False),
    ("year", T.IntegerType(), False),
    ("quarter", T.IntegerType(), False),
    ("month", T.IntegerType(), False),
    ("month_name", T.StringType(), False),
    ("day_of_month", T.IntegerType(), False),
    ("day_of_week", T.IntegerType(), False),
    ("is_weekend", T.BooleanType(), False),
    ("last_updated", TS, True),
)
DIM_FACILITY = _struct(
    ("facility_key", T.LongType(), False),
    ("facility_id_source", T.LongType(), False),
    ("facility_name", T.StringType(), False),
    ("facility_type", T.StringType(), False),
    ("country_name", T.StringType(), True),
    ("region_name", T.StringType(), True),
    ("last_updated", TS, True),
)
DIM_PRODUCT = _struct(
    ("product_key", T.LongType(), False),
    ("product_id_source", T.LongType(), False),
    ("product_name", T.StringType(), False),
    ("category_name", T.StringType(), True),
    ("unit_price", MONEY_PRICE, False),
    ("is_active", T.BooleanType(), True),
    ("row_start_date", T.DateType(), False),
    ("row_end_date", T.DateType(), True),
    ("is_current", T.BooleanType(), False),
    ("last_updated", TS, True),
)
FACT_ORDERS = _struct(
    ("order_line_key", T.LongType(), False),
    ("date_key", T.LongType(), False),
    ("facility_key", T.LongType(), False),
    ("product_key", T.LongType(), False),
    ("order_id", T.LongType(), False),
    ("quantity", T.IntegerType(), False),
    ("unit_price_sold", MONEY_PRICE, False),
    ("line_total", MONEY_TOTAL, False),
    ("last_updated", TS, True),
)


@dataclass(frozen=True)
class TableSpec:
    """What the sync and the quality checks need to know about a table."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    ts_col: str = "last_updated"
    unknown_key: int | None = None
    # Declared VARCHAR(n) lengths and NUMERIC(p, s) precisions.
    lengths: dict[str, int] = field(default_factory=dict)
    decimals: dict[str, tuple[int, int]] = field(default_factory=dict)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


# Declared column widths of the warehouse DDL.
DIM_DATE_SPEC = TableSpec("dim_date", DIM_DATE, ("date_key",), lengths={"month_name": 20})
DIM_FACILITY_SPEC = TableSpec(
    "dim_facility",
    DIM_FACILITY,
    ("facility_key",),
    unknown_key=-1,
    lengths={"facility_name": 200, "facility_type": 50, "country_name": 100, "region_name": 50},
)
DIM_PRODUCT_SPEC = TableSpec(
    "dim_product",
    DIM_PRODUCT,
    ("product_key",),
    unknown_key=-1,
    lengths={"product_name": 100, "category_name": 100},
    decimals={"unit_price": (10, 2)},
)
FACT_ORDERS_SPEC = TableSpec(
    "fact_orders",
    FACT_ORDERS,
    ("order_line_key",),
    decimals={"unit_price_sold": (10, 2), "line_total": (12, 2)},
)
WAREHOUSE_SPECS = (DIM_DATE_SPEC, DIM_FACILITY_SPEC, DIM_PRODUCT_SPEC, FACT_ORDERS_SPEC)
