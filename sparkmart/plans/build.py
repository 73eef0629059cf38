"""D6 — the end-to-end warehouse build, a later load, and the star the reports read.

Order of the reference's script: reset → extracts → calendar → facility →
product → staging edits → product → facility → fact.  Every table is written
as a new snapshot version below ``out_dir`` (a scratch folder of the shared
checkpoint directory when none is given) and the later stages read the files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.operators import calendar, facts, quality, scd, staging
from sparkmart.operators.keys import assign_keys, next_key
from sparkmart.session import scratch_path, stored_copy
from sparkmart.sources.bindings import Sources
from sparkmart.sources.sinks import latest_version, publish_snapshot, read_snapshot, read_stored, upsert, write_snapshot

# A scripted change scenario (facility 1 renamed, products 1 and
# 2 repriced by 1.2).
RENAMED_FACILITY = (1, "Renamed Facility One")
REPRICED_PRODUCTS = (1, 2)
REPRICE_FACTOR = "1.2"


@dataclass(frozen=True)
class BuildParams:
    """Run-time parameters; the reference reads the clock, we take it in.

    The defaults suit the scenarios on the static test data; the command line
    passes the clock.
    """

    now: dt.datetime = dt.datetime(2002, 1, 1)
    as_of: dt.date = dt.date(1998, 7, 1)
    first_day_of_week: int = 7
    start_year: int | None = None  # None (with end_year): whole years of the orders
    end_year: int | None = None
    initial_start: dt.date | None = None  # None: the calendar's first day
    renamed_facility: tuple[int, str] | None = RENAMED_FACILITY
    repriced_products: tuple[int, ...] = REPRICED_PRODUCTS
    fact_partition: str | None = "date_key"  # stored layout of the fact; None: sorted by date_key
    gates: bool = True  # Q1–Q4 on the dimensions and the fact before they are published


@dataclass
class Warehouse:
    staging_facility: DataFrame
    staging_product: DataFrame
    staging_order: DataFrame
    dim_date: DataFrame
    dim_facility: DataFrame
    dim_product: DataFrame
    fact_orders: DataFrame
    params: BuildParams = field(default_factory=BuildParams)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "raw_facility": self.staging_facility,
            "raw_product": self.staging_product,
            "raw_order": self.staging_order,
            "dim_date": self.dim_date,
            "dim_facility": self.dim_facility,
            "dim_product": self.dim_product,
            "fact_orders": self.fact_orders,
        }


class _Store:
    """Writes snapshot versions below a root and reads each back."""

    def __init__(self, spark, root: str, params: BuildParams):
        self.spark, self.root, self.params = spark, root, params

    def write(self, df: DataFrame, name: str, check: Callable[[DataFrame], None] | None = None) -> DataFrame:
        """Write a version and read it back; with ``check`` it becomes complete only once that passes on the written rows."""
        layout = {}
        if name == "fact_orders":
            part = self.params.fact_partition
            layout = {"partition_by": [part]} if part else {"sort_by": ["date_key"]}
        path = write_snapshot(df, self.root, name, publish=check is None, **layout)
        stored = read_stored(self.spark, path, df)
        if check is not None:
            check(stored)
            publish_snapshot(self.spark, path)
        return stored

    def latest(self, name: str) -> DataFrame | None:
        version = latest_version(self.spark, self.root, name)
        return None if version is None else read_snapshot(self.spark, self.root, name, version)


def _edited(stg_fac: DataFrame, stg_prod: DataFrame, p: BuildParams) -> tuple[DataFrame, DataFrame]:
    if p.renamed_facility is not None:
        stg_fac = staging.rename_facility(stg_fac, *p.renamed_facility)
    if p.repriced_products:
        stg_prod = staging.reprice(stg_prod, p.repriced_products, REPRICE_FACTOR)
    return stg_fac, stg_prod


def _calendar(src: Sources, p: BuildParams) -> DataFrame:
    if p.start_year is not None and p.end_year is not None:
        return calendar.build_dim_date(src.spark, p.start_year, p.end_year, p.first_day_of_week, p.now)
    # Whole years spanned by the orders, derived lazily (nothing reaches the driver).
    return calendar.dim_date_for(src.purchase_order, "order_date", p.first_day_of_week, p.now)


def _check_fact(fact: DataFrame, wh_dims: dict[str, DataFrame]) -> None:
    parents = {key: (wh_dims[dim], key) for dim, key in (("dim_date", "date_key"), ("dim_facility", "facility_key"), ("dim_product", "product_key"))}
    quality.gate(fact, schemas.FACT_ORDERS_SPEC, parents)


def run_build(
    src: Sources,
    params: BuildParams = BuildParams(),
    keyed_lines: bool = True,
    apply_edits: bool = True,
    out_dir: str | None = None,
) -> Warehouse:
    """Rebuild staging, dimensions and fact from the source tables.

    ``keyed_lines=False`` skips the order-line key (reports never read it);
    ``apply_edits=False`` stops after the first load (no change scenario).
    Each table is a new version; earlier versions stay.
    """
    spark, p = src.spark, params
    store = _Store(spark, out_dir or scratch_path(spark, "warehouse"), p)

    stg_fac = staging.extract_facility(src.facility, src.country, src.region, p.now)
    stg_prod = staging.extract_product(src.product, src.category, p.now)
    lines = src.order_line if keyed_lines else src.order_line_unkeyed
    stg_order = store.write(staging.extract_order(lines, src.purchase_order, p.now), "raw_order")
    dim_date = store.write(_calendar(src, p), "dim_date")

    initial = p.initial_start if p.initial_start is not None else calendar.first_day(dim_date)
    dim_fac = scd.scd1_merge(scd.empty_dim_facility(spark, p.now), stg_fac, p.now)
    dim_prod = scd.scd2_merge(scd.empty_dim_product(spark, p.now), stg_prod, p.as_of, p.now, initial)
    if apply_edits:
        stg_fac, stg_prod = _edited(stg_fac, stg_prod, p)
        dim_prod = scd.scd2_merge(dim_prod, stg_prod, p.as_of, p.now, initial)
        dim_fac = scd.scd1_merge(dim_fac, stg_fac, p.now)
    if p.gates:
        quality.gate(dim_fac, schemas.DIM_FACILITY_SPEC)
        quality.gate(dim_prod, schemas.DIM_PRODUCT_SPEC)

    stg_fac, stg_prod = store.write(stg_fac, "raw_facility"), store.write(stg_prod, "raw_product")
    dim_fac, dim_prod = store.write(dim_fac, "dim_facility"), store.write(dim_prod, "dim_product")
    # Partitioned by date_key (a directory per calendar day), a date filter on
    # dim_date prunes fact directories through dynamic partition pruning.
    fact = facts.load_fact(stg_order, dim_date, dim_fac, dim_prod, p.now)
    dims = {"dim_date": dim_date, "dim_facility": dim_fac, "dim_product": dim_prod}
    fact = store.write(fact, "fact_orders", (lambda rows: _check_fact(rows, dims)) if p.gates else None)
    return Warehouse(stg_fac, stg_prod, stg_order, dim_date, dim_fac, dim_prod, fact, p)


#: What tells one staged order line from another (equal lines are interchangeable).
LINE_IDENTITY = ("order_id", "product_id", "quantity", "line_total")


def run_load(src: Sources, params: BuildParams, out_dir: str, apply_edits: bool = False) -> Warehouse:
    """The reference's procedures against tables that already hold data.

    The latest stored versions are merged with the present source: Type 1 and
    Type 2 keep their history, the calendar grows, and only order lines that
    are not staged yet get keys (from the largest one on), so no stored key or
    fact row changes.  Without stored versions it is the first load.  Each
    table becomes a new version.
    """
    spark, p = src.spark, params
    store = _Store(spark, out_dir, p)
    stg_fac = staging.extract_facility(src.facility, src.country, src.region, p.now)
    stg_prod = staging.extract_product(src.product, src.category, p.now)
    if apply_edits:
        stg_fac, stg_prod = _edited(stg_fac, stg_prod, p)

    old_date, old_fac, old_prod = (store.latest(n) for n in ("dim_date", "dim_facility", "dim_product"))
    old_order, old_fact = store.latest("raw_order"), store.latest("fact_orders")

    cal = _calendar(src, p)
    if old_date is not None:  # days the stored calendar lacks, keyed after its last
        more = cal.drop("date_key").join(old_date.select("full_date"), "full_date", "left_anti")
        more = assign_keys(more, ["full_date"], "date_key", start=next_key(old_date, "date_key"))
        cal = old_date.unionByName(more.select(*old_date.columns))
    dim_date = store.write(cal, "dim_date")

    staged = staging.extract_order(src.order_line_unkeyed, src.purchase_order, p.now)
    fresh, start = staged, 1
    if old_order is not None:
        fresh, start = new_lines(staged, old_order), next_key(old_order, "order_line_id")
    # Numbered rows are stored already: their key is an addition on reading, no further copy is made.
    fresh = assign_keys(fresh, LINE_IDENTITY, "order_line_id", start=start).select("order_line_id", *staged.columns)
    stg_order = store.write(fresh if old_order is None else old_order.unionByName(fresh), "raw_order")

    initial = p.initial_start if p.initial_start is not None else calendar.first_day(dim_date)
    dim_fac = scd.scd1_merge(old_fac if old_fac is not None else scd.empty_dim_facility(spark, p.now), stg_fac, p.now)
    dim_prod = scd.scd2_merge(old_prod if old_prod is not None else scd.empty_dim_product(spark, p.now), stg_prod, p.as_of, p.now, initial)
    if p.gates:
        quality.gate(dim_fac, schemas.DIM_FACILITY_SPEC)
        quality.gate(dim_prod, schemas.DIM_PRODUCT_SPEC)
    stg_fac, stg_prod = store.write(stg_fac, "raw_facility"), store.write(stg_prod, "raw_product")
    dim_fac, dim_prod = store.write(dim_fac, "dim_facility"), store.write(dim_prod, "dim_product")

    dims = {"dim_date": dim_date, "dim_facility": dim_fac, "dim_product": dim_prod}
    fact = facts.load_fact(fresh, dim_date, dim_fac, dim_prod, p.now)
    if old_fact is None:
        fact = store.write(fact, "fact_orders", (lambda rows: _check_fact(rows, dims)) if p.gates else None)
    else:
        fact = stored_copy(fact, "fact-checked")
        if p.gates:
            _check_fact(fact, dims)
        fact = store.write(upsert(old_fact.select(*fact.columns), fact, "order_line_key"), "fact_orders")
    return Warehouse(stg_fac, stg_prod, stg_order, dim_date, dim_fac, dim_prod, fact, p)


def new_lines(staged: DataFrame, known: DataFrame) -> DataFrame:
    """Staged lines beyond those already known, as a multiset over ``LINE_IDENTITY``.

    Both are counted in one grouping (staged lines up, known ones down): of
    ``n`` equal staged lines and ``k`` known ones, ``n - k`` are new.  The known
    lines are dealt by the order, as the join with the headers deals the staged
    ones, so a union of the two is grouped where it lies.
    """
    others = [f for f in staged.schema.fields if f.name not in LINE_IDENTITY]
    up = staged.withColumn("_sm_new", F.lit(1))
    down = known.select(*LINE_IDENTITY).repartition(LINE_IDENTITY[0])
    down = down.select(*LINE_IDENTITY, *[F.lit(None).cast(f.dataType).alias(f.name) for f in others], F.lit(-1).alias("_sm_new"))
    rest = up.unionByName(down).groupBy(*LINE_IDENTITY).agg(F.sum("_sm_new").alias("_sm_new"), *[F.min(f.name).alias(f.name) for f in others])
    copies = F.explode(F.sequence(F.lit(1), F.col("_sm_new").cast("int")))
    return rest.where("_sm_new > 0").withColumn("_sm_i", copies).select(*staged.columns)
