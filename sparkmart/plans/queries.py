"""Query registry: one entry per operator of the inventory, keyed ``q_*``.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables.  What runs before the caller's action: the tables at rest
(warehouse, merged dimensions, deltas) are written once per session in the
shared folder, dimension sizes are counted for the broadcast check, and
watermarks are read as one scalar.
Column names equal those of the SQL in ``sparkmart.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.operators import calendar, facts, quality, staging, sync, verify
from sparkmart.operators.asof import lookup_key_asof_merge
from sparkmart.operators.keys import assign_keys
from sparkmart.plans import dashboard, views
from sparkmart.plans.build import run_build
from sparkmart.plans.maintained import SalesState
from sparkmart.plans.scenarios import NOW, Scenarios
from sparkmart.session import CODEC, scratch_path, stored_copy
from sparkmart.sources.bindings import LINE_ORDER, Sources
from sparkmart.sources.delta_log import Commit, DeltaLog
from sparkmart.sources.incremental import read_since, watermark, watermark_col
from sparkmart.sources.sinks import read_snapshot, read_stored, versions, write_snapshot
from sparkmart.sources.tables import register_warehouse_views
from sparkmart.streaming.log_stream import start_log_stream

QueryFn = Callable[[SparkSession, str], DataFrame]

_CACHE: dict[str, tuple[object, SparkSession, Scenarios]] = {}


def scenarios(spark: SparkSession, sf_dir: str) -> Scenarios:
    """One lazily built scenario set per data directory and live session.

    An entry is reused only by the same session on the same SparkContext; a
    stopped and re-created session gets fresh frames (cached frames hold
    checkpointed data of their own context).
    """
    hit = _CACHE.get(sf_dir)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect has no driver-side context; the session identifies it
        sc = spark
    if hit is None or hit[0] is not sc or hit[1] is not spark:
        hit = (sc, spark, Scenarios(Sources(spark, sf_dir)))
        _CACHE[sf_dir] = hit
    return hit[2]


def _star(spark: SparkSession, sf_dir: str, *dims: str) -> DataFrame:
    wh = scenarios(spark, sf_dir).warehouse
    sides = {"date": wh.dim_date, "facility": wh.dim_facility, "product": wh.dim_product}
    return dashboard.sales_star(wh.fact_orders, **{d: sides[d] for d in dims})


# --- S2 / S3 / A5 / I1 / I2 -------------------------------------------------------
# Fixed value: calendar days per stored partition in q_sync_stored.
DAYS_PER_BLOCK = 31


def q_sync_stored(spark, sf_dir):
    """I1 on a stored target partitioned by blocks of days: only touched partitions are rewritten."""
    sc = scenarios(spark, sf_dir)
    block = F.floor(F.col("date_key") / DAYS_PER_BLOCK).cast("long")
    root, source = scratch_path(spark, "sync-target"), sc.sync_source_fact.withColumn("date_block", block)
    path = write_snapshot(sc.sync_targets["fact_orders"].withColumn("date_block", block), root, "fact_orders", partition_by=["date_block"])
    sync.sync_stored_table(spark, source, path, schemas.FACT_ORDERS_SPEC, "date_block")
    return read_stored(spark, path, sc.sync_source_fact)


def q_snapshot_rebuild(spark, sf_dir):
    """The warehouse rebuilt into the same folder; both versions of every table are kept."""
    sc = scenarios(spark, sf_dir)
    root, parts = scratch_path(spark, "rebuild"), []
    for _ in range(2):
        built = run_build(sc.src, sc.params, keyed_lines=False, out_dir=root)
    for name in built.tables():
        for version in sorted(versions(spark, root, name)):
            rows = read_snapshot(spark, root, name, version).agg(F.count(F.lit(1)).alias("row_count"))
            parts.append(rows.select(F.lit(name).alias("table_name"), F.lit(version).alias("version"), "row_count"))
    return reduce(DataFrame.unionByName, parts)


def q_incremental_scan(spark, sf_dir):
    sc = scenarios(spark, sf_dir)
    wm = watermark(sc.sync_targets["fact_orders"], "last_updated")
    return read_since(sc.sync_source_fact, "last_updated", wm)


def q_upsert_fact(spark, sf_dir):
    sc = scenarios(spark, sf_dir)
    return sync.sync_table(sc.sync_source_fact, sc.sync_targets["fact_orders"], schemas.FACT_ORDERS_SPEC).target


def _synced_log(sc, spark):
    """A log with the old targets, then the sync of all tables; (log, first commit, second)."""
    log = DeltaLog(spark, scratch_path(spark, "log"))
    first = log.append(sc.sync_targets)
    return log, first, log.sync(sc.sync_sources)[0]


def q_log_fact(spark, sf_dir):
    """S3/I1 as merge-on-read: the sync writes only its delta, reading merges."""
    log, _, _ = _synced_log(scenarios(spark, sf_dir), spark)
    return log.read("fact_orders")


def q_log_compacted(spark, sf_dir):
    """The delta in five loads, then runs of one tier merged."""
    sc = scenarios(spark, sf_dir)
    log = DeltaLog(spark, scratch_path(spark, "log"))
    log.append({"fact_orders": sc.sync_target_fact})
    delta = read_since(sc.sync_source_fact, "last_updated", log.watermark("fact_orders"))
    for k in range(5):
        log.append({"fact_orders": delta.where(F.pmod(F.xxhash64("order_line_key"), F.lit(5)) == k)})
    log.compact("fact_orders")
    return log.read("fact_orders")


def q_log_stream(spark, sf_dir):
    """I1 as a stream with keyed state into the log: the whole source arrives in two parts, only changes are written."""
    sc = scenarios(spark, sf_dir)
    log, feed = DeltaLog(spark, scratch_path(spark, "log")), scratch_path(spark, "stream-source")
    log.append({"fact_orders": sc.sync_target_fact})
    checkpoint = scratch_path(spark, "stream-state")
    for part in (0, 1):
        sc.sync_source_fact.where(F.pmod(F.xxhash64("order_line_key"), F.lit(2)) == part).write.mode("append").option("compression", CODEC).parquet(feed)
        start_log_stream(spark, feed, log, "fact_orders", checkpoint).awaitTermination()
    return log.read("fact_orders")


def q_sql_views(spark, sf_dir):
    """``spark.sql`` over the registered warehouse tables and views, revenue of a month and a category beside their views."""
    register_warehouse_views(spark, scenarios(spark, sf_dir).warehouse)
    return spark.sql(SQL_VIEWS)


# The statement of q_sql_views.
SQL_VIEWS = """
SELECT d.year, d.month, p.category_name, m.revenue AS month_revenue, r.n_products, r.best_rank,
       CAST(SUM(f.line_total) AS DECIMAL(22,2)) AS revenue, CAST(COUNT(*) AS BIGINT) AS line_count
FROM fact_orders f
JOIN dim_date d ON f.date_key = d.date_key
JOIN dim_product p ON f.product_key = p.product_key
JOIN dim_facility c ON f.facility_key = c.facility_key
JOIN vw_monthly_revenue m ON m.year = d.year AND m.month = d.month
JOIN (SELECT category_name, CAST(COUNT(*) AS BIGINT) AS n_products, CAST(MIN(revenue_rank) AS BIGINT) AS best_rank
      FROM vw_product_revenue_rank GROUP BY category_name) r ON r.category_name = p.category_name
GROUP BY d.year, d.month, p.category_name, m.revenue, r.n_products, r.best_rank
"""


def q_log_commit(spark, sf_dir):
    """One commit for all tables: rows of each table as of the second commit."""
    log, _, second = _synced_log(scenarios(spark, sf_dir), spark)
    counts = [log.read(t, second).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count") for t in log.specs]
    return reduce(DataFrame.unionByName, counts)


def _maintained(spark, sf_dir):
    log, first, second = _synced_log(scenarios(spark, sf_dir), spark)
    state = SalesState(spark, scratch_path(spark, "state"))
    state.refresh(log, Commit(), first)
    state.refresh(log, first, second)
    return state


def q_maintained_monthly_revenue(spark, sf_dir):
    """V1 after two loads, from sums kept up by signed changes."""
    return _maintained(spark, sf_dir).monthly_revenue()


def q_maintained_product_rank(spark, sf_dir):
    """V2 after two loads, from sums kept up by signed changes."""
    return _maintained(spark, sf_dir).product_revenue_rank()


def q_merged_order_counts(spark, sf_dir):
    """A3 by merged bitmaps: distinct orders per quarter after two loads."""
    quarter = F.ceil(F.col("month") / 3).cast("int").alias("quarter")
    return _maintained(spark, sf_dir).distinct_orders(F.col("year"), quarter)


def q_upsert_facility(spark, sf_dir):
    sc = scenarios(spark, sf_dir)
    return sync.sync_table(sc.scd1_result, sc.scd1_dim_before, schemas.DIM_FACILITY_SPEC).target


def q_watermarks(spark, sf_dir):
    sc = scenarios(spark, sf_dir)
    parts = []
    for spec in schemas.WAREHOUSE_SPECS:
        key_col = spec.key[0] if spec.unknown_key is not None else None
        parts.append(
            watermark_col(sc.sync_targets[spec.name], spec.ts_col, key_col).select(
                F.lit(spec.name).alias("table_name"), "watermark"
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_sync_report(spark, sf_dir):
    sc = scenarios(spark, sf_dir)
    results = [
        sync.sync_table(sc.sync_sources[spec.name], sc.sync_targets[spec.name], spec)
        for spec in schemas.WAREHOUSE_SPECS
    ]
    return sync.sync_report(spark, results)


def _drifted(sc):
    """(sources, targets) after a sync; the target's fact then drifted without a new stamp.

    Lines of 7 units sold on the first of a month have one unit more, lines of
    11 units sold on the second are gone.
    """
    sources = sc.sync_sources  # stored tables all of them
    targets = {spec.name: sync.sync_table(sources[spec.name], sc.sync_targets[spec.name], spec).target for spec in schemas.WAREHOUSE_SPECS}
    day, units = F.col("date_key") % 100, F.col("quantity")
    fact = targets["fact_orders"].where(~((day == 2) & (units == 11)))
    targets["fact_orders"] = fact.withColumn("quantity", F.when((day == 1) & (units == 7), units + 1).otherwise(units))
    return sources, {t: stored_copy(df, f"verify-target-{t}") for t, df in targets.items()}


def q_verify_rows(spark, sf_dir):
    """The lines in which a synced copy differs, found by digests of key ranges."""
    sources, targets = _drifted(scenarios(spark, sf_dir))
    return verify.differing_rows(sources["fact_orders"], targets["fact_orders"], "order_line_key")


def q_verify_report(spark, sf_dir):
    """Per table, the rows that are missing, too many or changed in the copy."""
    return verify.verify_all(*_drifted(scenarios(spark, sf_dir)))


# --- E1–E4 -----------------------------------------------------------------------
def q_extract_facility(spark, sf_dir):
    return scenarios(spark, sf_dir).staging_facility


def q_extract_product(spark, sf_dir):
    return scenarios(spark, sf_dir).staging_product


def q_extract_order(spark, sf_dir):
    return scenarios(spark, sf_dir).staging_order(keyed=True)


def q_staging_price_update(spark, sf_dir):
    sc = scenarios(spark, sf_dir)
    return staging.reprice(sc.staging_product, sc.params.repriced_products)


# --- K1 / D3 / D1 / D2 / D5 / J5 / D4 / D6 -------------------------------------------
def q_surrogate_keys(spark, sf_dir):
    src = scenarios(spark, sf_dir).src
    keyed = assign_keys(src.raw("lineitem"), LINE_ORDER, "order_line_id")
    return keyed.select(
        "order_line_id",
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("long").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
    )


def q_dim_date(spark, sf_dir):
    src = scenarios(spark, sf_dir).src
    return calendar.dim_date_for(src.purchase_order, "order_date", 7, NOW)


# The years of the surveyed form of the calendar.
CALENDAR_YEARS = (1996, 1999)


def q_calendar_years(spark, sf_dir):
    """D3 for fixed years, with the orders of each day (days without orders too)."""
    orders = scenarios(spark, sf_dir).src.purchase_order.groupBy("order_date").agg(F.count(F.lit(1)).alias("n_orders"))
    days = calendar.build_dim_date(spark, *CALENDAR_YEARS, 7, NOW)
    joined = days.join(orders, F.col("full_date") == F.col("order_date"), "left").drop("order_date")
    return joined.withColumn("n_orders", F.coalesce("n_orders", F.lit(0)))


def q_scd1_facility(spark, sf_dir):
    return scenarios(spark, sf_dir).scd1_result


def q_scd2_product(spark, sf_dir):
    return scenarios(spark, sf_dir).scd2_result


def q_asof_product_join(spark, sf_dir):
    sc = scenarios(spark, sf_dir)
    lines = sc.staging_order(keyed=False).select("order_id", "order_date", "product_id", "quantity", "line_total")
    return facts.lookup_key_asof(lines, sc.loaded_product, "product_id", "order_date")


def q_asof_merge_join(spark, sf_dir):
    """J5 as a merge by ranges of (product, date), for a dimension that is not broadcast."""
    sc = scenarios(spark, sf_dir)
    lines = sc.staging_order(keyed=False).select("order_id", "order_date", "product_id", "quantity", "line_total")
    return lookup_key_asof_merge(lines, sc.loaded_product, "product_id", "order_date")


def q_fact_unknown_members(spark, sf_dir):
    return scenarios(spark, sf_dir).scenario_fact()


def q_fact_load(spark, sf_dir):
    return scenarios(spark, sf_dir).first_load_fact


def q_second_load(spark, sf_dir):
    """A second load over stored tables: kept history, kept keys, new lines keyed from the largest on."""
    return scenarios(spark, sf_dir).second_load.fact_orders


def q_second_load_product(spark, sf_dir):
    """The Type-2 dimension after the second load (both versions of repriced products)."""
    return scenarios(spark, sf_dir).second_load.dim_product


def q_pipeline(spark, sf_dir):
    return scenarios(spark, sf_dir).warehouse.fact_orders


# --- V1 / V2 / W3 ----------------------------------------------------------------
def q_monthly_revenue(spark, sf_dir):
    wh = scenarios(spark, sf_dir).warehouse
    return views.monthly_revenue(wh.fact_orders, wh.dim_date)


def q_product_revenue_rank(spark, sf_dir):
    wh = scenarios(spark, sf_dir).warehouse
    return views.product_revenue_rank(wh.fact_orders, wh.dim_product, "rank")


def q_product_revenue_dense_rank(spark, sf_dir):
    wh = scenarios(spark, sf_dir).warehouse
    return views.product_revenue_rank(wh.fact_orders, wh.dim_product, "dense")


def q_monthly_report(spark, sf_dir):
    wh = scenarios(spark, sf_dir).warehouse
    return views.monthly_report(wh.fact_orders, wh.dim_date)


def q_rank_report(spark, sf_dir):
    wh = scenarios(spark, sf_dir).warehouse
    return views.rank_report(wh.fact_orders, wh.dim_product)


# --- B0–B6 / A6 / U1 ------------------------------------------------------------
# The slicer selection exercised by q_slicer_sales.
SLICER_FROM, SLICER_TO, SLICER_REGIONS = "1997-01-01", "1998-12-31", ("ASIA", "EUROPE")


def q_slicer_sales(spark, sf_dir):
    import datetime as dt

    sliced = dashboard.apply_slicers(
        _star(spark, sf_dir, "date", "facility"),
        date_from=dt.date.fromisoformat(SLICER_FROM),
        date_to=dt.date.fromisoformat(SLICER_TO),
        regions=SLICER_REGIONS,
    )
    return dashboard.sales_by_country(sliced)


# The facilities and countries chosen in q_slicer_facility.
SLICER_FACILITIES = ("Customer#000000001", "Customer#000000002", "Customer#000000007", "Customer#000000011", "Customer#000000013")
SLICER_COUNTRIES = ("NATION_1", "NATION_4", "NATION_8", "NATION_12", "NATION_24")


def q_slicer_facility(spark, sf_dir):
    """The facility and the country slicer, revenue by product category."""
    star = _star(spark, sf_dir, "facility", "product")
    by_country = dashboard.revenue_by_category(dashboard.apply_slicers(star, countries=SLICER_COUNTRIES)).withColumn("slicer", F.lit("country"))
    by_name = dashboard.revenue_by_category(dashboard.apply_slicers(star, facilities=SLICER_FACILITIES)).withColumn("slicer", F.lit("facility"))
    return by_country.unionByName(by_name)


def q_kpi_cards(spark, sf_dir):
    return dashboard.kpi_cards(_star(spark, sf_dir))


def q_revenue_daily(spark, sf_dir):
    return dashboard.revenue_over_time(_star(spark, sf_dir, "date"), "day")


def q_sales_by_country(spark, sf_dir):
    return dashboard.sales_by_country(_star(spark, sf_dir, "facility"))


def q_revenue_by_category(spark, sf_dir):
    return dashboard.revenue_by_category(_star(spark, sf_dir, "product"))


def q_top_products(spark, sf_dir):
    return dashboard.top_products(_star(spark, sf_dir, "product"), 5)


def q_units_vs_price(spark, sf_dir):
    return dashboard.units_vs_price(_star(spark, sf_dir, "product"))


def q_row_counts(spark, sf_dir):
    src = scenarios(spark, sf_dir).src
    return dashboard.row_counts(
        {
            "region": src.region,
            "country": src.country,
            "product_category": src.category,
            "product": src.product,
            "facility": src.facility,
            "purchase_order": src.purchase_order,
            "order_line": src.raw("lineitem"),
        }
    )


# --- Q1–Q4 -----------------------------------------------------------------------
def q_dq_not_null(spark, sf_dir):
    stg = scenarios(spark, sf_dir).edited_facility
    return quality.check_not_null(stg, ["facility_id", "facility_name", "facility_type", "country_name", "region_name"])


def q_dq_unique(spark, sf_dir):
    lines = scenarios(spark, sf_dir).src.order_line_unkeyed
    return quality.check_unique(lines, ["order_id", "line_number"])


def q_dq_foreign_key(spark, sf_dir):
    sc = scenarios(spark, sf_dir)
    lines = sc.staging_order(keyed=False).select("order_id", "order_date", "facility_id", "product_id", "line_total")
    return quality.check_foreign_key(lines, sc.loaded_facility, "facility_id", "facility_id_source")


def q_dq_domain(spark, sf_dir):
    sc = scenarios(spark, sf_dir)
    fac = quality.domain_report(sc.staging_facility, "raw_facility", schemas.DIM_FACILITY_SPEC.lengths)
    prod = quality.domain_report(
        sc.staging_product, "raw_product", schemas.DIM_PRODUCT_SPEC.lengths, schemas.DIM_PRODUCT_SPEC.decimals
    )
    lines = sc.src.raw("lineitem").select(F.col("l_extendedprice").alias("line_total"))
    order = quality.domain_report(lines, "raw_order", {}, {"line_total": (12, 2)})
    return fac.unionByName(prod).unionByName(order)


QUERIES: dict[str, QueryFn] = {
    name: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
