"""Change scenarios derived from the driver's tables.

The test data is one static snapshot, so "what the warehouse held before" and
"what changed since" are derived by rules on data attributes (segment,
category, product-name words, quantity).  Every customer and part takes part in
the merge scenarios; members that were never loaded exist only in the
scenarios about unknown members and foreign keys.  The same rules are written
in SQL in ``sparkmart.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.predicates import ts_literal
from sparkmart.operators import calendar, facts, scd, staging
from sparkmart.plans.build import BuildParams, Warehouse, run_build, run_load
from sparkmart.session import scratch_path, stored_copy
from sparkmart.sources.bindings import Sources

# Scenario clock and rules.
NOW = dt.datetime(2002, 1, 1)  # load time of the current run
EARLIER = dt.datetime(2000, 1, 1)  # load time of the previous run
AS_OF = dt.date(1998, 7, 1)  # business date of the Type-2 change
SCD2_START = dt.date(1990, 1, 1)  # first-version start that precedes all orders
CLOSED_END = dt.date(1997, 1, 1)  # end of the history rows that have no current row
SYNCED_UNTIL = dt.date(2000, 1, 1)  # the target copy holds orders before this date
CORRECTED_MIN_QTY = 45  # lines with at least this quantity were corrected later

# Type 1 (facilities, by market segment):
FAC_NEW_SEGMENT = "HOUSEHOLD"  # not yet in the dimension: inserted
FAC_ABSENT_SEGMENT = "MACHINERY"  # missing from the new staging: untouched
FAC_NEVER_SEGMENT = "FURNITURE"  # never loaded: lines fall back to -1
FAC_RENAMED_TYPE = "BUILDING"  # renamed 'Renamed <name>'
FAC_NO_COUNTRY_REGION = "AFRICA"  # country and region become NULL (G7)

# Type 2 (products, by category and by the last word of the name):
PROD_NEW_CATEGORY = "PROMO"  # brand-new products (start = SCD2_START)
PROD_CLOSED_CATEGORY = "LARGE"  # history only, no current row (re-opened, G5)
PROD_ABSENT_CATEGORY = "SMALL"  # missing from the new staging: untouched
PROD_NEVER_CATEGORY = "MEDIUM"  # never loaded: lines fall back to -1
PROD_REPRICED_SUFFIX = " bolt"  # price × 1.2
PROD_RENAMED_SUFFIX = " ring"  # renamed, price unchanged (ignored, G4)
PROD_NULL_PRICE_SUFFIX = " rod"  # staging price NULL (never a change)
PROD_REPRICE_FACTOR = "1.2"


def _ts(value: dt.datetime):
    return ts_literal(value)


@dataclass
class Scenarios:
    """Lazily built scenario frames over one ``Sources``.

    The tables at rest (the warehouse, the source fact and the target copy of a
    sync) are written once in the shared folder, as the stored tables they
    model; queries read the files.
    """

    src: Sources

    @property
    def spark(self):
        return self.src.spark

    # --- canonical warehouse (the reference's script on the test data) ------
    @cached_property
    def params(self) -> BuildParams:
        # A few hundred rows a day don't fill a file: the fact is sorted by day here, not split by it.
        return BuildParams(now=NOW, as_of=AS_OF, fact_partition=None)

    @cached_property
    def root(self) -> str:
        return scratch_path(self.spark, "warehouse")

    @cached_property
    def warehouse(self) -> Warehouse:
        """D6, stored; the reports, the syncs and the scenario facts read it."""
        return run_build(self.src, self.params, out_dir=self.root)

    @cached_property
    def first_load_fact(self) -> DataFrame:
        """D4 against the dimensions of the first load (no staging edits)."""
        wh, spark = self.warehouse, self.spark
        fac = scd.scd1_merge(scd.empty_dim_facility(spark, NOW), self.staging_facility, NOW)
        prod = scd.scd2_merge(scd.empty_dim_product(spark, NOW), self.staging_product, AS_OF, NOW, calendar.first_day(wh.dim_date))
        return facts.load_fact(wh.staging_order, wh.dim_date, fac, prod, NOW)

    @cached_property
    def second_load(self) -> Warehouse:
        """A first load of the orders before SYNCED_UNTIL, then a load of all of them with edited staging."""
        root = scratch_path(self.spark, "loads")
        run_load(self.src.until(SYNCED_UNTIL), self.params, root)
        return run_load(self.src, self.params, root, apply_edits=True)

    # --- staging -------------------------------------------------------------
    @cached_property
    def staging_facility(self) -> DataFrame:
        return staging.extract_facility(self.src.facility, self.src.country, self.src.region, NOW)

    @cached_property
    def staging_product(self) -> DataFrame:
        return staging.extract_product(self.src.product, self.src.category, NOW)

    def staging_order(self, keyed: bool) -> DataFrame:
        if keyed:
            return self.warehouse.staging_order
        return staging.extract_order(self.src.order_line_unkeyed, self.src.purchase_order, NOW)

    # --- Type 1 ---------------------------------------------------------------
    @cached_property
    def scd1_dim_before(self) -> DataFrame:
        stg = self.staging_facility.where(F.col("facility_type") != FAC_NEW_SEGMENT)
        dim = stg.select(
            (F.col("facility_id") + 1).alias("facility_key"),  # keys of the earlier load
            F.col("facility_id").alias("facility_id_source"),
            *scd.FACILITY_ATTRS,
            _ts(EARLIER).alias("last_updated"),
        )
        return dim.unionByName(scd.unknown_facility(self.spark, EARLIER))

    @property
    def scd1_staging(self) -> DataFrame:
        return self.edited_facility.where(F.col("facility_type") != FAC_ABSENT_SEGMENT)

    @cached_property
    def edited_facility(self) -> DataFrame:
        stg = self.staging_facility
        africa = F.col("region_name") == FAC_NO_COUNTRY_REGION
        return stg.select(
            "facility_id",
            F.when(F.col("facility_type") == FAC_RENAMED_TYPE, F.concat(F.lit("Renamed "), F.col("facility_name")))
            .otherwise(F.col("facility_name"))
            .alias("facility_name"),
            "facility_type",
            F.when(africa, F.lit(None).cast("string")).otherwise(F.col("country_name")).alias("country_name"),
            F.when(africa, F.lit(None).cast("string")).otherwise(F.col("region_name")).alias("region_name"),
            "source_load_date",
        )

    @cached_property
    def scd1_result(self) -> DataFrame:
        return scd.scd1_merge(self.scd1_dim_before, self.scd1_staging, NOW)

    # --- Type 2 ---------------------------------------------------------------
    @cached_property
    def scd2_dim_before(self) -> DataFrame:
        stg = self.staging_product.where(F.col("category_name") != PROD_NEW_CATEGORY)
        closed = F.col("category_name") == PROD_CLOSED_CATEGORY
        dim = stg.select(
            (F.col("product_id") + 1).alias("product_key"),  # keys of the earlier load
            F.col("product_id").alias("product_id_source"),
            *scd.PRODUCT_ATTRS,
            F.lit(SCD2_START).alias("row_start_date"),
            F.when(closed, F.lit(CLOSED_END)).otherwise(F.lit(None).cast("date")).alias("row_end_date"),
            (~closed).alias("is_current"),
            _ts(EARLIER).alias("last_updated"),
        )
        return dim.unionByName(scd.unknown_product(self.spark, EARLIER))

    @cached_property
    def scd2_staging(self) -> DataFrame:
        stg = self.staging_product.where(F.col("category_name") != PROD_ABSENT_CATEGORY)
        name = F.col("product_name")
        price = F.col("unit_price")
        new_price = (
            F.when(name.endswith(PROD_REPRICED_SUFFIX), (price * F.lit(PROD_REPRICE_FACTOR).cast("decimal(10,4)")).cast("decimal(10,2)"))
            .when(name.endswith(PROD_NULL_PRICE_SUFFIX), F.lit(None).cast("decimal(10,2)"))
            .otherwise(price)
        )
        new_name = F.when(name.endswith(PROD_RENAMED_SUFFIX), F.concat(name, F.lit(" v2"))).otherwise(name)
        return stg.select(
            "product_id",
            new_name.alias("product_name"),
            "category_name",
            new_price.alias("unit_price"),
            "is_active",
            "source_load_date",
        )

    @cached_property
    def scd2_result(self) -> DataFrame:
        return scd.scd2_merge(self.scd2_dim_before, self.scd2_staging, AS_OF, NOW, SCD2_START)

    # --- fact against the scenario dimensions (unknown members) -------------
    @cached_property
    def loaded_facility(self) -> DataFrame:
        """The facility dimension without the segment that was never loaded."""
        return self.scd1_result.where(F.col("facility_type") != FAC_NEVER_SEGMENT)

    @cached_property
    def loaded_product(self) -> DataFrame:
        """The product dimension without the category that was never loaded."""
        return self.scd2_result.where(~F.col("category_name").eqNullSafe(PROD_NEVER_CATEGORY))

    def scenario_fact(self, stamp=None) -> DataFrame:
        return facts.load_fact(
            self.staging_order(keyed=True), self.warehouse.dim_date, self.loaded_facility, self.loaded_product,
            NOW if stamp is None else stamp,
        )

    # --- incremental sync -------------------------------------------------
    @cached_property
    def sync_source_fact(self) -> DataFrame:
        """Source fact: lines stamped on their order date, corrected lines later."""
        stamp = F.when(F.col("quantity") >= CORRECTED_MIN_QTY, _ts(NOW)).otherwise(
            F.col("order_date").cast("timestamp_ntz")
        )
        return stored_copy(self.scenario_fact(stamp=stamp), "sync-source")

    @cached_property
    def sync_target_fact(self) -> DataFrame:
        """Target copy: synced up to SYNCED_UNTIL, corrected lines still stale."""
        stg = self.staging_order(keyed=True).where(F.col("order_date") < F.lit(SYNCED_UNTIL))
        stale = stg.withColumn(
            "quantity",
            F.when(F.col("quantity") >= CORRECTED_MIN_QTY, F.col("quantity") - 1).otherwise(F.col("quantity")),
        )
        fact = facts.load_fact(
            stale, self.warehouse.dim_date, self.loaded_facility, self.loaded_product, F.col("order_date").cast("timestamp_ntz")
        )
        return stored_copy(fact, "sync-target")

    @cached_property
    def sync_sources(self) -> dict[str, DataFrame]:
        return {
            "dim_date": self.warehouse.dim_date,
            "dim_facility": self.scd1_result,
            "dim_product": self.scd2_result,
            "fact_orders": self.sync_source_fact,
        }

    @cached_property
    def sync_targets(self) -> dict[str, DataFrame]:
        return {
            "dim_date": self.warehouse.dim_date.withColumn("last_updated", _ts(EARLIER)),
            "dim_facility": self.scd1_dim_before,
            "dim_product": self.scd2_dim_before,
            "fact_orders": self.sync_target_fact,
        }
