"""D1 Type-1 merge, D2 Type-2 merge, D5 unknown members.

Both merges shuffle on the natural key only:

* Type 1 is a full outer join of the dimension with staging (the classic
  MERGE): matched rows take every staging attribute (NULLs included),
  dimension-only rows pass through, staging-only rows are new members.
* Type 2 joins every version to its product's staging row (expiry is a
  per-row expression), counts the current versions left per product with a
  grouped aggregate, and joins that back to staging to find the products that
  need a new version or are brand new — the reference's three sequential
  steps, with every operator splitting a hot product across tasks.

New members get dense keys after the current maximum (K1).  Rows that really
change — and only those — get ``last_updated = now`` so the incremental sync
picks them up.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.functions.joins import broadcast_if_small
from sparkmart.functions.predicates import UNKNOWN_KEY, changed, differs, ts_literal
from sparkmart.operators.keys import assign_keys, next_key
from sparkmart.session import stored_copy
from sparkmart.sources.sinks import assert_unique

FACILITY_ATTRS = ("facility_name", "facility_type", "country_name", "region_name")
PRODUCT_ATTRS = ("product_name", "category_name", "unit_price", "is_active")

# The unknown members and the Type-2 default start date.
UNKNOWN_FACILITY = (UNKNOWN_KEY, UNKNOWN_KEY, "Unknown Facility", "Unknown", None, None)
UNKNOWN_PRODUCT = (UNKNOWN_KEY, UNKNOWN_KEY, "Unknown Product", None, "0.00", True, dt.date(2000, 1, 1), None, True)
DEFAULT_ROW_START = dt.date(2000, 1, 1)


# --- D5 ---------------------------------------------------------------------
def unknown_facility(spark: SparkSession, now: dt.datetime | None = None) -> DataFrame:
    key, src, name, ftype, country, region = UNKNOWN_FACILITY
    return spark.range(1).select(
        F.lit(key).cast("long").alias("facility_key"),
        F.lit(src).cast("long").alias("facility_id_source"),
        F.lit(name).alias("facility_name"),
        F.lit(ftype).alias("facility_type"),
        F.lit(country).cast("string").alias("country_name"),
        F.lit(region).cast("string").alias("region_name"),
        (ts_literal(now) if now else F.lit(None).cast("timestamp_ntz")).alias("last_updated"),
    )


def unknown_product(spark: SparkSession, now: dt.datetime | None = None) -> DataFrame:
    key, src, name, cat, price, active, start, end, current = UNKNOWN_PRODUCT
    return spark.range(1).select(
        F.lit(key).cast("long").alias("product_key"),
        F.lit(src).cast("long").alias("product_id_source"),
        F.lit(name).alias("product_name"),
        F.lit(cat).cast("string").alias("category_name"),
        F.lit(price).cast("decimal(10,2)").alias("unit_price"),
        F.lit(active).alias("is_active"),
        F.lit(start).alias("row_start_date"),
        F.lit(end).cast("date").alias("row_end_date"),
        F.lit(current).alias("is_current"),
        (ts_literal(now) if now else F.lit(None).cast("timestamp_ntz")).alias("last_updated"),
    )


def with_unknown_member(dim: DataFrame, member: DataFrame, key_col: str) -> DataFrame:
    """Make sure the dimension holds the key -1 row (added once)."""
    return dim.where(F.col(key_col) != UNKNOWN_KEY).unionByName(member.select(*dim.columns))


def empty_dim_facility(spark: SparkSession, now: dt.datetime | None = None) -> DataFrame:
    """A freshly reset facility dimension: only the unknown member."""
    return unknown_facility(spark, now)


def empty_dim_product(spark: SparkSession, now: dt.datetime | None = None) -> DataFrame:
    """A freshly reset product dimension: only the unknown member."""
    return unknown_product(spark, now)


def _with_ids(staging: DataFrame, staging_key: str, attrs: Sequence[str], what: str) -> DataFrame:
    """Staging keyed by ``_sm_nk`` with its attributes as ``_sm_s_*``; a NULL id raises."""
    missing = F.raise_error(F.lit(f"{what} staging row without an id"))
    return staging.select(
        F.when(F.col(staging_key).isNull(), missing).otherwise(F.col(staging_key)).cast("long").alias("_sm_nk"),
        *[F.col(a).alias(f"_sm_s_{a}") for a in attrs],
    )


# --- D1 -----------------------------------------------------------------------
def scd1_merge(
    dim: DataFrame,
    staging: DataFrame,
    now: dt.datetime,
    natural_key: str = "facility_id_source",
    staging_key: str = "facility_id",
    surrogate_key: str = "facility_key",
    attrs: Sequence[str] = FACILITY_ATTRS,
    materialize: bool = True,
) -> DataFrame:
    """Type-1 (overwrite) merge of ``staging`` into ``dim``.

    * id in both: every attribute is taken from staging, NULLs included (G7);
      ``last_updated`` moves to ``now`` only if some attribute differs.
    * id only in the dimension: untouched (nothing is ever deleted, G6).
    * id only in staging: inserted with the next surrogate key.

    A NULL id in staging is an error: it would match nothing and be inserted
    again on every run.
    """
    stamp = ts_literal(now)
    # One staging row per id.
    s = assert_unique(_with_ids(staging, staging_key, attrs, "Type-1"), ["_sm_nk"], "Type-1 staging")
    joined = dim.join(s, F.col(natural_key) == F.col("_sm_nk"), "full_outer")
    if materialize:  # both halves below read it
        joined = stored_copy(joined, "type1-join")
    in_dim = F.col(surrogate_key).isNotNull()
    in_stg = F.col("_sm_nk").isNotNull()

    any_diff = None
    for a in attrs:
        diff = differs(a, f"_sm_s_{a}")
        any_diff = diff if any_diff is None else any_diff | diff

    kept = joined.where(in_dim).select(
        surrogate_key,
        natural_key,
        *[F.when(in_stg, F.col(f"_sm_s_{a}")).otherwise(F.col(a)).alias(a) for a in attrs],
        F.when(in_stg & any_diff, stamp).otherwise(F.col("last_updated")).alias("last_updated"),
    )
    fresh = joined.where(~in_dim).select(
        F.col("_sm_nk").alias(natural_key),
        *[F.col(f"_sm_s_{a}").alias(a) for a in attrs],
        stamp.alias("last_updated"),
    )
    keyed = assign_keys(fresh, [natural_key], surrogate_key, start=next_key(dim, surrogate_key))
    return _snapshot(kept.unionByName(keyed.select(*kept.columns)), materialize)


# --- D2 -----------------------------------------------------------------------
def scd2_merge(
    dim: DataFrame,
    staging: DataFrame,
    as_of: dt.date,
    now: dt.datetime,
    initial_start: dt.date | DataFrame = DEFAULT_ROW_START,
    tracked: str = "unit_price",
    natural_key: str = "product_id_source",
    staging_key: str = "product_id",
    surrogate_key: str = "product_key",
    attrs: Sequence[str] = PRODUCT_ATTRS,
    materialize: bool = True,
) -> DataFrame:
    """Type-2 merge tracking one column (price by default).

    Same outcome as the reference's three steps run in order:

    1. a current version whose tracked value differs from staging (NULLs never
       differ) is closed: ``is_current = false``, ``row_end_date = as_of``;
    2. a staging product that has versions but no current one after step 1
       gets a new current version starting ``as_of`` (this also re-opens a
       product whose history has no current row, G5);
    3. a staging product with no version at all starts at ``initial_start``
       (a date, or a one-row frame computed lazily, e.g. the calendar start).

    Other attribute changes on a current row wait for the next price change
    (G4).  A duplicate id in staging raises instead of picking a row (G14).
    New versions are keyed after the current maximum, step-2 rows before
    step-3 rows, each in id order.
    """
    stamp = ts_literal(now)
    nk = F.col(natural_key)
    # Staging keyed by the natural key; a NULL or repeated id is an error.
    stg = assert_unique(_with_ids(staging, staging_key, attrs, "Type-2"), ["_sm_nk"], "Type-2 staging")

    # Step 1: every version meets its product's staging row (left join on the
    # natural key: a product with very many versions is split by AQE's skew
    # handling, the staging side holds one row per key).
    joined = dim.join(stg, nk == F.col("_sm_nk"), "left")
    expire = (
        F.col("_sm_nk").isNotNull()
        & F.coalesce(F.col("is_current"), F.lit(False))
        & changed(tracked, f"_sm_s_{tracked}")
    )
    updates = {
        "is_current": F.when(expire, F.lit(False)).otherwise(F.col("is_current")),
        "row_end_date": F.when(expire, F.lit(as_of)).otherwise(F.col("row_end_date")),
        "last_updated": F.when(expire, stamp).otherwise(F.col("last_updated")),
    }
    versions = joined.select(*[updates.get(c, F.col(c)).alias(c) for c in dim.columns])
    if materialize:  # read by the count of current versions and by the result
        versions = stored_copy(versions, "type2-versions")

    # Per product after step 1: does a current version remain?  A grouped
    # aggregate (partial aggregation first), on the join's partitioning.
    remaining = versions.groupBy(nk.alias("_sm_fk")).agg(
        F.max(F.col("is_current").cast("int")).alias("_sm_cur")
    )
    if materialize:  # no more products than stored versions, whose files look far smaller than they are
        remaining, _ = broadcast_if_small(remaining, rows=versions.count())

    # Steps 2 and 3: staging products with no current version left, or none at all.
    flagged = stg.join(remaining, F.col("_sm_nk") == F.col("_sm_fk"), "left")
    has_dim = F.col("_sm_fk").isNotNull()
    step = F.when(has_dim, F.lit(2)).otherwise(F.lit(3))
    if isinstance(initial_start, DataFrame):  # a lazily derived one-row start date (scalar subquery)
        first_start = initial_start.select(F.col(initial_start.columns[0])).scalar()
    else:
        first_start = F.lit(initial_start)
    new_rows = flagged.where(~has_dim | (F.coalesce(F.col("_sm_cur"), F.lit(0)) == 0)).select(
        F.col("_sm_nk").alias(natural_key),
        *[F.col(f"_sm_s_{a}").alias(a) for a in attrs],
        F.when(has_dim, F.lit(as_of)).otherwise(first_start).cast("date").alias("row_start_date"),
        F.lit(None).cast("date").alias("row_end_date"),
        F.lit(True).alias("is_current"),
        stamp.alias("last_updated"),
        step.alias("_sm_step"),
    )
    keyed = assign_keys(new_rows, ["_sm_step", natural_key], surrogate_key, start=next_key(dim, surrogate_key))
    return _snapshot(versions.unionByName(keyed.select(*dim.columns)), materialize)


def _snapshot(dim: DataFrame, materialize: bool) -> DataFrame:
    """The merged dimension is the new version of a stored table: materialise
    it once so the size checks, the fact lookups, the
    next merge and the reports read it instead of re-running the merge chain,
    and lineage stays short."""
    return stored_copy(dim, "dimension") if materialize else dim
