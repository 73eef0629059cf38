"""V1, V2 and the order counts kept up by change, over the merge-on-read log.

A load of the log changes some fact rows.  Their old and new images, signed
-1 and +1, are summed per month and per product group and appended to the
stored sums; reading the state adds the sums up, so no load rewrites or scans
the fact.  A fact row counts as changed too when its product appeared, vanished
or was renamed (V2 groups by name and category).

Distinct orders (A3) stay exact under changes and deletions of lines: the state
keeps, per group and order, how many lines there are, again as signed
rows.  Only the orders of the load are looked up; an order that goes from none
to some lines adds one to its group, and the reverse takes one away.

Counts that merge: per touched month the orders are stored as bitmaps by
bucket of 32,768 ids.  The distinct orders of any set of months (a quarter, a
year, the card over all) are the bits of the or-ed bitmaps.

A load's state lies in one folder, which counts once its mark is written.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.functions.joins import broadcast_if_small
from sparkmart.functions.predicates import known
from sparkmart.operators.keys import global_rank
from sparkmart.plans.views import star_join
from sparkmart.session import stored_copy
from sparkmart.sources.delta_log import Commit, DeltaLog, key_bitmaps
from sparkmart.sources.sinks import _file_system

MONTH = ("year", "month", "month_name")
PRODUCT = ("product_name", "category_name")
_SUMS = "revenue decimal(38,2), units long, lines long, orders long"
#: Stored tables: the sums, the lines per group and order, and the month bitmaps.
SCHEMAS = {
    "months": f"year int, month int, month_name string, {_SUMS}",
    "products": f"product_name string, category_name string, {_SUMS}",
    "month_orders": "year int, month int, month_name string, order_id long, lines long",
    "product_orders": "product_name string, category_name string, order_id long, lines long",
    "bitmaps": "year int, month int, load long, bucket long, bitmap binary",
}


def _same(names: Sequence[str], other: DataFrame, prefix: str = "__") -> tuple[DataFrame, Column]:
    """``other`` with prefixed names and the null-safe equality of ``names`` with them."""
    renamed = other.select(*[F.col(n).alias(prefix + n) for n in names])
    return renamed, reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(prefix + n)) for n in names])


class SalesState:
    """Stored sums below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def loads(self) -> list[int]:
        fs, place = _file_system(self.spark, self.root)
        if not fs.exists(place):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(place)]
        return sorted(int(n.removeprefix("done-")) for n in names if n.startswith("done-"))

    def read(self, table: str) -> DataFrame:
        paths = [f"{self.root}/load-{n}/{table}" for n in self.loads()]
        if not paths:
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(*paths)

    def _write(self, load: int, table: str, df: DataFrame) -> None:
        df.selectExpr(*[f"cast({c.split()[0]} as {c.split()[1]}) {c.split()[0]}" for c in SCHEMAS[table].split(", ")]).write.parquet(f"{self.root}/load-{load}/{table}")

    # --- folding -----------------------------------------------------------
    def _fold(self, load: int, kind: str, signed: DataFrame, group: Sequence[str]) -> DataFrame:
        """Append the signed sums of one grouping; returns the stored order changes."""
        orders, sums = f"{kind}_orders", f"{kind}s"
        changed = signed.groupBy(*group, "order_id").agg(F.sum("sign").alias("lines")).where("lines <> 0")
        prior = self.read(orders)
        self._write(load, orders, changed)
        changed = self.spark.read.schema(SCHEMAS[orders]).parquet(f"{self.root}/load-{load}/{orders}")
        # Only orders of this load are looked up in the state.
        keys, met = _same([*group, "order_id"], changed)
        keys, _ = broadcast_if_small(keys)
        held = prior.join(keys, met, "left_semi").withColumn("new", F.lit(False))
        both = held.unionByName(changed.withColumn("new", F.lit(True)))
        both = both.groupBy(*group, "order_id").agg(F.sum(F.when(~F.col("new"), F.col("lines")).otherwise(0)).alias("old"), F.sum("lines").alias("now"))
        step = (F.col("now") > 0).cast("long") - (F.col("old") > 0).cast("long")
        zero = F.lit(0).cast("long")
        steps = both.groupBy(*group).agg(F.sum(step).alias("orders")).select(*group, zero.alias("revenue"), zero.alias("units"), zero.alias("lines"), "orders")
        added = signed.groupBy(*group).agg(
            F.sum(F.col("sign") * F.col("line_total")).alias("revenue"),
            F.sum(F.col("sign") * F.col("quantity")).alias("units"),
            F.sum("sign").alias("lines"),
        ).withColumn("orders", zero)
        self._write(load, sums, added.unionByName(steps))
        return changed

    def apply(self, old: DataFrame, new: DataFrame, dims_before: Sequence[DataFrame], dims_after: Sequence[DataFrame]) -> int:
        """Fold the change from ``old`` to ``new`` fact rows; dims: (dim_date, dim_product) of either side."""
        load = max(self.loads(), default=0) + 1
        columns = ["date_key", "product_key", "order_id", "quantity", "line_total"]

        def signed(pick) -> DataFrame:
            sides = []
            for rows, dims, sign in ((old, dims_before, -1), (new, dims_after, 1)):
                rows = rows.select(*columns, F.lit(sign).cast("long").alias("sign"))
                sides.append(pick(rows, dims))
            return sides[0].unionByName(sides[1])

        dates = signed(lambda rows, dims: star_join(rows, dims[0].select("date_key", *MONTH), "date_key"))
        products = signed(lambda rows, dims: star_join(rows, dims[1].where(known("product_key")).select("product_key", *PRODUCT), "product_key"))
        changed = self._fold(load, "month", dates, MONTH)
        self._fold(load, "product", products, PRODUCT)
        # The touched months' orders, those of this load included, as bitmaps.
        months, met = _same(("year", "month"), changed.select("year", "month").distinct())
        rows = self.read("month_orders").unionByName(changed).join(F.broadcast(months), met, "left_semi")
        present = rows.groupBy("year", "month", "order_id").agg(F.sum("lines").alias("lines")).where("lines > 0")
        at = present.selectExpr("year", "month", "bitmap_bucket_number(order_id) as bucket", "bitmap_bit_position(order_id) as position")
        bitmaps = at.groupBy("year", "month", "bucket").agg(F.bitmap_construct_agg("position").alias("bitmap"))
        # A month that lost its last order has one empty bitmap, so that older ones don't count.
        emptied = changed.select("year", "month").distinct().select("year", "month", F.lit(None).cast("long").alias("bucket"), F.lit(None).cast("binary").alias("bitmap"))
        self._write(load, "bitmaps", bitmaps.unionByName(emptied).withColumn("load", F.lit(load)))
        fs, place = _file_system(self.spark, f"{self.root}/done-{load}")
        fs.create(place, False).close()
        return load

    def refresh(self, log: DeltaLog, before: Commit, after: Commit) -> int:
        """Fold what ``after`` changed since ``before``; only changed fact rows enter the sums."""
        fact = log.specs["fact_orders"]
        known_runs = {r.name for r in before.tables.get("fact_orders", [])}
        added = [r for r in after.tables.get("fact_orders", []) if r.name not in known_runs]
        key = fact.key[0]
        dims = [[log.read("dim_date", c), log.read("dim_product", c)] for c in (before, after)]
        a, b = (d[1].select("product_key", F.struct(*PRODUCT).alias(n)) for d, n in zip(dims, ("was", "now"), strict=True))
        moved = stored_copy(a.join(b, "product_key", "full_outer").where(~F.col("was").eqNullSafe(F.col("now"))).select("product_key"), "moved-products")
        others = None
        if before.tables.get("fact_orders") and moved.limit(1).count():
            side, _ = broadcast_if_small(moved)
            others = key_bitmaps(log.read("fact_orders", after).join(side, "product_key", "left_semi"), key)
        # The runs store which keys they hold: no key is shuffled or written again.
        touched = stored_copy(log.held_keys("fact_orders", [r.name for r in added], others), "touched-lines")
        old = log.rows_in("fact_orders", touched, before)
        new = log.rows_in("fact_orders", touched, after)
        return self.apply(old, new, *dims)

    # --- the views ---------------------------------------------------------
    def _sums(self, table: str, group: Sequence[str]) -> DataFrame:
        sums = self.read(table).groupBy(*group).agg(*[F.sum(c).alias(c) for c in ("revenue", "units", "lines", "orders")])
        return sums.where("lines > 0")

    def monthly_revenue(self) -> DataFrame:
        """V1 from the stored sums."""
        months = self._sums("months", MONTH).withColumn("revenue", F.col("revenue").cast("decimal(22,2)"))
        months = months.withColumn("prev_month_revenue", F.lag("revenue").over(Window.orderBy("year", "month")))
        growth = (F.col("revenue") - F.col("prev_month_revenue")) / F.nullif(F.col("prev_month_revenue"), F.lit(0)) * F.lit(100)
        return months.select(
            *MONTH, "revenue", F.col("orders").alias("order_count"), F.col("units").alias("units_sold"), "prev_month_revenue",
            F.round(growth, 2).cast("decimal(18,2)").alias("mom_growth_pct"),
        )

    def product_revenue_rank(self) -> DataFrame:
        """V2 from the stored sums."""
        totals = self._sums("products", PRODUCT).select(*PRODUCT, F.col("revenue").cast("decimal(22,2)").alias("total_revenue"), F.col("units").alias("total_units"), F.col("orders").alias("order_count"))
        ranked = global_rank(totals, ["total_revenue"], "revenue_rank", descending=True)
        return ranked.select(*PRODUCT, "total_revenue", "total_units", "order_count", "revenue_rank")

    def month_bitmaps(self) -> DataFrame:
        """The newest bitmaps (year, month, bucket, bitmap) of each month."""
        all_ = self.read("bitmaps")
        newest, met = _same(("year", "month", "load"), all_.groupBy("year", "month").agg(F.max("load").alias("load")))
        return all_.join(F.broadcast(newest), met, "left_semi").where("bucket is not null").select("year", "month", "bucket", "bitmap")

    def distinct_orders(self, *by: Column) -> DataFrame:
        """Exact distinct orders per ``by`` (columns over year and month; none: one row for all months)."""
        merged = self.month_bitmaps().groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        names = [c for c in merged.columns if c not in ("bucket", "bitmap")]
        return merged.groupBy(*names).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("long").alias("order_count"))
