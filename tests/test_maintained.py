"""Views kept up by change against the full views after every load."""

import datetime as dt
import random

from pyspark.sql import functions as F

from sparkmart.plans import views
from sparkmart.plans.maintained import SalesState
from sparkmart.schemas import DIM_DATE_SPEC, DIM_PRODUCT_SPEC, FACT_ORDERS_SPEC
from sparkmart.sources.delta_log import Commit, DeltaLog

NOW = dt.datetime(2024, 1, 1)


def frame(spark, spec, rows):
    """Rows as dicts; columns not given are null."""
    schema = spec.schema.fromJson(spec.schema.jsonValue())
    for f in schema.fields:
        f.nullable = True
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def products(spark, names, load):
    return frame(spark, DIM_PRODUCT_SPEC, [{"product_key": k, "product_name": n, "category_name": c, "last_updated": NOW + dt.timedelta(days=load)} for k, (n, c) in names.items()])


def lines(spark, rows, load):
    from decimal import Decimal

    out = []
    for key, (date, product, order, quantity) in rows.items():
        out.append({"order_line_key": key, "date_key": date, "facility_key": 1, "product_key": product, "order_id": order, "quantity": quantity, "unit_price_sold": Decimal("2.50"), "line_total": Decimal(quantity) * Decimal("2.50"), "last_updated": NOW + dt.timedelta(days=load)})
    return frame(spark, FACT_ORDERS_SPEC, out)


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    left, right = (sorted((tuple(map(str, r)) for r in x.select(*sorted(x.columns)).collect())) for x in (a, b))
    assert left == right


def test_views_follow_every_load(spark, tmp_path):
    rng = random.Random(2)
    log, state = DeltaLog(spark, str(tmp_path / "log")), SalesState(spark, str(tmp_path / "state"))
    dates = [{"date_key": m * 100 + d, "year": 2023 + m // 13, "month": (m - 1) % 12 + 1, "month_name": f"m{(m - 1) % 12 + 1}", "last_updated": NOW} for m in range(10, 15) for d in (1, 2)]
    names = {-1: ("Unknown", "Unknown"), 1: ("gauze", "care"), 2: ("gauze", "care"), 3: ("mask", None), 4: ("glove", "care")}
    fact, before = {}, Commit()
    for load in range(4):
        changed = {}
        for key in rng.sample(range(60), 40 if load == 0 else 12):
            # Lines move between months, products and orders; months lose their last line.
            changed[key] = (dates[rng.randrange(10 if load < 2 else 6)]["date_key"], rng.choice([-1, 1, 2, 3, 4]), rng.choice([*range(8), 40_000]), rng.randrange(1, 5))
        if load == 3:
            changed = {k: (dates[0]["date_key"], 1, 1, 1) for k in fact}
        fact |= changed
        tables = {"fact_orders": lines(spark, changed, load)}
        if load == 0:
            tables |= {"dim_date": frame(spark, DIM_DATE_SPEC, dates), "dim_product": products(spark, names, 0)}
        if load == 2:  # a product gets the name of another one, one is new
            names |= {4: ("mask", None), 5: ("gown", "wear")}
            tables["dim_product"] = products(spark, {k: names[k] for k in (4, 5)}, load)
        after = log.append(tables)
        assert state.refresh(log, before, after) == load + 1
        before = after
        full = [log.read(t) for t in ("fact_orders", "dim_date", "dim_product")]
        same(state.monthly_revenue(), views.monthly_revenue(full[0], full[1]))
        same(state.product_revenue_rank(), views.product_revenue_rank(full[0], full[2]))
        dated = full[0].join(full[1], "date_key")
        years = dated.groupBy("year").agg(F.countDistinct("order_id").alias("order_count"))
        same(state.distinct_orders(F.col("year")), years)
        assert state.distinct_orders().collect()[0]["order_count"] == dated.select("order_id").distinct().count()


def test_only_changed_orders_enter(spark, tmp_path):
    log, state = DeltaLog(spark, str(tmp_path / "log")), SalesState(spark, str(tmp_path / "state"))
    dates = frame(spark, DIM_DATE_SPEC, [{"date_key": 1, "year": 2024, "month": 1, "month_name": "m1", "last_updated": NOW}])
    first = log.append({"dim_date": dates, "dim_product": products(spark, {1: ("a", "b")}, 0), "fact_orders": lines(spark, {k: (1, 1, k, 1) for k in range(500)}, 0)})
    state.refresh(log, Commit(), first)
    second = log.append({"fact_orders": lines(spark, {3: (1, 1, 900, 2)}, 1)})
    state.refresh(log, first, second)
    load = spark.read.parquet(str(tmp_path / "state" / "load-2" / "month_orders"))
    assert sorted(map(tuple, load.select("order_id", "lines").collect())) == [(3, -1), (900, 1)]
    # A state without its mark doesn't count.
    assert state.loads() == [1, 2]
    (tmp_path / "state" / "done-2").unlink()
    assert state.loads() == [1] and state.monthly_revenue().collect()[0]["units_sold"] == 500


def test_empty_state(spark, tmp_path):
    state = SalesState(spark, str(tmp_path / "none"))
    assert state.monthly_revenue().count() == 0 and state.product_revenue_rank().count() == 0
    assert state.distinct_orders().collect()[0]["order_count"] == 0


def test_a_refresh_takes_the_touched_keys_from_the_stored_bitmaps(spark, tmp_path, monkeypatch):
    from sparkmart.plans import maintained

    stored = {}
    keep = maintained.stored_copy
    monkeypatch.setattr(maintained, "stored_copy", lambda df, name: stored.setdefault(name, keep(df, name)))
    log, state = DeltaLog(spark, f"{tmp_path}/log"), SalesState(spark, f"{tmp_path}/state")
    fact = frame(spark, FACT_ORDERS_SPEC, [{"order_line_key": k, "date_key": 1, "product_key": 1, "order_id": k, "quantity": 1} for k in (-1, 0, 1, 32768, 32769, 99999)])
    commit = log.append({"fact_orders": fact})
    state.refresh(log, Commit(), commit)
    touched = stored["touched-lines"]
    assert touched.columns == ["bucket", "bitmap"] and touched.count() == commit.tables["fact_orders"][0].buckets
    assert sorted(r[0] for r in log.rows_in("fact_orders", touched).select("order_line_key").collect()) == [-1, 0, 1, 32768, 32769, 99999]
