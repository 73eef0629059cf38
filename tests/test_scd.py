"""Type-1 and Type-2 merges on the edge rows of the fixtures."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from sparkmart import schemas
from sparkmart.operators import scd

T0 = dt.datetime(2020, 1, 1)
NOW = dt.datetime(2021, 6, 1)
AS_OF = dt.date(2021, 6, 1)

FAC_STG = "facility_id long, facility_name string, facility_type string, country_name string, region_name string"


def _dim_facility(spark, rows):
    return spark.createDataFrame(
        [(*r, T0) for r in rows], schemas.DIM_FACILITY
    ).unionByName(scd.unknown_facility(spark, T0))


def test_scd1_overwrites_inserts_and_keeps(spark):
    dim = _dim_facility(
        spark,
        [
            (1, 100, "A", "H", "France", "EUROPE"),  # renamed
            (2, 200, "B", "H", "Japan", "ASIA"),  # country becomes NULL
            (3, 300, "C", "H", "Peru", "AMERICA"),  # unchanged
            (4, 400, "D", "H", "Chad", "AFRICA"),  # absent from staging
        ],
    )
    stg = spark.createDataFrame(
        [
            (100, "A2", "H", "France", "EUROPE"),
            (200, "B", "H", None, "ASIA"),
            (300, "C", "H", "Peru", "AMERICA"),
            (500, "E", "K", "Kenya", "AFRICA"),
            (150, "F", "K", "Kenya", "AFRICA"),
        ],
        FAC_STG,
    )
    out = {r.facility_id_source: r for r in scd.scd1_merge(dim, stg, NOW).collect()}
    assert out[100].facility_name == "A2" and out[100].last_updated == NOW
    assert out[200].country_name is None and out[200].last_updated == NOW  # G7: NULL overwrites
    assert out[300].last_updated == T0  # nothing changed: not re-stamped
    assert out[400].facility_name == "D" and out[400].last_updated == T0  # G6
    assert (out[150].facility_key, out[500].facility_key) == (5, 6)  # max + 1, id order
    assert out[-1].facility_key == -1
    assert len(out) == 7


PROD_STG = "product_id long, product_name string, category_name string, unit_price decimal(10,2), is_active boolean"


def _dim_product(spark, rows):
    return spark.createDataFrame(
        [(*r, T0) for r in rows], schemas.DIM_PRODUCT
    ).unionByName(scd.unknown_product(spark, T0))


def _p(x):
    return Decimal(x)


def test_scd2_three_steps(spark):
    d2000 = dt.date(2000, 1, 1)
    dim = _dim_product(
        spark,
        [
            (1, 10, "pump", "EQ", _p("5.00"), True, d2000, None, True),  # repriced
            (2, 20, "lamp", "EQ", _p("7.00"), True, d2000, None, True),  # renamed only (G4)
            (3, 30, "bed", "EQ", _p("9.00"), True, d2000, dt.date(2010, 1, 1), False),  # history only (G5)
            (4, 40, "mask", "CO", _p("1.00"), True, d2000, None, True),  # staging price NULL
            (5, 50, "gown", "CO", _p("2.00"), True, d2000, None, True),  # absent from staging
        ],
    )
    stg = spark.createDataFrame(
        [
            (10, "pump", "EQ", _p("6.00"), True),
            (20, "lamp XL", "EQ", _p("7.00"), True),
            (30, "bed", "EQ", _p("9.50"), True),
            (40, "mask", "CO", None, True),
            (60, "glove", "CO", _p("0.50"), True),
        ],
        PROD_STG,
    )
    rows = scd.scd2_merge(dim, stg, AS_OF, NOW, initial_start=d2000).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.product_id_source, []).append(r)
    old, new = sorted(by_id[10], key=lambda r: r.product_key)
    assert (old.is_current, old.row_end_date, old.last_updated) == (False, AS_OF, NOW)
    assert (new.product_key, new.unit_price, new.row_start_date, new.is_current) == (6, _p("6.00"), AS_OF, True)
    assert [r.product_name for r in by_id[20]] == ["lamp"]  # name change waits for a price change
    reopened = [r for r in by_id[30] if r.is_current]
    assert len(reopened) == 1 and reopened[0].product_key == 7 and reopened[0].row_start_date == AS_OF
    assert len(by_id[40]) == 1 and by_id[40][0].is_current  # NULL never differs
    assert len(by_id[50]) == 1 and by_id[50][0].last_updated == T0
    (fresh,) = by_id[60]
    assert (fresh.product_key, fresh.row_start_date) == (8, d2000)  # step 3 after step 2
    for versions in by_id.values():  # property: at most one current version per product
        assert sum(r.is_current for r in versions) <= 1


def test_scd1_null_staging_id_fails(spark):
    dim = scd.empty_dim_facility(spark, dt.datetime(2024, 1, 1))
    stg = spark.createDataFrame([(None, "A", "H", "X", "R")], "facility_id long, facility_name string, facility_type string, country_name string, region_name string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        scd.scd1_merge(dim, stg, dt.datetime(2024, 2, 1)).collect()


def test_scd2_duplicate_staging_key_fails(spark):
    dim = _dim_product(spark, [])
    stg = spark.createDataFrame([(1, "a", "X", _p("1.00"), True), (1, "b", "X", _p("2.00"), True)], PROD_STG)
    with pytest.raises((PySparkException, Py4JJavaError)):
        scd.scd2_merge(dim, stg, AS_OF, NOW).collect()


def test_scd2_intervals_never_overlap_after_two_changes(spark):
    dim = _dim_product(spark, [])
    stg1 = spark.createDataFrame([(1, "a", "X", _p("1.00"), True)], PROD_STG)
    stg2 = spark.createDataFrame([(1, "a", "X", _p("2.00"), True)], PROD_STG)
    stg3 = spark.createDataFrame([(1, "a", "X", _p("3.00"), True)], PROD_STG)
    d1 = scd.scd2_merge(dim, stg1, dt.date(2021, 1, 1), NOW)
    d2 = scd.scd2_merge(d1, stg2, dt.date(2021, 2, 1), NOW)
    d3 = scd.scd2_merge(d2, stg3, dt.date(2021, 2, 1), NOW)  # same-day second change: [d, d)
    versions = sorted((r for r in d3.collect() if r.product_key > 0), key=lambda r: r.product_key)
    assert [(r.row_start_date, r.row_end_date) for r in versions] == [
        (dt.date(2000, 1, 1), dt.date(2021, 2, 1)),
        (dt.date(2021, 2, 1), dt.date(2021, 2, 1)),
        (dt.date(2021, 2, 1), None),
    ]
    assert [r.is_current for r in versions] == [False, False, True]


def test_changed_rows_reach_the_next_sync(spark):
    """A Type-1 update moves last_updated, so the watermark scan sees it."""
    from sparkmart.sources.incremental import read_since, watermark

    dim = _dim_facility(spark, [(1, 100, "A", "H", "France", "EUROPE"), (2, 200, "B", "H", "Japan", "ASIA")])
    stg = spark.createDataFrame(
        [(100, "A renamed", "H", "France", "EUROPE"), (200, "B", "H", "Japan", "ASIA")], FAC_STG
    )
    merged = scd.scd1_merge(dim, stg, NOW)
    delta = read_since(merged, "last_updated", watermark(dim, key_col="facility_key"))
    assert [r.facility_id_source for r in delta.collect()] == [100]


def test_with_unknown_member_adds_it_once(spark):
    dim = _dim_facility(spark, [(1, 100, "A", "H", "France", "EUROPE")])  # already has -1
    twice = scd.with_unknown_member(dim, scd.unknown_facility(spark, NOW), "facility_key")
    keys = sorted(r.facility_key for r in twice.collect())
    assert keys == [-1, 1]


def test_scd2_products_beyond_the_counted_bound_are_not_broadcast(spark, monkeypatch):
    from sparkmart.functions import joins

    new_rows, assign = [], scd.assign_keys
    monkeypatch.setattr(scd, "assign_keys", lambda rows, *a, **b: new_rows.append(rows) or assign(rows, *a, **b))
    row = "cast(1 as decimal(10,2)) as unit_price, true as is_active"
    stg = spark.sql(f"select id as product_id, concat('p', id) as product_name, 'c' as category_name, {row} from range(50)").repartition(2)
    plans = []
    for counted in (8, 1e-5):  # of the default threshold: 80 MB, 100 bytes
        monkeypatch.setattr(joins, "COUNTED", counted)
        dim = scd.scd2_merge(scd.empty_dim_product(spark, T0), stg.where("product_id < 49"), AS_OF, NOW)
        dim = scd.scd2_merge(dim, stg, AS_OF, NOW)
        assert sorted(r.product_key for r in dim.collect()) == [-1, *range(1, 51)]
        plan = new_rows[-1]._jdf.queryExecution().executedPlan().toString()
        plans.append([x for x in plan.splitlines() if "Join [_sm_nk" in x and ", [_sm_fk" in x])
    assert [len(p) for p in plans] == [1, 1] and "BroadcastHashJoin" in plans[0][0] and "SortMergeJoin" in plans[1][0]
