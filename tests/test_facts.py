"""Fact load: as-of edges, unknown members, calendar misses."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from sparkmart import schemas
from sparkmart.operators import facts, scd
from sparkmart.operators.calendar import build_dim_date

T0 = dt.datetime(2020, 1, 1)
ORDER = "order_line_id long, order_id long, order_date date, facility_id long, product_id long, quantity int, unit_price_sold decimal(10,2), line_total decimal(12,2)"


def _dims(spark):
    fac = spark.createDataFrame([(1, 100, "A", "H", "France", "EUROPE", T0)], schemas.DIM_FACILITY).unionByName(
        scd.unknown_facility(spark, T0)
    )
    d = dt.date
    prod = spark.createDataFrame(
        [
            (1, 10, "pump", "EQ", Decimal("5.00"), True, d(2020, 1, 1), d(2020, 6, 1), False, T0),
            (2, 10, "pump", "EQ", Decimal("6.00"), True, d(2020, 6, 1), d(2020, 6, 1), False, T0),  # empty
            (3, 10, "pump", "EQ", Decimal("7.00"), True, d(2020, 6, 1), None, True, T0),
        ],
        schemas.DIM_PRODUCT,
    ).unionByName(scd.unknown_product(spark, T0))
    return build_dim_date(spark, 2019, 2021), fac, prod


def _line(i, date, fac=100, prod=10):
    return (i, 1000 + i, date, fac, prod, 1, Decimal("1.00"), Decimal("1.00"))


def test_asof_edges_and_unknown_members(spark):
    cal, fac, prod = _dims(spark)
    d = dt.date
    lines = spark.createDataFrame(
        [
            _line(1, d(2020, 1, 1)),  # = start of version 1
            _line(2, d(2020, 6, 1)),  # = end of version 1 → version 3 (version 2 is empty)
            _line(3, d(2019, 12, 31)),  # before the first start → -1
            _line(4, d(2020, 3, 1), fac=999, prod=999),  # unknown facility and product
        ],
        ORDER,
    )
    out = {r.order_line_key: r for r in facts.load_fact(lines, cal, fac, prod, T0).collect()}
    assert out[1].product_key == 1
    assert out[2].product_key == 3
    assert out[3].product_key == -1
    assert (out[4].facility_key, out[4].product_key) == (-1, -1)
    assert out[1].date_key == 366  # 2019 has 365 days
    assert len(out) == 4  # the as-of join never multiplies lines


def test_date_outside_calendar_fails(spark):
    cal, fac, prod = _dims(spark)
    lines = spark.createDataFrame([_line(1, dt.date(2030, 1, 1))], ORDER)
    with pytest.raises((PySparkException, Py4JJavaError)) as err:
        facts.load_fact(lines, cal, fac, prod, T0).collect()
    assert "order_id=1001" in str(err.value) and "order_date=2030-01-01" in str(err.value)


def test_calendar_check_survives_column_pruning(spark):
    from sparkmart.plans.views import product_revenue_rank

    cal, fac, prod = _dims(spark)
    lines = spark.createDataFrame([_line(1, dt.date(2020, 1, 1)), _line(2, dt.date(2030, 1, 1)), _line(3, None)], ORDER)
    fact = facts.load_fact(lines, cal, fac, prod, T0)
    with pytest.raises((PySparkException, Py4JJavaError)):  # the ranking never reads date_key
        product_revenue_rank(fact, prod).collect()
    assert sorted(r.order_id for r in facts.missing_dates(lines, cal).collect()) == [1002, 1003]


def test_asof_plan_is_equi_join_with_residual(spark):
    cal, fac, prod = _dims(spark)
    lines = spark.createDataFrame([_line(1, dt.date(2020, 1, 1))], ORDER)
    plan = facts.lookup_key_asof(lines, prod, "product_id", "order_date")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_few_versions_are_joined_many_are_merged(spark):
    import datetime as dt

    def plan_and_keys(n):
        start = dt.date(2020, 1, 1)
        dim = spark.range(n).selectExpr(
            "5L as product_id_source", "id + 1 as product_key", "date_add(date'2020-01-01', cast(id as int)) as row_start_date",
            f"if(id = {n - 1}, null, date_add(date'2020-01-01', cast(id as int) + 1)) as row_end_date",
        )
        lines = spark.createDataFrame([(i, 5, start + dt.timedelta(days=i)) for i in range(-1, n)], "line long, product_id long, order_date date")
        found = facts.lookup_key_asof(lines, dim, "product_id", "order_date", merge=True, few_versions=4)
        return found._jdf.queryExecution().executedPlan().toString(), sorted((r["line"], r["product_key"]) for r in found.collect())

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n, merged in ((4, False), (5, True)):
            plan, keys = plan_and_keys(n)
            assert ("Window" in plan) == merged
            assert keys == [(-1, -1)] + [(i, i + 1) for i in range(n)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
