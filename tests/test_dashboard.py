import datetime as dt
from decimal import Decimal

import pytest

from sparkmart.plans import dashboard

STAR = (
    "date_key long, facility_key long, product_key long, order_id long, quantity int, unit_price_sold decimal(10,2), "
    "line_total decimal(12,2), full_date date, year int, month int, facility_name string, country_name string, "
    "region_name string, product_name string, category_name string"
)


def _star(spark):
    d = dt.date
    rows = [
        (1, 1, 1, 10, 2, Decimal("5.00"), Decimal("10.00"), d(2025, 1, 5), 2025, 1, "North", "France", "EUROPE", "p", "c"),
        (2, 2, 1, 11, 1, Decimal("5.00"), Decimal("5.00"), d(2025, 2, 5), 2025, 2, "South", "Japan", "ASIA", "p", "c"),
        (3, 1, 2, 12, 3, Decimal("7.00"), Decimal("21.00"), d(2025, 2, 9), 2025, 2, "North", "France", "EUROPE", "q", "c"),
    ]
    return spark.createDataFrame(rows, STAR)


def test_slicers_apply_before_measures(spark):
    star = _star(spark)
    sliced = dashboard.apply_slicers(star, date_from=dt.date(2025, 2, 1), countries=["France", "Japan"], facilities=["North"])
    cards = dashboard.kpi_cards(sliced).first()
    assert (cards.total_sales, cards.total_orders) == (Decimal("21.00"), 1)
    by_region = dashboard.sales_by_country(dashboard.apply_slicers(star, regions=["ASIA"])).collect()
    assert [(r.country_name, r.revenue, r.units_sold) for r in by_region] == [("Japan", Decimal("5.00"), 1)]


def test_sales_by_country_counts_orders_beside_the_sums(spark):
    # Null countries and orders, an order in two countries, an order of several lines, a country of null orders only.
    rows = [
        ("France", 10, 2, Decimal("10.00")), ("France", 10, 1, Decimal("5.00")), ("France", 11, None, None), ("France", None, 4, Decimal("1.00")),
        ("Japan", 10, 3, Decimal("2.50")), (None, 12, 1, Decimal("3.00")), (None, 12, 1, Decimal("3.00")), ("Peru", None, None, None),
    ]
    star = spark.createDataFrame(rows, "country_name string, order_id long, quantity int, line_total decimal(12,2)")
    report = dashboard.sales_by_country(star)
    assert dict(report.dtypes) == {"country_name": "string", "revenue": "decimal(22,2)", "order_count": "bigint", "units_sold": "bigint"}
    assert {tuple(r) for r in report.collect()} == {
        ("France", Decimal("16.00"), 2, 7), ("Japan", Decimal("2.50"), 1, 3), (None, Decimal("6.00"), 1, 2), ("Peru", None, 0, None),
    }
    # No sum is shuffled once per order.
    by_order = [line for line in report._jdf.queryExecution().executedPlan().toString().splitlines() if "HashAggregate" in line and "order_id" in line.split("functions=")[0]]
    assert by_order and not any("sum(" in line for line in by_order)


def test_revenue_over_time_grains(spark):
    star = _star(spark)
    daily = {r.full_date: r.revenue for r in dashboard.revenue_over_time(star, "day").collect()}
    monthly = {(r.year, r.month): r.revenue for r in dashboard.revenue_over_time(star, "month").collect()}
    assert len(daily) == 3
    assert monthly == {(2025, 1): Decimal("10.00"), (2025, 2): Decimal("26.00")}
    with pytest.raises(ValueError):
        dashboard.revenue_over_time(star, "week")


def test_units_vs_price_and_row_counts(spark):
    star = _star(spark)
    pts = {r.product_name: (r.units_sold, r.avg_unit_price) for r in dashboard.units_vs_price(star).collect()}
    assert pts == {"p": (3, 5.0), "q": (3, 7.0)}
    counts = {r.table_name: r.row_count for r in dashboard.row_counts({"a": star, "b": star.limit(1)}).collect()}
    assert counts == {"a": 3, "b": 1}
