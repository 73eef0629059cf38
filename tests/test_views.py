"""V1 / V2 semantics on small stars."""

import datetime as dt
from decimal import Decimal

from sparkmart.operators.calendar import build_dim_date
from sparkmart.plans import dashboard, views

FACT = "date_key long, facility_key long, product_key long, order_id long, quantity int, unit_price_sold decimal(10,2), line_total decimal(12,2)"


def _fact(spark, rows):
    return spark.createDataFrame(
        [(dk, 1, pk, oid, q, Decimal(p), Decimal(t)) for dk, pk, oid, q, p, t in rows], FACT
    )


def test_monthly_revenue_gaps_zero_and_first_month(spark):
    cal = build_dim_date(spark, 2025, 2025)
    # date_key 1 = Jan 1, 32 = Feb 1, 91 = Apr 1, 121 = May 1 (no sales in March)
    fact = _fact(
        spark,
        [
            (1, 1, 1, 2, "10.00", "100.00"),
            (2, 1, 2, 1, "10.00", "50.00"),
            (32, 1, 2, 1, "0.00", "0.00"),
            (91, 1, 3, 1, "10.00", "30.00"),
            (121, 1, 4, 1, "10.00", "45.00"),
        ],
    )
    rows = {r.month: r for r in views.monthly_revenue(fact, cal).collect()}
    assert rows[1].order_count == 2 and rows[1].prev_month_revenue is None and rows[1].mom_growth_pct is None
    assert rows[2].mom_growth_pct == Decimal("-100.00")
    assert 3 not in rows
    assert rows[4].prev_month_revenue == Decimal("0.00") and rows[4].mom_growth_pct is None  # NULLIF
    assert rows[5].prev_month_revenue == Decimal("30.00")  # previous month *with sales* (G1)
    assert rows[5].mom_growth_pct == Decimal("50.00")


def test_product_rank_ties_and_grouping(spark):
    products = spark.createDataFrame(
        [(-1, "Unknown", None), (1, "pump", "EQ"), (2, "pump", "EQ"), (3, "lamp", "EQ"), (4, "bed", "EQ")],
        "product_key long, product_name string, category_name string",
    )
    fact = _fact(
        spark,
        [
            (1, 1, 1, 1, "1.00", "10.00"),
            (1, 2, 2, 1, "1.00", "10.00"),  # second version of pump: grouped by name (G15)
            (1, 3, 3, 1, "1.00", "20.00"),
            (1, 4, 4, 1, "1.00", "5.00"),
            (1, -1, 5, 1, "1.00", "99.00"),  # unknown member excluded
        ],
    )
    rank = {r.product_name: r.revenue_rank for r in views.product_revenue_rank(fact, products).collect()}
    dense = {r.product_name: r.revenue_rank for r in views.product_revenue_rank(fact, products, "dense").collect()}
    assert rank == {"pump": 1, "lamp": 1, "bed": 3}
    assert dense == {"pump": 1, "lamp": 1, "bed": 2}


def test_top_products_tie_break_and_share(spark):
    star = spark.createDataFrame(
        [(1, "b", "X", 1, Decimal("5.00")), (2, "a", "X", 1, Decimal("5.00")), (3, "c", "Y", 1, Decimal("10.00"))],
        "product_key long, product_name string, category_name string, quantity int, line_total decimal(12,2)",
    )
    top = [r.product_name for r in dashboard.top_products(star, 2).collect()]
    assert top == ["c", "a"]
    share = {r.category_name: r.revenue_share for r in dashboard.revenue_by_category(star).collect()}
    assert share == {"X": 0.5, "Y": 0.5}
