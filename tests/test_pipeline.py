"""End-to-end build on the smallest test data: the properties of SURVEY §5."""

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from sparkmart import schemas
from sparkmart.operators import quality, sync
from sparkmart.plans.build import BuildParams, run_build
from sparkmart.plans.views import monthly_revenue
from sparkmart.sources.bindings import Sources
from sparkmart.plans.build import new_lines, run_load
from sparkmart.sources.sinks import read_snapshot, versions

SF = "/root/testdata/sf0.001"
#: A directory per day is many tiny files here; one test below builds that layout.
FLAT = BuildParams(fact_partition=None)
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_build_writes_consistent_snapshots(spark, tmp_path):
    src = Sources(spark, SF)
    out = str(tmp_path / "wh")
    run_build(src, FLAT, out_dir=out)
    t = {name: read_snapshot(spark, out, name) for name in ("raw_order", "dim_date", "dim_facility", "dim_product", "fact_orders")}

    # One fact row per staged line, one per source line.
    n_lines = src.order_line.count()
    assert t["fact_orders"].count() == t["raw_order"].count() == n_lines
    # Money is preserved through staging, fact and the monthly view.
    total = src.order_line.agg(F.sum("line_total")).first()[0]
    assert t["fact_orders"].agg(F.sum("line_total")).first()[0] == total
    assert monthly_revenue(t["fact_orders"], t["dim_date"]).agg(F.sum("revenue")).first()[0] == total
    # Keys, references and required columns.
    fact = t["fact_orders"]
    assert quality.check_unique(fact, ["order_line_key"]).count() == 0
    for dim, key in (("dim_date", "date_key"), ("dim_facility", "facility_key"), ("dim_product", "product_key")):
        assert quality.check_unique(t[dim], [key]).count() == 0
        assert quality.check_foreign_key(fact, t[dim], key, key).count() == 0
    assert quality.check_not_null(fact, schemas.FACT_ORDERS_SPEC.required).count() == 0
    # Type-2 invariant: at most one current version per product.
    cur = t["dim_product"].where("is_current").groupBy("product_id_source").count().where("count > 1")
    assert cur.count() == 0
    # Type-2 intervals of one product never overlap.
    versions_by_id = {}
    for r in t["dim_product"].where("product_key <> -1").collect():
        versions_by_id.setdefault(r.product_id_source, []).append((r.row_start_date, r.row_end_date))
    for spans in versions_by_id.values():
        spans.sort()
        for (s1, e1), (s2, _) in zip(spans, spans[1:]):
            assert e1 is not None and e1 <= s2
    # The two repriced products have exactly two versions each.
    versions = {r.product_id_source: r["count"] for r in t["dim_product"].groupBy("product_id_source").count().collect()}
    assert versions[1] == versions[2] == 2


def test_sync_all_then_nothing_left(spark, tmp_path):
    src = Sources(spark, SF)
    wh = run_build(src, FLAT)
    source = {"dim_date": wh.dim_date, "dim_facility": wh.dim_facility, "dim_product": wh.dim_product, "fact_orders": wh.fact_orders}
    empty = {name: spark.createDataFrame([], df.schema) for name, df in source.items()}
    out = str(tmp_path / "target")
    months = {"dim_date": ("month",)}
    first = sync.sync_all(source, empty, out_dir=out, partition_by=months)
    assert [r.rows for r in first] == [df.count() for df in source.values()]
    targets = {spec.name: read_snapshot(spark, out, spec.name) for spec in schemas.WAREHOUSE_SPECS}
    second = sync.sync_all(source, targets, out_dir=out, partition_by=months)
    assert [r.rows for r in second] == [0, 0, 0, 0]
    # Nothing newer: no new version; a table keeps its layout.
    assert [versions(spark, out, spec.name) for spec in schemas.WAREHOUSE_SPECS] == [{0: True}] * 4
    assert "month=7" in os.listdir(os.path.join(out, "dim_date", "version=0"))


def test_views_are_queryable_with_sql(spark):
    from sparkmart.sources.tables import register_warehouse_views

    wh = run_build(Sources(spark, SF), FLAT, keyed_lines=False)
    names = register_warehouse_views(spark, wh)
    assert "vw_monthly_revenue" in names
    by_sql = spark.sql("SELECT year, month, revenue FROM vw_monthly_revenue ORDER BY year, month").collect()
    assert len(by_sql) == 80 and by_sql[0].year == 1995
    top = spark.sql("SELECT product_name FROM vw_product_revenue_rank WHERE revenue_rank = 1").collect()
    assert len(top) >= 1
    n = spark.sql("SELECT COUNT(*) AS n FROM fact_orders f JOIN dim_date d ON f.date_key = d.date_key").first().n
    assert n == wh.fact_orders.count()


def test_stored_fact_is_pruned_by_a_date_filter_on_the_calendar(spark, tmp_path):
    import datetime as dt

    from sparkmart.plans.dashboard import apply_slicers, sales_by_country, sales_star

    out = str(tmp_path / "wh")
    wh = run_build(Sources(spark, SF), BuildParams(), keyed_lines=False, out_dir=out)
    # Read back from the partitioned snapshot with the loaded column order and types.
    assert wh.fact_orders.columns == [c for c in schemas.FACT_ORDERS.fieldNames() if c != "order_line_key"]
    assert dict(wh.fact_orders.dtypes)["date_key"] == "bigint"
    cards = sales_star(wh.fact_orders)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in cards
    sliced = apply_slicers(
        sales_star(wh.fact_orders, wh.dim_date, wh.dim_facility),
        date_from=dt.date(1997, 1, 1),
        date_to=dt.date(1997, 3, 31),
    )
    report = sales_by_country(sliced)
    rows = report.collect()
    assert rows
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan.lower()


def test_second_load_keeps_keys_and_history(spark, tmp_path):
    import datetime as dt

    out = str(tmp_path / "wh")
    src = Sources(spark, SF)
    params = FLAT
    first = run_load(src.until(dt.date(1998, 1, 1)), params, out)
    keys = {r.order_line_key: tuple(r) for r in first.fact_orders.collect()}
    # An early order appears only now: the later load must not move any key.
    second = run_load(src, replace(FLAT, now=dt.datetime(2003, 1, 1)), out, apply_edits=True)
    rows = {r.order_line_key: tuple(r) for r in second.fact_orders.select(*first.fact_orders.columns).collect()}
    assert len(rows) == src.order_line_unkeyed.count() and sorted(rows) == list(range(1, len(rows) + 1))
    assert all(rows[k] == v for k, v in keys.items())
    products = second.dim_product.where("product_id_source in (1, 2)").groupBy("product_id_source").count().collect()
    assert [r["count"] for r in products] == [2, 2]
    facility = second.dim_facility.where("facility_id_source = 1").collect()
    assert len(facility) == 1 and facility[0].facility_name == params.renamed_facility[1]
    assert [versions(spark, out, t) for t in second.tables()] == [{0: True, 1: True}] * 7
    # A third load of the same source adds nothing.
    third = run_load(src, replace(FLAT, now=dt.datetime(2004, 1, 1)), out, apply_edits=True)
    assert third.fact_orders.count() == len(rows)


def test_new_lines_are_a_multiset_difference(spark):
    schema = "order_line_id long, order_id long, product_id long, quantity int, line_total decimal(12,2), unit_price_sold decimal(10,2)"
    from decimal import Decimal as D

    known = spark.createDataFrame([(1, 1, 1, 1, D(5), D(5)), (2, 1, 1, 1, D(5), D(5))], schema)
    staged = spark.createDataFrame([(1, 1, 1, D(5), D(6))] * 3 + [(0, 9, 1, D(1), D(1)), (1, None, 1, D(5), D(5))], schema.split(", ", 1)[1])
    got = sorted((tuple(r) for r in new_lines(staged, known).select("order_id", "product_id").collect()), key=str)
    assert got == sorted([(0, 9), (1, 1), (1, None)], key=str)


def test_a_failing_gate_publishes_nothing(spark, tmp_path):
    from sparkmart.operators.quality import QualityError

    out = str(tmp_path / "wh")
    src = Sources(spark, SF)
    src.__dict__["facility"] = src.facility.withColumn("facility_name", F.when(F.col("facility_id") != 3, F.col("facility_name")))
    with pytest.raises(QualityError):
        run_build(src, FLAT, keyed_lines=False, out_dir=out)
    assert versions(spark, out, "fact_orders") == {}


def test_lines_of_unknown_parts_reach_the_fact(spark):
    src = Sources(spark, SF)
    src.raw("part")
    src.__dict__["_raw"]["part"] = src.raw("part").where("p_partkey <> 7")
    wh = run_build(src, FLAT, keyed_lines=False)
    assert wh.fact_orders.count() == src.raw("lineitem").count()
    lost = src.raw("lineitem").where("l_partkey = 7").count()
    assert lost > 0 and wh.fact_orders.where("product_key = -1").count() == lost


def test_a_failing_gate_leaves_an_incomplete_fact(spark, tmp_path, monkeypatch):
    from sparkmart.plans import build
    from sparkmart.sources.sinks import latest_version

    copies = []
    monkeypatch.setattr(build, "stored_copy", lambda df, name: copies.append(name) or df)
    out, src = str(tmp_path / "wh"), Sources(spark, SF)
    run_build(src, FLAT, keyed_lines=False, out_dir=out)
    assert copies == []  # the fact is checked where it lies, not written twice
    assert versions(spark, out, "fact_orders") == {0: True}
    monkeypatch.setattr(build, "_check_fact", lambda fact, dims: quality.fail_if_any(fact, "broken"))
    with pytest.raises(quality.QualityError):
        run_build(src, FLAT, keyed_lines=False, out_dir=out)
    assert versions(spark, out, "fact_orders") == {0: True, 1: False} and latest_version(spark, out, "fact_orders") == "0"


def test_a_rebuild_builds_twice_and_verification_copies_no_source(spark, monkeypatch):
    from sparkmart import session
    from sparkmart.plans import queries

    monkeypatch.setattr(queries, "_CACHE", {})
    rows = queries.q_snapshot_rebuild(spark, SF)
    assert "warehouse" not in queries.scenarios(spark, SF).__dict__
    assert sorted((r["table_name"], r["version"]) for r in rows.collect())[:2] == [("dim_date", 0), ("dim_date", 1)]
    before = len(session._SCRATCH)
    queries.q_verify_rows(spark, SF)
    assert not [p for p in session._SCRATCH[before:] if "/verify-source" in p]


def test_known_and_staged_lines_are_grouped_where_the_header_join_left_them(spark, tmp_path):
    from sparkmart.operators.staging import extract_order

    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        line = "id as order_id, 1 as quantity, id as product_id, cast(1 as decimal(10,2)) as unit_price_sold, cast(id as decimal(12,2)) as line_total"
        lines = spark.sql(f"select {line} from range(200)")
        header = spark.sql("select id as order_id, date'2000-01-01' as order_date, id as facility_id from range(200)")
        extract_order(lines.where("order_id < 150"), header).write.parquet(f"{tmp_path}/known")
        fresh = new_lines(extract_order(lines, header), spark.read.parquet(f"{tmp_path}/known"))
        assert sorted(r.order_id for r in fresh.collect()) == list(range(150, 200))
        final = fresh._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert final.count("Exchange hashpartitioning") == 3  # lines, headers and known lines, once each
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_a_load_keeps_no_copy_of_the_numbered_lines(spark, tmp_path, monkeypatch):
    import datetime as dt

    from sparkmart.plans import build

    copies, keep = [], build.stored_copy
    monkeypatch.setattr(build, "stored_copy", lambda df, name: copies.append(name) or keep(df, name))
    src, out = Sources(spark, SF), str(tmp_path / "wh")
    run_load(src.until(dt.date(1998, 1, 1)), FLAT, out)
    run_load(src, FLAT, out)
    assert copies == ["fact-checked"]
