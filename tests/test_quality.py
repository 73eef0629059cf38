from decimal import Decimal

import pytest

from sparkmart.operators import quality


def test_checks_find_offending_rows(spark):
    df = spark.createDataFrame(
        [(1, "ok", Decimal("1.00")), (1, None, Decimal("2.00")), (2, "x" * 30, Decimal("99999.00"))],
        "id long, name string, price decimal(12,2)",
    )
    nulls = quality.check_not_null(df, ["id", "name"]).collect()
    assert [(r.id, r.null_columns) for r in nulls] == [(1, "name")]
    dups = quality.check_unique(df, ["id"]).collect()
    assert [(r.id, r.duplicate_count) for r in dups] == [(1, 2)]
    bad = quality.check_domain(df, {"name": 20}, {"price": (5, 2)}).collect()
    assert [(r.id, r.violations) for r in bad] == [(2, "name:length<=20,price:numeric(5,2)")]
    report = {(r.column_name, r.rule): r.violations for r in quality.domain_report(df, "t", {"name": 20}).collect()}
    assert report == {("name", "length<=20"): 1}
    parent = spark.createDataFrame([(1,)], "pid long")
    orphans = quality.check_foreign_key(df, parent, "id", "pid").collect()
    assert [r.id for r in orphans] == [2]
    with pytest.raises(quality.QualityError):
        quality.fail_if_any(quality.check_unique(df, ["id"]), "unique id")


def test_gate_reports_nulls_widths_keys_and_parents(spark):
    from pyspark.sql import types as T

    from sparkmart.schemas import TableSpec

    schema = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType(), False)])
    spec = TableSpec("t", schema, ("a",), lengths={"b": 3})
    df = spark.createDataFrame([(1, None), (2, None), (3, "x"), (4, "long")], "a long, b string")
    found = {(r.column_name, r.rule): r.violations for r in quality.spec_violations(df, spec).collect()}
    assert found == {("b", "not null"): 2, ("b", "length<=3"): 1}
    good = df.where("b = 'x'")
    quality.gate(good, spec, {"a": (spark.range(5), "id")})
    for bad, parents in ((df, None), (good.union(good), None), (good, {"a": (spark.range(2), "id")})):
        with pytest.raises(quality.QualityError):
            quality.gate(bad, spec, parents)
