import os

import pytest
from pyspark.sql import types as T

from sparkmart import schemas
from sparkmart.sources.bindings import Sources
from sparkmart.sources.tables import read_table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_typed_scan_casts_and_prunes(spark):
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", schemas.MONEY_TOTAL)])
    df = read_table(spark, f"{SF}/orders.parquet", schema)
    assert df.dtypes == [("o_orderkey", "bigint"), ("o_totalprice", "decimal(12,2)")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_typed_scan_rejects_missing_columns(spark):
    schema = T.StructType([T.StructField("no_such_column", T.LongType())])
    with pytest.raises(ValueError):
        read_table(spark, f"{SF}/orders.parquet", schema)


def test_bindings_match_the_source_schemas(spark):
    src = Sources(spark, SF)
    for df, schema in (
        (src.region, schemas.REGION),
        (src.country, schemas.COUNTRY),
        (src.category, schemas.CATEGORY),
        (src.product, schemas.PRODUCT),
        (src.facility, schemas.FACILITY),
        (src.purchase_order, schemas.PURCHASE_ORDER),
        (src.order_line, schemas.ORDER_LINE),
    ):
        assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schema.fields]


def test_the_price_lookup_broadcasts_only_counted_parts(spark, tmp_path, monkeypatch):
    from sparkmart.functions import joins
    from sparkmart.sources.bindings import Sources

    spark.sql("select id as p_partkey, 'n' as p_name, 'b' as p_brand, 't' as p_type, 1 as p_size, cast(id as double) as p_retailprice from range(100)").write.parquet(f"{tmp_path}/part.parquet")
    line = "id as l_orderkey, id as l_partkey, 1L as l_suppkey, 1 as l_linenumber, 2D as l_quantity, 8D as l_extendedprice, 0D as l_discount, 0D as l_tax"
    spark.sql(f"select {line}, 'N' as l_returnflag, 'O' as l_linestatus, timestamp_ntz'2000-01-01' as l_shipdate from range(101)").write.parquet(f"{tmp_path}/lineitem.parquet")
    for counted, joined in ((8, "BroadcastHashJoin"), (1e-4, "SortMergeJoin")):  # of the default threshold: 80 MB, 1 kB
        monkeypatch.setattr(joins, "COUNTED", counted)
        lines = Sources(spark, str(tmp_path)).order_line_unkeyed
        assert joined in lines._jdf.queryExecution().executedPlan().toString()
        assert {r.product_id: float(r.unit_price_sold) for r in lines.collect()} == {k: float(k) for k in range(100)} | {100: 4.0}


def test_a_stored_copy_leaves_no_shuffle_files(spark, tmp_path):
    import time
    from pathlib import Path

    from sparkmart.session import _SHUFFLE_CLEANUP, stored_copy
    from sparkmart.sources.sinks import write_snapshot

    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    shuffled = lambda: {f.name.split("_")[1] for d in folders for f in Path(d).rglob("shuffle_*.data")}
    before, setting = shuffled(), spark.conf.get(_SHUFFLE_CLEANUP)
    counts = spark.range(1000).groupBy("id").count()
    copy = stored_copy(counts)
    write_snapshot(counts, str(tmp_path), "counts")
    assert spark.conf.get(_SHUFFLE_CLEANUP) == setting
    until = time.time() + 10  # they are deleted in the background
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before and copy.count() == 1000
