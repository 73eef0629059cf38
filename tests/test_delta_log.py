"""Merge-on-read log: equal to the upsert, one commit for all tables, conflicts, compaction, plans."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest

from sparkmart.schemas import DIM_PRODUCT_SPEC, FACT_ORDERS_SPEC
from sparkmart.sources.delta_log import FAN, CommitConflict, DeltaLog, tier
from sparkmart.sources.sinks import upsert

FACT = FACT_ORDERS_SPEC.schema
NOW = dt.datetime(2024, 1, 1)


def fact(spark, rows):
    """(key, quantity, day) triples as fact rows."""
    data = []
    for key, quantity, day in rows:
        values = {"order_line_key": key, "date_key": 20240101 + day, "facility_key": 1, "product_key": key % 3, "order_id": key // 2, "quantity": quantity, "unit_price_sold": Decimal(1), "line_total": Decimal(quantity), "last_updated": NOW + dt.timedelta(days=day)}
        data.append(tuple(values.get(f.name) for f in FACT.fields))
    return spark.createDataFrame(data, FACT)


def content(df):
    return sorted(map(tuple, df.select("order_line_key", "quantity").collect()))


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names}


def test_read_equals_upsert(spark, tmp_path):
    rng = random.Random(1)
    log, want = DeltaLog(spark, str(tmp_path)), None
    for load in range(6):
        # Keys around the borders of the bitmaps' buckets, zero and negative ones too.
        keys = rng.sample([*range(-5, 40), *range(32_760, 32_775), *range(65_530, 65_540), 10**12, 10**12 + 1], 30)
        batch = fact(spark, [(k, 10 * load + 1, load) for k in keys])
        before = files(tmp_path)
        log.append({"fact_orders": batch})
        assert before <= files(tmp_path)  # a load only adds files
        want = batch if want is None else upsert(want, batch, "order_line_key")
        assert content(log.read("fact_orders")) == content(want)
        assert log.watermark("fact_orders") == NOW + dt.timedelta(days=load)
    assert log.read("fact_orders").columns == FACT.fieldNames()
    newest = sorted({r[0] for r in content(batch)})
    asked = log.masked_rows("fact_orders", batch.select("order_line_key"))
    assert sorted(r["order_line_key"] for r in asked.collect()) == newest
    # Earlier commits stay readable; compaction changes no row.
    first = content(log.read("fact_orders", log.commit(1)))
    runs = log.compact("fact_orders", fan=FAN)
    assert len(runs) == 1 and runs[0].first == 1 and runs[0].last == 6
    assert content(log.read("fact_orders")) == content(want) and content(log.read("fact_orders", log.commit(1))) == first
    assert log.remove_unused([log.commit().number]) > 0
    assert content(log.read("fact_orders")) == content(want)


def test_base_is_not_shuffled(spark, tmp_path):
    log = DeltaLog(spark, str(tmp_path))
    log.append({"fact_orders": fact(spark, [(k, 1, 0) for k in range(200)])})
    log.append({"fact_orders": fact(spark, [(3, 2, 1)])})
    plan = log.read("fact_orders")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_all_tables_or_none(spark, tmp_path):
    log = DeltaLog(spark, str(tmp_path))
    product = spark.createDataFrame([], DIM_PRODUCT_SPEC.schema)
    log.append({"fact_orders": fact(spark, [(1, 1, 0)]), "dim_product": product})
    assert list(log.commit().tables) == ["fact_orders"]  # a table without rows gets no run
    twice = fact(spark, [(7, 1, 3), (7, 2, 3)])
    rows = [tuple(9 if f.name == "product_key" else None for f in DIM_PRODUCT_SPEC.schema.fields)]
    nullable = DIM_PRODUCT_SPEC.schema.fromJson(DIM_PRODUCT_SPEC.schema.jsonValue())
    for f in nullable.fields:
        f.nullable = True
    with pytest.raises(Exception, match="duplicate key"):
        log.append({"dim_product": spark.createDataFrame(rows, nullable), "fact_orders": twice})
    assert log.numbers() == [1] and log.read("dim_product").count() == 0 and content(log.read("fact_orders")) == [(1, 1)]


def test_writers_on_one_head(spark, tmp_path, monkeypatch):
    log, other = DeltaLog(spark, str(tmp_path)), DeltaLog(spark, str(tmp_path))
    log.append({"fact_orders": fact(spark, [(1, 1, 0)])})
    head = log.commit
    # The other writer commits between this writer's look at the head and its own commit.
    stale = head()
    other.append({"fact_orders": fact(spark, [(2, 1, 1)])})
    run = log._write("fact_orders", fact(spark, [(3, 1, 2)]), 2, 2)
    with pytest.raises(CommitConflict):
        log._commit_changes(stale, {"fact_orders": ([], [run])})
    assert content(log.read("fact_orders")) == [(1, 1), (2, 1)]
    # Another table's load goes on top; a taken number is never overwritten.
    new = log._commit_changes(stale, {"dim_date": ([], [run])})
    assert new.number == 3 and set(new.tables) == {"fact_orders", "dim_date"}
    assert not log._publish(new)


def test_sync_reads_the_watermark_from_the_commit(spark, tmp_path):
    log = DeltaLog(spark, str(tmp_path))
    source = fact(spark, [(k, 1, k % 4) for k in range(20)])
    commit, report = log.sync({"fact_orders": source.where("quantity = 1 and last_updated < timestamp'2024-01-03'")})
    assert report == [("fact_orders", dt.datetime(1970, 1, 1), 10)]
    commit, report = log.sync({"fact_orders": source})
    assert report[0][2] == 10 and commit.tables["fact_orders"][-1].rows == 10
    again, report = log.sync({"fact_orders": source})
    assert again.number == commit.number and report[0][2] == 0
    assert log.read("fact_orders").count() == 20


def test_tiers():
    assert [tier(n, 4, 100) for n in (0, 100, 101, 399, 401, 1601)] == [0, 0, 1, 1, 2, 3]
