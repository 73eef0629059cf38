"""The stream with keyed state writes only changes to the log, survives retries and restarts."""

import datetime as dt
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sparkmart.schemas import FACT_ORDERS_SPEC
from sparkmart.sources.delta_log import DeltaLog
from sparkmart.streaming.log_stream import start_log_stream
from tests.test_delta_log import FACT, NOW, content, fact


def feed(rows, src):
    rows.coalesce(1).write.mode("append").parquet(src)


def run(spark, src, log, ckpt, **options):
    start_log_stream(spark, src, log, "fact_orders", ckpt, **options).awaitTermination()
    return log.commit()


def run_rows(commit):
    return [r.rows for r in commit.tables.get("fact_orders", [])]


def test_batches_write_only_changes(spark, tmp_path):
    src, ckpt, log = f"{tmp_path}/src", f"{tmp_path}/ckpt", DeltaLog(spark, f"{tmp_path}/log")
    log.append({"fact_orders": fact(spark, [(k, 1, 5) for k in range(100)])})
    # The seed again (nothing to do), an older row, a newer one, a new key, a correction at the same stamp.
    feed(fact(spark, [(k, 1, 5) for k in range(50)] + [(60, 9, 4), (61, 2, 6), (200, 3, 1), (62, 7, 5), (62, 7, 5)]), src)
    assert run_rows(run(spark, src, log, ckpt)) == [100, 3]
    want = {k: 1 for k in range(100)} | {61: 2, 200: 3, 62: 7}
    assert dict(content(log.read("fact_orders"))) == want
    # After a restart the state is still known: older rows and repeats change nothing, the newest row of a batch wins.
    feed(fact(spark, [(61, 2, 6), (61, 5, 5), (200, 4, 2), (200, 5, 3), (200, 6, 2)]), src)
    assert run_rows(run(spark, src, log, ckpt)) == [100, 3, 1]
    assert dict(content(log.read("fact_orders"))) == want | {200: 5}
    # Nothing new: no run.
    assert run_rows(run(spark, src, log, ckpt)) == [100, 3, 1]


def test_a_batch_tried_again_adds_nothing(spark, tmp_path):
    src, ckpt, log = f"{tmp_path}/src", f"{tmp_path}/ckpt", DeltaLog(spark, f"{tmp_path}/log")
    log.append({"fact_orders": fact(spark, [(k, 1, 5) for k in range(10)])})
    feed(fact(spark, [(1, 2, 6)]), src)
    run(spark, src, log, ckpt)
    # The stream's own note of its last batch is lost, as if the driver had died after the log's commit.
    last = max((n for n in os.listdir(f"{ckpt}/commits") if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        os.remove(f"{ckpt}/commits/{name}")
    feed(fact(spark, [(2, 3, 4), (3, 4, 7)]), src)  # (2, 3, 4) is older than the seed
    assert run_rows(run(spark, src, log, ckpt)) == [10, 1, 1]
    assert dict(content(log.read("fact_orders"))) == {k: 1 for k in range(10)} | {1: 2, 3: 4}


def test_hot_key_and_equal_stamps(spark, tmp_path):
    src, log = f"{tmp_path}/src", DeltaLog(spark, f"{tmp_path}/log")
    hot = spark.range(25_000).selectExpr("1L as order_line_key", "20240101L as date_key", "1L as facility_key", "1L as product_key", "1L as order_id", "cast(id as int) as quantity", "cast(1 as decimal(10,2)) as unit_price_sold", "cast(1 as decimal(12,2)) as line_total", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) as last_updated")
    feed(hot.select(*FACT.fieldNames()), src)
    run(spark, src, log, f"{tmp_path}/ckpt")
    assert content(log.read("fact_orders")) == [(1, 24_999)]
    feed(fact(spark, [(5, 1, 900), (5, 2, 900)]), src)
    with pytest.raises(StreamingQueryException, match="one stamp"):
        run(spark, src, log, f"{tmp_path}/ckpt")
    assert content(log.read("fact_orders")) == [(1, 24_999)]


def test_null_stamps_and_null_keys(spark, tmp_path):
    src, ckpt, log = f"{tmp_path}/src", f"{tmp_path}/ckpt", DeltaLog(spark, f"{tmp_path}/log")
    plain = fact(spark, [(1, 1, 0), (2, 2, 0)])
    feed(plain.selectExpr("* except (last_updated)", "if(order_line_key = 1, null, last_updated) as last_updated"), src)
    run(spark, src, log, ckpt)
    feed(fact(spark, [(1, 5, 0)]), src)
    run(spark, src, log, ckpt)
    assert dict(content(log.read("fact_orders"))) == {1: 5, 2: 2}
    feed(plain.selectExpr("cast(null as bigint) as order_line_key", "* except (order_line_key)"), src)
    with pytest.raises(StreamingQueryException):
        run(spark, src, log, ckpt)


def test_micro_batches_follow_the_files(spark, tmp_path):
    src, log = f"{tmp_path}/src", DeltaLog(spark, f"{tmp_path}/log")
    for day in range(3):
        feed(fact(spark, [(k, day, day) for k in range(5 * day + 5)]), src)
    commit = run(spark, src, log, f"{tmp_path}/ckpt", max_files_per_trigger=1)
    assert len(run_rows(commit)) >= 2 and commit.writers
    assert log.watermark("fact_orders") == NOW + dt.timedelta(days=2)
    assert FACT_ORDERS_SPEC.key == ("order_line_key",)
    assert {k: q for k, q in content(log.read("fact_orders"))} == {k: 2 for k in range(15)}


def test_state_is_asked_once_per_range_of_keys(spark, tmp_path):
    src, ckpt, log = f"{tmp_path}/src", f"{tmp_path}/ckpt", DeltaLog(spark, f"{tmp_path}/log")
    keys = [*range(-5, 3000), 1 << 60]
    log.append({"fact_orders": fact(spark, [(k, 1, 0) for k in keys if k % 2])})
    feed(fact(spark, [(k, 1 + (k % 3 == 0), 0) for k in keys]), src)
    query = start_log_stream(spark, src, log, "fact_orders", ckpt)
    query.awaitTermination()
    # Ranges of 1024 keys: one below zero, three above it, one far away.
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 5
    assert dict(content(log.read("fact_orders"))) == {k: 1 + (k % 3 == 0) for k in keys}
    assert run_rows(log.commit())[1] == sum(1 for k in keys if k % 2 == 0 or k % 3 == 0)


class Held:
    """A state value in memory."""

    def __init__(self, value=None):
        self.value = value

    def get(self):
        return None if self.value is None else (self.value,)

    def update(self, new):
        self.value = new[0]


def entry(marks):
    import pandas as pd

    from sparkmart.streaming.log_stream import _MARKS, _ROW

    return iter([pd.DataFrame(marks, columns=list(_MARKS)).assign(**{_ROW: [f"row {m[0]}" for m in marks]})])


@pytest.mark.parametrize("n", [1, 3, 500, 1024])
def test_state_entries_take_little_more_than_their_fingerprints(n):
    import random

    import numpy as np

    from sparkmart.streaming.log_stream import newest_rows

    draw = random.Random(n)
    word = lambda: draw.randrange(-(1 << 63), 1 << 63)
    marks = [(k - 700, -(1 << 63) if k % 7 == 0 else 10**15 + k % 9, word(), word()) for k in range(n)]
    work = newest_rows()
    for before in (None, np.array(marks, dtype="<i8")[: n // 2].tobytes()):  # no entry; one stored as rows, by an earlier version
        work.seen = Held(before)
        first = [r for part in work.handleInputRows(None, entry(marks), None) for r in part.iloc[:, 0]]
        assert first == [f"row {m[0]}" for m in marks[0 if before is None else n // 2 :]]
        assert len(work.seen.value) % 32 and len(work.seen.value) < 20 * n + 100
        assert not list(work.handleInputRows(None, entry(marks), None))
        newer = (marks[-1][0], 10**15 + 99, 1, 2)
        assert [part.iloc[0, 0] for part in work.handleInputRows(None, entry([newer, marks[0]][: 1 + (n > 1)]), None)] == [f"row {newer[0]}"]
        assert not list(work.handleInputRows(None, entry([marks[-1], newer]), None))


def test_rows_pass_the_stream_as_they_are(spark):
    from pyspark.sql.types import StructField, StructType

    from sparkmart.schemas import DIM_PRODUCT_SPEC
    from sparkmart.streaming.log_stream import _ROW, _packed, _unpacked

    rows = spark.createDataFrame(
        [(1, 1, 'a "b"\n,[]\n\u00e9', "", None, True, dt.date(2000, 1, 1), None, True, dt.datetime(2020, 1, 1, 0, 0, 0, 123456)), (2, *[None] * 9)],
        StructType([StructField(f.name, f.dataType) for f in DIM_PRODUCT_SPEC.schema.fields]),
    )
    assert _unpacked(rows.select(_packed(DIM_PRODUCT_SPEC).alias(_ROW)), DIM_PRODUCT_SPEC).collect() == rows.collect()
    longest = rows.select(F.max(F.length(_packed(DIM_PRODUCT_SPEC)))).first()[0]
    assert longest < 120  # no column names
