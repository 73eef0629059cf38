"""Archives: exact round trip, predicates on headers, skipped payloads."""

import hashlib

from pyspark.sql import functions as F

from sparkmart.llm.common import shared_dir
from sparkmart.llm.warc import page_records, read_archive, round_trip, write_archive

SCHEMA = "page_id long, url string, html string, payload string, first long, n int"


def pages():
    big = "<p>" + "é" * 700 + "</p>"
    return [
        (1, "http://a/1", big), (2, "http://a/2", big), (3, None, big), (4, "http://a/4", "small"), (5, "http://a/5", "small"),
        (6, "http://a/6", None), (7, "http://a/7", ""), (8, "http://a/\r\nX: 1", "x" * 999), (9, "u", "x" * 999), (10, "u", "x" * 1000),
        (11, "u", "x" * 1000), (12, "u", "HTTP/1.1 200 OK\r\n\r\nWARC/1.1\r\n" * 300), (None, "u", "y" * 5000), (13, "long", "z" * 2_000_000),
        (10, "u", "x" * 1000),
    ]


def frame(llm, rows):
    return llm.createDataFrame([(*r, "clash", 0, 1) for r in rows], SCHEMA)


def test_round_trip(llm):
    rows = pages()
    got = sorted((tuple(r) for r in round_trip(frame(llm, rows).repartition(3)).collect()), key=str)
    largest = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            largest[h] = max(i, largest.get(h, i))
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        revisit = h in largest and largest[h] != i
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", largest[h] if revisit else None))
    assert got == sorted(want, key=str)


def test_payloads_and_predicates(llm):
    path = shared_dir(llm, "warc-test")
    write_archive(page_records(frame(llm, pages()).repartition(4)), path)
    back = read_archive(llm, path)
    texts = {r["record_id"]: bytes(r["payload"]).decode() for r in back.where("record_type = 'response'").collect()}
    assert texts["urn:page:13"] == "z" * 2_000_000 and texts["urn:page:6"] == "" and texts["urn:page:3"].startswith("<p>é")
    revisits = back.where(F.col("record_type") == "revisit")
    assert {r["record_id"] for r in revisits.collect()} == {"urn:page:1", "urn:page:2", "urn:page:10"}
    assert "record_type" not in revisits._jdf.queryExecution().executedPlan().toString().split("Filter", 1)[-1] or revisits.count() == 4
    assert back.where("target_uri = 'http://a/4' and payload_bytes = 5").count() == 1
    assert back.where("content_length > 1000000").select("record_id").first()[0] == "urn:page:13"
    assert back.where(F.col("target_uri").isNull()).count() == 1
    assert read_archive(llm, path, payload=False).where(F.col("payload").isNotNull()).count() == 0


def test_empty(llm):
    assert round_trip(frame(llm, [])).count() == 0
