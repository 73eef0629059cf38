"""The cascade: base columns against counting by hand, order without effect on the verdict."""

import random
import re

from pyspark.sql import functions as F

from sparkmart.llm.quality_rules import RULES, base_columns, judge, order_rules, verdict
from texts import WORD, prose


def brute(text):
    ws = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(ws) - 7):
        at.setdefault(tuple(ws[i : i + 8]), []).append(i)
    hit = {p for x in at.values() if len(x) > 1 for i in x for p in range(i, i + 8)}
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


def texts():
    rng = random.Random(4)
    plain = prose(rng, 60)
    return [
        plain, None, "", " \n\t", "a b c", prose(rng, 8), prose(rng, 19), prose(rng, 20),
        " ".join([prose(rng, 9)] * 3), plain + "\n" + plain, "x " * 40, plain + "\n" + "é ü#*$ |<>&% ñ" + "\n\n" + plain[:50],
        "the same line here\n" * 12 + plain, plain.upper(), prose(rng, 3000, 12), "\u00a0a\u2003b", " ".join("123" for _ in range(30)),
    ]


def test_base_columns(frame):
    rows = list(enumerate(texts()))
    got = {r["doc_id"]: r for r in base_columns(frame(rows)).collect()}
    for i, t in rows:
        r = got[i]
        want = brute(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, i
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def test_order_changes_nothing(frame):
    rng = random.Random(6)
    rows = list(enumerate(texts() + [prose(rng, rng.randrange(10, 80)) for _ in range(40)]))
    df = base_columns(frame(rows))
    a = {r["doc_id"]: r["k"] for r in df.select("doc_id", verdict(RULES).alias("k")).collect()}
    b = {r["doc_id"]: r["k"] for r in df.select("doc_id", verdict(RULES[::-1]).alias("k")).collect()}
    c = {r["doc_id"]: r["kept"] for r in judge(frame(rows)).collect()}
    assert a == b == c
    assert c[0] and not c[1] and not c[10] and not c[13]
    ordered = order_rules(frame(rows), RULES)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in RULES)


def test_filter_on_the_verdict_and_clashing_columns(frame):
    df = frame(list(enumerate(texts()))).selectExpr("*", "'x' as n_words", "7 as kept")
    out = judge(df)
    want = {r["doc_id"] for r in out.collect() if r["kept"] is True}
    assert {r["doc_id"] for r in out.where("kept").select("doc_id").collect()} == want
    assert out.where(F.col("n_words") == 60).count() >= 1


def test_empty_and_repeated_rows(frame):
    assert judge(frame([])).count() == 0
    t = texts()[0]
    assert [r["kept"] for r in judge(frame([(1, t), (1, t), (None, t)])).collect()] == [True] * 3
