"""Line dedup against a dictionary of keys."""

import hashlib
import random

from sparkmart.llm.line_dedup import dedup_digests, keep_bitmaps, kept_lines, line_hashes, recurring

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return line.strip(SPACE).translate({c: c + 32 for c in range(65, 91)})


def brute(rows):
    docs = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if i is not None and len(k) >= 40:
                docs.setdefault(k, set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if i is None or len(docs.get(key(x), ())) < 5 or max(docs[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def rows():
    rng = random.Random(12)
    shared = ["É" + "x" * 38 + str(k) for k in range(6)] + ["y" * 39, "Z" * 40, "é" * 39, "é" * 40]
    out = []
    for i in range(60):
        lines = [rng.choice([f"own line {rng.random()}", "", "short", *shared]) for _ in range(rng.randrange(20))]
        lines = [f"\t{x.upper()} \r" if x.isascii() and rng.random() < 0.3 else x for x in lines]
        out.append((i, "\n".join(lines)))
    out += [(100, None), (101, ""), (102, "\n\n"), (None, "\n".join(shared)), (103, "Z" * 40 + "\n" + "z" * 40), (3, out[3][1])]
    out += [(200 + k, "w" * 200_000 + "\n" + "Z" * 40) for k in range(6)]
    rng.shuffle(out)
    return out


def test_against_brute_force(frame):
    data = rows()
    df = frame(data).selectExpr("*", "1 as h1", "'x' as pos", "2 as keep", "3 as n_dropped").repartition(4)
    assert sorted((tuple(r) for r in dedup_digests(df).collect()), key=str) == brute(data)


def test_hot_line_over_many_partitions(frame, llm):
    hot = "the very same long line in every one of these documents"
    df = frame([(i, f"{hot}\nown {i}") for i in range(3000)])
    width = llm.conf.get("spark.sql.shuffle.partitions")
    llm.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = recurring(line_hashes(df)).collect()
        assert [r["keeper"] for r in found] == [2999]
        lost = keep_bitmaps(df).collect()
    finally:
        llm.conf.set("spark.sql.shuffle.partitions", width)
    assert len(lost) == 2999 and all(r["n_dropped"] == 1 for r in lost)
    assert kept_lines(f"{hot}\nown 1".encode(), bytes(lost[0]["keep"])) == (2, b"own 1")


def test_empty(frame):
    assert dedup_digests(frame([])).count() == 0
