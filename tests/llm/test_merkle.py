"""Merkle manifest against a direct build; closed-form positions against a sequential log."""

import random
import zlib
from hashlib import sha256

import pytest

from sparkmart.llm.merkle import FAN, LogBuilder, build, document_proofs, height, leaves, log_nodes, position, run_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    parts = []
    for v in (doc_id, source, lang, n_chars, text):
        s = None if v is None else str(v)
        parts.append("-" if s is None else f"{len(s.encode())}:{s}")
    return h("".join(parts))


def climb(nodes):
    """(root, per leaf its (left, right) siblings per level)"""
    steps, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, j in enumerate(at):
            s = j - j % 16
            steps[k].append(("".join(level[s:j]), "".join(level[j + 1 : s + 16])))
            at[k] = j // 16
        level = [h(*level[s : s + 16]) for s in range(0, len(level), 16)]
    return level[0], steps


def brute(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        own = sorted((r for r in rows if r[3] == s), key=key)
        trees.append((own, *climb([leaf(r, r[1]) for r in own])))
    root, upper = climb([t[1] for t in trees])
    out = []
    for (own, sub, steps), above in zip(trees, upper, strict=True):
        for r, st in zip(own, steps, strict=True):
            text = r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            node = leaf(r, text)
            for a, b in (*st, *above):
                node = h(a, node, b)
            out.append((r[0], leaf(r, r[1]), sub, root, h(*(a + b for a, b in (*st, *above))), node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4095, 4096, 4097, 5000])
def test_closed_form_positions(n):
    levels = height(n)
    builder = LogBuilder(levels)
    names = iter(range(n))
    for k in names:
        builder.append(str(k).encode())
    log = builder.finish()
    assert len(log) == n + sum(-(-n // FAN**k) for k in range(1, levels + 1))
    level = [str(k).encode() for k in range(n)]
    for depth in range(levels + 1):
        for j, node in enumerate(level):
            assert log[position(min((j + 1) * FAN**depth, n) - 1, depth)] == node
        below, level = level, [sha256(b"".join(level[s : s + FAN])).hexdigest().encode() for s in range(0, len(level), FAN)]
    assert log[-1] == below[0]
    own, run = run_of(log, n - 1, 0, n)
    assert run[own] == log[position(n - 1, 0)] and own == (n - 1) % FAN


def rows_of(collected):
    return sorted((tuple(r) for r in collected), key=str)


def test_small_table(llm):
    rng = random.Random(5)
    text = lambda: rng.choice(["Ab c", "low", "", None, "É Ü Z", "long " * 500 + "Q"])
    rows = [(i, text(), rng.choice(["en", None]), rng.choice(["a", "b", "é", "", None]), rng.choice([1, None])) for i in range(900)]
    rows += [(1000 + i, "X", "en", f"only{i}", 1) for i in range(40)]  # lone documents
    rows += [(None, "N", None, "a", None), (None, "M", None, "a", None), (5, "Again", None, "a", None), rows[0], rows[0]]
    rng.shuffle(rows)
    df = llm.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as leaf", "'x' as tree", "2 as i", "0 as salt").repartition(4)
    assert rows_of(document_proofs(df).collect()) == brute(rows)


def test_hot_source_over_several_segments(llm):
    rows = [(i, f"T{i % 7}", "en", "hot", 3) for i in range(9000)] + [(20_000 + i, "t", "en", f"s{i:05d}", 1) for i in range(5000)]
    got = rows_of(document_proofs(llm.createDataFrame(rows, SCHEMA).repartition(6)).collect())
    assert got == brute(rows)
    ids = {r[0] for r in got if not r[-1]}
    assert ids == {i for i in range(9000) if zlib.crc32(str(i).encode()) % 5 == 0}


def test_log_is_gapless(llm):
    rows = [(i, "t", "en", "hot", 3) for i in range(4200)] + [(20_000 + i, "t", "en", "s", 1) for i in range(20)]
    manifest = build(leaves(llm.createDataFrame(rows, SCHEMA)))
    at = {}
    for r in log_nodes(manifest).collect():
        at.setdefault(r["tree"], {})[r["position"]] = r["node"]
    assert sorted(at[1]) == list(range(20 + 2 + 1))
    # The hot source's upper nodes (levels 4 and on) stand in the segments above.
    assert len(at[0]) == 4200 + 263 + 17 + 2 and max(at[0]) == position(4199, 3)


def test_lone_and_empty(llm):
    rows = [(10, "A", None, None, None)]
    assert rows_of(document_proofs(llm.createDataFrame(rows, SCHEMA)).collect()) == brute(rows)
    assert brute(rows)[0][4] == sha256(b"").hexdigest()
    assert document_proofs(llm.createDataFrame([], SCHEMA)).count() == 0
