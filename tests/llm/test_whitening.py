"""Whitening against numpy on the expanded vectors."""

import random

import numpy as np
import pytest

from sparkmart.llm.whitening import component_rows, deviations, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(vectors):
    x = np.floor(64 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    return x, n, s, e[::-1], (c @ u[:, ::-1])


def test_against_numpy(llm):
    rng = np.random.default_rng(3)
    base = (rng.normal(size=(300, 6)) * [5, 4, 3, 2, 1.5, 1] + 10).tolist()
    vectors = base + [base[0]] * 150 + base[:40]  # a third of all rows share a vector
    rows = [(i, v, 0) for i, v in enumerate(vectors)]
    odd = [(900, None, 0), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0), (902, [float("nan")] * 6, 0), (903, [float("inf")] * 6, 0), (904, [], 0), (905, [1.0], 0), (906, [3e38] * 6, 0)]
    more = [(None, base[5], 1), (0, base[6], 2)]
    rows = rows + odd + more
    random.Random(1).shuffle(rows)
    df = llm.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as x", "2 as k1", "'a' as weight").repartition(4)
    got = component_rows(df).collect()
    valid = [r[1] for r in rows if r[0] is None or r[0] < 900]
    x, n, s, e, y = expected(valid)
    assert len(got) == len(valid) * 6 and {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-9 and len({r["identity_error"] for r in got}) == 1
    explained = e / e.sum()
    sign = {}
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    for r, row, white in zip([r for r in rows if r[0] is None or r[0] < 900], x, y / np.sqrt(e), strict=True):
        for k in range(6):
            found = by[(r[0], k + 1)]
            assert all(abs(f["explained"] - explained[k]) < 1e-12 for f in found)
            dev = sum(int(v) ** 2 for v in n * row - s)
            mine = [f for f in found if f["deviation"] == dev]
            assert mine
            if abs(white[k]) > 1e-6 and len(found) == 1:
                sign.setdefault(k, np.sign(white[k] * mine[0]["whitened"]))
                assert abs(mine[0]["whitened"] * sign[k] - white[k]) < 1e-9


def test_weights_one(llm):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(50, 3)).tolist()
    df = llm.createDataFrame([(i, v, 0) for i, v in enumerate(base + [base[0]] * 100)], SCHEMA)
    got = whiten(df, weights="one").collect()
    _, n, _, e, _ = expected(base)
    assert len(got) == 150 and {r["n"] for r in got} <= {n, len(set(map(tuple, expected(base)[0].tolist())))}
    assert got[0]["identity_error"] < 1e-9
    with pytest.raises(ValueError):
        whiten(df, weights="other")


def test_degenerate(llm):
    assert component_rows(llm.createDataFrame([], SCHEMA)).count() == 0
    assert component_rows(llm.createDataFrame([(1, None, 0)], SCHEMA)).count() == 0
    assert component_rows(llm.createDataFrame([(i, [1.0, 2.0], 0) for i in range(5)], SCHEMA)).count() == 0
    # A plane in three dimensions has two components.
    rows = [(i, [float(i), float(i % 3), float(i)], 0) for i in range(9)]
    got = component_rows(llm.createDataFrame(rows, SCHEMA)).collect()
    assert {r["component"] for r in got} == {1, 2} and abs(sum({r["component"]: r["explained"] for r in got}.values()) - 1) < 1e-9


def test_long_vectors(llm):
    rng = np.random.default_rng(6)
    rows = [(i, v, 0) for i, v in enumerate(rng.normal(size=(120, 700)).tolist())]
    got = whiten(llm.createDataFrame(rows, SCHEMA)).collect()
    assert all(len(r["whitened"]) == 32 for r in got) and got[0]["identity_error"] < 1e-8


def test_deviation_beyond_a_long():
    x = np.array([[1 << 30, 0], [0, 0]])
    assert deviations(x, 8, np.array([0, 0])) == [None, 0]
    assert deviations(x, 2, np.array([3, 1])) == [(2 * (1 << 30) - 3) ** 2 + 1, 10]
