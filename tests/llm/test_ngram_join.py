"""The Jaccard join against all pairs, its prefix bound and its components."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from sparkmart.llm.components import components
from sparkmart.llm.ngram_join import link_components, parities, partitions, representatives, shingle_sets, signatures, size_classes
from texts import brute_components, prose, shingles


def edited(rng, text, edits):
    ws = text.split()
    for _ in range(edits):
        ws[rng.randrange(len(ws))] = f"x{rng.randrange(10_000)}"
    return " ".join(ws)


def corpus():
    rng = random.Random(3)
    out, common = [], prose(rng, 40)
    for k in range(12):  # near copies in chains, around the threshold
        base = prose(rng, rng.choice([30, 60, 120]))
        for j in range(8):
            out.append(edited(rng, base, rng.randrange(0, 4)))
            if j % 3 == 2:
                base = out[-1]
    out += [f"{common} {prose(rng, 15)}" for _ in range(25)]  # a shared passage, mostly below the threshold
    base = prose(rng, 90)
    out += [edited(rng, base, 1) for _ in range(60)]  # one large group of near copies
    out += [out[0]] * 5 + ["one two three", "One  TWO\tthree", "a b c d e", "", None, "  \n", "word"]
    rng.shuffle(out)
    return list(enumerate(out))


def test_components_match_all_pairs(frame):
    rows = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in link_components(frame(rows)).collect()}
    assert got == brute_components(rows)


def test_edge_rows(frame, llm):
    empty = frame([])
    assert link_components(empty).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None), (3, "a B c D e f")]
    df = frame(rows).selectExpr("*", "1L as id", "2 as n", "array(1) as prefix", "'x' as region", "0 as comp")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in link_components(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, None), (2, 0, 2), (3, 2, 1)], key=str)
    kept = representatives(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 1, None, 2], key=str)


def test_long_text(frame):
    rng = random.Random(5)
    long = prose(rng, 30_000, 5000)
    rows = [(1, long), (2, edited(rng, long, 200)), (3, prose(rng, 30_000, 5000))]
    got = {r["doc_id"]: r["component_id"] for r in link_components(frame(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_size_classes():
    starts = size_classes()
    for n in [*range(1, 400), 12_345]:
        c = np.searchsorted(starts, [n, 100 * n // 80], side="right") - 1
        assert c[1] - c[0] <= 1


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 21, 40, 100, 700])
def test_linked_sets_share_a_signature(n):
    rng = np.random.default_rng(n)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        # The most distant partners allowed: drop, replace or add shingles up to the threshold.
        drop = int(rng.integers(0, n // 9 + 2))
        kept = rng.permutation(a)[: max(1, len(a) - drop)]
        add = max(0, 100 * len(kept) // 80 - len(a))
        add = int(rng.integers(max(0, add - 1), add + 1))
        b = np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, add, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]))
        inter = len(np.intersect1d(a, b))
        if 100 * inter >= 80 * (len(a) + len(b) - inter):
            x, y = signatures([a, b])
            assert len(np.intersect1d(x, y)), (len(a), len(b), inter)
    parts, emitted = partitions(np.array([n]), np.array([(np.searchsorted(size_classes(), n, side="right") - 1) // 3]))
    assert 0 < emitted[0] <= parts[0] and math.ceil(0.25 * n) + 1 >= emitted[0]


def test_a_passage_of_thousands_of_unrelated_texts(frame):
    rng = random.Random(12)
    passage = prose(rng, 60, 5000)
    rows = [(i, f"{prose(rng, rng.randrange(20, 90), 20_000)} {passage} {prose(rng, rng.randrange(20, 90), 20_000)}") for i in range(3000)]
    rows += [(5000 + i, rows[i][1] + " more") for i in range(0, 100, 10)]
    trace = []
    got = {r["doc_id"]: r["component_id"] for r in link_components(frame(rows).repartition(16), trace=trace).collect()}
    assert {i: c for i, c in got.items() if c != i} == {5000 + i: i for i in range(0, 100, 10)}
    assert sum(trace) < 20 * len(rows), trace  # all pairs would be 4.5 million


def test_many_edits_of_one_short_text(frame):
    rng = random.Random(21)
    base = prose(rng, 45, 5000)
    rows = [(i, edited(rng, base, rng.randrange(4, 7))) for i in range(900)]
    rows += [(2000 + i, rows[i][1] + " more") for i in range(0, 90, 10)]
    trace = []
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in link_components(frame(rows).repartition(16), trace=trace).collect()}
    assert got == brute_components(rows)
    assert sum(trace) < 20 * len(rows), trace  # all pairs would be 0.4 million


def test_parities_bound_the_difference():
    rng = np.random.default_rng(9)
    sets = [np.unique(rng.integers(0, 1 << 63, int(k), dtype=np.uint64)) for k in (0, 1, 5, 60, 60, 700, 20_000)]
    sets += [np.union1d(sets[4][5:], sets[1]), np.union1d(sets[6][50:], sets[3])]
    odd = parities(sets)
    for a, x in zip(sets, odd, strict=True):
        for b, y in zip(sets, odd, strict=True):
            turned = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
            assert turned <= len(np.setxor1d(a, b)) and turned % 2 == (len(a) + len(b)) % 2
    assert parities([]).shape == (0, odd.shape[1])


def test_shingle_sets_count_as_brute_force():
    rng = random.Random(8)
    texts = [prose(rng, n, 7) for n in range(30)] + ["É é A a", "x\u00a0y z", None]
    got = [len(s) for s in shingle_sets(pa.array(texts, pa.string()))]
    assert got == [len(shingles(t)) for t in texts]
    a, b = shingle_sets(pa.array(["A b C", "a B c"]))
    assert np.array_equal(a, b)


def test_components_of_a_chain_and_a_star(llm):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(50)]
    links = llm.createDataFrame(chain + star + chain[:3], "u long, v long")
    got = {r["id"]: r["comp"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(51)}}
    assert components(links.limit(0)).count() == 0
