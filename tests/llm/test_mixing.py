"""Targets against step-by-step resharing; rounding against its invariants."""

import random

import pytest

from sparkmart.llm.mixing import CAP, SHARE, WEIGHTS, mix, pivotal_rounding, targets
from texts import WORD


def brute_targets(sizes):
    """Share by weight, stop at the cap, reshare the excess until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, full = SHARE * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > CAP * sizes[s]]
        if not over:
            return {**full, **share}
        full.update({s: CAP * sizes[s] for s in over})


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 90, None: 40}, {"a": 5, "b": 0, "c": 1000, "d": 3, "e": 77}, {"x": 9}, {"a": 4, "b": 4, "c": 4}])
def test_targets(llm, sizes):
    df = llm.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def rows(n=900):
    rng = random.Random(2)
    texts = [" ".join("w" * rng.randrange(1, 9) for _ in range(int(rng.expovariate(1 / 60)))) for _ in range(n)]
    return [(i, t if i % 97 else None) for i, t in enumerate(texts)], [("big" if i % 3 else f"s{i % 11}") if i % 13 else None for i in range(n)]


def test_mix(frame):
    docs, sources = rows()
    df = frame(docs, sources=sources).selectExpr("*", "1 as size", "2 as target", "'k' as key", "3 as x", "4 as copies", "5 as bucket")
    got = mix(df).collect()
    assert len(got) == len(docs)
    size = {i: len(WORD.findall(t or "")) for i, t in docs}
    total = {}
    for (i, _), s in zip(docs, sources, strict=True):
        total[s] = total.get(s, 0) + size[i]
    want = brute_targets(total)
    taken = {}
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        ratio = want[r["source"]] / total[r["source"]] if total[r["source"]] else 0
        assert int(ratio) <= r["copies"] <= int(ratio) + 1 or r["copies"] == round(ratio)
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in taken.items():  # off by one document at most
        assert abs(t - want[s]) <= max(size[i] for (i, _), x in zip(docs, sources, strict=True) if x == s) + 1e-6
    again = {r["doc_id"]: r["taken"] for r in mix(df.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_rounding_keeps_mass_and_probabilities(llm):
    items = [("s", i, 1.0 + i % 5, 0.3) for i in range(2000)]
    df = llm.createDataFrame(items, "stratum string, key long, size double, x double")
    ups = {r["key"]: r["up"] for r in pivotal_rounding(df, fan=20).collect()}
    assert set(ups) == {i for _, i, _, _ in items}
    mass = sum(s * ups[i] for _, i, s, _ in items)
    assert abs(mass - sum(s * x for _, _, s, x in items)) <= 5.0
    for k in range(5):  # every size is taken about as often as its probability says
        share = [ups[i] for _, i, _, _ in items if i % 5 == k]
        assert 0.2 < sum(share) / len(share) < 0.4


def test_edge_rows(frame):
    assert mix(frame([])).count() == 0
    got = mix(frame([(1, None), (2, ""), (None, "a b"), (4, "a"), (4, "a")])).collect()
    assert len(got) == 5
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert all(r["taken"] <= 2 * r["size"] for r in got)


def test_null_and_repeated_ids_are_documents_of_their_own(llm, frame):
    from sparkmart.llm.stages import COLUMNS, mix_sources

    texts = [f"{'w ' * (1 + i % 40)}{i}" for i in range(600)]
    ids = [None if i % 3 == 0 else 7 if i % 3 == 1 else 1000 + i for i in range(600)]
    docs = list(zip(ids, texts, strict=True)) + [(None, "same words here")] * 60 + [(7, "other same words")] * 60
    df = frame(docs, sources=["a" if i % 2 else "b" for i in range(len(docs))])
    size = [len(WORD.findall(t)) for _, t in docs]
    total = {s: sum(n for i, n in enumerate(size) if ("a" if i % 2 else "b") == s) for s in "ab"}
    want = brute_targets(total)
    got = mix(df).collect()
    assert len(got) == len(docs)
    for s in "ab":
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - want[s]) <= max(size) + 1e-6
    out = mix_sources(llm, df, "")
    assert tuple(out.columns) == COLUMNS
    rows = out.collect()
    assert len(rows) == sum(r["copies"] for r in got)
    assert sum(len(WORD.findall(r["text"])) for r in rows) == sum(r["taken"] for r in got)
    assert {r["doc_id"] is None for r in rows} == {True, False}
    most = {t: 0 for _, t in docs}
    for r in rows:
        most[r["text"]] += 1
    assert all(most[t] <= 2 for t in texts) and most["same words here"] <= 120
    # Rows with unlike texts keep their copies however the table is dealt.
    unlike = df.where("text not like '%same words%'")
    again = [sorted((r["text"], r["doc_id"] or 0) for r in mix_sources(llm, x, "").collect()) for x in (unlike, unlike.repartition(5))]
    assert again[0] == again[1]
