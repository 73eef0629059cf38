"""Language identification: the forward sum against all segmentations, held-out accuracy."""

import random
import zlib

import numpy as np
import pytest

from sparkmart.llm.language_id import UNKNOWN, PieceTable, identify, score_words, words

pytest.importorskip("public_tokenizers")


def test_forward_sums_all_segmentations():
    pieces = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "é"]
    prob = np.random.default_rng(0).random((len(pieces), 2))
    table = PieceTable(pieces, prob)
    place = {p: i for i, p in enumerate(pieces)}

    def brute(w):
        if not w:
            return np.ones(2)
        total = np.zeros(2)
        for k in range(1, len(w) + 1):
            if w[:k] in place:
                total = total + prob[place[w[:k]]] * brute(w[k:])
            elif k == 1:
                total = total + UNKNOWN * brute(w[1:])
        return total

    texts = ["Ab", "aba", "é", "zab", "abab ba", ""]
    cp, start, end, per_text = words(texts)
    assert per_text.tolist() == [1, 1, 1, 1, 2, 0]
    got = score_words(cp, start, end, table)
    flat = [w for t in texts for w in t.lower().split()]
    assert got == pytest.approx(np.log([brute("▁" + w) for w in flat]))


def test_words_are_letter_runs():
    cp, start, end, n = words(["It's 3x", "É" * 40, "!?", "", "日本"])
    run = ["".join(map(chr, cp[a:b])) for a, b in zip(start, end, strict=True)]
    assert run == ["it", "s", "x", "é" * 32, "é" * 8, "日本"] and n.tolist() == [3, 2, 0, 0, 1]


PARTS = {"en": "the and with tion ing ed er th wh of".split(), "fr": "que les ment eau eux é è ou la de".split(), "de": "der die und ung heit ß ein sch ch".split()}


def corpus(n=300):
    rng = random.Random(2)
    out = []
    for i in range(n):
        lang = rng.choice(list(PARTS))
        out.append((i, " ".join("".join(rng.choices(PARTS[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(5, 60))), lang))
    return out


def test_held_out_accuracy(frame):
    rows = corpus()
    df = frame([(i, t) for i, t, _ in rows], langs=[g for *_, g in rows])
    truth = {i: g for i, _, g in rows}
    got = identify(df.selectExpr("*", "'zz' as lang_pred", "0 as score", "1 as piece")).collect()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    out = [r for r in got if r["held_out"]]
    assert len(out) > 40 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) / len(out) >= 0.97


def test_held_out_labels_are_never_learned(frame):
    rows = corpus(120)
    held = {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    wrong = frame([(i, t) for i, t, _ in rows], langs=["xx" if i in held else g for i, _, g in rows])
    right = frame([(i, t) for i, t, _ in rows], langs=[g for *_, g in rows])
    pick = lambda df: {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(df).collect()}
    assert pick(wrong) == pick(right)


def test_edge_rows(frame):
    assert identify(frame([])).count() == 0
    rows = [(1, None), (2, ""), (3, "12 !?"), (None, "the and"), (4, "the " * 20_000), (5, "q" * 5000), (4, "the and")]
    got = identify(frame(rows)).collect()  # no labels at all
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    got = identify(frame(rows + [(8, "the and of"), (9, "der die und")], langs=[None] * 7 + ["en", "de"])).collect()
    assert [r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)] == ["und"] * 3
    assert {r["lang_pred"] for r in got if r["doc_id"] in (None, 4)} == {"en"}


def test_marks_alone_are_no_word():
    from sparkmart.llm.language_id import words

    assert words(["́̂ 123", "é ́", "", "a1b"])[3].tolist() == [0, 1, 0, 2]
