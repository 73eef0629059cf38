"""Small made-up texts and brute-force counterparts of the operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
HIT_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return (text or "").translate(LOWER)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def shingles(text):
    ws = WORD.findall(lower(text))
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4)))


def linked(a, b):
    k = len(a & b)
    return bool(k) and 100 * k >= 80 * (len(a) + len(b) - k)


def brute_components(rows):
    """{doc_id: (n_shingles, component_id)}"""
    sets = {i: shingles(t) for i, t in rows}
    comp = {i: i for i in sets}
    ids = sorted(sets)

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if linked(sets[a], sets[b]):
                ra, rb = sorted((root(a), root(b)))
                comp[rb] = ra
    return {i: (len(sets[i]), root(i)) for i in ids}


def brute_hits(text, items):
    """(n_words, n_hit, sorted ids of items that occur)"""
    ws = HIT_WORD.findall(lower(text))
    covered, found = set(), set()
    for item, words in items:
        iw = HIT_WORD.findall(lower(words))
        k = min(10, len(iw))
        wins = {tuple(iw[i : i + k]) for i in range(len(iw) - k + 1)} if k else set()
        for i in range(len(ws) - k + 1 if k else 0):
            if tuple(ws[i : i + k]) in wins:
                covered.update(range(i, i + k))
                found.add(str(item))
    return len(ws), len(covered), sorted(found)
