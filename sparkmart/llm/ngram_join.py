"""N-gram Jaccard join: pivots, Voronoi regions with triangle-inequality windows, recursion.

Documents are points of the Jaccard metric (distance 1 - similarity of their
sets of word shingles).  Equal sets form one point (classes by a 128-bit
digest); a link is a pair of points at distance at most ``eps``.

First regions.  Almost all points are at distance 1 of each other, where no
pivot separates them, so the first regions come from the sets: the hash range is
cut into more parts than linked sets can have different shingles, so linked
sets hold the same shingles in some part (``signatures``).  All points that list
a part with the same contents form a region; regions with the same members are
one.  A part holds several shingles, so unrelated texts that share a passage
seldom meet; parts that a sample of the documents shows to be frequent are the
first that a set may leave out.

A first step links every point with one pivot, the smallest point of the
regions it shares most shingles in, if they are near.

Recursion.  In each region pivots are drawn and the distance of the other
points to them is computed exactly.  Bounds come first: the join of points and
pivots makes a pair only if their sizes and the parities of their shingles
(``parities``) allow the similarity, then histograms are compared, then sets.
A point within ``eps`` of a pivot is
linked with it and belongs to the cell of its nearest one (its Voronoi
region).  A pair of links can join a cell's point only with points within
``2 eps`` of its pivot (triangle inequality), so these boundary points are
replicated into the cell; points beyond ``eps`` of all pivots form the outer
region.  Cells and outer region are the regions of the next round.  Pairs
already connected need no test: a region whose points are all in one
component is done, so a group of thousands of near copies costs a distance
per point, not per pair.  The share of pivots grows from round to round and
reaches all points, so the recursion ends with every link found or implied.

Results: components of the links, exact up to collisions of 64-bit shingle
hashes.

Defined results: null texts and texts without words have no shingles and link
with nothing; a text with fewer words than a shingle is one shingle; rows with
null doc_id have null component_id; repeated rows of one doc_id are one
document; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache, reduce
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.llm.arrowtext import LOWER, hash_spans, mix64, shards, text_bytes, words_of
from sparkmart.llm.common import broadcast_checked, made, release, sized, stored
from sparkmart.llm.components import components

#: Words per shingle; links need 100 * intersection >= PERCENT * union.
WORDS = 5
PERCENT = 80
#: Text bytes handled at once.
SHARD_BYTES = 2 * 1024 * 1024
#: Size classes from one size space to the next; parts beyond the largest difference, in percent of it.
STEP = 3
SPARE = 20
#: Parts are counted on one document in so many; these counts and more are hot; entries of the broadcast table of hot parts (8 bytes each).
SAMPLED = 16
HOT_COUNT = 3
HOT_PARTS = 1 << 20
#: Longs of parities per set; unrelated sets of up to twice as many shingles as these have bits are told apart.
PARITY_WORDS = 8
PARITIES = f"struct<{', '.join(f'w{i}: long' for i in range(PARITY_WORDS))}>"
#: Pairs of one pivot tested by one task, about.
PIVOT_PAIRS = 2000
#: Points from which on regions with mostly the same members are joined.
LARGE_REGION = 32
#: Pivots drawn per region in the first round; four times as many in each later one.
PIVOTS = 16

IS_WORD = np.ones(256, np.bool_)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def shingle_sets(col: pa.Array, words: int = WORDS):
    """Sorted distinct 64-bit shingle hashes of each text."""
    raw, offsets = text_bytes(col)
    buf = LOWER[raw]
    starts, ends, per_text = words_of(buf, offsets, IS_WORD)
    h = hash_spans(buf, starts, ends)
    factors = mix64(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    grams = np.zeros(len(h), np.uint64)
    for k in range(words):
        grams[: len(h) - k] += h[k:] * factors[k]
    grams = mix64(grams)
    stop = np.cumsum(per_text)
    for a, b in zip((stop - per_text).tolist(), stop.tolist(), strict=True):
        if b - a >= words:
            yield np.unique(grams[a : b - words + 1])
        elif b > a:  # fewer words: the whole sequence
            yield mix64((h[a:b] * factors[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield grams[:0]


def signature(hashes: np.ndarray) -> bytes:
    """Shingles per bucket of the hash range, a byte each (255: so many or more); about a bucket per shingle."""
    bits = max(6, min(13, len(hashes).bit_length() - 1))
    counts = np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """Per set ``PARITY_WORDS`` longs: for each of their bits, whether an odd number of shingles falls on it.

    A shingle in only one of two sets turns one bit, so two sets differ in at
    least as many shingles as their parities differ in bits.
    """
    bits = 64 * PARITY_WORDS
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    place = np.concatenate(sets).astype(np.int64) & (bits - 1) if sets else np.zeros(0, np.int64)
    place += np.repeat(np.arange(len(sets)) * bits, sizes)
    odd = (np.bincount(place, minlength=len(sets) * bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(len(sets), PARITY_WORDS)


def _may_reach(n: Column, a: str, other: Column, b: str, least: int) -> Column:
    """Whether the sizes and the parities ``a`` and ``b`` of two sets allow ``least`` percent of similarity."""
    turned = [F.bit_count(F.col(f"{a}.w{i}").bitwiseXOR(F.col(f"{b}.w{i}"))) for i in range(PARITY_WORDS)]
    apart = reduce(lambda x, y: x + y, turned)
    return (100 * F.least(n, other) >= least * F.greatest(n, other)) & ((100 + least) * apart <= (100 - least) * (n + other))


def overlap_bound(a: bytes, b: bytes) -> int:
    """At most so many shingles are in both sets, by their signatures; -1 when these can't tell."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if not len(x) or not len(y) or max(x.max(), y.max()) == 255:
        return -1
    n = min(len(x), len(y))
    x, y = (v.reshape(n, -1).sum(axis=1, dtype=np.int64) for v in (x, y))
    return int(np.minimum(x, y).sum())


@F.pandas_udf(T.LongType())
def _bound(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([overlap_bound(x, y) for x, y in zip(a, b, strict=True)], dtype="int64")


@lru_cache(maxsize=8)
def size_classes(percent: int = PERCENT) -> np.ndarray:
    """Smallest sizes of the size classes; a set of one class links only with sets of this class and its neighbours."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(100 * starts[-1] // percent + 1)
    return np.array(starts, np.int64)


def partitions(n: np.ndarray, space: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(parts, emitted) of sets of ``n`` shingles in their size space.

    Linked sets of ``a`` and ``b`` shingles differ in at most
    ``(a + b) (100 - percent) / (100 + percent)``; a set of the space meets no
    larger partner than the space's top.
    """
    starts = size_classes(percent)
    top = starts[np.minimum(space * STEP + STEP + 1, len(starts) - 1)] - 1
    apart = lambda total: total * (100 - percent) // (100 + percent)
    most = apart(2 * top)
    parts = most + 3 + most * SPARE // 100
    emitted = apart(n + np.minimum(top, 100 * n // percent)) + 1
    return parts, emitted


def signatures(sets: list[np.ndarray], percent: int = PERCENT, hot: np.ndarray | None = None, whole: bool = False) -> list[np.ndarray]:
    """Hashes of parts per set; linked sets share one.

    Size spaces are ``STEP + 1`` neighbouring classes, with one class in
    common, so linked sets meet in a space.  There the hash range is cut into
    more parts than linked sets can differ in, so at least
    ``parts - difference`` parts are the same in both.  Each set may leave out
    all but ``emitted`` of its parts, those of the sorted array ``hot`` first, then
    the smallest: in one order of all possible parts, the set that leaves out
    more still lists one that is equal, and the other set lists it too.
    ``whole``: leave out only the empty ones.
    """
    out: list[list[np.ndarray]] = [[] for _ in sets]
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    classes = np.searchsorted(size_classes(percent), sizes, side="right") - 1
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    mixed, high = mix64(every), every >> np.uint64(32)
    for lower in (False, True):
        space = classes // STEP - lower
        own = (sizes > 0) & (space >= 0) & (~np.bool_(lower) | (classes % STEP == 0))
        if not own.any():
            continue
        space = np.where(own, space, 0)
        parts, emitted = partitions(sizes, space, percent)
        inside = own[owner]
        who, values = owner[inside], mixed[inside]
        part = ((high[inside] * parts[who].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (part[1:] != part[:-1])]))
        held = np.diff(np.append(first, len(who)))
        who, part = who[first], part[first]
        place = mix64((space[who].astype(np.uint64) << np.uint64(40)) + part.astype(np.uint64) + np.uint64(1))
        marks = mix64(np.add.reduceat(values, first) + place)
        rank = -np.minimum(held, 255)
        if hot is not None and len(hot):
            rank[hot[np.minimum(np.searchsorted(hot, marks), len(hot) - 1)] == marks] += 512
        order = np.lexsort((marks, rank, who))
        who, marks = who[order], marks[order]
        filled = np.bincount(who, minlength=len(sets))
        begin = np.cumsum(filled) - filled
        keep = whole | (np.arange(len(who)) - begin[who] < emitted[who])
        cut = np.cumsum(np.bincount(who[keep], minlength=len(sets)))[:-1]
        for i, m in enumerate(np.split(marks[keep], cut)):
            if len(m):
                out[i].append(m)
        for i in np.flatnonzero(own & (filled < emitted) & (not whole)).tolist():  # empty parts come last
            part = ((sets[i] >> np.uint64(32)) * np.uint64(parts[i])) >> np.uint64(32)
            empty = np.setdiff1d(np.arange(parts[i], dtype=np.uint64), part)
            marks_ = mix64(mix64(np.uint64(int(space[i]) << 40) + empty + np.uint64(1)))
            out[i].append(np.sort(marks_)[: emitted[i] - filled[i]])
    return [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in out]


def _hot_parts(docs: DataFrame, words: int, percent: int, limit: int = HOT_PARTS) -> np.ndarray:
    """Sorted hashes of parts seen often in a sixteenth of the documents, at most ``limit``.

    They only steer which parts a set leaves out first; any table gives the same links.
    """

    def run(batches):
        for batch in shards(batches, 1, SHARD_BYTES):
            marks = np.concatenate(signatures(list(shingle_sets(batch.column(1), words)), percent, whole=True))
            yield pa.RecordBatch.from_arrays([pa.array(marks.view(np.int64))], ["part"])

    seen = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLED)) == 0).select("doc_id", "text").mapInArrow(run, "part long")
    counts = seen.repartition("part").groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= HOT_COUNT)
    counts = stored(counts, "part-counts")
    held = counts.groupBy("n").agg(F.count(F.lit(1)).alias("k")).orderBy(F.col("n").desc())
    least, total = None, 0
    for row in held.toLocalIterator():  # from the highest count down, until the table is full
        if total + row["k"] > limit:
            break
        least, total = row["n"], total + row["k"]
    if least is None:
        return np.zeros(0, np.uint64)
    return np.sort(counts.where(F.col("n") >= least).select("part").toArrow().column("part").to_numpy().view(np.uint64))


def _points(docs: DataFrame, hot: np.ndarray, words: int, percent: int) -> DataFrame:
    """Per document (id, n, d1, d2, parts, sig, odd): size and digest of its set, the hashes of its parts, its histogram and parities."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        for batch in shards(batches, 1, SHARD_BYTES):
            sets = list(shingle_sets(batch.column(1), words))
            lists = signatures(sets, percent, shared.value)
            d = np.frombuffer(b"".join(blake2b(s.tobytes(), digest_size=16).digest() for s in sets), np.int64).reshape(-1, 2)
            cuts = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            parts = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(lists).view(np.int64)))
            sigs = pa.array([signature(s) for s in sets], pa.binary())
            odd = pa.StructArray.from_arrays([pa.array(w) for w in np.ascontiguousarray(parities(sets).T)], [f"w{i}" for i in range(PARITY_WORDS)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]), parts, sigs, odd],
                ["id", "n", "d1", "d2", "parts", "sig", "odd"],
            )

    return docs.mapInArrow(run, f"id long, n long, d1 long, d2 long, parts array<long>, sig binary, odd {PARITIES}")


def _sets(docs: DataFrame, wanted: DataFrame, key: str, row_bytes: int, words: int) -> DataFrame:
    """``wanted`` (key, p, ...) with the shingle set of document ``key``; longs only."""
    names = wanted.columns
    wanted = wanted.withColumnRenamed(key, "__key")
    found = docs.join(broadcast_checked(wanted, row_bytes), F.col("doc_id") == F.col("__key"))
    found = found.select(*[F.col("__key" if c == key else c).alias(c) for c in names], "text")
    at = len(names)

    def run(batches):
        for batch in shards(batches, at, SHARD_BYTES):
            sets = list(shingle_sets(batch.column(at), words))
            cuts = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat))], [*names, "set"])

    return found.mapInArrow(run, ", ".join(f"{c} long" for c in names) + ", set array<long>")


def _tested(docs: DataFrame, points: DataFrame, pairs: DataFrame, least: int, words: int) -> DataFrame:
    """``pairs`` (id, p, n, np) of similarity ``least`` percent or more, with the size of their intersection.

    Sizes and signatures bound the intersection from above; the sets of the
    pairs left are made from the texts and meet at the pivot, so every pair
    moves one set.
    """
    pairs = stored(pairs.where(100 * F.least("n", "np") >= least * F.greatest("n", "np")), "pairs")
    few = broadcast_checked(pairs.withColumnRenamed("id", "__id"), 48)
    pairs = points.select("id", F.col("sig").alias("sa")).join(few, F.col("id") == F.col("__id")).drop("__id")
    ends = broadcast_checked(few.select("p").distinct(), 16)
    sigs = points.select(F.col("id").alias("__id"), F.col("sig").alias("sb")).join(ends, F.col("__id") == F.col("p"), "left_semi")
    pairs = pairs.join(sigs, F.col("p") == F.col("__id")).drop("__id")
    pairs = pairs.withColumn("bound", _bound("sa", "sb"))
    possible = (F.col("bound") < 0) | (100 * F.col("bound") >= least * (F.col("n") + F.col("np") - F.col("bound")))
    left = stored(pairs.where(possible).select("id", "p", "n", "np"), "pairs-left")
    # A pivot of very many pairs is dealt to several tasks, its set to each of them.
    shares = left.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / PIVOT_PAIRS).cast("long").alias("shares"))
    shares = stored(sized(shares, left.count()), "pivot-shares")
    spread = left.join(broadcast_checked(shares.withColumnRenamed("p", "__p"), 32), F.col("p") == F.col("__p"))
    spread = spread.withColumn("salt", F.pmod(F.xxhash64("id"), "shares")).select("id", "p", "n", "np", "salt")
    sets = _sets(docs, spread, "id", 48, words)
    copies = stored(shares.select("p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("__salt")), "pivot-copies")
    pivots = _sets(docs, copies, "p", 32, words).select(F.col("p").alias("q"), "__salt", F.col("set").alias("pivot"))
    met = (F.col("p") == F.col("q")) & (F.col("salt") == F.col("__salt"))
    both = sets.join(pivots, met).withColumn("inter", F.size(F.array_intersect("set", "pivot")).cast("long"))
    # The smaller value if a doc_id has several texts; one row per pair either way.
    both = both.groupBy("id", "p", "n", "np").agg(F.min("inter").alias("inter"))
    return both.where(100 * F.col("inter") >= least * (F.col("n") + F.col("np") - F.col("inter")))


def _distinct_regions(members: DataFrame) -> DataFrame:
    """One region of those with the same members; ``weight`` adds up."""
    marks = members.groupBy("region").agg(
        F.count(F.lit(1)).alias("k"), F.min("id").alias("lo"), F.max("id").alias("hi"), F.max("weight").alias("w"),
        F.bit_xor(F.xxhash64(F.lit(6), "id")).alias("s"), F.bit_xor(F.xxhash64(F.lit(7), "id")).alias("x"),
    )
    kept = marks.where("k > 1").groupBy("k", "lo", "hi", "s", "x").agg(F.min("region").alias("region"), F.sum("w").alias("w"))
    kept = stored(sized(kept.select(F.col("region").alias("__region"), "w"), members.count()), "regions")
    rows = members.join(broadcast_checked(kept, 24), F.col("region") == F.col("__region"))
    return rows.select("region", "id", "n", F.col("w").alias("weight"))


def _joined_regions(members: DataFrame, turn: int) -> DataFrame:
    """Large regions with mostly the same members become one, so that their pairs are met once.

    Two minima of hashed members agree with the squared share of common ones;
    a union misses no pair.
    """
    members = stored(members, "all-regions")
    marks = members.groupBy("region").agg(F.count(F.lit(1)).alias("k"), *[F.min(F.xxhash64(F.lit(1000 + 2 * turn + j), "id")).alias(f"m{j}") for j in (0, 1)])
    large = marks.where(F.col("k") >= LARGE_REGION).select(F.col("region").alias("__region"), F.xxhash64(F.lit(5), "m0", "m1").alias("__joined"))
    large = stored(large, "large-regions")
    renamed = members.join(broadcast_checked(large, 24), F.col("region") == F.col("__region"), "left")
    renamed = renamed.select(F.coalesce("__joined", "region").alias("region"), "id", "n", "weight")
    return renamed.groupBy("region", "id", "n").agg(F.sum("weight").alias("weight"))


def _met(points: DataFrame, pivots: DataFrame, least: int) -> DataFrame:
    """(region, id, p, n, np) of the pivots and the points of other components whose sizes and parities allow ``least`` percent."""
    reach = pivots.withColumnRenamed("region", "r")
    met = (F.col("region") == F.col("r")) & (F.col("id") != F.col("p")) & (F.col("comp") != F.col("cp"))
    met = met & _may_reach(F.col("n"), "odd", F.col("np"), "oddp", least)
    return points.join(broadcast_checked(reach, 56 + 8 * PARITY_WORDS), met).select("region", "id", "p", "n", "np")


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with the larger id first."""
    first = F.col("id") > F.col("p")
    n, other = F.when(first, F.col("n")).otherwise(F.col("np")), F.when(first, F.col("np")).otherwise(F.col("n"))
    return pairs.select(F.greatest("id", "p").alias("id"), F.least("id", "p").alias("p"), n.alias("n"), other.alias("np")).distinct()


def _first_regions(points: DataFrame) -> DataFrame:
    """(region, id, n, weight) of the points that share a part; weight: how many parts all of them share so."""
    rows = points.select("id", "n", F.explode("parts").alias("part"))
    # Hardly any part occurs twice in a task, so the rows are dealt out before they are counted.
    groups = rows.select("part", "id").repartition("part").groupBy("part").agg(F.count(F.lit(1)).alias("k"), F.min("id").alias("lo"), F.max("id").alias("hi")).where("k > 1")
    groups = stored(groups, "part-groups")
    sizes = points.select("id", "n")
    # A region of two points is told by its smallest and largest member.
    two = groups.where("k = 2").groupBy("lo", "hi").agg(F.count(F.lit(1)).alias("weight"))
    two = two.select(F.xxhash64(F.lit(2), "lo", "hi").alias("region"), F.explode(F.array("lo", "hi")).alias("id"), "weight")
    two = stored(two, "part-pairs")
    two = sizes.join(broadcast_checked(two, 40), "id").select("region", "id", "n", "weight")
    more = groups.where("k > 2").select(F.col("part").alias("__part"))
    many = rows.join(broadcast_checked(more, 16), F.col("part") == F.col("__part"), "left_semi")
    many = stored(many.select(F.col("part").alias("region"), "id", "n", F.lit(1).cast("long").alias("weight")), "part-members")
    return _distinct_regions(many).unionByName(two)


def _draw(*cols) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / float(1 << 40)


def _first_links(docs: DataFrame, points: DataFrame, members: DataFrame, near: int, words: int) -> DataFrame:
    """Links (u, v) of points with one pivot each: the smallest member of the regions that hold most of their shared shingles."""
    pivots = members.groupBy("region").agg(F.min(F.struct("id", "n")).alias("p")).select(F.col("region").alias("r"), F.col("p.id").alias("p"), F.col("p.n").alias("np"))
    pairs = members.join(pivots, F.col("region") == F.col("r")).where("id <> p")
    pairs = pairs.groupBy("id", "n", "p", "np").agg(F.sum("weight").alias("w"))
    best = pairs.groupBy("id", "n").agg(F.max(F.struct("w", F.negative("p").alias("m"), "p", "np")).alias("b"))
    best = sized(best, members.count())
    return _tested(docs, points, best.select("id", F.col("b.p").alias("p"), "n", F.col("b.np").alias("np")), near, words).select(F.col("id").alias("u"), F.col("p").alias("v"))


def find_components(docs: DataFrame, points: DataFrame, words: int = WORDS, percent: int = PERCENT, trace: list | None = None) -> DataFrame:
    """(id, comp) of the points (id, n, parts, sig, odd) that are linked with others; ``trace`` gets the pairs met in each round."""
    near, wide = percent, 2 * percent - 100  # similarities at distance eps and 2 eps
    members = stored(_joined_regions(_first_regions(points), 0), "regions-1")
    comps = components(_first_links(docs, points, members, near, words))
    turn, spark = 0, docs.sparkSession
    while True:
        turn += 1
        began = made()
        members = members.select("region", "id", "n").join(broadcast_checked(comps, 32), "id", "left")
        members = stored(members.withColumn("comp", F.coalesce("comp", "id")), "members")
        # Regions with one component are done; pivots come from all but a region's largest component.
        total = members.count()
        parts = sized(members.groupBy("region", "comp").agg(F.count(F.lit(1)).alias("k")), total)
        state = parts.groupBy("region").agg(F.count(F.lit(1)).alias("parts"), F.sum("k").alias("k"), F.max(F.struct("k", "comp")).alias("top"))
        state = state.where("parts > 1").select(F.col("region").alias("r"), F.col("top.comp").alias("top"), (F.col("k") - F.col("top.k")).alias("rest"))
        state = stored(sized(state, total), "region-state")
        regions = state.count()
        if not regions:
            return comps
        open_ = stored(members.join(broadcast_checked(state, 40, rows=regions), F.col("region") == F.col("r")).drop("r"), "open-regions")
        ids = stored(open_.select("id").distinct(), "open-ids")
        odd = points.select("id", "n", "odd").join(broadcast_checked(ids, 16), "id", "left_semi").distinct()
        odd = stored(odd, "open-parities")  # one row per point, so that repeated rows of a doc_id stay one
        seen = open_.join(broadcast_checked(odd, 32 + 8 * PARITY_WORDS), ["id", "n"])
        chosen = seen.where("comp <> top")
        order = F.xxhash64(F.lit(turn), "id")  # overlapping regions draw the same pivots, so their pairs coincide
        first = chosen.groupBy("region").agg(F.min(F.struct(order.alias("o"), F.col("id"), F.col("n"), F.col("comp"), F.col("odd"))).alias("p"))
        share = float(PIVOTS * 4 ** (turn - 1)) / F.col("rest")
        drawn = chosen.where(_draw(F.lit(100 + turn), F.col("id")) < share).select("region", "id", "n", "comp", "odd")
        pivots = first.select("region", "p.id", "p.n", "p.comp", "p.odd").unionByName(drawn)
        pivots = sized(pivots.distinct(), total)
        pivots = stored(pivots.select("region", F.col("id").alias("p"), F.col("n").alias("np"), F.col("comp").alias("cp"), F.col("odd").alias("oddp")), "pivots")
        # Pivots meet the points of their region that are of another component; what sizes and parities exclude makes no pair.
        pairs = stored(_met(seen, pivots, near).select("id", "p", "n", "np"), "pivot-pairs")
        if trace is not None:
            trace.append(pairs.count())
        found = _tested(docs, points, _ordered(pairs), near, words)
        links = stored(found.select(F.col("id").alias("u"), F.col("p").alias("v")), "pivot-links")
        # Only pivots with links get cells, so only their distances up to 2 eps are needed.
        ends = stored(links.select(F.explode(F.array("u", "v")).alias("__p")).distinct(), "linked-ends")
        centres = pivots.join(broadcast_checked(ends, 16), F.col("p") == F.col("__p"), "left_semi")
        pairs = stored(_met(seen, centres, wide), "cell-pairs")
        found = stored(_tested(docs, points, _ordered(pairs), wide, words), "pivot-distances")
        found = found.select(F.col("id").alias("a"), F.col("p").alias("b"), "inter")
        near_p = pairs.join(broadcast_checked(found, 40), (F.greatest("id", "p") == F.col("a")) & (F.least("id", "p") == F.col("b")))
        union_ = F.col("n") + F.col("np") - F.col("inter")
        near_p = near_p.select("region", "id", "p", "n", (100 * F.col("inter") >= near * union_).alias("link"), (F.col("inter") / union_).alias("likeness"))
        near_p = stored(near_p, "region-distances")
        # Next regions: a cell around each pivot that has linked points, with its boundary points; the outer rest.
        homes = near_p.where("link").groupBy("region", "id").agg(F.max_by("p", F.struct("likeness", "p")).alias("p"))
        homes = stored(sized(homes, near_p.count()), "homes")
        cells = sized(homes.select(F.col("region").alias("r"), F.col("p").alias("q")).distinct(), homes.count())
        inside = near_p.join(broadcast_checked(stored(cells, "cells"), 32), (F.col("region") == F.col("r")) & (F.col("p") == F.col("q"))).drop("r", "q")
        done = pivots.select("region", F.col("p").alias("id"))  # pivots have met their whole region
        done = broadcast_checked(done, 32)
        inside = inside.join(done, ["region", "id"], "left_anti")
        inside = inside.select(F.xxhash64(F.lit(3), F.col("region"), F.col("p"), F.lit(turn)).alias("region"), "id", "n")
        outer = open_.join(done, ["region", "id"], "left_anti").join(broadcast_checked(homes.select("region", "id"), 32), ["region", "id"], "left_anti")
        outer = outer.select(F.xxhash64(F.lit(4), F.col("region"), F.lit(turn)).alias("region"), "id", "n")
        both = stored(inside.unionByName(outer).withColumn("weight", F.lit(1).cast("long")), "next-members")
        members = stored(_joined_regions(_distinct_regions(both), turn), "next-regions")
        if links.limit(1).count():
            comps = components(links.unionByName(comps.select(F.col("id").alias("u"), F.col("comp").alias("v"))))
        release(spark, began, members, comps)


def link_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, trace: list | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    points = stored(_points(docs, _hot_parts(docs, words, percent), words, percent), "shingle-points")
    whole = points.where((F.col("n") > 0) & F.col("id").isNotNull())
    # Classes of equal sets; the smallest doc_id stands for its class.
    classes = whole.groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.max("id").alias("__most"))
    classes = stored(classes.where("rep <> __most").drop("__most"), "shingle-classes")
    rows = points.select("id", "n", "d1", "d2").join(broadcast_checked(classes, 40), ["d1", "d2"], "left")
    rows = rows.select(F.col("id").alias("doc_id"), "n", F.coalesce("rep", "id").alias("rep"))
    copies = stored(rows.where("n > 0 and rep <> doc_id").select(F.col("doc_id").alias("id")).distinct(), "shingle-copies")
    reps = whole.join(broadcast_checked(copies, 16), "id", "left_anti")
    began = made()
    comps = find_components(docs, reps, words, percent, trace)
    release(docs.sparkSession, began, comps)
    comps = comps.withColumnRenamed("id", "__id")
    found = rows.join(broadcast_checked(comps, 32), (F.col("rep") == F.col("__id")) & (F.col("n") > 0), "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", F.when(F.col("n") > 0, F.col("rep")), "doc_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"))


def representatives(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component; rows with null doc_id stay."""
    comps = link_components(docs, words, percent)
    others = stored(comps.where("component_id <> doc_id").select(F.col("doc_id").alias("__id")).distinct(), "near-copies")
    return docs.join(broadcast_checked(others, 16), F.col("doc_id") == F.col("__id"), "left_anti")
