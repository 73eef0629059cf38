"""Mixing sources to target weights by pivotal dependent rounding (DataFrame functions only).

Each source's weight gives it a target number of words; ``target / size`` is
the fractional number of copies of every document of the source.  The whole
part is taken as it is, the fraction is rounded by the pivotal method: two
documents exchange mass (words times fraction, so the source's expected words
stay fixed) in a random direction until one fraction is 0 or 1.  Documents
are folded in buckets of about ``FAN`` rows, each bucket leaves at most one
undecided document, and these meet again in the next level of a reduction
tree, so the last one per source is at most one document off the target.
Randomness is a hash of the two ids and the seed: reruns agree.  Rows with
null or repeated doc_id are told apart by their source and text, rows equal
in these too by their place in the input.

Defined results: null text has size 0 and takes 0 words; null source is a
source of its own, last in order; a source without words has target 0; an
empty table gives an empty table; every row, of a null or repeated doc_id
too, is a document of its own with its own rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkmart.llm.common import WORD, broadcast_checked, stored

#: Rows folded in one bucket (average).
FAN = 100

#: Fixed values of the production mix: weights by source order, share of all words, cap per source.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: weighted shares, capped, the excess reshared.

    Sharing the excess by weight until none is above its cap gives
    ``min(cap, weight * level)`` with one level for all; the level follows
    from running sums over the sources in order of ``cap / weight``.  One row
    per source goes through the unpartitioned windows.
    """
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    df = sizes.withColumn("__w", weight).withColumn("__cap", cap * F.col("source_size"))
    df = df.withColumn("__total", share * F.sum("source_size").over(W.partitionBy()))
    by_ratio = W.orderBy(F.col("__cap") / F.col("__w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    full = F.coalesce(F.sum("__cap").over(before), F.lit(0.0))  # caps of the sources filled before this one
    df = df.withColumn("__level", (F.col("__total") - full) / F.sum("__w").over(after))
    # The first source whose cap holds its share sets the level for itself and all after it.
    free = F.col("__w") * F.col("__level") <= F.col("__cap")
    level = F.min_by("__level", F.when(free, F.col("__cap") / F.col("__w"))).over(W.partitionBy())
    target = F.least(F.col("__cap"), F.coalesce(F.col("__w") * level, F.col("__cap")))
    return df.select("source", "source_size", target.alias("target"))


def _uniform(seed: int, *cols: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 52)) / float(1 << 52)


def _meet(acc: Column, b: Column, seed: int) -> Column:
    """One pivotal step of the open document ``acc.cur`` with ``b``; the decided one goes to ``acc.out``."""
    a = acc["cur"]
    rise = F.least(a["size"] * (1 - a["x"]), b["size"] * b["x"])
    fall = F.least(a["size"] * a["x"], b["size"] * (1 - b["x"]))
    up = _uniform(seed, a["key"], b["key"]) * (rise + fall) < fall
    a_ends = F.when(up, a["size"] * (1 - a["x"]) <= b["size"] * b["x"]).otherwise(a["size"] * a["x"] <= b["size"] * (1 - b["x"]))
    moved = F.when(up, rise).otherwise(-fall)

    def clamp(x):
        return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))

    def item(d, x):
        return F.struct(d["key"].alias("key"), d["size"].alias("size"), clamp(x).alias("x"))

    done_a = F.struct(a["key"].alias("key"), up.cast("int").alias("up"))
    done_b = F.struct(b["key"].alias("key"), (~up).cast("int").alias("up"))
    cur = F.when(a.isNull(), b).when(a_ends, item(b, b["x"] - moved / b["size"])).otherwise(item(a, a["x"] + moved / a["size"]))
    out = F.when(a.isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.when(a_ends, done_a).otherwise(done_b))))
    return F.struct(cur.alias("cur"), out.alias("out"))


def pivotal_rounding(df: DataFrame, seed: int = 11, fan: int = FAN) -> DataFrame:
    """Round ``x`` in (0, 1) of rows (stratum, key, size > 0, x) to (stratum, key, up 0/1).

    The sum of ``size * x`` of a stratum is kept up to one row's size.
    """
    counts = df.groupBy("stratum").agg(F.count(F.lit(1)).alias("__n"))
    largest = counts.agg(F.max("__n")).first()[0] or 0
    buckets = F.ceil(F.col("__n") / fan)
    joined = df.join(F.broadcast(counts) if counts.count() <= 100_000 else counts, df["stratum"].eqNullSafe(counts["stratum"])).drop(counts["stratum"])
    level = joined.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "key", "size"), buckets)).drop("__n")
    kind = df.schema["key"].dataType.simpleString()
    member, outcome = f"struct<key:{kind},size:double,x:double>", f"array<struct<key:{kind},up:int>>"
    decided = []
    width = largest
    while True:
        groups = level.groupBy("stratum", "bucket").agg(F.array_sort(F.collect_list(F.struct("key", "size", "x"))).alias("d"))
        start = F.struct(F.lit(None).cast(member).alias("cur"), F.array().cast(outcome).alias("out"))
        folded = groups.select("stratum", "bucket", F.aggregate("d", start, lambda acc, b: _meet(acc, b, seed)).alias("r"))
        folded = stored(folded, "mix-level")
        decided.append(folded.select("stratum", F.explode("r.out").alias("o")).select("stratum", "o.key", "o.up"))
        level = folded.select("stratum", F.floor(F.col("bucket") / fan).alias("bucket"), "r.cur.key", "r.cur.size", "r.cur.x")
        width = -(-width // fan)
        if width <= 1:
            break
    last = level.select("stratum", "key", (_uniform(seed, F.col("key")) < F.col("x")).cast("int").alias("up"))
    for part in decided:
        last = last.unionByName(part)
    return last


def _keys(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__key``, a struct that no two rows share; its hash is that of the doc_id where this is unique.

    Of a null or repeated doc_id the key also has the hash of source and text,
    and of rows equal in these the row's number.
    """
    parts = [F.col("__id"), F.lit(None).cast("long"), F.lit(None).cast("long")]
    repeated = docs.groupBy(F.col("__id").alias("__i")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1 or __i is null")
    repeated = stored(repeated.select("__i", F.lit(True).alias("__many")), "mix-repeated")
    if n := repeated.count():
        docs = docs.join(broadcast_checked(repeated, 24, rows=n), F.col("__id").eqNullSafe(F.col("__i")), "left").drop("__i")
        same = docs.where("__many").groupBy(F.col("__id").alias("__i"), F.col("__text").alias("__t")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
        same = stored(same.select("__i", "__t", F.lit(True).alias("__same")), "mix-same")
        alike = F.col("__many") & F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__text") == F.col("__t"))
        docs = docs.join(broadcast_checked(same, 32), alike, "left").drop("__i", "__t")
        parts[1:] = F.when(F.col("__many"), F.col("__text")), F.when(F.col("__same"), F.col("__row"))
    return docs.withColumn("__key", F.struct(*[c.alias(k) for c, k in zip(parts, ("id", "text", "row"), strict=True)])).drop("__many", "__same")


def mix(df: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 11, carry=()) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target (its source's), copies, taken; with ``carry``, a struct ``carried`` of these columns."""
    sized = df.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.col("doc_id").cast("long").alias("__id"),
        F.xxhash64("source", "text").alias("__text"), F.monotonically_increasing_id().alias("__row"), *([F.struct(*carry).alias("carried")] if carry else []),
    )
    docs = stored(sized, "mix-sizes")
    sources = targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    sources = stored(sources, "mix-targets").withColumnRenamed("source", "__source")
    few = F.broadcast(sources) if sources.count() <= 100_000 else sources
    docs = _keys(docs)
    docs = docs.join(few, docs["source"].eqNullSafe(F.col("__source"))).drop("__source")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    docs = docs.withColumn("__whole", F.floor(copies + 1e-12)).withColumn("__x", F.greatest(copies - F.col("__whole"), F.lit(0.0)))
    open_rows = docs.where((F.col("__x") > 1e-12) & (F.col("size") > 0)).select(
        F.col("source").alias("stratum"), F.col("__key").alias("key"), F.col("size").cast("double").alias("size"), F.col("__x").alias("x")
    )
    ups = pivotal_rounding(open_rows, seed).where("up = 1").select("key", F.col("up").alias("__up"))
    docs = docs.join(broadcast_checked(ups, 64), docs["__key"] == ups["key"], "left").drop("key")
    docs = docs.withColumn("copies", (F.col("__whole") + F.coalesce("__up", F.lit(0))).cast("long"))
    return docs.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"), *(["carried"] if carry else []))
