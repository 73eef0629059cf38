"""I2 verification: do two copies of a table hold the same rows?  By a tree of digests over key ranges.

The sync moves what its timestamps show, and equal row counts prove nothing: a
row changed without a new stamp stays different for ever.  A digest tree holds
a row per range of ``LEAF_KEYS`` keys (number of rows, two xor-ed 64-bit row
hashes) and ``LEVELS`` levels above it, each node a digest of its ``FANOUT``
children.  It is built in one scan with map-side combining and can be stored
with its table.  Comparing starts at the top and descends only below nodes that
differ; of the tables themselves only the rows of differing leaves are read.

Defined results: keys are integers and unique, rows without a key are not
compared; NULLs are values like any other; columns that only one side has are
ignored; two empty tables are equal.  Equality holds up to collisions of 128
hash bits per range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.joins import broadcast_if_small
from sparkmart.schemas import WAREHOUSE_SPECS, TableSpec
from sparkmart.session import stored_copy

#: Keys per leaf, children per node, levels above the leaves: a top node covers 6.9e10 keys.
LEAF_KEYS = 4096
FANOUT = 64
LEVELS = 4
#: Up to so many runs of differing leaves are pushed into the scans as ranges; more become a semi join.
PUSHED_RANGES = 256

_DIGEST = ("n", "x", "y")


def _leaf(key: str) -> Column:
    return F.floor(F.col(key) / F.lit(LEAF_KEYS)).cast("long")


def _parent(node: str) -> Column:
    return F.floor(F.col(node) / F.lit(FANOUT)).cast("long")


def digest_tree(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(level, node, n, x, y) of every node above ``df``'s keys; level 0 are the leaves."""
    names = sorted(columns or df.columns)
    # xxhash64 skips NULLs, so their places are hashed too.
    values = [v for c in names for v in (F.col(c), F.col(c).isNull())]
    rows = df.where(F.col(key).isNotNull())
    level = rows.groupBy(_leaf(key).alias("node")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(F.lit(1), *values)).alias("x"), F.bit_xor(F.xxhash64(F.lit(2), *values)).alias("y")
    )
    levels = [stored_copy(level, "digest-leaves")]
    for _ in range(LEVELS):
        below = levels[-1]
        levels.append(
            below.groupBy(_parent("node").alias("node")).agg(
                F.sum("n").alias("n"),
                F.bit_xor(F.xxhash64(F.lit(3), "node", *_DIGEST)).alias("x"),
                F.bit_xor(F.xxhash64(F.lit(4), "node", *_DIGEST)).alias("y"),
            )
        )
    marked = [nodes.select(F.lit(k).alias("level"), "node", *_DIGEST) for k, nodes in enumerate(levels)]
    return stored_copy(reduce(DataFrame.unionByName, marked), "digest-tree")


def _unequal(left: DataFrame, right: DataFrame) -> DataFrame:
    """Nodes that only one side has or whose digests differ."""
    a = left.select("node", F.struct(*_DIGEST).alias("a"))
    b = right.select("node", F.struct(*_DIGEST).alias("b"))
    return a.join(b, "node", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("node")


def differing_leaves(left: DataFrame, right: DataFrame) -> DataFrame:
    """Leaves (node) in which two trees differ; below the top only children of differing nodes are compared."""
    nodes = _unequal(left.where(F.col("level") == LEVELS), right.where(F.col("level") == LEVELS))
    for level in range(LEVELS - 1, -1, -1):
        open_, _ = broadcast_if_small(stored_copy(nodes.select(F.col("node").alias("open")), "digest-open"))
        sides = [t.where(F.col("level") == level).join(open_, _parent("node") == F.col("open"), "left_semi") for t in (left, right)]
        nodes = _unequal(*sides)
    return stored_copy(nodes, "digest-differing")


def _rows_of(df: DataFrame, key: str, leaves: DataFrame, runs: list | None) -> DataFrame:
    if runs is not None:  # ranges of keys, pushed into the scan
        bounds = [F.col(key).between(r["lo"] * LEAF_KEYS, (r["hi"] + 1) * LEAF_KEYS - 1) for r in runs]
        return df.where(reduce(lambda x, y: x | y, bounds, F.lit(False)))
    side, _ = broadcast_if_small(leaves)
    return df.join(side, _leaf(key) == F.col("node"), "left_semi")


def differing_rows(source: DataFrame, target: DataFrame, key: str, trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(key, status) of the rows in which ``target`` differs from ``source``: ``missing``, ``extra`` or ``changed``.

    ``trees``: the stored digest trees of both, over their common columns;
    else they are built here.
    """
    columns = sorted(set(source.columns) & set(target.columns))
    left, right = trees or tuple(digest_tree(df, key, columns) for df in (source, target))
    leaves = differing_leaves(left, right)
    # Neighbouring leaves form one run; the runs go to the driver only while they are few.
    starts = leaves.join(leaves.select((F.col("node") + 1).alias("node")), "node", "left_anti").select(F.col("node").alias("lo"))
    ends = leaves.join(leaves.select((F.col("node") - 1).alias("node")), "node", "left_anti").select(F.col("node").alias("hi"))
    runs = None
    if starts.count() <= PUSHED_RANGES:
        los, his = (sorted(r[0] for r in side.collect()) for side in (starts, ends))
        runs = [{"lo": lo, "hi": hi} for lo, hi in zip(los, his, strict=True)]
    rest = [c for c in columns if c != key]
    a, b = (
        _rows_of(df.where(F.col(key).isNotNull()), key, leaves, runs).select(F.col(key), F.struct(F.lit(1), *[F.col(c) for c in rest]).alias(side))
        for df, side in ((source, "a"), (target, "b"))
    )
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    return a.join(b, key, "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(key, status.alias("status"))


def verify_all(sources: Mapping[str, DataFrame], targets: Mapping[str, DataFrame], specs: Sequence[TableSpec] = WAREHOUSE_SPECS) -> DataFrame:
    """Per table (table_name, missing, extra, changed), counted row by row only where digests differ."""
    parts = []
    for spec in specs:
        rows = differing_rows(sources[spec.name], targets[spec.name], spec.key[0])
        counts = [F.count(F.when(F.col("status") == s, 1)).alias(s) for s in ("missing", "extra", "changed")]
        parts.append(rows.agg(*counts).select(F.lit(spec.name).alias("table_name"), "missing", "extra", "changed"))
    return reduce(DataFrame.unionByName, parts)
