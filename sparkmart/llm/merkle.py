"""Merkle dataset manifest: a hash tree per source, kept as a postorder append log.

A document is a leaf, the SHA-256 of its fields.  The leaves of a source,
ordered by doc_id, form a tree in which 16 consecutive nodes get a parent (the
last run may be shorter), and the sources' roots form one more tree.

Aligned builders: a builder takes the 4096 leaves from a multiple of 4096 on
and appends nodes to its segment in the order in which they are complete (a
parent right after its last child).  The tops of a source's segments are the
leaves of the next tier of builders, until one segment holds the root.  In such
a postorder log the place of a node follows from the sizes of the complete
subtrees before it: the node of level ``l`` whose last leaf is ``e`` stands at
``e + e // 16 + e // 256 + ... + l`` (``position``), for ragged right edges
too.  Proof extraction addresses siblings by that formula, first in the document's own
segment, then in those above; a document's text is read once, for its leaf.

Nothing per document leaves the executors; a group is at most 4096 leaves.

Defined results: a null field counts as ``-``; rows with null doc_id come first;
rows with equal doc_id follow each other by leaf digest and are leaves of their
own; null source is a source of its own, first in order; a null doc_id is never
tampered with; a lone document's proof has no siblings (the hash of nothing); an
empty table has no rows and no root; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import broadcast_checked, stored
from sparkmart.operators.keys import sequence_number

#: Children per node, and levels of a builder's segment (16 ** 3 leaves).
FAN = 16
LEVELS = 3
BLOCK = FAN**LEVELS
#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Leaves handled by one task of a build or of the proofs, about.
TASK_LEAVES = 1 << 20

LOG = "tree long, block long, n long, first long, nodes binary, keys array<long>, others array<binary>"


def digest(parts) -> bytes:
    """Hex SHA-256 of hex digests one after the other."""
    return sha256(b"".join(parts)).hexdigest().encode()


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // FAN), h + 1
    return h


def position(last_leaf: int, level: int) -> int:
    """Place in the postorder log of the node of ``level`` that ends with leaf ``last_leaf``."""
    at, full = last_leaf + level, last_leaf // FAN
    while full:
        at, full = at + full, full // FAN
    return at


class LogBuilder:
    """Appends leaves and, as soon as they are complete, the nodes above them."""

    def __init__(self, levels: int):
        self.levels, self.log = levels, []
        self.open: list[list[bytes]] = [[] for _ in range(levels)]

    def append(self, node: bytes, level: int = 0) -> None:
        self.log.append(node)
        if level < self.levels:
            self.open[level].append(node)
            if len(self.open[level]) == FAN:
                self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        self.append(digest(run), level + 1)

    def finish(self) -> list[bytes]:
        for level in range(self.levels):
            if self.open[level]:
                self._close(level)
        return self.log


def run_of(log, leaf: int, level: int, n: int) -> tuple[int, list]:
    """(own place, nodes) of the run at ``level`` that holds ``leaf`` in a log of ``n`` leaves."""
    span = FAN**level
    node = leaf // span
    start = node - node % FAN
    stop = min(start + FAN, -(-n // span))
    return node - start, [log[position(min((j + 1) * span, n) - 1, level)] for j in range(start, stop)]


def segment_levels(n: int) -> int:
    """Levels within a segment of a tree of ``n`` leaves."""
    return height(n) if n <= BLOCK else LEVELS


# --- leaves ----------------------------------------------------------------


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(text: Column) -> Column:
    fields = [text if name == "text" else F.col(name) for name in FIELDS]
    return F.unhex(F.sha2(F.concat(*[_field(c) for c in fields]), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, other); ``other``: the leaf of the tampered text where one is asked for."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *FIELDS[1:])
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    other = F.when(chosen, leaf_digest(F.translate("text", UPPER, LOWER)))
    return docs.select("doc_id", "source", leaf_digest(F.col("text")).alias("leaf"), other.alias("other"))


# --- building --------------------------------------------------------------


def _segment(tree: int, block: int, n: int, rows: list[tuple]) -> tuple:
    builder = LogBuilder(segment_levels(n))
    for node, _, _ in rows:
        builder.append(node.hex().encode())
    nodes = b"".join(bytes.fromhex(x.decode()) for x in builder.finish())
    return tree, block, n, position(block * BLOCK, 0), nodes, [r[1] for r in rows], [r[2] for r in rows]


def _build(batches):
    """Segments of rows (tree, block, i, n, node, key, other) that come block after block, sorted by i."""
    kinds = [pa.int64()] * 4 + [pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary())]
    names = ["tree", "block", "n", "first", "nodes", "keys", "others"]

    def out(segment):
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(segment, kinds, strict=True)], names)

    at, size, held = None, 0, []
    for batch in batches:
        for tree, block, _, n, node, key, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at is not None and at != (tree, block):
                yield out(_segment(*at, size, held))
                held = []
            at, size = (tree, block), n
            held.append((node, key, other))
    if at is not None:
        yield out(_segment(*at, size, held))


def _tier(items: DataFrame, total: int) -> DataFrame:
    """Stored segments of ``items`` (tree, i, n, node, key, other)."""
    width = max(1, -(-total // TASK_LEAVES), min(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BLOCK)))
    rows = items.select("tree", F.floor(F.col("i") / BLOCK).cast("long").alias("block"), "i", "n", "node", "key", "other")
    dealt = rows.repartition(width, "tree", "block").sortWithinPartitions("tree", "block", "i")
    return stored(dealt.mapInArrow(_build, LOG), "merkle-log")


def _grow(items: DataFrame, total: int) -> list[DataFrame]:
    """The tiers of segments over ``items``, lowest first."""
    tiers = [_tier(items, total)]
    while True:
        tops = tiers[-1].where(F.col("n") > BLOCK)
        total = tops.count()
        if not total:
            return tiers
        n = F.ceil(F.col("n") / BLOCK).cast("long")
        none = F.lit(None)
        tiers.append(_tier(tops.select("tree", F.col("block").alias("i"), n.alias("n"), _top().alias("node"), none.cast("long").alias("key"), none.cast("binary").alias("other")), total))


def _top() -> Column:
    """The last node of a segment."""
    return F.substring("nodes", -32, 32)


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """(tree, node) of each tree's root."""
    out = None
    for log in tiers:
        part = log.where(F.col("n") <= BLOCK).select("tree", _top().alias("node"))
        out = part if out is None else out.unionByName(part)
    return out


@dataclass
class Manifest:
    """Stored segments of the sources' trees and of the tree over their roots; ``root`` is None without documents."""

    sources: DataFrame  # tree, source, n
    trees: list[DataFrame]
    subroots: DataFrame  # tree, node
    upper: list[DataFrame]
    root: str | None


def build(leaf_rows: DataFrame) -> Manifest | None:
    """The manifest of ``leaf_rows`` (doc_id, source, leaf, other)."""
    # The salt only lets equal rows, which may stand in any order, spread over several ranges.
    leaf_rows = stored(leaf_rows.withColumn("salt", F.rand(7)), "merkle-leaves")
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("salt")]
    numbered = sequence_number(leaf_rows, order, "g", 0, keep=["source", "doc_id", "leaf", "other"])
    groups = numbered.groupBy("source").agg(F.min("g").alias("first"), F.count(F.lit(1)).alias("n"))
    sources = stored(sequence_number(groups, ["first"], "tree", 0, num_partitions=_width(groups)), "merkle-sources")
    facts = sources.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.max(F.octet_length("source")).alias("b")).first()
    if not facts["k"]:
        return None
    side = sources.withColumnRenamed("source", "__source")
    side = broadcast_checked(side, 64 + (facts["b"] or 0), rows=facts["k"])
    items = numbered.join(side, F.col("source").eqNullSafe(F.col("__source")))
    items = items.select("tree", (F.col("g") - F.col("first")).alias("i"), "n", F.col("leaf").alias("node"), F.col("doc_id").alias("key"), "other")
    trees = _grow(items, facts["n"])
    subroots = stored(_roots(trees), "merkle-subroots")
    none = F.lit(None)
    tops = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("i"), F.lit(facts["k"]).cast("long").alias("n"), "node", none.cast("long").alias("key"), none.cast("binary").alias("other"))
    upper = _grow(tops, facts["k"])
    root = _roots(upper).first()["node"].hex()
    return Manifest(sources.select("tree", "source", "n"), trees, subroots, upper, root)


def _width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def log_nodes(manifest: Manifest) -> DataFrame:
    """(tree, position, node): the nodes of the lowest tier in log order, positions over the source's whole log."""
    log = manifest.trees[0].select("tree", "first", F.explode(F.sequence(F.lit(0), (F.octet_length("nodes") / 32 - 1).cast("int"))).alias("p"), "nodes")
    return log.select("tree", (F.col("first") + F.col("p")).alias("position"), F.expr("lower(hex(substring(nodes, 32 * p + 1, 32)))").alias("node"))


# --- proofs ----------------------------------------------------------------


def _unpack(path: bytes) -> list[tuple[bytes, bytes]]:
    """(left, right) hex digests per level of a packed path."""
    out, at = [], 0
    while at < len(path):
        left, right = path[at], path[at + 1]
        at += 2
        out.append((path[at : at + 32 * left].hex().encode(), path[at + 32 * left : at + 32 * (left + right)].hex().encode()))
        at += 32 * (left + right)
    return out


def _pack(steps: list[tuple[bytes, bytes]]) -> bytes:
    return b"".join(bytes([len(a) // 64, len(b) // 64]) + bytes.fromhex((a + b).decode()) for a, b in steps)


def local_steps(nodes: bytes, size: int, levels: int):
    """Per leaf of a segment its (left, right) hex siblings at each of its levels."""
    text = nodes.hex().encode()
    log = [text[64 * k : 64 * k + 64] for k in range(len(nodes) // 32)]
    runs: list[dict[int, bytes]] = [{} for _ in range(levels)]
    for leaf in range(size):
        steps = []
        for level in range(levels):
            node = leaf // FAN**level
            own = node % FAN
            run = runs[level].get(node // FAN)
            if run is None:
                run = runs[level][node // FAN] = b"".join(run_of(log, leaf, level, size)[1])
            steps.append((run[: 64 * own], run[64 * own + 64 :]))
        yield log[position(leaf, 0)], steps


def _segment_rows(batches):
    """(tree, block, n, size, nodes, keys, others, path, subroot) of joined segments."""
    for batch in batches:
        for row in batch.to_pylist():
            yield row


def _item_paths(batches):
    """Packed paths of a tier's items, the segments' tops of the tier below."""
    for row in _segment_rows(batches):
        levels, size = segment_levels(row["n"]), len(row["keys"])
        paths = [_pack(steps) + row["path"] for _, steps in local_steps(row["nodes"], size, levels)]
        start = row["block"] * BLOCK
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["tree"]] * size), pa.array(range(start, start + size), pa.int64()), pa.array(paths, pa.binary()), pa.array([row["subroot"]] * size, pa.binary())],
            ["tree", "i", "path", "subroot"],
        )


def _proof_rows(root: str):
    def run(batches):
        for row in _segment_rows(batches):
            above = _unpack(row["path"])
            shared = b"".join(a + b for a, b in above)
            columns: list[list] = [[] for _ in range(6)]
            for (leaf, steps), other in zip(local_steps(row["nodes"], len(row["keys"]), segment_levels(row["n"])), row["others"], strict=True):
                proof = sha256(b"".join(a + b for a, b in steps))
                proof.update(shared)
                node = leaf if other is None else other.hex().encode()
                for left, right in (*steps, *above):
                    node = digest((left, node, right)) if left or right else sha256(node).hexdigest().encode()
                folded = node.decode()
                for c, v in zip(columns, (leaf.decode(), row["subroot"].hex(), root, proof.hexdigest(), folded, folded == root), strict=True):
                    c.append(v)
            kinds = [pa.string()] * 5 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["keys"], pa.int64()), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )

    return run


def _with_paths(tiers: list[DataFrame], roots: DataFrame) -> DataFrame:
    """The lowest tier's segments with the packed path above each; ``roots`` (tree, path, subroot)."""
    paths, log = None, tiers[-1]
    for log in reversed(tiers):
        whole = log.where(F.col("n") <= BLOCK).join(_sent(roots, "__tree"), F.col("tree") == F.col("__tree")).drop("__tree")
        if paths is not None:
            part = log.where(F.col("n") > BLOCK).join(_sent(paths, "__tree").withColumnRenamed("i", "__i"), (F.col("tree") == F.col("__tree")) & (F.col("block") == F.col("__i")))
            whole = whole.unionByName(part.drop("__tree", "__i"))
        if log is tiers[0]:
            return whole
        paths = stored(whole.mapInArrow(_item_paths, "tree long, i long, path binary, subroot binary"), "merkle-paths")
    return log


def _sent(df: DataFrame, tree: str) -> DataFrame:
    """Broadcast while the counted rows and their measured longest path allow it."""
    facts = df.agg(F.count(F.lit(1)).alias("k"), F.max(F.octet_length("path")).alias("b")).first()
    return broadcast_checked(df.withColumnRenamed("tree", tree), 64 + (facts["b"] or 0), rows=facts["k"])


def proofs(manifest: Manifest) -> DataFrame:
    """Per document: leaf, subroot, root, the digest of its siblings, and the root folded from its (tampered) leaf."""
    spark = manifest.subroots.sparkSession
    top = spark.createDataFrame([(0, bytearray(), bytearray())], "tree long, path binary, subroot binary")
    above = _with_paths(manifest.upper, top).mapInArrow(_item_paths, "tree long, i long, path binary, subroot binary")
    above = stored(above.select(F.col("i").alias("__i"), "path"), "merkle-upper")
    roots = manifest.subroots.join(above, F.col("tree") == F.col("__i")).select("tree", "path", F.col("node").alias("subroot"))
    segments = _with_paths(manifest.trees, stored(roots, "merkle-roots"))
    n = manifest.trees[0].count()
    dealt = segments.repartition(max(1, min(n, max(_width(segments), n * BLOCK // TASK_LEAVES))))
    return dealt.mapInArrow(_proof_rows(manifest.root), "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def document_proofs(docs: DataFrame) -> DataFrame:
    manifest = build(leaves(docs))
    if manifest is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return proofs(manifest)
