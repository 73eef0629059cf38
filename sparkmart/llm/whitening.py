"""Embedding whitening with weighted multiplicity covariance.

Entries become integers (``floor(64 c) + 1000000``).  Vectors with the same
integers are grouped once; the group's count (or one, ``weights="one"``) is its
weight in the fit.  Sums per dimension are exact integers; the covariance is a
weighted product of the centred distinct vectors, made of one partial matrix
per task and added up by matrix row in task order.  Each distinct vector is whitened
once, on the eigenvectors of the covariance, and joined back to the rows that
hold it, so a vector that a third of all rows share is computed once.

The driver holds matrices of dimension x dimension only.

Defined results: rows whose vector is null, holds a null, NaN or infinite entry,
or an entry of 2**40 or more are dropped, and so are vectors of another length
than the most frequent one (the longer of equally frequent ones; empty vectors
have no components); null or repeated vec_ids keep their rows; components whose
eigenvalue is zero to double precision don't exist (equal vectors: no rows);
``deviation`` is null where it exceeds a long; an empty table gives no rows;
extra columns are ignored.  Groups are told apart by a 128-bit hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import stored

#: Fixed values of the production whitening.
SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32

#: Larger entries count as not finite.
LARGEST = float(1 << 40)
#: Partial matrices per covariance at most.
PARTIALS = 4096


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x, k1, k2) of the valid rows; the keys are a 128-bit hash of x."""
    v = F.col(vector_col)
    valid = v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    # Only valid vectors are scaled, wherever the filter below is run.
    x = F.transform(F.when(valid, v), lambda c: F.floor(SCALE * c.cast("double")) + F.lit(SHIFT).cast("long"))
    rows = vectors.where(valid).select(F.col(id_col).alias("vec_id"), x.alias("x"))
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    rows = rows.where((F.size("x") == d) & (F.size("x") > 0))
    return rows.withColumn("k1", F.xxhash64(F.lit(1), "x")).withColumn("k2", F.xxhash64(F.lit(2), "x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _column_sums(df: DataFrame, value: str, kind: str) -> list:
    """Weighted sum of each entry of the array column ``value``, and of the weights."""
    dtype = np.int64 if kind == "long" else np.float64

    def run(batches):
        total, weight = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            w = batch.column(0).to_numpy()
            part = (_matrix(batch.column(1)) * w[:, None].astype(dtype)).sum(axis=0)
            total, weight = part if total is None else total + part, weight + int(w.sum())
        if total is not None:
            k, d = TaskContext.get().partitionId(), len(total)
            yield pa.RecordBatch.from_pydict({"part": pa.array([k] * d), "i": pa.array(range(d)), "s": pa.array(total), "w": pa.array([weight] * d)})

    parts = df.select("weight", value).coalesce(PARTIALS).mapInArrow(run, f"part long, i long, s {kind}, w long")
    added = F.aggregate(F.array_sort(F.collect_list(F.struct("part", "s"))), F.lit(0).cast(kind), lambda a, p: a + p["s"])
    return parts.groupBy("i").agg(added.alias("s"), F.sum("w").alias("w")).orderBy("i").collect()


def _weighted_gram(df: DataFrame, value: str, centre) -> np.ndarray:
    """Sum of weight * c c^T over the rows, c = centre(matrix of ``value``)."""

    def run(batches):
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            c = centre(_matrix(batch.column(1)))
            part = (c * batch.column(0).to_numpy()[:, None]).T @ c
            total = part if total is None else total + part
        if total is not None:
            k, d = TaskContext.get().partitionId(), len(total)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(d + 1) * d, pa.int32()), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(range(d)), pa.array([k] * d), flat], ["i", "part", "row"])

    def add(batches):
        at, total = None, None
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), _matrix(batch.column(2)) if batch.num_rows else (), strict=True):
                if i != at:
                    if at is not None:
                        yield _row(at, total)
                    at, total = i, np.zeros(len(row))
                total = total + row
        if at is not None:
            yield _row(at, total)

    parts = df.select("weight", value).coalesce(PARTIALS).mapInArrow(run, "i long, part long, row array<double>")
    summed = parts.repartition("i").sortWithinPartitions("i", "part").mapInArrow(add, "i long, row array<double>")
    return np.array([r["row"] for r in summed.orderBy("i").collect()])


def _row(i: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([values])], ["i", "row"])


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list:
    """Sum over dimensions of (n x - S)^2 of each row, exact; None beyond a long."""
    c = n * x - sums
    near = (c.astype(np.float64) ** 2).sum(axis=1)
    out = (c * c).sum(axis=1).tolist()
    for i in np.flatnonzero(near >= 9e18).tolist():
        exact = sum(v * v for v in c[i].tolist())
        out[i] = exact if exact < 1 << 63 else None
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding", weights: str = "counts") -> DataFrame:
    """Per row (vec_id, n, deviation, whitened array, explained array, identity_error)."""
    if weights not in ("counts", "one"):
        raise ValueError("weights: counts or one")
    spark = vectors.sparkSession
    rows = stored(quantised(vectors, id_col, vector_col), "quantised")
    fit = F.count(F.lit(1)) if weights == "counts" else F.lit(1).cast("long")
    distinct = stored(rows.groupBy("k1", "k2").agg(F.first("x").alias("x"), fit.alias("weight")), "distinct-vectors")
    sums = _column_sums(distinct, "x", "long")
    empty = "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"
    if not sums:
        return spark.createDataFrame([], empty)
    n, total = int(sums[0]["w"]), np.array([r["s"] for r in sums], np.int64)
    v = _weighted_gram(distinct, "x", lambda x: (n * x - total) / n) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > max(e[0], 0.0) * len(e) * np.finfo(np.float64).eps).sum()))
    if not k:
        return spark.createDataFrame([], empty)
    scaled, explained = u[:, :k] / np.sqrt(e[:k]), (e[:k] / np.trace(v)).tolist()

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(3))
                y = ((n * x - total) / n) @ scaled
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * k, pa.int32()), pa.array(y.ravel()))
                dev = pa.array(deviations(x, n, total), pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], dev, flat], ["k1", "k2", "weight", "deviation", "whitened"])

    white = distinct.select("k1", "k2", "weight", "x").mapInArrow(run, "k1 long, k2 long, weight long, deviation long, whitened array<double>")
    white = stored(white, "whitened")
    mean = np.array([r["s"] for r in _column_sums(white, "whitened", "double")]) / n
    covariance = _weighted_gram(white, "whitened", lambda y: y - mean) / n
    error = float(np.abs(covariance - np.eye(k)).max())
    back = rows.select("vec_id", "k1", "k2").join(white.drop("weight"), ["k1", "k2"])
    return back.select(
        "vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.array(*[F.lit(x) for x in explained]).alias("explained"), F.lit(error).alias("identity_error"),
    )


def component_rows(vectors: DataFrame, **options) -> DataFrame:
    """One row per vector and component, numbered from 1."""
    wide = whiten(vectors, **options)
    long = wide.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("pos", "whitened"))
    return long.select(
        "vec_id", (F.col("pos") + 1).alias("component"), "n", "deviation", "whitened",
        F.element_at("explained", F.col("pos") + 1).alias("explained"), "identity_error",
    )
