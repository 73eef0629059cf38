"""Helpers shared by the pipeline operators: stored intermediates, size-checked broadcast, shipping code to workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.session import ensure_checkpoint_dir

#: Word separators of the text contracts: blank and the controls 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows and bytes per Arrow batch handed to a Python worker.
ARROW_ROWS = 1000
ARROW_BYTES = 4 * 1024 * 1024


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they start (once per context)."""
    # Bounded Arrow batches, whatever the length of the texts.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_sparkmart_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = os.path.join(tempfile.mkdtemp(prefix="sparkmart-code-"), "sparkmart.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(top, "sparkmart")):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, top))
    sc.addPyFile(archive)
    sc._sparkmart_shipped = True


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder of this run below the cluster's shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


#: Folders handed out, for ``release``.
_MADE: list[str] = []


def made() -> int:
    """How many folders were handed out so far."""
    return len(_MADE)


def release(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Delete the folders handed out after ``since`` that no stored table of ``keep`` is in."""
    read = [f for df in keep for f in df.inputFiles()[:1]]
    for path in _MADE[since:]:
        if not any(path.rsplit("/", 1)[-1] in f for f in read):
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends in files every executor sees."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows per partition of small derived tables.
PART_ROWS = 100_000


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df``, known to have at most ``rows`` rows, in no more partitions than these fill."""
    return df.coalesce(max(1, -(-rows // PART_ROWS)))


#: Default bound of a broadcast side; its rows are counted before it is sent.
BROADCAST_BYTES = 24 * 1024 * 1024


def broadcast_checked(df: DataFrame, row_bytes: int, max_bytes: int = BROADCAST_BYTES, rows: int | None = None) -> DataFrame:
    """``broadcast(df)`` when the counted rows times ``row_bytes`` fit, else ``df`` (a shuffled join follows)."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n * row_bytes <= max_bytes else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
