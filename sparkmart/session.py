"""Session construction and checkpoint-directory resolution."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every sparkmart job relies on: adaptive execution (coalescing,
# skew-join splitting, runtime broadcast conversion) and a pinned UTC zone so
# timestamps compare equal across engines.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "sparkmart",
    driver_memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, resolving it if needed.

    Order: a directory already set on the context, then the cluster's
    ``spark.checkpoint.dir`` setting.  Only a local-mode session (tests, the
    bench) may fall back to a fresh folder under the machine's temp dir; on a
    cluster a machine-local folder would not survive executor loss, so an
    unset directory is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's configured directory is used
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) so key assignment survives executor loss"
        )
    local_dir = tempfile.mkdtemp(prefix="sparkmart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir() or local_dir


#: Parquet codec of stored copies and snapshot versions: fewer bytes than the default for a little more time.
CODEC = "zstd"

#: Spark's switch to delete an execution's shuffle files when it ends; else they stay until the driver collects its garbage.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Executions planned within delete their shuffle files when they end: for writes, whose shuffles nothing reads again."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


#: Folders written by ``stored_copy`` in this process, for ``release_scratch``.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, removed by ``release_scratch``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def stored_copy(df, name: str = "frame"):
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Lineage ends at files every executor sees, and later reads prune columns
    and push filters into them.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete the scratch folders of this process; frames that read them end here."""
    while _SCRATCH:
        place = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def reliable_checkpoint(df):
    """Materialise ``df`` in the shared checkpoint directory and cut lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
