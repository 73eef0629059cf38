"""Size-checked broadcast for join sides whose size the planner cannot see.

Dimensions produced by merges and checkpoints carry no reliable size
statistics, so the static planner starts with a sort-merge join and shuffles
the fact before AQE can switch to a broadcast.  One cheap count of the (much
smaller) side proves its size: broadcast it when ``rows × row width`` fits the
session's broadcast bound, keep the shuffle join otherwise.

The bound is ``COUNTED`` times the session's threshold: the planner holds that
against compressed file sizes, here the size is counted and uncompressed, and
the other side of a lookup is far larger, so shuffling it costs many times the
lookup side (a lookup by a million keys is 16 to 40 MB, the lines it would
shuffle are gigabytes).

A side beyond the bound gets the MERGE hint: the planner would hold its
threshold against the packed files, in which millions of dense keys are a few
megabytes, and collect them on the driver all the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: fallback threshold when the session disables auto-broadcast.
DEFAULT_MAX_BYTES = 10 * 1024 * 1024
# Fixed value: a counted size may be this many times the threshold for estimated ones.
COUNTED = 8


def _threshold(df: DataFrame) -> int:
    value = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", str(DEFAULT_MAX_BYTES))
    try:
        n = int(str(value).lower().rstrip("b"))
    except ValueError:
        n = DEFAULT_MAX_BYTES
    return n if n > 0 else 0


# Per-type byte widths, as Spark's planner estimates them.
_WIDTHS = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
    T.StringType: 20,
}


def row_width(df: DataFrame) -> int:
    """Bytes per row: a row header plus the default size of each column type."""
    return 8 + sum(_WIDTHS.get(type(f.dataType), 16) for f in df.schema.fields)


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None, rows: int | None = None) -> tuple[DataFrame, bool]:
    """``(F.broadcast(df), True)`` when the counted size fits, else ``df`` for a sort-merge join and ``False``.

    ``rows``: a known bound of the number of rows, which saves the count.
    """
    limit = COUNTED * _threshold(df) if max_bytes is None else max_bytes
    if limit <= 0:
        return df, False
    max_rows = limit // row_width(df)
    if rows is None:
        rows = df.count()  # one row per task is sent
    return (F.broadcast(df), True) if rows <= max_rows else (df.hint("merge"), False)
