"""A5 high-water mark and S2 incremental scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.predicates import EPOCH, UNKNOWN_KEY, newer_than


def watermark_col(
    target: DataFrame, ts_col: str = "last_updated", key_col: str | None = None, default: dt.datetime = EPOCH
) -> DataFrame:
    """A5 as a one-row frame: ``coalesce(max(ts), epoch)``.

    Rows of the unknown member (``key_col = -1``) are ignored: they are seeded
    on the target and would otherwise hide the "empty table" case (G9).
    """
    rows = target.where(F.col(key_col) != UNKNOWN_KEY) if key_col else target
    return rows.agg(F.coalesce(F.max(ts_col), F.lit(default).cast("timestamp_ntz")).alias("watermark"))


def watermark(
    target: DataFrame, ts_col: str = "last_updated", key_col: str | None = None, default: dt.datetime = EPOCH
) -> dt.datetime:
    """A5: the watermark as a driver-side scalar, so the next scan can push it
    into the source (parquet row-group skipping / JDBC ``WHERE``)."""
    return watermark_col(target, ts_col, key_col, default).first()[0]


def read_since(
    source: DataFrame,
    ts_col: str,
    wm: dt.datetime | Column,
    columns: Sequence[str] | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Rows newer than the watermark, explicit column list.

    Strict ``>`` by default: a later row stamped exactly at the watermark is
    skipped (G12); ``inclusive=True`` re-reads it, which is safe because the
    upsert is idempotent.
    """
    cols = list(columns) if columns else source.columns
    return source.where(newer_than(ts_col, wm, inclusive)).select(*cols)
