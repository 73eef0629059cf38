"""Column-level predicates and scalar helpers (P1–P7, §2.12 built-ins).

All return ``Column`` expressions, so they stay inside whole-stage codegen and
are pushed down by Catalyst wherever the scan supports it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The unknown-member surrogate key and the "empty table"
# watermark of the reference's sync.
UNKNOWN_KEY = -1
EPOCH = dt.datetime(1970, 1, 1)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def newer_than(ts_col: str | Column, watermark, inclusive: bool = False) -> Column:
    """``ts > watermark`` (strict by default, as the reference's sync)."""
    wm = watermark if isinstance(watermark, Column) else ts_literal(watermark)
    return col(ts_col) >= wm if inclusive else col(ts_col) > wm


def changed(old: str | Column, new: str | Column) -> Column:
    """SQL ``old <> new``; a NULL on either side is *not* a change."""
    return F.coalesce(col(old) != col(new), F.lit(False))


def differs(old: str | Column, new: str | Column) -> Column:
    """Null-safe difference (NULL vs value counts as a change)."""
    return ~col(old).eqNullSafe(col(new))


def valid_at(d: str | Column, start: str | Column, end: str | Column) -> Column:
    """P5: ``d >= start AND (d < end OR end IS NULL)`` — half-open validity."""
    return (col(d) >= col(start)) & ((col(d) < col(end)) | col(end).isNull())


def non_empty_interval(start: str | Column, end: str | Column) -> Column:
    """A version ``[s, e)`` with ``e <= s`` can never match (trap G3)."""
    return col(end).isNull() | (col(start) < col(end))


def known(key: str | Column) -> Column:
    """Exclude the unknown member."""
    return col(key) != F.lit(UNKNOWN_KEY)


def weekday_number(d: str | Column, first_day_of_week: int = 7) -> Column:
    """SQL Server ``DATEPART(WEEKDAY, d)`` under ``SET DATEFIRST n``.

    ``first_day_of_week`` uses the DATEFIRST numbering (1 = Monday ... 7 =
    Sunday); 7 is the US default the reference runs under.  Spark's
    ``dayofweek`` is 1 = Sunday ... 7 = Saturday.
    """
    if not 1 <= first_day_of_week <= 7:
        raise ValueError("first_day_of_week must be in 1..7")
    return (F.pmod(F.dayofweek(col(d)) - 1 - F.lit(first_day_of_week), F.lit(7)) + 1).cast("int")


def ts_literal(value: dt.datetime | dt.date) -> Column:
    """A zone-free timestamp literal (built from text, so neither the Python
    process zone nor the session zone can shift it)."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
