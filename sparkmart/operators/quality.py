"""Q1–Q4: the database constraints of the reference as DataFrame checks.

Each check returns the offending rows (empty = pass); :func:`fail_if_any`
turns a check into a pipeline gate.  Reports count violations per column so a
whole-table audit is one aggregate, not one job per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.functions.joins import broadcast_if_small
from sparkmart.schemas import TableSpec


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q1: rows where any required column is NULL, with the list of those columns."""
    # concat_ws skips NULLs, so only the names of the NULL columns remain.
    names = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return df.withColumn("null_columns", names).where(F.col("null_columns") != "")


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Q2: key values that occur more than once, with their count.

    A grouped count with map-side partial aggregation, so a key that holds a
    large share of the rows is pre-counted in every task before the shuffle.
    """
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).cast("long").alias("duplicate_count"))
        .where(F.col("duplicate_count") > 1)
    )


def check_foreign_key(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Q3: child rows whose (non-NULL) key has no parent (left anti join; the
    parent side is broadcast only when a count proves it small)."""
    parents, _ = broadcast_if_small(parent.select(F.col(parent_key).alias("_sm_pk")))
    return child.where(F.col(child_key).isNotNull()).join(
        parents, F.col(child_key) == F.col("_sm_pk"), "left_anti"
    )


def _domain_rules(
    lengths: Mapping[str, int], decimals: Mapping[str, tuple[int, int]]
) -> list[tuple[str, str, Column]]:
    rules = []
    for c, n in lengths.items():
        rules.append((c, f"length<={n}", F.length(F.col(c)) > F.lit(n)))
    for c, (p, s) in decimals.items():
        # try_cast returns NULL when the value does not fit NUMERIC(p, s).
        value = F.col(c)
        rules.append((c, f"numeric({p},{s})", value.isNotNull() & value.try_cast(f"decimal({p},{s})").isNull()))
    return rules


def check_domain(
    df: DataFrame, lengths: Mapping[str, int], decimals: Mapping[str, tuple[int, int]] | None = None
) -> DataFrame:
    """Q4: rows breaking a declared VARCHAR(n) length or NUMERIC(p, s) range."""
    rules = _domain_rules(lengths, decimals or {})
    broken = F.concat_ws(",", *[F.when(cond, F.lit(f"{c}:{rule}")) for c, rule, cond in rules])
    return df.withColumn("violations", broken).where(F.col("violations") != "")


def domain_report(
    df: DataFrame,
    table: str,
    lengths: Mapping[str, int],
    decimals: Mapping[str, tuple[int, int]] | None = None,
) -> DataFrame:
    """Q4 as an audit: one row per (column, rule) with its violation count."""
    return _counted(df, table, _domain_rules(lengths, decimals or {}))


def _counted(df: DataFrame, table: str, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """One aggregate over ``df``; a row per (column, rule)."""
    counts = df.agg(*[F.sum(cond.cast("long")).alias(f"_r{i}") for i, (_, _, cond) in enumerate(rules)])
    stack = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"_r{i}").alias("v"))
                for i, (c, rule, _) in enumerate(rules)
            ]
        )
    ).alias("r")
    return counts.select(stack).select(
        F.lit(table).alias("table_name"),
        F.col("r.column_name").alias("column_name"),
        F.col("r.rule").alias("rule"),
        F.coalesce(F.col("r.v"), F.lit(0)).cast("long").alias("violations"),
    )


def spec_violations(df: DataFrame, spec: TableSpec, table: str | None = None) -> DataFrame:
    """Q1 and Q4 of a declared table in one pass: (table_name, column_name, rule, violations > 0)."""
    rules = [(c, "not null", F.col(c).isNull()) for c in spec.required if c in df.columns]
    rules += _domain_rules(
        {c: n for c, n in spec.lengths.items() if c in df.columns}, {c: p for c, p in spec.decimals.items() if c in df.columns}
    )
    return _counted(df, table or spec.name, rules).where(F.col("violations") > 0)


def gate(df: DataFrame, spec: TableSpec, parents: Mapping[str, tuple[DataFrame, str]] | None = None) -> None:
    """Q1–Q4 before ``df`` is used as ``spec.name``: required columns, widths, unique key, parents.

    ``parents``: child column → (parent table, parent key).
    """
    fail_if_any(spec_violations(df, spec), f"{spec.name}: required columns and widths")
    if all(k in df.columns for k in spec.key):
        fail_if_any(check_unique(df, spec.key), f"{spec.name}: unique {list(spec.key)}")
    for column, (parent, key) in (parents or {}).items():
        orphans = check_foreign_key(df.select(column), parent, column, key)
        fail_if_any(orphans.groupBy(column).agg(F.count(F.lit(1)).alias("n")), f"{spec.name}: {column} without {key}")


class QualityError(RuntimeError):
    pass


def fail_if_any(violations: DataFrame, what: str) -> None:
    """Gate: raise (showing a few offending rows) if the check found anything."""
    sample = violations.take(5)
    if sample:
        raise QualityError(f"{what}: {len(sample)}+ offending rows, e.g. {sample}")
