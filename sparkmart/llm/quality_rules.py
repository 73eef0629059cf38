"""Quality rules as a short-circuit cascade (DataFrame functions only).

Every rule is a Boolean expression that is true when a document fails.  The
order of the rules never changes the verdict (a document is kept when no rule
fails it), only the work: each rule's cost (wall time) and rejection rate are
measured on a bounded sample, and the rules run in descending rejection per
second inside one ``CASE WHEN``, which stops at the first failing branch.

Defined results: null text has no words, hence fails the base rules; nulls in
a rule's expression count as "does not fail"; an empty table gives an empty
table; repeated rows are judged one by one; extra columns are kept.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import WORD

#: Fixed values of the base rules.
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = r"[#*$%&|<>]"
HAS_WORD = r"[^\x20\x09-\x0D]"
NO_LETTERS = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]+(?![^\x20\x09-\x0D])"
ELLIPSIS = r"(?:\.\.\.|…)[ \t\r]*(?:\n|$)"

#: Bound of the sample on which cost and selectivity are estimated.
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """``fails(text)`` is true when the document fails; base columns may be used by name."""

    name: str
    fails: Callable[[Column], Column]


def _matches(text: Column, pattern: str) -> Column:
    """Characters of ``text`` within matches of the pattern."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def base_columns(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Repeated windows are found inside the row: window hashes first (no equal
    hashes: no repeats), and only rows with equal hashes sort their windows'
    words themselves, so the counts are exact.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    work = df.withColumn("__words", F.regexp_extract_all(body, F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(HAS_WORD))
    work = work.withColumn("__lines", lines)
    n = F.size("__words")
    hashes = F.when(
        n > WINDOW,
        F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(F.col("__words"), i, WINDOW))),
    )
    work = work.withColumn("__hashes", hashes)
    repeats = F.size(F.array_distinct("__hashes")) < F.size("__hashes")
    spans = F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)),
        lambda i: F.struct(F.array_join(F.slice(F.col("__words"), i, WINDOW), " ").alias("k"), i.alias("i")),
    )
    work = work.withColumn("__spans", F.when(repeats, F.array_sort(spans)))
    s = F.col("__spans")
    again = F.filter(
        s,
        lambda x, j: ((j > 0) & (F.get(s, j - 1)["k"] == x["k"]))
        | F.coalesce(F.get(s, j + 1)["k"] == x["k"], F.lit(False)),
    )
    work = work.withColumn("__at", F.array_sort(F.transform(again, lambda x: x["i"])))
    at = F.col("__at")
    # Words covered by the windows: each adds its distance to the next one, at most its length.
    covered = F.aggregate(
        F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0),
        lambda acc, x: acc + x,
    )
    # A filter on the result must not be pushed below this projection: the windows' expressions
    # would be put into each other and evaluated per element.  The partition id (times zero) holds it.
    here = F.spark_partition_id() * 0
    work = work.select(
        *[F.col(f"`{c}`") for c in df.columns],
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        _matches(body, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        (F.coalesce(F.when(F.size("__at") > 0, covered), F.lit(0)) + here).cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("__n_lines"),
        F.size(F.filter(F.zip_with("__words", F.slice("__words", 2, F.greatest(n, F.lit(1))), lambda a, b: a == b), lambda x: x)).cast("long").alias("__n_stutter"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return work.withColumn("base_failed", failed)


#: The production rules.  Thresholds follow published rule sets (mean word
#: length, symbol-to-word ratio, duplicated lines, stuttered words, share of
#: capitals, share of words with a letter, lines ending in an ellipsis).
RULES = (
    Rule("mean_word_length", lambda t: ~F.col("word_chars").between(2 * F.col("n_words"), 20 * F.col("n_words"))),
    Rule("symbols", lambda t: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("duplicate_lines", lambda t: (F.col("n_dup_lines") >= 3) & (10 * F.col("n_dup_lines") > 3 * F.col("__n_lines"))),
    Rule("stutter", lambda t: 5 * F.col("__n_stutter") > F.col("n_words")),
    Rule("capitals", lambda t: 2 * _matches(t, r"\p{Lu}+") > _matches(t, r"\p{L}+")),
    Rule("words_with_letters", lambda t: 2 * F.regexp_count(t, F.lit(NO_LETTERS)) > F.col("n_words")),
    Rule("ellipsis_lines", lambda t: 10 * F.regexp_count(t, F.lit(ELLIPSIS)) > 3 * F.col("__n_lines")),
)


def order_rules(df: DataFrame, rules, text: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 17) -> list[Rule]:
    """Rules in descending rejection per second, both measured on a sample of about ``sample_rows`` rows.

    ``df`` has the base columns' inputs; the sample's base columns are
    computed once and cached, so each timing covers the rule alone.
    """
    total = df.count()
    if not total or len(rules) < 2:
        return list(rules)
    part = df.select(F.col(f"`{text}`").alias("text")).sample(fraction=min(1.0, sample_rows / total), seed=seed)
    sample = base_columns(part.coalesce(4)).cache()
    try:
        rows = max(1, sample.count())
        scored = []
        for rule in rules:
            began = time.perf_counter()
            rejected = sample.agg(F.count_if(F.coalesce(rule.fails(F.col("text")), F.lit(False)))).first()[0]
            scored.append(((rejected + 0.5) / rows / (time.perf_counter() - began), rule))
    finally:
        sample.unpersist()
    return [rule for _, rule in sorted(scored, key=lambda x: (-x[0], x[1].name))]


def verdict(rules, text: str = "text") -> Column:
    """True when neither the base rules nor any of ``rules`` (in this order) fails the document."""
    kept = F.when(F.col("base_failed"), False)
    for rule in rules:
        kept = kept.when(rule.fails(F.coalesce(F.col(f"`{text}`"), F.lit(""))), False)
    return kept.otherwise(True)


def judge(df: DataFrame, rules=RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``df`` with the base columns and ``kept``; columns of these names in ``df`` are replaced."""
    own = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"}
    df = df.drop(*(c for c in df.columns if c in own))
    ordered = order_rules(df, rules, text, sample_rows)
    return base_columns(df, text).withColumn("kept", verdict(ordered, text)).drop("__n_lines", "__n_stutter")
