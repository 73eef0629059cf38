"""URL filters: stated site rules, then association rules mined from labelled URLs.

A URL becomes a set of tokens (host labels and their hyphen parts, path
segments, query keys).  Spark's FP-growth mines token combinations together
with a label token over the labelled pages; rules ``tokens -> unwanted`` with
enough support and confidence, and more confidence than any of their sub-rules,
block the pages that hold all their tokens.  Matching uses an inverted index:
each rule is listed under its rarest token, a page looks up its tokens there
and tests the few rules found.  Tokens of the same unwanted pages are mined as
one item, so a site's many shared tokens don't multiply the itemsets.

Defined results: a null URL or one without ``://`` has empty host and path, no
tokens and is allowed; without labelled pages or strong rules every page
without a stated rule is allowed; pages with several labels count as unwanted
when one of the labels says so; an empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import urls
from sparkmart.llm.common import broadcast_checked, stored

#: The production site rules (action, host/path).
SITE_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: Bounds of mined rules: share and number of labelled unwanted pages, share of unwanted pages among those matched.
MIN_SUPPORT = 0.001
MIN_PAGES = 10
MIN_CONFIDENCE = 0.6
UNWANTED = "label:unwanted"


def site_rule(host: Column, path: Column, rules=SITE_RULES) -> Column:
    """The longest stated rule that fits, else null."""
    chain = None
    for _, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        chain = F.when(fits, rule) if chain is None else chain.when(fits, rule)
    return chain if chain is not None else F.lit(None).cast("string")


def tokens(url: Column) -> Column:
    """Sorted distinct tokens of a URL; numbers in paths share one token."""
    def named(kind, parts):
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))

    labels = F.split(urls.host(url), r"\.")
    parts = F.flatten(F.transform(labels, lambda x: F.split(x, "-")))
    segments = F.transform(F.split(urls.path(url), "/"), lambda x: F.regexp_replace(x, r"\d+", "0"))
    keys = F.transform(F.split(urls.query(url), "&"), lambda x: F.regexp_extract(x, r"^[^=]*", 0))
    return F.array_sort(F.array_distinct(F.concat(named("h:", labels), named("h:", parts), named("p:", segments), named("q:", keys))))


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, unwanted) of labelled pages: of low quality or toxic by any label row."""
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    votes = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(bad.cast("int")).alias("__bad"))
    ids = pages.select("page_id")
    return ids.join(votes, F.col("page_id") == F.col("doc_id")).select("page_id", (F.col("__bad") == 1).alias("unwanted"))


def _classes(bad: DataFrame, least: float) -> DataFrame:
    """(head, members): tokens that stand on at least ``least`` unwanted pages, those of the same pages together.

    Page sets are compared by their size and 128 bits of xor-ed page hashes.
    A class has at most as many tokens as one of its pages.
    """
    one, two = F.bit_xor(F.xxhash64("id")).alias("one"), F.bit_xor(F.xxhash64(F.lit(7), "id")).alias("two")
    sets = bad.select("id", F.explode("items").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"), one, two)
    same = sets.where(F.col("n") >= least).groupBy("n", "one", "two")
    return same.agg(F.min("t").alias("head"), F.array_sort(F.collect_list("t")).alias("members")).select("head", "members")


def mine(items: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, max_tokens: int | None = None) -> DataFrame:
    """(antecedent, confidence, support) of the pruned rules for the unwanted label.

    ``items``: one array of distinct tokens per labelled page, with the label
    token on unwanted ones.  A rule needs ``min_support`` among the unwanted
    pages, so rarer tokens are left out before the trees are built, and tokens
    that stand on the same unwanted pages are one item there: of the token sets
    that differ only within such classes, the whole one is mined, which is the
    surest.  Rules have any number of tokens unless ``max_tokens`` is given.
    """
    n = items.count()
    schema = "antecedent array<string>, confidence double, support double"
    none = items.sparkSession.createDataFrame([], schema)
    least = max(MIN_PAGES, min_support * n)
    unwanted = items.where(F.array_contains("items", UNWANTED))
    bad = stored(unwanted.select(F.monotonically_increasing_id().alias("id"), F.array_remove("items", UNWANTED).alias("items")), "url-unwanted")
    classes = stored(_classes(bad, least), "url-classes")
    heads = broadcast_checked(classes.select("head"), 200)
    kept = bad.select("id", F.explode("items").alias("head")).join(heads, "head").groupBy("id").agg(F.collect_list("head").alias("items"))
    kept = stored(kept.select("items"), "url-heads")
    n_kept = kept.count()
    if not n_kept:
        return none
    # Half a page below the bound: the share times the pages is rounded up again.
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, (math.ceil(least) - 0.5) / n_kept), minConfidence=1.0).fit(kept)
    found = stored(model.freqItemsets, "url-itemsets")
    whole = found.select("items", "freq", F.explode("items").alias("head")).join(classes, "head").groupBy("items", "freq")
    sets = whole.agg(F.array_sort(F.flatten(F.collect_list("members"))).alias("antecedent")).select("antecedent", F.col("freq").alias("n_bad"))
    if max_tokens is not None:
        sets = sets.where(F.size("antecedent") <= max_tokens)
    sets = stored(sets, "url-sets")
    every = matches(items.withColumn("id", F.monotonically_increasing_id()), sets.select("antecedent"))
    totals = every.groupBy("antecedent").agg(F.count(F.lit(1)).alias("n_all"))
    rules = sets.join(totals, "antecedent").select(
        "antecedent", (F.col("n_bad") / F.col("n_all")).alias("confidence"), (F.col("n_bad") / n).alias("support")
    )
    strong = stored(rules.where(F.col("confidence") >= min_confidence), "url-rules")
    # A rule adds nothing when one with a subset of its tokens is as sure.
    single = strong.select(F.explode("antecedent").alias("t"), "antecedent", "confidence")
    parts = strong.select(F.col("antecedent").alias("less"), F.col("confidence").alias("sure"), F.array_min("antecedent").alias("t"))
    shorter = F.size("less") < F.size("antecedent")
    within = F.size(F.array_except("less", "antecedent")) == 0
    weak = single.join(parts, "t").where(shorter & within & (F.col("sure") >= F.col("confidence"))).select("antecedent").distinct()
    return strong.join(weak, "antecedent", "left_anti")


def matches(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(id, antecedent) of every page (id, items) and rule whose tokens it holds.

    Inverted index: a rule stands under the one of its tokens that the fewest
    pages hold, so a page finds a rule at most once and common tokens find none.
    """
    listed = stored(rules.select("antecedent", F.explode("antecedent").alias("token")), "url-rule-tokens")
    pages_tokens = pages.select("id", "items", F.explode("items").alias("token"))
    uses = pages_tokens.select("token").join(broadcast_checked(listed.select("token").distinct(), 200), "token", "left_semi")
    uses = uses.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    by_use = F.struct(F.coalesce("n", F.lit(0)), "token")
    index = stored(listed.join(uses, "token", "left").groupBy("antecedent").agg(F.min_by("token", by_use).alias("token")), "url-index")
    bytes_ = F.aggregate("antecedent", F.lit(100), lambda total, t: total + F.octet_length(t) + 32)
    longest = index.agg(F.max(bytes_)).first()[0] or 0
    found = pages_tokens.join(broadcast_checked(index, longest), "token")
    return found.where(F.size(F.array_except("antecedent", "items")) == 0).select("id", "antecedent")


def judge(pages: DataFrame, labels: DataFrame, rules=SITE_RULES) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict."""
    url = F.col("url")
    votes = labelled(pages, labels).withColumnRenamed("page_id", "__id")
    seen = pages.select("page_id", tokens(url).alias("items")).join(votes, F.col("page_id") == F.col("__id"))
    with_label = F.when(F.col("unwanted"), F.concat("items", F.array(F.lit(UNWANTED)))).otherwise(F.col("items"))
    mined = mine(stored(seen.select(with_label.alias("items")), "url-labelled"))
    hits = matches(pages.select(F.col("page_id").alias("id"), tokens(url).alias("items")), mined.select("antecedent"))
    hits = hits.select(F.col("id").alias("__id")).distinct().withColumn("__hit", F.lit(True))
    rows = pages.select("page_id", urls.host(url).alias("host"), urls.path(url).alias("path"))
    rows = rows.withColumn("rule", site_rule(F.col("host"), F.col("path"), rules))
    action = F.create_map(*[F.lit(x) for act, rule in rules for x in (rule, act)]) if rules else F.create_map(F.lit(""), F.lit(""))
    rows = rows.join(hits, F.col("page_id") == F.col("__id"), "left")
    verdict = F.when(F.col("rule").isNotNull(), action[F.col("rule")]).when(F.col("__hit"), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
