"""Stages of the corpus pipeline: each applies one operator to the whole of its input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm.common import ship, table

#: The columns of ``documents`` that every stage but the last returns.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality cascade rejects go."""
    from sparkmart.llm.quality_rules import judge

    return judge(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of linked documents stays."""
    from sparkmart.llm.ngram_join import representatives

    ship(spark)
    return representatives(docs.select(*COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts."""
    from sparkmart.llm.decontamination import remove_spans

    ship(spark)
    return remove_spans(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (a row per copy)."""
    from sparkmart.llm.mixing import mix

    taken = mix(docs.select(*COLUMNS), carry=COLUMNS).where("copies > 0")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*[f"carried.{c}" for c in COLUMNS])


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, written as files and read back."""
    from sparkmart.llm.token_output import digest_rows

    ship(spark)
    return digest_rows(docs)
