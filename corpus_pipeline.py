"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing, token output.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each result as Parquet in the shared folder, removes what the stage has
left there besides, and hands the reread table to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkmart.llm import stages
from sparkmart.llm.common import made, release, stored, table

STAGES = [
    ("quality_rules", stages.quality),
    ("ngram_jaccard_join", stages.near_duplicates),
    ("benchmark_decontamination", stages.decontaminate),
    ("source_mixing", stages.mix_sources),
    ("token_output", stages.token_output),
]

#: The mix and the similarity regions are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = made()
        docs = stored(stage(spark, docs, sf_dir), name)
        release(spark, before, docs)
    return docs
