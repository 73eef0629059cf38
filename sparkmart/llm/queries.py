"""The registered queries of the pipeline operators: ``opN_<name>(spark, sf_dir)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkmart.llm.common import ship, table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.ngram_join import link_components

    ship(spark)
    return link_components(table(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.mixing import mix

    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.decontamination import contamination

    ship(spark)
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.url_filter import judge

    ship(spark)
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.quality_rules import judge

    judged = judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.warc import round_trip

    ship(spark)
    return round_trip(table(spark, sf_dir, "pages"))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.token_output import digest_rows

    ship(spark)
    return digest_rows(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.line_dedup import dedup_digests

    ship(spark)
    return dedup_digests(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.language_id import identify

    ship(spark)
    return identify(table(spark, sf_dir, "documents"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.html_extract import extract

    ship(spark)
    return extract(table(spark, sf_dir, "pages"))


def op11_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.packing import digest_rows

    ship(spark)
    return digest_rows(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.merkle import document_proofs

    ship(spark)
    return document_proofs(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkmart.llm.whitening import component_rows

    ship(spark)
    return component_rows(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op3_warc": op3_warc,
    "op4_token_output": op4_token_output,
    "op5_line_dedup": op5_line_dedup,
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_source_mixing": op2_source_mixing,
    "op6_decontamination": op6_decontamination,
    "op7_url_filter": op7_url_filter,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_html_extract": op10_html_extract,
    "op11_harmonic_packing": op11_harmonic_packing,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_embedding_whitening": op13_embedding_whitening,
}
