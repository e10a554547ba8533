"""Registered queries of the corpus operators; each reads whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_pipeline import run as run_pipeline
from tabulyst.llm import decontaminate as leaks
from tabulyst.llm import fingerprint, html, jaccard, language, licenses, oracles, packing, quality, ranking, resampling, secrets, spans, toxicity
from tabulyst.llm.frames import crc_class


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.digest(leaks.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(language.training_rows(docs)))
    return found.select("doc_id", (crc_class("doc_id", 5) == 0).alias("held_out"), "lang_pred", F.col("score"))


def op3_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (crc_class("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_likeness(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"))))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", (crc_class("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.dedup_spans(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_pipeline(spark, sf_dir)


LLM_QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_language_mixture": op2_language_mixture,
    "op3_html_density": op3_html_density,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_secret_scan": op5_secret_scan,
    "op6_toxicity": op6_toxicity,
    "op7_order_minhash": op7_order_minhash,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality": op9_quality,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_license_scan": op12_license_scan,
    "op13_importance_resampling": op13_importance_resampling,
    "pipeline": pipeline,
}

LLM_ORACLES = {
    "op1_decontaminate": oracles.DECONTAMINATE,
    "op4_ngram_jaccard": oracles.JACCARD,
    "op5_secret_scan": oracles.SECRETS,
    "op11_lexical_search": oracles.SEARCH,
    "op12_license_scan": oracles.LICENSES,
    "op13_importance_resampling": oracles.RESAMPLE,
}
