"""Corpus pipeline: language, near duplicates, benchmark leaks, secrets, packing.

Each stage takes the documents that the one before kept, as written Parquet. The stages and their
decisions: documents of no language, or of none with a share of 0.4, go; of each component of near
duplicates (five-word similarity of 0.8 or more) the document of least id stays; documents with any benchmark window go; secrets are
masked and n_chars follows; what is left is cut into pieces and packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulyst.llm import decontaminate, jaccard, language, packing, secrets
from tabulyst.llm.frames import Stages, replaced

LEAST_SHARE = 0.4
#: Near duplicates: words of a shingle, and hundredths of similarity from which on documents link.
NEAR_WORDS, NEAR_PART = 5, 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs, language.fit(language.training_rows(docs)), least=LEAST_SHARE)


def one_of_each_component(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_first(docs, shingle=NEAR_WORDS, part=NEAR_PART)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return replaced(secrets.mask(docs), "n_chars", lambda column: F.length(column("text")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(packing.token_pieces(docs)))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_component),
    ("decontaminate", without_benchmark),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Neither a mixture of languages nor a local search can be put in SQL; the tests hold brute force against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    stages, docs = Stages(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stages.keep(stage(spark, docs, sf_dir), name)
    return docs
