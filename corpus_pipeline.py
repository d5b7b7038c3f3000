"""From raw documents to token files: each stage reads what the one before kept.

``run`` writes every stage's documents as Parquet to shared storage and reads
them again for the next one, so a lost executor costs at most its own tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import contamination, lang, mixing, near_text, token_files
from strata.llm.common import stage, table
from strata.session import scratch_path

LEAST_SCORE = 0.5          # a prediction below it is no language


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from the table; those without a
    letter, or that no language explains better than the others, go."""
    pred, score = lang.prediction_columns(docs)
    found = lang.identify(docs, lang.fit(docs))
    return found.where((F.col(pred) != lang.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the least doc_id."""
    return near_text.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the weighted mix of their sources, each as often as taken."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and per document what they hold: doc_id, start,
    n_tokens, ids_crc32."""
    return token_files.read_tokens(spark, token_files.write_tokens(docs, scratch_path(spark, "corpus-tokens")))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("source_mix", source_mix), ("token_ids", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return docs


# Language scores and tokenizer ids are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None
