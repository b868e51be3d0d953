"""A training corpus from ``documents``: language, near duplicates, benchmark leaks, mix, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next stage's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry.llm import decontamination, language, mixing, near_dups, queries, token_files
from segmentry.session import scratch_path


# A text is in none of the languages if each codes it in more bits than no model does (8 a byte), by so many at least.
# Short texts of a few rare bytes stay below that; no text of sf0.1, check_s or check_h costs more than under no model.
BITS_OVER = 32


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those without a letter go, and those that no language learned explains.

    Where no label can be learned from, all documents with a letter stay.
    """
    model = language.train(docs)
    if not model.languages:
        return docs.where(language.has_letter())
    found = language.predict(docs, model, keep=tuple(docs.columns), added=("__llm_lang", "__llm_score", "__llm_gain"))
    told = (F.col("__llm_lang") != language.UNKNOWN) & (F.col("__llm_gain") > -BITS_OVER)
    return found.where(told).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return near_dups.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whole or edited."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and for each of its rows where its ids start, how many there are, and their crc32."""
    path = scratch_path(spark, "corpus")
    token_files.write_token_files(docs, path, queries.tokenizer_path())
    return token_files.read_digests(spark, path)


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mix_sources", mixed_sources),
    ("token_files", token_output),
]

# Language models, sketches, alignments, knapsacks and a tokenizer are beyond SQL; tests/llm compares by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
