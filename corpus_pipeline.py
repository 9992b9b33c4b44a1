"""From raw to training-ready documents: each stage reads what the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadweir.llm import byte_bpe, decontaminate, quality, simhash, substring
from loadweir.llm.common import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep to the base rules and to the bounds of their language and source."""
    judged = quality.judge(staged(quality.measure(docs), "measured"))
    return judged.where("kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 35-word passages that occur more than once, if any words are left.

    Texts that lose nothing stay as they are; the others are the words left, by one space.
    ``n_chars`` follows the text.
    """
    cut = substring.cut_repeats(docs, width=35)
    kept = cut.where("n_removed = 0 or n_words > n_removed")
    text = "if(n_removed = 0, text, kept)"
    return kept.selectExpr("doc_id", f"{text} as text", "lang", "source", f"cast(length({text}) as bigint) as n_chars")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten words in a row of any benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), width=10)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """For every document left, its number of tokens and the digests of its ids and of their decoding."""
    return byte_bpe.round_trip(docs, "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_level_bpe", byte_level_bpe),
]

#: The stages are beyond SQL (components, suffix arrays, BPE); tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's rows are written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
