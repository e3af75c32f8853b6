"""A training corpus from ``documents``: five stages, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fileload.llm import decontam, lines, minhash, pieces, toxicity
from fileload.session import stage_table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated score is below one half."""
    return toxicity.remove_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines of windows that an earlier document has."""
    return lines.remove_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8)."""
    return minhash.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), remove="documents")


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each text, and the text they decode to."""
    return pieces.encode_decode(docs.select("doc_id", "lang", "source", "text"), MODEL).select(
        "doc_id", "lang", "source", "ids", "decoded"
    )


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("near-duplicates", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("sentencepiece", piece_stage),
]

#: A trained classifier and piece ids are beyond SQL; tests hold every stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading the table the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
