"""Documents to packed training sequences: five stages, each written and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.common import kept
from shelfmark.llm.line_dedup import dedup_lines
from shelfmark.llm.mixing import mixed_documents
from shelfmark.llm.near_duplicates import one_per_group
from shelfmark.llm.packing import pack
from shelfmark.llm.quality_model import score_quality
from shelfmark.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    scored = score_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 1").select(*docs.columns)


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """`docs` with `n_chars` of its present text, where it has such a column."""
    if "n_chars" not in docs.columns:
        return docs
    n = F.coalesce(F.char_length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", n).select(*columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier runs; each stays, if only with an empty text."""
    return _counted(dedup_lines(docs), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_per_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, one row per piece."""
    return pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: Sets of hashes, components and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
