"""A training corpus from raw documents: stages in order, each written as Parquet and reread.

Every stage takes all documents that the one before it kept. All but the last return the
columns of the documents; the last one returns what is read back from the token files.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from etlkit.llm import decontamination, language_id, mixing, near_duplicates, token_files
from etlkit.llm.common import FEW_ROWS
from etlkit.session import options
from etlkit.workspace import new_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose best language is less likely than not, go."""
    return language_id.identified(docs, public_tokenizers.path("piece_bpe_32k.model"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_duplicates.NearDuplicates(docs).kept()


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item or more go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says."""
    return mixing.mixed(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: one row per document and copy."""
    folder = new_path(spark, "corpus-tokens")
    token_files.write_tokens(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_tokens(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mix_sources", mix_sources),
    ("token_files", write_token_files),
]

# Language scores and token ids have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"corpus-{name}")
        with options(spark, FEW_ROWS):  # whole texts go through Python
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
