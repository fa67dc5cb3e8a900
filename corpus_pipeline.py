"""The corpus pipeline: quality rules, exact dedup, near-duplicate join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents. All but the last
return the columns of ``documents``.

The mix repeats a document as often as it is used; packing packs each use.

Cases: null, empty and blank texts fail the quality rules, so later stages see none from ``run``; a stage that is given them
keeps one of them (exact dedup), keeps all (near copies), takes none (mix), or packs the end token alone (packing). Repeated rows are copies. Null sources are a source of their own. An empty table gives an empty result.
Columns beyond those of ``documents`` are kept, whatever their names, up to packing.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from watchpath.llm import exact_dedup, mixing, ngram_join, packing, quality_votes  # noqa: E402
from watchpath.llm.queries import ship, tokenizer_path  # noqa: E402
from watchpath.llm.tables import run_path  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    ship(spark)
    return quality_votes.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each exact text."""
    ship(spark)
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts."""
    ship(spark)
    return ngram_join.drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the target mix, each as often as it is used."""
    ship(spark)
    return mixing.repeated(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two sequences of token ids."""
    ship(spark)
    packed = packing.pieces(docs, tokenizer_path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "tokens")


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_copies), ("ngram_join", near_copies),
          ("mixing", source_mix), ("packing", sequences)]

#: The stages hold an iterative model fit and a tokenizer, which SQL can't express; tests/llm checks against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = run_path(docs, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
