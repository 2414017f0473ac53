"""From documents to packed sequences, in five stages."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavox.llm import lines, packing, quality, simhash, suffixes
from stratavox.shipping import shared_folder

#: Whether a document survives the near-duplicate stages depends on all others, by components and
#: by hashes that SQL does not offer; the tests hold the stages against brute force.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. Nulls, ties and empty tables: see quality.measure()."""
    return quality.keep(docs, "strict-1")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that 10 documents or more share go; documents stay. Nulls, ties, repeated rows, empty tables and
    clashing names: see lines.without_common_lines()."""
    return _counted(lines.without_common_lines(docs, least_docs=10))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8. Nulls, ties,
    repeated rows, empty tables and clashing names: see simhash.one_of_each()."""
    return simhash.one_of_each(docs, words=5, similar=True)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes go that a repeated string of 200 bytes covers; documents stay. Nulls, repeated rows, empty tables
    and clashing names: see suffixes.without_repeats()."""
    return _counted(suffixes.without_repeats(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens. Nulls, repeated rows and empty
    tables: see packing.pack()."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the cluster's shared folder and read again."""
    out = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{out}/{k}_{name}")
            docs = spark.read.parquet(f"{out}/{k}_{name}")
    return docs
