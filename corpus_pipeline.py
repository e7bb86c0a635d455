"""The training-data pipeline: documents in, token ids out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
result as Parquet into the shared folder and rereads it as the next stage's docs.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemscope.llm import bpe, lines, quality, simhash, winnowing
from itemscope.llm.common import ready, saved

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the full policy."""
    ready(spark)
    return quality.keep(docs, quality.FULL)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their texts without lines that stand elsewhere already; n_chars follows the text."""
    ready(spark)
    return lines.deduplicate(docs).withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of near-duplicates."""
    ready(spark)
    return simhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    items = ready(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return winnowing.decontaminate(docs, items)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and their decoding."""
    ready(spark)
    coded = bpe.apply(docs, TOKENIZER, decoded="decoded", carry=["doc_id", "lang", "source"])
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", bpe_encoding),
]

#: Line and near-duplicate components are not expressible in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = ready(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = saved(stage(spark, docs, sf_dir), f"stage-{k}")
    return docs
