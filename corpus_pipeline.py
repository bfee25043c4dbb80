"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs. All but the last return the
columns of documents:

* quality rules: rejected documents go, kept ones lose their failed lines;
* language id: documents without a language found with enough confidence go;
* line dedup: later copies of repeated runs of lines go from the texts;
* SimHash near-dedup: one document of each group stays, the one with the smallest doc_id;
* best-fit packing: a row per piece of a document with its place in a sequence,
  lengths counted in tokens with one end token a document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from earshot.llm import langid, linededup, packing, quality, simhash, tokenstore
from earshot.llm.common import documents_of, few_rows
from earshot.session import scratch_folder, share_code

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    few_rows(share_code(spark))
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    few_rows(share_code(spark))
    return langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    few_rows(share_code(spark))
    return linededup.keep_first_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    few_rows(share_code(spark))
    return simhash.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    few_rows(share_code(spark))
    lengths = tokenstore.with_token_count(docs, public_tokenizers.path(TOKENIZER), carry=["doc_id"])
    return packing.pack(lengths)


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("line dedup", line_dedup),
    ("simhash near-dedup", near_dedup),
    ("best-fit packing", best_fit_packing),
]

# Fingerprints and packing are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = documents_of(spark, sf_dir)
    folder = scratch_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return STAGES[-1][1](spark, docs, sf_dir)
