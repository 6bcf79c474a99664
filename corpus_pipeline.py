"""Corpus preparation: quality rules, line dedup, near-duplicate removal,
substring dedup and packing, each stage over all that its predecessor kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  All but the last return the columns of documents; their
output is written as Parquet and reread as the next one's docs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import cut
from feedloom.llm.line_dedup import line_dedup
from feedloom.llm.packing import pack_documents
from feedloom.llm.quality_rules import keep_good
from feedloom.llm.simhash_trie import keep_one
from feedloom.llm.suffix_dedup import suffix_dedup


#: bytes of a passage that counts as repeated: some 50 short words (the repeated lines of over 50
#: words in the test tables have 246 bytes or more)
REPEATED = 240


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars, where there is one, follows the text."""
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) \
        if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return keep_good(spark, docs, labels)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted from the texts."""
    rows = line_dedup(spark, docs)
    return _counted(rows.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest doc_id."""
    return keep_one(spark, docs, shingle=3, max_bits=2)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes under strings of REPEATED bytes that start more than once are removed from the texts."""
    rows = suffix_dedup(spark, docs, length=REPEATED, as_text=True)
    return _counted(rows.select(*[F.col("kept").alias("text") if c == "text" else F.col("row")[c].alias(c)
                                  for c in docs.columns]))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents placed in sequences of 2048 tokens."""
    return pack_documents(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), encode_special_tokens=False)


STAGES = [("quality rules", quality), ("line dedup", lines), ("SimHash near-dedup", near_duplicates),
          ("suffix-array dedup", substrings), ("best-fit packing", packing)]

#: learned cutoffs, XXH64 fingerprints and packing have no SQL form; tests/llm
#: hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(spark, stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
