"""The corpus pipeline: quality rules, near-duplicates, repeated passages, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns
of ``docs``.  ``run`` writes every stage's result to the shared folder and reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from snapmerge.llm import common, decontam, line_rules, packing, repeats, simhash

#: vocabulary file of the packing stage
TOKENIZER = "word_bpe_49k.json"
#: repeated passages of at least so many words go; the least bytes that so many words had in 2,200 measured passages were 260
PASSAGE_WORDS, PASSAGE_BYTES = 50, 240


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines common to a source go, and documents that the rules reject."""
    return line_rules.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates the document with the smallest doc_id stays."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that occur more than once go, everywhere they occur."""
    return repeats.remove_repeats(docs, length=PASSAGE_BYTES, min_words=PASSAGE_WORDS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in packed sequences."""
    cut = packing.pieces(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER))
    return packing.pack(cut).select("doc_id", "piece", "start", "length", "ids", "sequence_id", "offset")


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("decontamination", decontamination), ("packing", sequences)]

#: packing and SimHash are not expressible in SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with common.scratch() as made:
            docs = common.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
            made.pop()  # the stage's result stays, what it was made from goes
    return docs
