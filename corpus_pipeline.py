"""From raw documents to packed training sequences: five stages, each one operator.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the next one's ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saleslake.llm import language, lines, packing, quality, simhash
from saleslake.llm.queries import trusted_ids
from saleslake.llm.shared import small_batches, store, table, tokenizer_file

# tokenizers cannot be written in SQL; tests compare with a brute-force version
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are near to a learned language."""
    found = language.identified(docs)
    return found.where(~found[found.columns[-1]].rejected).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the model keep."""
    judged = quality.judged(docs, trusted_ids(spark, sf_dir))
    return judged.where(judged[judged.columns[-1]].kept).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of three-line windows that an earlier one has."""
    return lines.deduplicated(docs).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one_of_group(docs, shingle=4, max_bits=4)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.described(packing.pack(docs, tokenizer_file("word_bpe_49k.json")))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    with small_batches(spark):
        for name, stage in STAGES[:-1]:
            docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
