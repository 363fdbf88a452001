"""A corpus pipeline over documents: quality, exact copies, near copies, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the next one's docs.
All but the last return the columns of documents (extra columns are carried). Empty input gives empty output of the
same columns; nulls are handled as each operator's module says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofkit.llm import bpe, exact_dedup, mixing, ngram_join, quality_classifier
from asofkit.llm.common import Scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 4, fitted on the documents themselves: those that the classifier rejects go."""
    return quality_classifier.kept_rows(docs, quality_classifier.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 5: one row of each text stays, the one with the largest doc_id."""
    return exact_dedup.kept_rows(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 9: one document of each group of near copies stays, the one with the smallest doc_id (null last)."""
    return ngram_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 8: a document's row for each time that it is taken whole, in training order."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 2: doc_id, source, n_tokens, ids and the text decoded from them."""
    coded = bpe.bpe_encode(docs.select("doc_id", "source", "text"), public_tokenizers.path("word_bpe_49k.json"), decoded="decoded")
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("bpe", encode)]

#: SQL can express neither the trained classifier nor the encoder; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    scratch, docs = Scratch(spark), table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
