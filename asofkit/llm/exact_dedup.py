"""Op 5: exact copies by progressive refinement: length, then a hash of the beginning, then a hash of the whole text.

A row whose length, or whose beginning among rows of its length, no other row has is settled without hashing its
content; only the others are read in full. Every step moves keys and counts, combined before the shuffle, so a group
that holds a third of all rows is a row per task. Tables of surviving keys are written first: the planner then knows
their size and broadcasts them only below ``spark.sql.autoBroadcastJoinThreshold``; else it joins by shuffle, and
adaptive execution splits a hot key's rows.

Defined results: null text equals the empty text. Of equal texts the row with the largest doc_id stays (a null doc_id
loses against any other). Rows that repeat doc_id and text are each marked as staying here, and ``kept_rows`` keeps
one of them. An empty table gives no rows. Other columns are carried by ``kept_rows`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofkit.llm.common import Scratch, table

#: Code points of the beginning that the second step hashes.
HEAD = 64


def _body(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def _keys(text: str, head: int) -> tuple[Column, Column]:
    return F.octet_length(_body(text)).alias("_len"), F.xxhash64(F.substring(_body(text), 1, head)).alias("_head")


def copies(docs: DataFrame, id: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """(len, head, hash, keep_id, group_size, at_top) of each group of two rows or more; at_top: its rows with keep_id."""
    scratch = Scratch(docs.sparkSession)
    length, start = _keys(text, head)
    rows = docs.select(F.col(id).alias("_id"), _body(text).alias("_text"), length, start)
    lengths = scratch.keep(rows.groupBy("_len").count().where("count > 1").select("_len"))
    heads = scratch.keep(rows.select("_len", "_head").join(lengths, "_len", "left_semi")
                         .groupBy("_len", "_head").count().where("count > 1").select("_len", "_head"))
    full = (rows.join(heads, ["_len", "_head"], "left_semi")
            .select("_id", "_len", "_head", F.unhex(F.sha2("_text", 256)).alias("_hash")))
    by_id = full.groupBy("_len", "_head", "_hash", "_id").agg(F.count(F.lit(1)).alias("_n"))
    groups = by_id.groupBy("_len", "_head", "_hash").agg(
        F.max("_id").alias("_keep_id"), F.sum("_n").alias("_size"), F.max_by("_n", F.coalesce("_id", F.lit(-(1 << 63)))).alias("_at_top"))
    return scratch.keep(groups.where("_size > 1"))


def marked(docs: DataFrame, id: str = "doc_id", text: str = "text", head: int = HEAD, carry: list[str] | None = None) -> DataFrame:
    """A row per row: row (a struct of the columns ``carry``, all if None), hash (null if settled before), keep_id,
    group_size, kept, at_top (rows of its group with keep_id).

    The whole text is hashed again only for rows whose length and beginning belong to a group.
    """
    groups = copies(docs, id, text, head)
    heads = groups.select("_len", "_head", F.lit(True).alias("_open")).distinct()
    row = F.struct(*(docs.columns if carry is None else carry)).alias("row")
    found = docs.select(row, F.col(id).alias("_id"), _body(text).alias("_text"), *_keys(text, head)).join(heads, ["_len", "_head"], "left")
    hashed = found.select("row", "_id", "_len", "_head", F.when(F.col("_open"), F.unhex(F.sha2("_text", 256))).alias("_hash"))
    out = hashed.join(groups, ["_len", "_head", "_hash"], "left")
    in_group = F.col("_size").isNotNull()
    return out.select(
        "row", F.col("_hash").alias("hash"), F.when(in_group, F.col("_keep_id")).otherwise(F.col("_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).alias("group_size"), (~in_group | F.col("_id").eqNullSafe(F.col("_keep_id"))).alias("kept"),
        F.coalesce("_at_top", F.lit(1)).alias("at_top"))


def kept_rows(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, one of each text, with the columns of ``docs``."""
    rows = marked(docs, id, text).where("kept")
    again = rows.where("at_top > 1").dropDuplicates(["hash"])
    return rows.where("at_top = 1").unionByName(again).select("row.*")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of documents: the row of its group that stays, the group's size, and the digest of its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # The digest is a column of the report alone: the operator hashes only what its first two steps leave open.
    digested = docs.withColumn("text_sha256", F.sha2(_body("text"), 256))
    return marked(digested, carry=["doc_id", "text_sha256"]).select(
        "row.doc_id", "keep_id", "group_size", "kept", "row.text_sha256")


OP5_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
