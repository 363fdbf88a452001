"""Op 7: token counts through a cache of digests.

A text's key is the digest of its content and of the tokenizer file. Known keys get their counts from the cache table;
of the others each distinct text is encoded once and its count appended to the cache (Parquet files in a shared
folder), then all documents get their counts by a join on the key.

Which row's text stands for a key is found on keys alone, combined before the shuffle, so a third of all rows with one
text costs one row per task. Counting follows the file's own pre-tokenizer: pieces of a text are counted by
the tokenizers library's model once per worker and remembered (bounded), as merges never cross pieces.

Defined results: null counts as empty (0 bytes, 0 tokens). Rows that repeat are counted one for one. An empty table
gives no rows and leaves the cache as it is. Other columns are not read. A special token's string inside a text counts
as one token, the library's default. Two jobs that append the same keys at a time leave equal rows: reads combine them.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofkit.llm.bpe import byte_letters
from asofkit.llm.common import Scratch, map_arrow, strings, table
from asofkit.sources.tables import scratch_dir

_CACHE = "content binary, tokenizer string, n_tokens long"


class Counter:
    """Counts of one byte-level BPE file."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        d = json.loads(source)
        if d["normalizer"] is not None or d["pre_tokenizer"]["type"] != "ByteLevel" or d["pre_tokenizer"]["add_prefix_space"] or d["post_processor"]:
            raise ValueError("not a byte-level BPE file of the known kind")
        self.tokenizer = Tokenizer.from_str(source)
        special = [regex.escape(x["content"]) for x in d["added_tokens"]]
        self.special = regex.compile("|".join(special)) if special else None
        self.pieces = regex.compile(public_tokenizers.PATTERN)
        self.letters = {b: c for c, b in byte_letters().items()}
        self.known: dict[str, int] = {}

    def _plain(self, text: str) -> int:
        pieces, known = self.pieces.findall(text), self.known
        counts = list(map(known.get, pieces))
        if None in counts:
            tokens = self.tokenizer.model.tokenize
            made = {p: len(tokens(p.encode().decode("latin-1").translate(self.letters)))
                    for p in {p for p, c in zip(pieces, counts, strict=True) if c is None}}
            counts = [made[p] if c is None else c for p, c in zip(pieces, counts, strict=True)]
            if len(known) > 600_000:
                known.clear()
            known.update((p, c) for p, c in made.items() if len(p) < 64)
        return sum(counts)

    def count(self, text: str) -> int:
        if self.special is None or "<" not in text:
            return self._plain(text)
        return len(self.special.findall(text)) + sum(self._plain(x) for x in self.special.split(text) if x)


@lru_cache(maxsize=2)
def counter(source: str) -> Counter:
    return Counter(source)


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """(content, n_tokens) of one tokenizer. A folder that isn't there yet is an empty cache."""
    spark.createDataFrame([], _CACHE).write.mode("append").parquet(path)
    rows = spark.read.schema(_CACHE).parquet(path).where(F.col("tokenizer") == tokenizer)
    return rows.groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str, cache: str) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens. ``cache``: a folder that grows."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        text = f.read()
    source, version = spark.sparkContext.broadcast(text), hashlib.sha256(text.encode()).hexdigest()
    body = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.octet_length(body).cast("long").alias("n_bytes"), F.unhex(F.sha2(body, 256)).alias("content"), body.alias("text"))
    stored = read_cache(spark, cache, version)
    # Keys first, without texts: what is not in the cache, and the one row whose text will be encoded. Joined on both, so
    # copies of one text are spread; rows that repeat with their doc_id meet in one place and are combined there.
    rows = rows.withColumn("chosen", F.coalesce("doc_id", F.lit(-(1 << 63))))
    missing = rows.groupBy("content").agg(F.min("chosen").alias("chosen")).join(stored, "content", "left_anti")
    misses = rows.select("content", "chosen", "text").join(Scratch(spark).keep(missing), ["content", "chosen"]).dropDuplicates(["content", "chosen"])

    def encode(batch):
        c = counter(source.value)
        return {"content": batch.column("content"), "tokenizer": [version] * batch.num_rows,
                "n_tokens": np.array([c.count(t) for t in strings(batch, "text")], np.int64)}

    map_arrow(misses.select("content", "text"), encode, _CACHE).write.mode("append").parquet(cache)
    return rows.select("doc_id", "n_bytes", "content").join(read_cache(spark, cache, version), "content").select("doc_id", "n_bytes", "n_tokens")


def op7_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """Every row of documents: bytes, tokens, whether over the limit. The cache is a folder of its own for each call."""
    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(tokenizer), f"{scratch_dir(spark)}/counts")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
