"""Helpers shared by the operators: input tables, scratch tables, batches of texts, a bitmap of keys."""

from __future__ import annotations

import ctypes
import sys
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofkit.sources.tables import scratch_dir

#: ASCII white space that parts words: \x20 and \x09-\x0D. ``bytes.split()`` parts at just these.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Intermediate tables of one run, in the folder that the cluster shares (``spark.checkpoint.dir``)."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.n, self.held = spark, scratch_dir(spark), 0, {}

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` as Parquet and go on from the files, which outlive the executors that wrote them."""
        self.n += 1
        at = f"{self.path}/t{self.n}"
        df.write.option("compression", "zstd").parquet(at)
        back = self.spark.read.schema(df.schema).parquet(at)
        self.held[id(back)] = (back, at)
        return back

    def release(self, *tables: DataFrame) -> None:
        """Delete tables that ``keep`` gave, once all that reads them is written itself."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for df in tables:
            path = jvm.org.apache.hadoop.fs.Path(self.held.pop(id(df))[1])
            path.getFileSystem(conf).delete(path, True)


BATCH_BYTES = 16 << 20


def bounded(df: DataFrame) -> DataFrame:
    """``df``, for a session whose Arrow batches hold 16 MB at most: rows with long texts would else fill a worker.

    Only Spark's default (64 MB) is lowered; a value that the caller has set stays.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key) == f"{64 << 20}b":
        conf.set(key, str(BATCH_BYTES))
    return df


def give_back() -> None:
    """Hand memory that is free back to the system: a Python worker outlives its task, and what it holds is the executor's."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


_FREE: list[Callable[[], None]] = []
_OWNER = [""]


def caching(free: Callable[[], None]) -> None:
    """Say before filling a cache of this worker how to empty it."""
    if free not in _FREE:
        _FREE.append(free)


def owned_by(operator: str) -> None:
    """Begin a task of ``operator``: when the task before was another's, all caches of this worker are emptied, so the stages of a
    pipeline, which share workers, hold one operator's caches at a time, and an operator keeps all that it uses."""
    if _OWNER[0] != operator:
        _OWNER[0] = operator
        while _FREE:
            _FREE.pop()()
        give_back()


def thrifty(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], operator: str = "") -> Callable:
    """``run`` as a task of ``operator`` (the module that wrote it, if none is named), then free memory goes back."""
    operator = operator or run.__module__

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owned_by(operator)
        yield from run(batches)
        give_back()

    return whole


def arrow_schema(ddl: str) -> pa.Schema:
    """On the driver: it asks the session."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 4_096, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of ``size`` rows or about ``most`` bytes at most."""
    held, weight = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        weight += sum(len(x) if isinstance(x, (bytes, str)) else sum(map(len, x)) for x in row if isinstance(x, (bytes, str, list)))
        if len(held) >= size or weight >= most:
            yield batch()
            held, weight = [], 0
    if held:
        yield batch()


def map_rows(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """``fn`` over the rows of each partition as they stream by."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches_of(fn(rows_of(batches)), arrow)

    return bounded(df).mapInArrow(thrifty(run, fn.__module__), schema)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Rows that ``fn`` makes of each Arrow batch, as a dict of columns in the schema's order."""
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = fn(batch)
            if made is not None:
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)

    return bounded(df).mapInArrow(thrifty(run, fn.__module__), schema)


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes; null counts as empty."""
    col = batch.column(name)
    return [x or b"" for x in col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()]


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """A string column; null counts as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


class Taken:
    """Which places of a text spans cover; asked by binary search."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def touches(self, start: int, end: int) -> bool:
        """Whether a span covers a place of [start, end)."""
        at = bisect_left(self.starts, end)
        return at > 0 and self.ends[at - 1] > start


class Bitmap:
    """A Bloom filter of one bit per key over 64-bit keys; its fixed size is the bound of what is broadcast.

    It only saves work: a key that it lets through by chance must do no harm, and no key of the table is ever missed.
    """

    def __init__(self, keys: DataFrame, bits: int = 25):
        """``keys``: one long column. 2**bits bits are gathered as words of 64, so 4 MB for 25."""
        c = F.col(keys.columns[0])
        rows = keys.groupBy(c.bitwiseAND((1 << (bits - 6)) - 1).alias("w")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, int(shiftrightunsigned(`{keys.columns[0]}`, 58)))")).alias("b")).toArrow()
        words = np.zeros(1 << (bits - 6), np.uint64)
        words[rows.column("w").to_numpy()] = rows.column("b").to_numpy().astype(np.int64).view(np.uint64)
        self.words, self.mask = words, np.uint64((1 << (bits - 6)) - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        k = keys.view(np.uint64)
        return (self.words[k & self.mask] >> (k >> np.uint64(58))) & np.uint64(1) == 1


def digest_sample(df: DataFrame, n: int, key: Column) -> DataFrame:
    """The ``n`` rows of the smallest key: a bounded sample that is the same in every run."""
    return df.orderBy(key).limit(n)


def attach(rows: DataFrame, values: DataFrame, key: str, count: str, how: str = "inner", share: int = 1_000) -> DataFrame:
    """``rows`` with the columns of ``values`` (one row per ``key``; ``count``: how many rows have it), but for ``count``.

    Keys that more than one in ``share`` of all rows have are broadcast, at most ``share`` of them whatever the table; all others are
    joined as the planner likes. So no key brings more than that part of the rows into one task. ``values``: a written table.
    """
    total = values.agg(F.sum(count)).first()[0] or 0
    hot = F.broadcast(values.where(F.col(count) * share > total).drop(count))
    cold = values.where(F.col(count) * share <= total).drop(count)
    met = rows.join(hot, key)
    return met.unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key, how).select(*met.columns))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


#: CRC-32 of an ASCII text, for SQL twins (DuckDB has none): a table made by its rule, as ``crc(tbl)``, and a fold over the characters.
CRC_TABLE_SQL = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tbl)"""


def crc_sql(text: str) -> str:
    """CRC-32 of the SQL expression ``text`` where ``crc`` is joined."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: xor(c >> 8, tbl[(xor(c, b) & 255) + 1])), 4294967295)"
