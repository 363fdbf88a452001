"""Where tables come from and go to. Only this module and the pipeline do any I/O."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_RECORDS_PER_FILE = 5_000_000


@dataclass(frozen=True)
class TablePaths:
    """Where the job's tables live below one root (the suffix stays whatever the table format). Join results are kept apart by their number of lags."""

    root: str

    @property
    def flights(self) -> str:
        return f"{self.root}/flight_clean.parquet"

    @property
    def stations(self) -> str:
        return f"{self.root}/airport_timezone_clean.parquet"

    @property
    def weather(self) -> str:
        return f"{self.root}/weather_clean.parquet"

    @property
    def quality(self) -> str:
        return f"{self.root}/quality"

    def joined(self, lags: int) -> str:
        return f"{self.root}/join_intermediate_lag{lags}.parquet"

    def flat(self, lags: int) -> str:
        return f"{self.root}/join_flat_lag{lags}.parquet"


def input_globs(flights_dir: str, weather_dir: str, month: str | None = None) -> tuple[str, str]:
    """The flight and weather files to read: all, or those of one ``YYYYMM`` month."""
    if month is None:
        return f"{flights_dir}/*.csv", f"{weather_dir}/*hourly.txt"
    if not re.fullmatch(r"\d{4}(0[1-9]|1[0-2])", month):
        raise ValueError(f"sample month must be YYYYMM: {month!r}")
    return f"{flights_dir}/{month}.csv", f"{weather_dir}/{month}hourly.txt"


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated text with a header, every column a string; nothing is inferred.

    A file whose header differs from the first one's raises, instead of being read by position.
    """
    return spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False).csv(path)


_BROKEN = "_broken_line"


def read_checked_text(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S1-S3 with quarantine: (rows, broken). A line with too few or too many fields is no row with shifted values: it goes, as it is,
    to ``broken`` (file, line). All columns are read for that, so a projection saves no parsing."""
    columns = read_text_table(spark, path).schema
    reader = (spark.read.schema(T.StructType([*columns.fields, T.StructField(_BROKEN, T.StringType())]))
              .option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
              .option("columnPruning", False).option("columnNameOfCorruptRecord", _BROKEN))
    lines = reader.csv(path)
    # Another column is asked for as well: the reader refuses a query of the broken text alone.
    other = F.length(F.coalesce(F.col(columns.names[0]), F.lit(""))) >= 0
    broken = lines.where(F.col(_BROKEN).isNotNull() & other).select(F.input_file_name().alias("file"), F.col(_BROKEN).alias("line"))
    return lines.where(F.col(_BROKEN).isNull() & other).select(*columns.names), broken


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table written by ``write_table``."""
    return spark.read.format(fmt).load(path)


def write_measured(df: DataFrame, path: str, measures: Mapping[str, Column], fmt: str = "parquet", max_records: int | None = None) -> dict:
    """Overwrite a table; returns what ``measures`` (aggregates without DISTINCT) say of its rows, taken while
    writing, so no second pass reads them."""
    seen = Observation(f"rows_{uuid.uuid4().hex}")
    writer = df.observe(seen, *[c.alias(n) for n, c in measures.items()]).write.format(fmt).mode("overwrite")
    if max_records is not None:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.save(path)
    return seen.get


def write_table(df: DataFrame, path: str, fmt: str = "parquet", max_records: int | None = None) -> int:
    """Overwrite a table; returns its row count, taken while writing instead of by a second pass."""
    return write_measured(df, path, {"rows": F.count(F.lit(1))}, fmt, max_records)["rows"]


MONTH = "month"


def write_months(df: DataFrame, path: str, day: str, fmt: str = "parquet") -> None:
    """Write a table by month (a folder ``month=yyyyMM`` each, of ``day``). Months in ``df`` replace theirs, all others stay, so
    months may come one by one and again.
    """
    monthly = df.withColumn(MONTH, F.date_format(F.col(day), "yyyyMM"))
    (monthly.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).save(path))


def read_months(spark: SparkSession, path: str, fmt: str = "parquet", first: str | None = None, last: str | None = None) -> DataFrame:
    """a table written by ``write_months``, its months from ``first`` to ``last`` (yyyyMM) alone: other folders are not listed
    as files to read. Without bounds all, rows without a day included."""
    df = spark.read.schema(_month_as_text(spark, path, fmt)).format(fmt).load(path)
    if first is not None:
        df = df.where(F.col(MONTH) >= first)
    return df if last is None else df.where(F.col(MONTH) <= last)


def _month_as_text(spark: SparkSession, path: str, fmt: str) -> T.StructType:
    found = spark.read.format(fmt).load(path).schema
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name == MONTH else f for f in found])


def read_months_within(spark: SparkSession, path: str, day: str, bounds: tuple[datetime, datetime] | None, fmt: str = "parquet") -> DataFrame:
    """rows of a month table whose ``day`` lies within bounds: first by folder, then by the files' statistics."""
    from asofkit.operators.intervals import within

    first, last = (None, None) if bounds is None else (b.strftime("%Y%m") for b in bounds)
    return within(read_months(spark, path, fmt, first, last), day, bounds)


def register_months(spark: SparkSession, database: str, name: str, path: str, fmt: str = "parquet") -> None:
    """K4: a month table in the catalog, with its partitions as they are now."""
    schema = _month_as_text(spark, path, fmt)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    quoted, full = path.replace("\\", "\\\\").replace("'", "\\'"), f"{database}.{name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if spark.catalog.tableExists(full):
        spark.sql(f"ALTER TABLE {full} SET LOCATION '{quoted}'")
    else:
        spark.sql(f"CREATE TABLE {full} ({columns}) USING {fmt} PARTITIONED BY ({MONTH}) LOCATION '{quoted}'")
    spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
    spark.catalog.refreshTable(full)


def write_colocated(df: DataFrame, table: str, by: str, buckets: int, sort: Sequence[str] = ()) -> DataFrame:
    """A catalog table in ``buckets`` hash buckets by one key, each sorted by it: tables with as many buckets meet on the key
    without an exchange. One task writes one bucket, so there is a file per bucket."""
    (df.repartition(buckets, by).write.mode("overwrite").format("parquet").bucketBy(buckets, by).sortBy(by, *sort).saveAsTable(table))
    return df.sparkSession.table(table)


def through_table(df: DataFrame, path: str, fmt: str = "parquet", max_records: int | None = None) -> DataFrame:
    """K6: write, then continue from the written table, so that later steps never recompute what led to it."""
    write_table(df, path, fmt, max_records)
    return read_table(df.sparkSession, path, fmt)


def write_report(df: DataFrame, path: str, fmt: str) -> None:
    """K2, K3, D3: a report of a few rows as one JSON or headed CSV file. Not for tables that grow."""
    writer = df.coalesce(1).write.mode("overwrite")
    writer.json(path) if fmt == "json" else writer.option("header", True).csv(path)


def write_month_counts(counts: DataFrame, path: str) -> None:
    """K7: month counts as headed CSV, in month order."""
    write_report(counts.coalesce(1).sortWithinPartitions("month"), path, "csv")


def register_tables(spark: SparkSession, database: str, tables: dict[str, str], fmt: str = "parquet") -> None:
    """K4: a database with external tables over the given paths. A table known already is pointed at its path."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, path in tables.items():
        quoted = path.replace("\\", "\\\\").replace("'", "\\'")
        full = f"{database}.{name}"
        known = spark.catalog.tableExists(full)
        if known:
            spark.sql(f"ALTER TABLE {full} SET LOCATION '{quoted}'")
        else:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {full} USING {fmt} LOCATION '{quoted}'")
        spark.catalog.refreshTable(full)


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a table that is used more than once, spilling to disk, and let go of it even on failure."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def scratch_dir(spark: SparkSession) -> str:
    """A new path for intermediate tables, below the shared folder of ``spark.checkpoint.dir``.

    A session without that setting gets a temporary folder, which is only right on one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="asofkit-")
    return f"{shared.rstrip('/')}/asofkit-{uuid.uuid4().hex}"
