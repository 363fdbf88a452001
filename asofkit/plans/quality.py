"""A report of counts over the clean tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asofkit.functions.clock import month
from asofkit.operators.shaping import conform, labelled


@dataclass(frozen=True)
class Metrics:
    """What to count in one table: non-NULL values by column, distinct values by column or expression."""

    non_null: tuple[str, ...] = ()
    distinct: Mapping[str, Column | str] = field(default_factory=dict)


# Tables and columns of the report.
def default_metrics() -> dict[str, Metrics]:
    """The metrics of the three clean tables."""
    return {
        "flight_clean": Metrics(
            non_null=("CRS_DEP_TIMESTAMP", "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID"),
            distinct={c: c for c in ("FL_DATE", "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID")},
        ),
        "weather_clean": Metrics(
            non_null=("timestamp", "AirportId"),
            distinct={"AirportId": "AirportId", "date": F.to_date("timestamp")},
        ),
        "airport_timezone_clean": Metrics(distinct={"AirportId": "AirportId", "WBAN": "WBAN"}),
    }


# Columns of the report, in order.
REPORT_COLUMNS = (
    "dataset", "rows",
    "non_null_CRS_DEP_TIMESTAMP", "non_null_ORIGIN_AIRPORT_ID", "non_null_DEST_AIRPORT_ID",
    "distinct_FL_DATE", "distinct_ORIGIN_AIRPORT_ID", "distinct_DEST_AIRPORT_ID",
    "non_null_timestamp", "non_null_AirportId", "distinct_AirportId", "distinct_date", "distinct_WBAN",
)


def report_schema(columns=REPORT_COLUMNS) -> T.StructType:
    """All counts are longs, the dataset name a string."""
    return T.StructType([
        T.StructField(c, T.StringType() if c == "dataset" else T.LongType()) for c in columns
    ])


def measures(metrics: Metrics, exact: bool = False) -> dict[str, Column]:
    """The counts of one table by their name in the report. Distinct counts are sketches unless ``exact``."""
    distinct = F.count_distinct if exact else F.approx_count_distinct
    return {
        "rows": F.count(F.lit(1)),
        **{f"non_null_{c}": F.count(c) for c in metrics.non_null},
        **{f"distinct_{n}": distinct(F.col(e) if isinstance(e, str) else e) for n, e in metrics.distinct.items()},
    }


def summarize(df: DataFrame, name: str, metrics: Metrics, exact: bool = False) -> DataFrame:
    """One row of counts in one pass."""
    return labelled(df.agg(*[c.alias(n) for n, c in measures(metrics, exact).items()]), "dataset", name)


def measured_report(spark: SparkSession, seen: Mapping[str, Mapping[str, int]], schema: T.StructType | None = None) -> DataFrame:
    """Z5 without a scan: the report from counts that were taken while the tables were written."""
    schema = report_schema() if schema is None else schema
    rows = [tuple(name if f.name == "dataset" else counts.get(f.name) for f in schema) for name, counts in seen.items()]
    return spark.createDataFrame(rows, schema)


def month_sketches(df: DataFrame, day: str, values: Mapping[str, Column | str]) -> DataFrame:
    """A4, A5: a mergeable sketch (HLL) of each value's distinct count by month, small enough to be kept with the tables: (month,
    a binary column per name)."""
    sketches = [F.hll_sketch_agg(F.col(e) if isinstance(e, str) else e, F.lit(12)).alias(n) for n, e in values.items()]
    return df.groupBy(month(F.col(day)).alias("month")).agg(*sketches)


def distinct_of_months(sketches: DataFrame, names: Sequence[str], span: Column) -> DataFrame:
    """Distinct counts of spans of months, from their sketches alone: ``span`` names each month's span."""
    merged = [F.hll_sketch_estimate(F.hll_union_agg(n)).alias(f"distinct_{n}") for n in names]
    return sketches.groupBy(span.alias("span")).agg(*merged)


def quality_report(
    tables: Mapping[str, DataFrame],
    metrics: Mapping[str, Metrics] | None = None,
    schema: T.StructType | None = None,
    exact: bool = False,
) -> DataFrame:
    """One row per table in one schema; counts a table does not have are NULL."""
    metrics = default_metrics() if metrics is None else metrics
    schema = report_schema() if schema is None else schema
    rows = [conform(summarize(df, n, metrics[n], exact), schema) for n, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
