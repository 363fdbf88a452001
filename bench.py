"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then twice; the faster run counts. The action counts rows and sums the hashes
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofkit.checks import queries as checks
from asofkit.checks.standins import observations, purchases
from asofkit.operators.asof import asof_lags

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def _asof(lags: int, keys: int | None = None, **kw):
    def query(spark: SparkSession, d: str) -> DataFrame:
        left, right = purchases(spark, d), observations(spark, d)
        if keys:
            left, right = (x.withColumn("user_id", F.col("user_id") % keys) for x in (left, right))
        return asof_lags(left.select("event_id", "user_id", "ts"), right, by="user_id", left_ts="ts",
                         right_ts="ts", lags=lags, payload=["obs_id", "value"], tie_break=["obs_id"], out="w", **kw)
    return query


QUERIES = {
    "asof_lag1_normal_keys": _asof(0),
    "asof_lag1_hot_keys": _asof(0, 3),
    "asof_lag7_normal_keys": _asof(7),
    "asof_lag7_hot_keys": _asof(7, 3),
    # one key that holds all rows, cut 100 and 10,000 times
    "asof_lag7_100_cuts": _asof(7, 1, segment_rows=1_000),
    "asof_lag7_10000_cuts": _asof(7, 1, segment_rows=10),
    **{q.__name__: q for q in (
        checks.interval_join_pairs, checks.lag_stats, checks.sky_features, checks.weather_scores,
        checks.lenient_casts, checks.clean_flights, checks.clean_weather, checks.enrich_two_sided,
        checks.flat_features, checks.quality_approx, checks.month_counts, checks.pipeline_month, checks.month_tables,
        checks.colocated_flights, checks.measured_write,
    )},
}


def run(query, spark: SparkSession) -> float:
    start = time.perf_counter()
    df = query(spark, SF_DIR)
    df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).collect()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, query in QUERIES.items():
        run(query, spark)
        seconds[name] = round(min(run(query, spark) for _ in range(2)), 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
