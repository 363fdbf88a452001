"""One query per operator or group of operators, over whole tables. Names match ``oracles``."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofkit.checks.standins import (
    observations, purchases, raw_flights, raw_stations, raw_weather, sky_text, table, weather_text,
)
from asofkit.functions import casts, clock, codes
from asofkit.operators import reducing, shaping
from asofkit.operators.asof import asof_lags
from asofkit.operators.intervals import interval_join, time_bounds, within
from asofkit.operators.lags import flatten_lags
from asofkit.plans import cleaning, enrich as enriching
from asofkit.plans.features import JOIN_FEATURES, add_sky_features, add_weather_scores
from asofkit.plans.pipeline import PipelineConfig, run_pipeline
from asofkit.plans.quality import (
    REPORT_COLUMNS, Metrics, distinct_of_months, measured_report, measures, month_sketches as sketches_of, quality_report, report_schema,
)
from asofkit.sources import tables as io

LONG, DOUBLE = "bigint", "double"


def us(ts: str | Column) -> Column:
    """Microseconds of a zoneless timestamp."""
    return clock.micros(F.col(ts) if isinstance(ts, str) else ts, True)


# --- joins in time

def asof_latest(spark: SparkSession, d: str) -> DataFrame:
    """J5 with one match, T1, C10."""
    m = asof_lags(purchases(spark, d), observations(spark, d), by="user_id", left_ts="ts", right_ts="ts", lags=0,
                  tie_break=["obs_id"], out="w")
    return m.select("event_id", F.col("w.obs_id").alias("obs_id"), us("w.w_ts").alias("obs_us"))


def asof_latest_dest(spark: SparkSession, d: str) -> DataFrame:
    """Matched at the computed arrival and the other key."""
    flights = purchases(spark, d).withColumn("arr", clock.add_minutes(F.col("ts"), F.col("value")))
    m = asof_lags(flights, observations(spark, d), by="dest_id", right_by="user_id", left_ts="arr", right_ts="ts",
                  lags=0, payload=["obs_id"], tie_break=["obs_id"], out="w")
    return m.select("event_id", us("arr").alias("arr_us"), F.col("w.obs_id").alias("obs_id"))


def asof_lags7(spark: SparkSession, d: str) -> DataFrame:
    """One row per flight and lag."""
    m = asof_lags(purchases(spark, d), observations(spark, d), by="user_id", left_ts="ts", right_ts="ts", lags=7,
                  payload=["obs_id"], tie_break=["obs_id"], out="w")
    return m.select("event_id", F.posexplode("w").alias("k", "o")).select(
        "event_id", F.col("k").cast(LONG).alias("k"), F.col("o.obs_id").alias("obs_id"))


def asof_hot_keys(spark: SparkSession, d: str) -> DataFrame:
    """J5 on three keys that hold all rows, cut into time segments with carried lags."""
    def fold(df):
        return df.withColumn("user_id", F.col("user_id") % 3)
    m = asof_lags(fold(purchases(spark, d)), fold(observations(spark, d)), by="user_id", left_ts="ts",
                  right_ts="ts", lags=7, payload=["obs_id"], tie_break=["obs_id"], out="w", segment_rows=500)
    return m.select("event_id", F.posexplode("w").alias("k", "o")).select(
        "event_id", F.col("k").cast(LONG).alias("k"), F.col("o.obs_id").alias("obs_id"))


def asof_many_segments(spark: SparkSession, d: str) -> DataFrame:
    """J5 on one key that holds all rows, cut thousands of times; more cuts than any number of shuffle partitions."""
    def fold(df):
        return df.withColumn("user_id", F.lit(0).cast(LONG))
    m = asof_lags(fold(purchases(spark, d)), fold(observations(spark, d)), by="user_id", left_ts="ts",
                  right_ts="ts", lags=7, payload=["obs_id"], tie_break=["obs_id"], out="w", segment_rows=5)
    return m.select("event_id", F.posexplode("w").alias("k", "o")).select(
        "event_id", F.col("k").cast(LONG).alias("k"), F.col("o.obs_id").alias("obs_id"))


def asof_hot_instants(spark: SparkSession, d: str) -> DataFrame:
    """J5 on two keys whose times are cut to days: every group is made of ties and spans several cuts."""
    def fold(df):
        return df.withColumns({"user_id": F.col("user_id") % 2,
                               "ts": F.to_date("ts").cast("timestamp_ntz")})
    m = asof_lags(fold(purchases(spark, d)), fold(observations(spark, d)), by="user_id", left_ts="ts",
                  right_ts="ts", lags=3, tolerance_hours=24, payload=["obs_id"], tie_break=["obs_id"], out="w",
                  segment_rows=50, max_pieces=400)
    return m.select("event_id", F.posexplode("w").alias("k", "o")).select(
        "event_id", F.col("k").cast(LONG).alias("k"), F.col("o.obs_id").alias("obs_id"))


def interval_join_pairs(spark: SparkSession, d: str) -> DataFrame:
    """All pairs inside the interval; flights without any stay."""
    obs = observations(spark, d).select("user_id", F.col("ts").alias("obs_ts"), "obs_id")
    pairs = interval_join(purchases(spark, d), obs, by="user_id", left_ts="ts", right_ts="obs_ts", hours=12)
    return pairs.select("event_id", "obs_id")


def time_pruned_scan(spark: SparkSession, d: str) -> DataFrame:
    """Line items shipped within the span of all orders; later shipments fall out."""
    bounds = time_bounds(table(spark, d, "orders"), "o_orderdate", hours_before=12)
    return within(table(spark, d, "lineitem"), "l_shipdate", bounds).select(
        "l_orderkey", F.col("l_linenumber").cast(LONG).alias("l_linenumber"), us("l_shipdate").alias("ship_us"))


def lag_flatten(spark: SparkSession, d: str) -> DataFrame:
    """One column per lag."""
    flat = _flat(spark, d)
    return flat.select("event_id", *[f"orig_obs_id_lag{k}" for k in range(7)],
                       us("orig_wts_lag0").alias("us0"), us("orig_wts_lag6").alias("us6"))


def lag_stats(spark: SparkSession, d: str) -> DataFrame:
    """A10: min, max, avg and delta over the lags."""
    return _flat(spark, d).select(
        "event_id", "orig_value_min", "orig_value_max", F.round("orig_value_avg", 6).alias("orig_value_avg"),
        F.round("orig_value_delta", 6).alias("orig_value_delta"),
        "orig_obs_id_min", "orig_obs_id_max", "orig_obs_id_delta")


def _flat(spark: SparkSession, d: str) -> DataFrame:
    m = asof_lags(purchases(spark, d).select("event_id", "user_id", "ts"), observations(spark, d), by="user_id",
                  left_ts="ts", right_ts="ts", lags=7, tie_break=["obs_id"], out="w")
    return flatten_lags(m, {"w": "orig"}, 7)


# --- expressions

def lenient_casts(spark: SparkSession, d: str) -> DataFrame:
    """C5, F7, F8, C8 over texts made from line items."""
    n = "l_orderkey * 7 + l_linenumber"
    texts = table(spark, d, "lineitem").selectExpr(
        f"CASE ({n}) % 6 WHEN 0 THEN concat(' ', l_partkey, ' ') WHEN 1 THEN concat(l_partkey, '.0')"
        f" WHEN 2 THEN 'M' WHEN 3 THEN '' WHEN 4 THEN concat('-', l_suppkey, '.9') ELSE string(l_orderkey * 5) END"
        " AS a",
        f"CASE ({n}) % 4 WHEN 0 THEN ' T' WHEN 1 THEN string(l_discount) WHEN 2 THEN 'T' ELSE 'VR' END AS b",
    )
    clean = casts.null_if_missing(F.col("a"))
    return texts.select(
        clean.alias("text"),
        casts.to_whole(clean, "smallint").cast(LONG).alias("as_short"),
        casts.to_whole(clean, "tinyint").cast(LONG).alias("as_byte"),
        casts.to_whole(clean, "int").cast(LONG).alias("as_int"),
        casts.to_real(casts.null_if_trace(F.col("b"))).cast(DOUBLE).alias("precip"),
    )


def hhmm_timestamp(spark: SparkSession, d: str) -> DataFrame:
    """Compact date + clock text, some of it impossible."""
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 31 == 0, "19970230")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("day"),
        (F.col("o_orderkey") * 37 % 2500).cast("string").alias("hhmm"),
    )
    at = clock.wall_clock(clock.compact_date(F.col("day")), F.col("hhmm"))
    return orders.select("o_orderkey", clock.pad_hhmm(F.col("hhmm")).alias("padded"), us(at).alias("at_us"))


def presence_and_default(spark: SparkSession, d: str) -> DataFrame:
    """A flag from the raw text, then the default."""
    raw = table(spark, d, "orders").select("o_orderkey", F.expr(
        "CASE o_orderkey % 3 WHEN 0 THEN string(o_totalprice) WHEN 1 THEN 'n/a' END").alias("t"))
    return raw.select("o_orderkey", F.col("t").isNotNull().alias("has_value"),
                      casts.value_or(casts.to_real(F.col("t"), DOUBLE), 0.0).alias("v"))


def arrival_times(spark: SparkSession, d: str) -> DataFrame:
    """C9, C10 on all events; once with elapsed times of centuries."""
    e = table(spark, d, "events")
    return e.select("event_id", us(clock.add_minutes(F.col("ts"), F.col("value"))).alias("arr_us"),
                    us(clock.add_minutes(F.col("ts"), F.col("value") * 10_000_000.0)).alias("far_us"),
                    us(clock.add_hours(F.col("ts"), -12)).alias("from_us"))


def sky_features(spark: SparkSession, d: str) -> DataFrame:
    """X1-X4, X7, C12, C13, P7 over texts made from line items."""
    n = "(l_orderkey * 7 + l_linenumber)"
    df = add_sky_features(table(spark, d, "lineitem").selectExpr(f"{sky_text(n)} AS SkyCondition"))
    return df.select(
        "SkyCondition", *[F.col(f"sky_{c}").cast(LONG).alias(c) for c in ("num_layers", "min_altitude", "max_altitude")],
        F.col("sky_mean_altitude").cast(DOUBLE).alias("mean_altitude"),
        *[f"sky_has_{c}" for c in ("CB", "TCU", *codes.SKY_PREFIXES)])


def weather_scores(spark: SparkSession, d: str) -> DataFrame:
    """X5, X6, X8, C14 over texts made from line items: all 28 codes."""
    n = "(l_partkey + l_linenumber)"
    df = add_weather_scores(table(spark, d, "lineitem").selectExpr(f"{weather_text(n)} AS WeatherType"))
    return df.select("WeatherType", *[F.col(f"wt_score_{c}").cast(LONG).alias(f"wt_score_{c}")
                                      for c in codes.WEATHER_CODES])


# --- cleaning stages

def flag_filter(spark: SparkSession, d: str) -> DataFrame:
    """drop flagged rows and those whose flag is no number."""
    raw = table(spark, d, "orders").select("o_orderkey", F.expr(
        "CASE o_orderstatus WHEN 'F' THEN '1.00' WHEN 'O' THEN '0.00' ELSE if(o_orderkey % 2 = 0, NULL, 'abc') END"
    ).alias("flag"))
    return raw.where(~casts.is_set(F.col("flag")))


def _flights(spark: SparkSession, d: str) -> DataFrame:
    """Clean flights whose airports are users of the events: more than a smallint holds in larger tables."""
    return cleaning.clean_flights(raw_flights(spark, d), LONG)


def clean_flights(spark: SparkSession, d: str) -> DataFrame:
    """Z1 on the derived raw flights: P1, P8, F1, F2, C1-C7."""
    df = _flights(spark, d)
    whole = ("OP_CARRIER_FL_NUM", "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID")
    real = ("CRS_ELAPSED_TIME", "ARR_DELAY_NEW", "WEATHER_DELAY", "NAS_DELAY")
    return df.select(
        F.col("FL_DATE").cast("string").alias("FL_DATE"), "OP_CARRIER", "CRS_DEP_TIME",
        *[F.col(c).cast(LONG).alias(c) for c in whole], *[F.col(c).cast(DOUBLE).alias(c) for c in real],
        "HAS_WEATHER_DELAY", "HAS_NAS_DELAY", us("CRS_DEP_TIMESTAMP").alias("dep_us"))


def clean_station_map(spark: SparkSession, d: str) -> DataFrame:
    """P3, F3, A7."""
    df = cleaning.clean_station_map(raw_stations(spark, d))
    return df.select(*[F.col(c).cast(LONG).alias(c) for c in df.columns])


def allowed_keys(spark: SparkSession, d: str) -> DataFrame:
    """Stations of the airports that flights use."""
    allowed = cleaning.allowed_stations(cleaning.clean_station_map(raw_stations(spark, d)), _flights(spark, d))
    return allowed.select(F.col("WBAN").cast(LONG).alias("WBAN"), F.col("AirportId").cast(LONG).alias("AirportId"))


def _weather(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.clean_weather(raw_weather(spark, d), cleaning.clean_station_map(raw_stations(spark, d)), _flights(spark, d))


def clean_weather(spark: SparkSession, d: str) -> DataFrame:
    """Z3: P2, F4, F7, F8, J2, X7, X8 on the derived raw weather; every column of the clean table."""
    df = _weather(spark, d)
    text, flags = ("Visibility", "StationType", "SkyCondition", "WeatherType", "file_month"), [c for c in df.columns if c.startswith("sky_has_")]
    real = ("DryBulbFarenheit", "WetBulbFarenheit", "DewPointFarenheit", "Altimeter", "SeaLevelPressure",
            "StationPressure", "HourlyPrecip", "sky_mean_altitude")
    whole = [c for c in df.columns if c not in (*text, *flags, *real, "timestamp")]
    return df.select(us("timestamp").alias("at_us"), *text, *flags,
                     *[F.col(c).cast(LONG).alias(c) for c in whole], *[F.col(c).cast(DOUBLE).alias(c) for c in real])


def restrict_and_attach(spark: SparkSession, d: str) -> DataFrame:
    """J2 alone: line items of suppliers in two regions, with the nation attached."""
    nations = table(spark, d, "nation").where("n_regionkey < 2").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_name")
    allowed = reducing.attach_keys(table(spark, d, "supplier"), nations, "s_nationkey").select(
        F.col("s_suppkey").alias("l_suppkey"), "n_name")
    return reducing.attach_keys(table(spark, d, "lineitem"), allowed, "l_suppkey").select(
        "l_suppkey", "n_name", "l_orderkey", F.col("l_linenumber").cast(LONG).alias("l_linenumber"), "l_quantity")


def dedup_subset(spark: SparkSession, d: str) -> DataFrame:
    """The cheapest line per supplier and return flag, lines with a low discount left out."""
    lines = table(spark, d, "lineitem").select(
        "l_suppkey", "l_returnflag", F.when(F.col("l_discount") > 0.02, F.col("l_quantity")).alias("q"),
        "l_extendedprice").na.drop(subset=["q"])
    return reducing.dedup_first(lines, ["l_suppkey", "l_returnflag"],
                                [F.col("l_extendedprice")])


def top_n_newest(spark: SparkSession, d: str) -> DataFrame:
    """The five newest orders of each customer."""
    top = reducing.top_n(table(spark, d, "orders"), ["o_custkey"],
                         [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 5)
    return top.select("o_custkey", "o_orderkey", F.col("rk").cast(LONG).alias("rk"))


def collect_newest(spark: SparkSession, d: str) -> DataFrame:
    """A2: the three newest orders of each customer as an array, shown by position."""
    few = reducing.collect_newest(table(spark, d, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"], 3, "m")
    return few.select("o_custkey", F.posexplode("m").alias("k", "o")).select(
        "o_custkey", F.col("k").cast(LONG).alias("k"), F.col("o.o_orderkey").alias("o_orderkey"))


def shaped_columns(spark: SparkSession, d: str) -> DataFrame:
    """A chain of projections."""
    df = shaping.keep_present(table(spark, d, "part"), ["p_partkey", "p_absent", "p_name", "p_brand", "p_size"])
    df = shaping.drop_matching(df, "brand")
    df = shaping.require(df, ["p_partkey", "p_size"], ["p_name", "p_absent"])
    df = shaping.with_prefix(df, "orig_", ["p_size"])
    df = shaping.packed(df, ["orig_p_size", "p_name"], "s")
    df = shaping.labelled(df, "data set", "part").withColumn("size (cm)", F.col("s.orig_p_size").cast(LONG))
    df = df.withColumn("name", F.col("s.p_name")).drop("s")
    return shaping.sanitise_names(df)


def picked_features(spark: SparkSession, d: str) -> DataFrame:
    """Whitelisted features under their join names."""
    df = table(spark, d, "lineitem").withColumn("weather_scores", F.lit(1))
    df = shaping.with_family(df, "q_", ["1", "2"], lambda m: F.col("l_quantity") * int(m))
    out, names = shaping.select_features(df, "l_suppkey", "l_shipdate", ["q_2", "l_tax", "absent", "q_1"])
    return out.select("apt_id", us("w_ts").alias("w_us"), *names)


# --- enrichment

def _enriched(spark: SparkSession, d: str, lags: int, **kw) -> DataFrame:
    """Z4 over clean tables that are written first (K1, K6, S4), as the job does; of the weather, whose features cost most, the columns
    that are joined. ``fold``: two airports, times cut to months."""
    paths = io.TablePaths(io.scratch_dir(spark))
    flights = io.through_table(_flights(spark, d), paths.flights)
    stations = io.through_table(cleaning.clean_station_map(raw_stations(spark, d)), paths.stations)
    reach = kw.pop("reach", None)
    weather = cleaning.clean_weather(raw_weather(spark, d), stations, flights, look_back_hours=reach)
    weather = io.through_table(weather.select("WBAN", "AirportId", "timestamp", *JOIN_FEATURES), paths.weather)
    if kw.pop("shift", False):
        kw["zones"] = stations
    if kw.pop("fold", False):
        flights, weather = folded_to_months(flights, weather)
    return enriching.enrich(flights, weather, lags=lags, **kw)


def folded_to_months(flights: DataFrame, weather: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean tables of two airports whose times are months: every group is hot and made of ties."""
    def cut(c: str) -> Column:
        return F.trunc(c, "month").cast("timestamp_ntz")
    airports = {c: (F.col(c) % 2).cast("smallint") for c in ("ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID")}
    return (flights.withColumns(airports | {"CRS_DEP_TIMESTAMP": cut("CRS_DEP_TIMESTAMP")}),
            weather.withColumns({"AirportId": (F.col("AirportId") % 2).cast("smallint"), "timestamp": cut("timestamp")}))


def _per_flight(joined: DataFrame) -> DataFrame:
    columns = [F.col("OP_CARRIER_FL_NUM").cast(LONG).alias("fl_num"), us("CRS_DEP_TIMESTAMP").alias("dep_us"),
               us("CRS_ARR_TIMESTAMP").alias("arr_us")]
    for side in ("origin", "dest"):
        w = F.col(f"weather_{side}")
        columns += [
            F.size(w).cast(LONG).alias(f"{side}_n"),
            us(F.get(w, 0)["w_ts"]).alias(f"{side}_new_us"),
            us(F.get(w, F.size(w) - 1)["w_ts"]).alias(f"{side}_old_us"),
            F.get(w, 0)["DryBulbFarenheit"].cast(DOUBLE).alias(f"{side}_dry"),
            F.aggregate(w, F.lit(0).cast(LONG), lambda a, x: a + x["WindSpeed"]).alias(f"{side}_wind"),
            F.aggregate(w, F.lit(0).cast(LONG), lambda a, x: a + x["wt_score_RA"]).alias(f"{side}_rain"),
        ]
    return joined.select(*columns)


def enrich_two_sided(spark: SparkSession, d: str) -> DataFrame:
    """Origin and destination, seven lags."""
    return _per_flight(_enriched(spark, d, 7))


def enrich_hot(spark: SparkSession, d: str) -> DataFrame:
    """Z4 with every airport cut into time segments."""
    return _per_flight(_enriched(spark, d, 7, segment_rows=20))


def enrich_in_reach(spark: SparkSession, d: str) -> DataFrame:
    """Weather cut to the days that a flight can look back on before it is parsed; the join finds the same."""
    return _per_flight(_enriched(spark, d, 7, reach=12))


def enrich_hot_instants(spark: SparkSession, d: str) -> DataFrame:
    """Z4 on two airports whose times are cut to months, in segments of 20 rows: instants span several cuts on both sides."""
    return _per_flight(_enriched(spark, d, 7, segment_rows=20, fold=True))


def enrich_zone_shift(spark: SparkSession, d: str) -> DataFrame:
    """Z4 with arrivals moved to the clock of the destination."""
    return _per_flight(_enriched(spark, d, 7, shift=True))


def enrich_single(spark: SparkSession, d: str) -> DataFrame:
    """Z4 without lags: one struct per side."""
    one = _enriched(spark, d, 0)
    columns = [F.col("OP_CARRIER_FL_NUM").cast(LONG).alias("fl_num"), us("CRS_DEP_TIMESTAMP").alias("dep_us")]
    for side in ("origin", "dest"):
        w = F.col(f"weather_{side}_single")
        columns += [us(w["w_ts"]).alias(f"{side}_us"), w["DryBulbFarenheit"].cast(DOUBLE).alias(f"{side}_dry"),
                    w["sky_num_layers"].cast(LONG).alias(f"{side}_layers")]
    return one.select(*columns)


def enrich_all_features(spark: SparkSession, d: str) -> DataFrame:
    """A row per flight, side and lag with all 33 features."""
    joined = _enriched(spark, d, 7).select(
        F.col("OP_CARRIER_FL_NUM").cast(LONG).alias("fl_num"), us("CRS_DEP_TIMESTAMP").alias("dep_us"), "weather_origin", "weather_dest")
    sides = [joined.select("fl_num", "dep_us", F.lit(side).alias("side"), F.posexplode(f"weather_{side}").alias("k", "o"))
             for side in ("origin", "dest")]
    rows = sides[0].unionByName(sides[1])

    def shown(f: str) -> Column:
        return F.col(f"o.{f}") if f == "Visibility" or f.startswith("sky_has_") else F.col(f"o.{f}").cast(DOUBLE)

    return rows.select("fl_num", "dep_us", "side", F.col("k").cast(LONG).alias("k"), us(F.col("o.w_ts")).alias("w_us"),
                       *[shown(f).alias(f) for f in JOIN_FEATURES])


def enrich_legacy(spark: SparkSession, d: str) -> DataFrame:
    """Unmatched flights get one struct of NULLs, which is told by its missing time."""
    joined = _enriched(spark, d, 3, legacy_unmatched=True)
    sides = [F.size(f"weather_{s}").cast(LONG).alias(f"{s}_n") for s in ("origin", "dest")]
    blank = [F.get(f"weather_{s}", 0)["w_ts"].isNull().alias(f"{s}_blank") for s in ("origin", "dest")]
    return joined.select(F.col("OP_CARRIER_FL_NUM").cast(LONG).alias("fl_num"), us("CRS_DEP_TIMESTAMP").alias("dep_us"), *sides, *blank)


def flat_all_features(spark: SparkSession, d: str) -> DataFrame:
    """Z6 with seven lags: every numeric feature of both sides, one row per feature: its lags, minimum, maximum, mean and difference."""
    flat = enriching.flat_features(_enriched(spark, d, 7), 7)
    names = sorted({c[len("orig_"):-len("_min")] for c in flat.columns if c.startswith("orig_") and c.endswith("_min")})
    stats = [*(f"lag{k}" for k in range(7)), "min", "max", "avg", "delta"]

    def one(side: str, f: str) -> Column:
        values = [F.col(f"{side}_{f}_{x}").cast(DOUBLE) for x in stats]
        return F.struct(F.lit(side).alias("side"), F.lit(f).alias("feature"), *[v.alias(x) for x, v in zip(stats, values, strict=True)])

    rows = flat.select(F.col("OP_CARRIER_FL_NUM").cast(LONG).alias("fl_num"), us("CRS_DEP_TIMESTAMP").alias("dep_us"),
                       F.explode(F.array(*[one(s, f) for s in ("orig", "dest") for f in names])).alias("r"))
    # rounded row by row: in the array, 100 of them would share one expression
    return rows.select("fl_num", "dep_us", "r.*").withColumns({x: F.round(x, 6) for x in ("avg", "delta")})


def flat_features(spark: SparkSession, d: str) -> DataFrame:
    """Z6 on the enriched table: P13-P15, A10."""
    flat = enriching.flat_features(_enriched(spark, d, 3), 3)
    names = [f"{side}_WindSpeed_{x}" for side in ("orig", "dest")
             for x in ("lag0", "lag1", "lag2", "min", "max", "delta")]
    return flat.select(
        F.col("OP_CARRIER_FL_NUM").cast(LONG).alias("fl_num"), us("CRS_DEP_TIMESTAMP").alias("dep_us"),
        *[F.col(n).cast(LONG).alias(n) for n in names],
        *[F.round(f"{s}_WindSpeed_avg", 6).alias(f"{s}_WindSpeed_avg") for s in ("orig", "dest")],
        us("orig_wts_lag2").alias("orig_us2"))


# --- reports, sources and sinks

def quality_counts(spark: SparkSession, d: str) -> DataFrame:
    """Row and non-NULL counts of three tables in one schema."""
    return quality_report(
        {"orders": table(spark, d, "orders").withColumn("big", F.when(F.col("o_totalprice") > 250000, 1)),
         "lineitem": table(spark, d, "lineitem"), "customer": table(spark, d, "customer")},
        {"orders": Metrics(non_null=("big", "o_custkey")), "lineitem": Metrics(non_null=("l_shipdate",)),
         "customer": Metrics()},
        report_schema(("dataset", "rows", "non_null_big", "non_null_o_custkey", "non_null_l_shipdate")))


def _quality(spark: SparkSession, d: str, exact: bool) -> DataFrame:
    """The report on all rows: airports and stations with ids of any size."""
    flights, stations = _flights(spark, d), cleaning.clean_station_map(raw_stations(spark, d), LONG, LONG)
    return quality_report({
        "flight_clean": flights,
        "weather_clean": cleaning.clean_weather(raw_weather(spark, d), stations, flights, station_ids=LONG),
        "airport_timezone_clean": stations,
    }, exact=exact)


def quality_exact(spark: SparkSession, d: str) -> DataFrame:
    """Z5 with exact distinct counts."""
    return _quality(spark, d, True)


def quality_approx(spark: SparkSession, d: str) -> DataFrame:
    """Z5, A4, A5 with sketched distinct counts, as the job does: beside each exact count, whether the sketch is within
    three times its stated error (5 %), or within 2 for small counts."""
    exact, approx = _quality(spark, d, True), _quality(spark, d, False)
    counts = [c for c in exact.columns if c != "dataset"]
    both = exact.alias("e").join(approx.alias("a"), F.col("e.dataset") == F.col("a.dataset"))

    def close(c: str) -> Column:
        e, a = F.col(f"e.{c}"), F.col(f"a.{c}")
        return (F.abs(e - a) <= F.greatest(F.lit(2.0), 0.15 * e)) if c.startswith("distinct_") else e == a

    return both.select("e.dataset", *[F.col(f"e.{c}").alias(c) for c in counts], *[close(c).alias(f"close_{c}") for c in counts])


def month_counts(spark: SparkSession, d: str) -> DataFrame:
    """A9, T2, C4."""
    return reducing.month_counts(table(spark, d, "orders"), "o_orderdate")


def month_count_files(spark: SparkSession, d: str) -> DataFrame:
    """K7, K3: month counts of line items through a CSV file."""
    path = io.scratch_dir(spark)
    io.write_month_counts(reducing.month_counts(table(spark, d, "lineitem"), "l_shipdate"), path)
    return io.read_text_table(spark, path).select("month", F.col("n").cast(LONG).alias("n"))


def capped_table_rows(spark: SparkSession, d: str) -> DataFrame:
    """A capped table, counted while written, read through the catalog."""
    path = io.scratch_dir(spark)
    written = io.write_table(table(spark, d, "orders"), path, max_records=4000)
    io.register_tables(spark, "asofkit_checks", {"orders_capped": path})
    return spark.table("asofkit_checks.orders_capped").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n")).withColumn("written", F.lit(written).cast(LONG))


def measured_write(spark: SparkSession, d: str) -> DataFrame:
    """Row, non-NULL and sketched distinct counts and bounds taken while a table is written, beside those of a pass over it."""
    lines, path = table(spark, d, "lineitem").withColumn("late", F.when(F.col("l_shipdate") > F.lit("1998-01-01"), F.col("l_shipdate"))), io.scratch_dir(spark)
    wanted = measures(Metrics(non_null=("late",), distinct={"l_suppkey": "l_suppkey"}))
    seen = io.write_measured(lines, path, wanted | {"first": F.min("l_shipdate"), "last": F.max("l_shipdate")})
    report = measured_report(spark, {"lineitem": seen}, report_schema(("dataset", "rows", "non_null_late", "distinct_l_suppkey")))
    exact = io.read_table(spark, path).agg(F.count_distinct("l_suppkey").alias("suppliers"))
    close = F.abs(F.col("distinct_l_suppkey") - F.col("suppliers")) <= F.greatest(F.lit(2.0), 0.15 * F.col("suppliers"))
    first, last = (us(F.lit(str(seen[c])).cast("timestamp_ntz")) for c in ("first", "last"))
    # one row beside one row
    return report.join(exact).select("dataset", "rows", "non_null_late", "suppliers", close.alias("close"), first.alias("first_us"), last.alias("last_us"))


def month_tables(spark: SparkSession, d: str) -> DataFrame:
    """Orders written by month, the last month written again with other prices, read through the catalog, and
    within bounds by month folder and time."""
    path, orders = io.scratch_dir(spark), table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    io.write_months(orders, path, "o_orderdate")
    low, high = time_bounds(orders, "o_orderdate")
    last = orders.where(F.date_format("o_orderdate", "yyyyMM") == high.strftime("%Y%m"))
    io.write_months(last.withColumn("o_totalprice", F.col("o_totalprice") + 1), path, "o_orderdate")
    io.register_months(spark, "asofkit_checks", "orders_by_month", path)
    inside = io.read_months_within(spark, path, "o_orderdate", (low + timedelta(days=180), high - timedelta(days=180)))
    parts = [spark.table("asofkit_checks.orders_by_month").withColumn("read", F.lit("catalog")), inside.withColumn("read", F.lit("within"))]
    return parts[0].unionByName(parts[1]).select("read", "o_orderkey", "month", F.round("o_totalprice", 2).alias("price"))


def colocated_flights(spark: SparkSession, d: str) -> DataFrame:
    """Clean flights and weather in buckets by airport; flights whose origin is ever observed, joined without an exchange."""
    flights = _flights(spark, d).withColumnRenamed("ORIGIN_AIRPORT_ID", "AirportId")
    # in buckets only by one type on both sides
    weather = _weather(spark, d).select(F.col("AirportId").cast(LONG).alias("AirportId"), "timestamp", "WindSpeed")
    spark.sql("CREATE DATABASE IF NOT EXISTS asofkit_checks")
    f = io.write_colocated(flights, "asofkit_checks.flights_by_airport", "AirportId", 8, ["CRS_DEP_TIMESTAMP"])
    w = io.write_colocated(weather, "asofkit_checks.weather_by_airport", "AirportId", 8, ["timestamp"])
    return reducing.restrict_to(f, w, "AirportId").select(
        F.col("OP_CARRIER_FL_NUM").cast(LONG).alias("fl_num"), F.col("AirportId").cast(LONG).alias("airport"), us("CRS_DEP_TIMESTAMP").alias("dep_us"))


def month_sketches(spark: SparkSession, d: str) -> DataFrame:
    """A4, A5: a sketch of each month's customers, merged by year: beside the exact count, whether the sketch is within five times its stated error."""
    orders, path = table(spark, d, "orders"), io.scratch_dir(spark)
    kept = io.through_table(sketches_of(orders, "o_orderdate", {"customers": "o_custkey"}), path)
    merged = distinct_of_months(kept, ["customers"], F.substring("month", 1, 4))
    exact = orders.groupBy(F.date_format("o_orderdate", "yyyy").alias("span")).agg(F.count_distinct("o_custkey").alias("customers"))
    close = F.abs(F.col("distinct_customers") - F.col("customers")) <= F.greatest(F.lit(2.0), 5 * 0.0163 * F.col("customers"))
    return merged.join(exact, "span").select("span", "customers", close.alias("close"))


def quarantined_lines(spark: SparkSession, d: str) -> DataFrame:
    """Orders as text files in which some lines lack a field and some have one too many: those are set aside, as they are."""
    root, columns = io.scratch_dir(spark), ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    kind = F.col("o_orderkey") % 40
    line = (F.when(kind == 0, F.concat_ws(",", *columns[:2])).when(kind == 1, F.concat_ws(",", *columns, F.lit("more")))
            .otherwise(F.concat_ws(",", *columns)))
    rows = table(spark, d, "orders").select((F.col("o_orderkey") % 4).alias("part"), F.lit(1).alias("o"), line.alias("value"))
    heads = rows.select("part").distinct().select("part", F.lit(0).alias("o"), F.lit(",".join(columns)).alias("value"))
    # one file a part, its header first
    (heads.unionByName(rows).repartition("part").sortWithinPartitions("part", "o").select("part", "value")
     .write.partitionBy("part").text(root))
    good, broken = io.read_checked_text(spark, f"{root}/part=*")
    return good.select(*columns, F.lit(None).cast("string").alias("line")).unionByName(broken.select("line"), allowMissingColumns=True)


def _raw_files(spark: SparkSession, d: str) -> str:
    """Raw text files of all months that occur, and the station list, below a new folder."""
    root = io.scratch_dir(spark)
    for df, place in ((raw_flights(spark, d), "Flights/{}.csv"), (raw_weather(spark, d), "Weather/{}hourly.txt")):
        for (month,) in df.select("file_month").distinct().collect():
            df.where(F.col("file_month") == month).drop("file_month").write.option("header", True).csv(f"{root}/{place.format(month)}")
    raw_stations(spark, d).write.option("header", True).csv(f"{root}/stations.csv")
    return root


def _config(root: str, **kw) -> PipelineConfig:
    return PipelineConfig(flights_dir=f"{root}/Flights", weather_dir=f"{root}/Weather", station_csv=f"{root}/stations.csv",
                          out_root=f"{root}/out", airport_ids=LONG, **kw)


def pipeline_month(spark: SparkSession, d: str) -> DataFrame:
    """Raw text files by month, all stages for one month, the joined table."""
    return _per_flight(run_pipeline(spark, _config(_raw_files(spark, d), sample_month="202401", database=None)))


def pipeline_all(spark: SparkSession, d: str) -> DataFrame:
    """Z7 over all months: raw text files, all stages, the joined table."""
    return _per_flight(run_pipeline(spark, _config(_raw_files(spark, d), database=None)))


def pipeline_reports(spark: SparkSession, d: str) -> DataFrame:
    """Z7 by its modes one after the other, K2, K3, K4, K7, A9, Z5: the JSON report read back, the month counts of all four tables
    read back from CSV, and the rows of the tables that the catalog holds."""
    root, database = _raw_files(spark, d), "asofkit_checks_job"
    for mode in ("prepare", "quality", "join"):
        run_pipeline(spark, _config(root, lags=2, mode=mode, exact_quality=True, numeric_visibility=True, flat=mode == "join", month_report=mode == "join", database=database))
    quality = f"{root}/out/quality"
    report = spark.read.schema(report_schema()).json(f"{quality}/quality_summary.json")
    counts = F.explode(F.map_from_arrays(*[F.array(*x) for x in zip(*[(F.lit(c), F.col(c)) for c in REPORT_COLUMNS if c != "dataset"], strict=True)]))
    parts = [report.select(F.lit("report").alias("kind"), F.col("dataset").alias("name"), counts.alias("item", "value"))]
    for name in ("flight_clean", "weather_clean", "join_intermediate_lag2", "join_flat_lag2"):
        months = io.read_text_table(spark, f"{quality}/months/{name}_months.csv")
        parts.append(months.select(F.lit("months"), F.lit(name), "month", F.col("n").cast(LONG)))
    known = [("catalog", t.name, "rows", spark.table(f"{database}.{t.name}").count()) for t in spark.catalog.listTables(database)]
    spark.sql(f"DROP DATABASE {database} CASCADE")  # its tables are external: the files stay
    parts.append(spark.createDataFrame(known, "kind string, name string, item string, value long"))
    return reduce(DataFrame.union, parts)


ALL = (
    asof_latest, asof_latest_dest, asof_lags7, asof_hot_keys, asof_hot_instants, interval_join_pairs,
    time_pruned_scan, lag_flatten, lag_stats, lenient_casts, hhmm_timestamp, presence_and_default, arrival_times,
    sky_features, weather_scores, flag_filter, clean_flights, clean_station_map, allowed_keys, clean_weather,
    restrict_and_attach, dedup_subset, top_n_newest, collect_newest, shaped_columns, picked_features,
    enrich_two_sided, enrich_hot, enrich_zone_shift, enrich_single, flat_features, quality_counts, quality_exact,
    quality_approx, asof_many_segments, month_counts, month_count_files, capped_table_rows, pipeline_month,
    enrich_all_features, enrich_hot_instants, enrich_in_reach, enrich_legacy, flat_all_features, measured_write, month_tables, colocated_flights, month_sketches,
    quarantined_lines, pipeline_all, pipeline_reports,
)
