"""Raw flight, weather and station tables derived by Spark from ``events`` and ``customer``.

Purchases stand for flights and all other events for weather observations; a user is an airport, a customer adds
its stations. Values are all-string and carry the dirt that cleaning has to deal with. Users with an odd id live
31 days later, so that there are two months of input files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def users(spark: SparkSession, sf_dir: str) -> int:
    """One more than the largest user of the events: every airport is somebody's destination, whatever the scale."""
    return (table(spark, sf_dir, "events").agg(F.max("user_id")).first()[0] or 0) + 1


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights of the generic as-of queries."""
    e = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    return e.select("event_id", "user_id", "ts", "value", ((F.col("user_id") + 37) % users(spark, sf_dir)).alias("dest_id"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations of the generic as-of queries; ``event_id`` is their tie-breaker."""
    e = table(spark, sf_dir, "events").where("event_type <> 'purchase'")
    return e.select("user_id", "ts", F.col("event_id").alias("obs_id"), "value")


def _shifted(spark: SparkSession, sf_dir: str, flights: bool) -> DataFrame:
    kind = F.col("event_type") == "purchase"
    return table(spark, sf_dir, "events").where(kind if flights else ~kind).withColumn(
        "at", F.timestamp_add("DAY", (F.col("user_id") % 2 * 31).cast("int"), F.col("ts"))
    )


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shifted(spark, sf_dir, True).selectExpr(
        "if(event_id % 97 = 0, '2024-02-31', string(date(at))) AS FL_DATE",
        "event_type AS OP_CARRIER",
        "concat(event_id % 40000, if(event_id % 2 = 1, '.0', '')) AS OP_CARRIER_FL_NUM",
        "if(event_id % 101 = 0, 'X', string(user_id)) AS ORIGIN_AIRPORT_ID",
        f"string((user_id + 38) % {users(spark, sf_dir)}) AS DEST_AIRPORT_ID",
        "if(event_id % 89 = 0, '2400', string(hour(at) * 100 + minute(at))) AS CRS_DEP_TIME",
        "if(event_id % 71 = 0, NULL, string(value)) AS CRS_ELAPSED_TIME",
        "if(event_id % 3 = 0, concat(event_id % 180, '.0'), NULL) AS ARR_DELAY_NEW",
        "if(event_id % 5 = 0, string(event_id % 60), NULL) AS WEATHER_DELAY",
        "CASE WHEN event_id % 7 = 0 THEN 'n/a' WHEN event_id % 6 = 0 THEN concat(event_id % 45, '.5') END"
        " AS NAS_DELAY",
        "CASE WHEN event_id % 11 = 0 THEN '1.00' WHEN event_id % 13 = 0 THEN NULL"
        " WHEN event_id % 17 = 0 THEN 'abc' ELSE '0.00' END AS CANCELLED",
        "if(event_id % 19 = 0, '1', '0.00') AS DIVERTED",
        "concat('N', event_id) AS TAIL_NUM",
        "date_format(at, 'yyyyMM') AS file_month",
    )


def sky_text(number: str) -> str:
    """SQL text of a sky code built from an integer column."""
    def height(m: int) -> str:
        return f"lpad(string({number} % {m}), 3, '0')"
    return (
        f"CASE {number} % 8 WHEN 0 THEN 'CLR' WHEN 1 THEN concat('FEW', {height(1000)})"
        f" WHEN 2 THEN concat('SCT014 OVC', {height(500)}, 'CB')"
        f" WHEN 4 THEN if({number} % 16 = 4, 'M', concat({height(1000)}, '/', {height(1000)}, ' SCT', {height(90)}))"
        f" WHEN 5 THEN ' BKN020  OVC060TCU ' WHEN 6 THEN concat('VV', {height(30)})"
        f" WHEN 7 THEN concat('FEW', {height(90)}, ' SCT', {height(200)}, ' BKN', {height(350)}) END"
    )


def weather_text(number: str) -> str:
    """SQL text of a weather code built from an integer column."""
    return (
        f"CASE {number} % 9 WHEN 0 THEN '-RA BR' WHEN 1 THEN '+TSRA' WHEN 2 THEN 'FZRA SN' WHEN 4 THEN 'RA -RA'"
        " WHEN 5 THEN 'BR HZ FU' WHEN 6 THEN 'M' WHEN 7 THEN '+FC VCSH' WHEN 8 THEN '-DZ FG' END"
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shifted(spark, sf_dir, False).selectExpr(
        "CASE WHEN event_id % 103 = 0 THEN 'M' WHEN event_id % 4 = 0 THEN string(50000 + user_id)"
        " ELSE string(10000 + user_id) END AS WBAN",
        "date_format(at, 'yyyyMMdd') AS Date",
        "string(hour(at) * 100 + minute(at)) AS Time",
        "'0' AS StationType",
        f"{sky_text('event_id')} AS SkyCondition",
        "'10.00' AS Visibility",
        f"{weather_text('event_id')} AS WeatherType",
        "if(event_id % 23 = 0, 'M', string(value)) AS DryBulbFarenheit",
        "'5' AS DryBulbCelsius",
        "string(event_id % 90) AS WetBulbFarenheit",
        "if(event_id % 2 = 0, ' ', '35') AS DewPointFarenheit",
        "string(event_id % 101) AS RelativeHumidity",
        "string(event_id % 40) AS WindSpeed",
        "if(event_id % 6 = 0, 'VR ', lpad(string(event_id % 36 * 10), 3, '0')) AS WindDirection",
        "if(event_id % 5 = 0, string(event_id % 200), '') AS ValueForWindCharacter",
        "string(event_id % 9) AS PressureTendency",
        "concat('0', event_id % 300) AS PressureChange",
        "concat('29.', lpad(string(event_id % 100), 2, '0')) AS Altimeter",
        "'M' AS SeaLevelPressure",
        "concat('28.', event_id % 10) AS StationPressure",
        "CASE event_id % 4 WHEN 0 THEN ' T' WHEN 1 THEN concat('0.', event_id % 10, '5') END AS HourlyPrecip",
        "date_format(at, 'yyyyMM') AS file_month",
    )


def raw_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer is one airport with a station; some have a second one, share one, or are listed twice."""
    c = table(spark, sf_dir, "customer")
    return c.selectExpr("explode(array("
        "named_struct('on', true, 'a', string(c_custkey), 'w', string(10000 + c_custkey), 'z', string(c_nationkey - 12)),"
        "named_struct('on', c_custkey % 3 = 0, 'a', string(c_custkey), 'w', string(50000 + c_custkey), 'z', '0'),"
        "named_struct('on', c_custkey % 10 = 0, 'a', concat(c_custkey, '.0'), 'w', string(10000 + c_custkey),"
        " 'z', if(c_custkey % 20 = 0, NULL, '-12')),"
        "named_struct('on', c_custkey % 25 = 0, 'a', string(c_custkey + 1), 'w', string(10000 + c_custkey), 'z', 'x'),"
        "named_struct('on', c_custkey % 50 = 0, 'a', CAST(NULL AS STRING), 'w', string(10000 + c_custkey), 'z', '1')"
        ")) AS s").where("s.on").selectExpr("s.a AS AirportId", "s.w AS WBAN", "s.z AS TimeZone")
