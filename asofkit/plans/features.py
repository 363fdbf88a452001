"""Feature columns of the weather table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofkit.functions import codes
from asofkit.operators.shaping import with_family

# Weather features handed to the join, in output order.
JOIN_FEATURES = (
    "DryBulbFarenheit", "WetBulbFarenheit", "DewPointFarenheit", "RelativeHumidity",
    "SeaLevelPressure", "StationPressure", "Altimeter",
    "WindSpeed", "WindDirection", "ValueForWindCharacter", "Visibility", "HourlyPrecip",
    "PressureTendency", "PressureChange",
    "sky_num_layers", "sky_min_altitude", "sky_max_altitude", "sky_mean_altitude",
    "sky_has_CB", "sky_has_TCU", "sky_has_OVC", "sky_has_BKN", "sky_has_SCT", "sky_has_FEW", "sky_has_VV",
    "wt_score_RA", "wt_score_TS", "wt_score_FG", "wt_score_BR", "wt_score_FZ", "wt_score_SN", "wt_score_SH",
    "wt_score_DZ",
)


def add_sky_features(df: DataFrame, sky: str = "SkyCondition") -> DataFrame:
    """Layer count, lowest, highest and mean layer height in feet, cloud flags.

    Heights are ints and NULL without layers. The five prefix flags are NULL for a NULL text, CB and TCU false.
    """
    text = F.col(sky)
    df = df.withColumn("_alt", codes.sky_altitudes(text)).withColumns({
        "sky_num_layers": codes.token_count(text).try_cast("tinyint"),
        "sky_min_altitude": F.array_min("_alt"),
        "sky_max_altitude": F.array_max("_alt"),
        "sky_mean_altitude": codes.mean_of(F.col("_alt")).cast("float"),
        "sky_has_CB": codes.has_token(text, "CB"),
        "sky_has_TCU": codes.has_token(text, "TCU"),
    }).drop("_alt")
    return with_family(df, "sky_has_", codes.SKY_PREFIXES, text.contains)


def add_weather_scores(df: DataFrame, weather: str = "WeatherType") -> DataFrame:
    """One intensity score column per weather code. The text is cut into codes once, then looked up."""
    df = df.withColumn("_codes", codes.code_list(F.col(weather)))
    df = with_family(df, "wt_score_", codes.WEATHER_CODES, lambda code: codes.score_in(F.col("_codes"), code))
    return df.drop("_codes")
