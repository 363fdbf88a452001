"""What ``queries`` computes, as SQL over the same tables."""

from __future__ import annotations

import re

from asofkit.functions.codes import SKY_PREFIXES, WEATHER_CODES
from asofkit.plans.features import JOIN_FEATURES

FLIGHTS = (
    "flights AS (SELECT event_id, user_id, ts, value, (user_id + 37) % (SELECT max(user_id) + 1 FROM events) AS dest_id FROM events"
    " WHERE event_type = 'purchase')"
)
OBS = "obs AS (SELECT user_id, ts AS ots, event_id AS obs_id, value AS oval FROM events WHERE event_type <> 'purchase')"


def ranked(key: str = "user_id", hours: int = 12, flights: str = FLIGHTS, obs: str = OBS) -> str:
    """CTEs: flights, observations, and all matches with their rank, newest first."""
    return (
        f"WITH {flights}, {obs}, m AS (SELECT f.event_id, o.obs_id, o.ots, o.oval, row_number() OVER"
        f" (PARTITION BY f.event_id ORDER BY o.ots DESC, o.obs_id DESC) - 1 AS k FROM flights f JOIN obs o"
        f" ON o.user_id = f.{key} AND o.ots <= f.ts AND o.ots >= f.ts - INTERVAL {hours} HOUR) "
    )


def lag_rows(n: int, **kw) -> str:
    return ranked(**kw) + f"SELECT event_id, k, obs_id FROM m WHERE k < {n}"


def folded(flights_ts: str, keys: int) -> dict[str, str]:
    cut = "date_trunc('day', ts)::TIMESTAMP" if flights_ts == "day" else "ts"
    return {
        "flights": f"flights AS (SELECT event_id, user_id % {keys} AS user_id, {cut} AS ts FROM events"
                   " WHERE event_type = 'purchase')",
        "obs": f"obs AS (SELECT user_id % {keys} AS user_id, {cut} AS ots, event_id AS obs_id, value AS oval"
               " FROM events WHERE event_type <> 'purchase')",
    }


def lag_case(value: str, k: int) -> str:
    return f"max(CASE WHEN k = {k} THEN {value} END)"


LAG_FLATTEN = (
    ranked() + "SELECT f.event_id, " + ", ".join(f"{lag_case('obs_id', k)} AS orig_obs_id_lag{k}" for k in range(7))
    + f", epoch_us({lag_case('ots', 0)}) AS us0, epoch_us({lag_case('ots', 6)}) AS us6"
    " FROM flights f LEFT JOIN m ON m.event_id = f.event_id AND k < 7 GROUP BY f.event_id"
)
LAG_STATS = (
    ranked() + "SELECT f.event_id, min(oval) AS orig_value_min, max(oval) AS orig_value_max,"
    " round(CASE WHEN count(oval) = 7 THEN sum(oval) / 7 END, 6) AS orig_value_avg,"
    f" round({lag_case('oval', 0)} - {lag_case('oval', 6)}, 6) AS orig_value_delta,"
    " min(obs_id) AS orig_obs_id_min, max(obs_id) AS orig_obs_id_max,"
    f" CAST({lag_case('obs_id', 0)} - {lag_case('obs_id', 6)} AS DOUBLE) AS orig_obs_id_delta"
    " FROM flights f LEFT JOIN m ON m.event_id = f.event_id AND k < 7 GROUP BY f.event_id"
)


def whole(text: str, kind: str) -> str:
    """A text as an integer type, cut toward zero; NULL when it is no plain number or out of range."""
    return (f"try_cast(nullif(regexp_extract({text}, '^\\s*([+-]?\\d+)(\\.\\d*)?\\s*$', 1), '') AS {kind})"
            "::BIGINT")


def missing(text: str) -> str:
    return f"(CASE WHEN trim({text}) NOT IN ('', 'M') THEN {text} END)"


def real(text: str) -> str:
    return f"try_cast(trim({text}) AS FLOAT)"


def clock_time(day: str, hhmm: str, day_format: str) -> str:
    padded = f"lpad({hhmm}, 4, '0')"
    return (f"(CASE WHEN {padded} < '2400' AND substr({padded}, 3, 2) < '60' THEN"
            f" try_strptime({day} || ' ' || {padded}, '{day_format} %H%M') END)")


def sky_text(n: str) -> str:
    def height(m: int) -> str:
        return f"lpad(({n} % {m})::VARCHAR, 3, '0')"
    return (
        f"CASE {n} % 8 WHEN 0 THEN 'CLR' WHEN 1 THEN 'FEW' || {height(1000)}"
        f" WHEN 2 THEN 'SCT014 OVC' || {height(500)} || 'CB'"
        f" WHEN 4 THEN CASE WHEN {n} % 16 = 4 THEN 'M' ELSE {height(1000)} || '/' || {height(1000)} || ' SCT' || {height(90)} END"
        f" WHEN 5 THEN ' BKN020  OVC060TCU ' WHEN 6 THEN 'VV' || {height(30)}"
        f" WHEN 7 THEN 'FEW' || {height(90)} || ' SCT' || {height(200)} || ' BKN' || {height(350)} END"
    )


def weather_text(n: str) -> str:
    return (
        f"CASE {n} % 9 WHEN 0 THEN '-RA BR' WHEN 1 THEN '+TSRA' WHEN 2 THEN 'FZRA SN' WHEN 4 THEN 'RA -RA'"
        " WHEN 5 THEN 'BR HZ FU' WHEN 6 THEN 'M' WHEN 7 THEN '+FC VCSH' WHEN 8 THEN '-DZ FG' END"
    )


def heights(sky: str) -> str:
    # digits beside a slash begin or end no height
    bare = f"regexp_replace(regexp_replace({sky}, '/\\d', '/x', 'g'), '\\d/', 'x/', 'g')"
    return f"list_transform(regexp_extract_all({bare}, '\\d{{3}}'), lambda h: h::BIGINT * 100)"


def layers(sky: str) -> str:
    return (f"(CASE WHEN {sky} IS NULL OR trim({sky}) IN ('', 'M') THEN 0"
            f" ELSE len(regexp_split_to_array(trim({sky}), '\\s+')) END)::BIGINT")


def mean_height(sky: str) -> str:
    return f"CAST(CAST(list_sum({heights(sky)}) / len({heights(sky)}) AS FLOAT) AS DOUBLE)"


def score(text: str, code: str) -> str:
    """The last token with this code tells: one less than two for '-', two more for '+'."""
    last = (f"list_last(list_filter(regexp_extract_all({text}, '[+-]?[A-Z]{{2}}'),"
            f" lambda t: right(t, 2) = '{code}'))")
    return (f"coalesce(CASE left({last}, 1) WHEN '-' THEN 1 WHEN '+' THEN 4 ELSE"
            f" CASE WHEN {last} IS NOT NULL THEN 2 END END, 0)::BIGINT")


SKY_FEATURES = (
    f"WITH t AS (SELECT {sky_text('(l_orderkey * 7 + l_linenumber)')} AS s FROM lineitem) SELECT"
    f" s AS SkyCondition, {layers('s')} AS num_layers, list_min({heights('s')}) AS min_altitude,"
    f" list_max({heights('s')}) AS max_altitude, {mean_height('s')} AS mean_altitude,"
    " coalesce(contains(s, 'CB'), false) AS sky_has_CB, coalesce(contains(s, 'TCU'), false) AS sky_has_TCU, "
    + ", ".join(f"contains(s, '{p}') AS sky_has_{p}" for p in SKY_PREFIXES) + " FROM t"
)
WEATHER_SCORES = (
    f"WITH t AS (SELECT {weather_text('(l_partkey + l_linenumber)')} AS w FROM lineitem) SELECT w AS WeatherType, "
    + ", ".join(f"{score('w', c)} AS wt_score_{c}" for c in WEATHER_CODES) + " FROM t"
)

_N = "(l_orderkey * 7 + l_linenumber)"
LENIENT_CASTS = (
    f"WITH t AS (SELECT CASE {_N} % 6 WHEN 0 THEN ' ' || l_partkey || ' ' WHEN 1 THEN l_partkey || '.0'"
    " WHEN 2 THEN 'M' WHEN 3 THEN '' WHEN 4 THEN '-' || l_suppkey || '.9' ELSE (l_orderkey * 5)::VARCHAR END AS a,"
    f" CASE {_N} % 4 WHEN 0 THEN ' T' WHEN 1 THEN l_discount::VARCHAR WHEN 2 THEN 'T' ELSE 'VR' END AS b"
    f" FROM lineitem), c AS (SELECT {missing('a')} AS text, b FROM t) SELECT text,"
    f" {whole('text', 'SMALLINT')} AS as_short, {whole('text', 'TINYINT')} AS as_byte,"
    f" {whole('text', 'INTEGER')} AS as_int, {real('b')}::DOUBLE AS precip FROM c"
)

# --- the derived raw tables, cleaned

SHIFTED = "e AS (SELECT *, ts + INTERVAL 31 DAY * (user_id % 2) AS moved FROM events)"
FL_DATE = "CASE WHEN event_id % 97 = 0 THEN NULL ELSE strftime(moved, '%Y-%m-%d') END"
HHMM = "(hour(moved) * 100 + minute(moved))::VARCHAR"
CRS = f"(CASE WHEN event_id % 89 = 0 THEN '2400' ELSE {HHMM} END)"
NAS = "(CASE WHEN event_id % 7 = 0 THEN 'n/a' WHEN event_id % 6 = 0 THEN (event_id % 45) || '.5' END)"

CLEAN_FLIGHTS = (
    f"fc AS (SELECT event_id, strftime(moved, '%Y%m') AS file_month, {FL_DATE} AS FL_DATE, event_type AS OP_CARRIER,"
    f" {CRS} AS CRS_DEP_TIME,"
    " try_cast(event_id % 40000 AS SMALLINT)::BIGINT AS OP_CARRIER_FL_NUM,"
    " CASE WHEN event_id % 101 <> 0 THEN user_id END AS ORIGIN_AIRPORT_ID, (user_id + 38) % (SELECT max(user_id) + 1 FROM events) AS DEST_AIRPORT_ID,"
    " CASE WHEN event_id % 71 <> 0 THEN value::VARCHAR::FLOAT::DOUBLE END AS CRS_ELAPSED_TIME,"
    " CASE WHEN event_id % 3 = 0 THEN (event_id % 180)::DOUBLE END AS ARR_DELAY_NEW,"
    " CASE WHEN event_id % 5 = 0 THEN event_id % 60 ELSE 0 END::DOUBLE AS WEATHER_DELAY,"
    f" coalesce(try_cast({NAS} AS DOUBLE), 0) AS NAS_DELAY,"
    f" event_id % 5 = 0 AS HAS_WEATHER_DELAY, {NAS} IS NOT NULL AS HAS_NAS_DELAY,"
    f" {clock_time(FL_DATE, CRS, '%Y-%m-%d')} AS dep"
    " FROM e WHERE event_type = 'purchase' AND event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0"
    " AND event_id % 19 <> 0)"
)
CLEAN_STATIONS = (
    "sm AS (SELECT a AS AirportId, w AS WBAN, min(z) AS TimeZone FROM ("
    "SELECT c_custkey AS a, 10000 + c_custkey AS w, c_nationkey - 12 AS z FROM customer"
    " UNION ALL SELECT c_custkey, 50000 + c_custkey, 0 FROM customer WHERE c_custkey % 3 = 0"
    " UNION ALL SELECT c_custkey, 10000 + c_custkey, CASE WHEN c_custkey % 20 <> 0 THEN -12 END FROM customer"
    " WHERE c_custkey % 10 = 0"
    " UNION ALL SELECT c_custkey + 1, 10000 + c_custkey, NULL FROM customer WHERE c_custkey % 25 = 0"
    ") WHERE a <= 32767 GROUP BY a, w)"
)
ALLOWED = (
    "al AS (SELECT WBAN, AirportId FROM sm WHERE AirportId IN"
    " (SELECT ORIGIN_AIRPORT_ID FROM fc WHERE ORIGIN_AIRPORT_ID IS NOT NULL UNION SELECT DEST_AIRPORT_ID FROM fc))"
)
CLEAN_WEATHER = (
    "wc AS (SELECT al.WBAN, al.AirportId, e.event_id, strftime(moved, '%Y%m') AS file_month,"
    " date_trunc('minute', moved)::TIMESTAMP AS w_ts,"
    f" {sky_text('event_id')} AS sky, {weather_text('event_id')} AS wt,"
    " CASE WHEN event_id % 23 <> 0 THEN value::VARCHAR::FLOAT::DOUBLE END AS dry,"
    " (event_id % 90)::DOUBLE AS wet, CASE WHEN event_id % 2 <> 0 THEN 35.0::DOUBLE END AS dew,"
    " event_id % 101 AS hum, event_id % 40 AS wind, CASE WHEN event_id % 6 <> 0 THEN event_id % 36 * 10 END AS wdir,"
    " CASE WHEN event_id % 5 = 0 AND event_id % 200 < 128 THEN event_id % 200 END AS wchar,"
    " event_id % 9 AS tend, event_id % 300 AS change,"
    " ('29.' || lpad((event_id % 100)::VARCHAR, 2, '0'))::FLOAT::DOUBLE AS alt,"
    " ('28.' || (event_id % 10))::FLOAT::DOUBLE AS station_p,"
    " CASE WHEN event_id % 4 = 1 THEN ('0.' || (event_id % 10) || '5')::FLOAT::DOUBLE END AS precip"
    " FROM e JOIN al ON al.WBAN = CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 4 = 0 THEN 50000 + user_id"
    " ELSE 10000 + user_id END WHERE event_type <> 'purchase')"
)
CLEAN = f"WITH {SHIFTED}, {CLEAN_FLIGHTS}, {CLEAN_STATIONS}, {ALLOWED}, {CLEAN_WEATHER}"



def weather_columns() -> dict[str, str]:
    """SQL of every feature of the clean weather over ``wc``; whole numbers and reals as they are."""
    measures = {
        "DryBulbFarenheit": "dry", "WetBulbFarenheit": "wet", "DewPointFarenheit": "dew", "Altimeter": "alt", "SeaLevelPressure": "NULL::DOUBLE",
        "StationPressure": "station_p", "HourlyPrecip": "precip", "RelativeHumidity": "hum", "WindSpeed": "wind", "WindDirection": "wdir",
        "ValueForWindCharacter": "wchar", "PressureTendency": "tend", "PressureChange": "change", "Visibility": "'10.00'",
    }
    sky = {
        "sky_num_layers": layers("sky"), "sky_min_altitude": f"list_min({heights('sky')})", "sky_max_altitude": f"list_max({heights('sky')})",
        "sky_mean_altitude": mean_height("sky"), **{f"sky_has_{c}": f"coalesce(contains(sky, '{c}'), false)" for c in ("CB", "TCU")},
        **{f"sky_has_{c}": f"contains(sky, '{c}')" for c in SKY_PREFIXES},
    }
    return measures | sky | {f"wt_score_{c}": score("wt", c) for c in WEATHER_CODES}


CLEAN_WEATHER_ROWS = CLEAN + (
    " SELECT epoch_us(w_ts) AS at_us, '0' AS StationType, file_month, sky AS SkyCondition, wt AS WeatherType, WBAN, AirportId, "
    + ", ".join(f"{v} AS {c}" for c, v in weather_columns().items()) + " FROM wc"
)


def joined(lags: int, month: str | None = None, shift: bool = False, fold: bool = False) -> str:
    """CTEs up to ``o`` and ``d``: the ranked matches of each side, and ``f``: flights with their arrival."""
    best, before, seen = "dry DESC NULLS LAST, wet DESC", "fc", "wc"
    if fold:  # many observations of a station at one time: all features rank them
        best = ", ".join(f"{weather_columns()[f]} DESC NULLS LAST" for f in JOIN_FEATURES)
        before = ("(SELECT * REPLACE (ORIGIN_AIRPORT_ID % 2 AS ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID % 2 AS DEST_AIRPORT_ID,"
                  " date_trunc('month', dep)::TIMESTAMP AS dep) FROM fc)")
        seen = "(SELECT * REPLACE (AirportId % 2 AS AirportId, date_trunc('month', w_ts)::TIMESTAMP AS w_ts) FROM wc)"
    only = f" WHERE file_month = '{month}'" if month else ""
    arrival = "dep + to_seconds(trunc(CRS_ELAPSED_TIME * 60)::BIGINT)"
    if shift:
        zone = "(SELECT min(TimeZone) FROM sm WHERE sm.AirportId = {})"
        arrival += (" + to_hours(coalesce(" + zone.format("DEST_AIRPORT_ID") + " - " + zone.format("ORIGIN_AIRPORT_ID")
                    + ", 0)::INTEGER)")
    fc, wc = (CLEAN_FLIGHTS, CLEAN_WEATHER)
    if month:  # stations in use are those of the month's flights
        fc = fc.replace("FROM e WHERE", f"FROM e WHERE strftime(moved, '%Y%m') = '{month}' AND")
    sides = []
    for name, key, t in (("o", "ORIGIN_AIRPORT_ID", "dep"), ("d", "DEST_AIRPORT_ID", "arr")):
        sides.append(
            f"{name} AS (SELECT * FROM (SELECT f.event_id AS fid, w.*, row_number() OVER"
            f" (PARTITION BY f.event_id ORDER BY w_ts DESC, w.WBAN DESC, {best}) - 1 AS k"
            f" FROM f JOIN w ON w.AirportId = f.{key} AND w_ts <= f.{t} AND w_ts >= f.{t} - INTERVAL 12 HOUR)"
            f" WHERE k < {lags})"
        )
    return (f"WITH {SHIFTED}, {fc}, {CLEAN_STATIONS}, {ALLOWED}, {wc}, f AS (SELECT *, {arrival} AS arr FROM {before}),"
            f" w AS (SELECT * FROM {seen}{only}), " + ", ".join(sides) + " ")


def per_flight(**kw) -> str:
    cte, parts, picks = joined(7, **kw), [], []
    for side, name in (("origin", "o"), ("dest", "d")):
        parts.append(
            f" LEFT JOIN (SELECT fid, count(*) AS n, max(w_ts) AS new, min(w_ts) AS old, sum(wind)::BIGINT AS wind,"
            f" max(CASE WHEN k = 0 THEN dry END) AS dry, sum({score('wt', 'RA')})::BIGINT AS rain FROM {name}"
            f" GROUP BY fid) AS {side} ON {side}.fid = f.event_id"
        )
        picks.append(
            f"coalesce({side}.n, 0) AS {side}_n, epoch_us({side}.new) AS {side}_new_us,"
            f" epoch_us({side}.old) AS {side}_old_us, {side}.dry AS {side}_dry,"
            f" coalesce({side}.wind, 0) AS {side}_wind, coalesce({side}.rain, 0) AS {side}_rain"
        )
    return (cte + "SELECT OP_CARRIER_FL_NUM AS fl_num, epoch_us(f.dep) AS dep_us, epoch_us(f.arr) AS arr_us, "
            + ", ".join(picks) + " FROM f" + "".join(parts))


def all_features() -> str:
    plain = {f: v if f == "Visibility" or f.startswith("sky_has_") else f"({v})::DOUBLE" for f, v in weather_columns().items() if f in JOIN_FEATURES}
    rows = [f"SELECT OP_CARRIER_FL_NUM AS fl_num, epoch_us(f.dep) AS dep_us, '{side}' AS side, k, epoch_us(w_ts) AS w_us, "
            + ", ".join(f"{v} AS {f}" for f, v in plain.items()) + f" FROM f JOIN {name} ON {name}.fid = f.event_id"
            for side, name in (("origin", "o"), ("dest", "d"))]
    return joined(7) + " UNION ALL ".join(rows)


def legacy() -> str:
    picks, parts = [], []
    for side, name in (("origin", "o"), ("dest", "d")):
        picks.append(f"coalesce({side}.n, 1) AS {side}_n, {side}.n IS NULL AS {side}_blank")
        parts.append(f" LEFT JOIN (SELECT fid, count(*) AS n FROM {name} GROUP BY fid) AS {side} ON {side}.fid = f.event_id")
    return joined(3) + "SELECT OP_CARRIER_FL_NUM AS fl_num, epoch_us(f.dep) AS dep_us, " + ", ".join(picks) + " FROM f" + "".join(parts)


def flat_all() -> str:
    rows, lags = [], [f"lag{k}" for k in range(7)]
    for side, name in (("orig", "o"), ("dest", "d")):
        for f, v in weather_columns().items():
            if f not in JOIN_FEATURES or f == "Visibility" or f.startswith("sky_has_"):
                continue
            picks = ", ".join(f"max(CASE WHEN k = {k} THEN ({v})::DOUBLE END) AS lag{k}" for k in range(7))
            rows.append(f"SELECT OP_CARRIER_FL_NUM AS fl_num, epoch_us(f.dep) AS dep_us, '{side}' AS side, '{f}' AS feature, {', '.join(lags)},"
                        f" least({', '.join(lags)}) AS min, greatest({', '.join(lags)}) AS max, round(({' + '.join(lags)}) / 7, 6) AS avg,"
                        f" round(lag0 - lag6, 6) AS delta FROM f LEFT JOIN (SELECT fid, {picks} FROM {name} GROUP BY fid) AS s ON s.fid = f.event_id")
    return joined(7) + " UNION ALL ".join(rows)


def single() -> str:
    picks, parts = [], []
    for side, name in (("origin", "o"), ("dest", "d")):
        picks.append(f"epoch_us({name}.w_ts) AS {side}_us, {name}.dry AS {side}_dry,"
                     f" CASE WHEN {name}.fid IS NOT NULL THEN {layers(name + '.sky')} END AS {side}_layers")
        parts.append(f" LEFT JOIN {name} ON {name}.fid = f.event_id")
    return (joined(1) + "SELECT OP_CARRIER_FL_NUM AS fl_num, epoch_us(f.dep) AS dep_us, " + ", ".join(picks)
            + " FROM f" + "".join(parts))


def flat() -> str:
    picks, parts = [], []
    for side, name in (("orig", "o"), ("dest", "d")):
        lag = [f"{name}{k}.wind" for k in range(3)]
        parts += [f" LEFT JOIN {name} {name}{k} ON {name}{k}.fid = f.event_id AND {name}{k}.k = {k}" for k in range(3)]
        picks += [f"{c} AS {side}_WindSpeed_lag{k}" for k, c in enumerate(lag)]
        picks += [f"least({', '.join(lag)}) AS {side}_WindSpeed_min",
                  f"greatest({', '.join(lag)}) AS {side}_WindSpeed_max",
                  f"{lag[0]} - {lag[2]} AS {side}_WindSpeed_delta",
                  f"round(({' + '.join(lag)}) / 3.0::DOUBLE, 6) AS {side}_WindSpeed_avg"]
    return (joined(3) + "SELECT OP_CARRIER_FL_NUM AS fl_num, epoch_us(f.dep) AS dep_us, epoch_us(o2.w_ts) AS orig_us2, "
            + ", ".join(picks) + " FROM f" + "".join(parts))


QUALITY = CLEAN + (
    " SELECT 'flight_clean' AS dataset, count(*) AS rows, count(dep) AS non_null_CRS_DEP_TIMESTAMP,"
    " count(ORIGIN_AIRPORT_ID) AS non_null_ORIGIN_AIRPORT_ID, count(DEST_AIRPORT_ID) AS non_null_DEST_AIRPORT_ID,"
    " count(DISTINCT FL_DATE) AS distinct_FL_DATE, count(DISTINCT ORIGIN_AIRPORT_ID) AS distinct_ORIGIN_AIRPORT_ID,"
    " count(DISTINCT DEST_AIRPORT_ID) AS distinct_DEST_AIRPORT_ID, NULL::BIGINT AS non_null_timestamp,"
    " NULL::BIGINT AS non_null_AirportId, NULL::BIGINT AS distinct_AirportId, NULL::BIGINT AS distinct_date,"
    " NULL::BIGINT AS distinct_WBAN FROM fc"
    " UNION ALL SELECT 'weather_clean', count(*), NULL, NULL, NULL, NULL, NULL, NULL, count(w_ts), count(AirportId),"
    " count(DISTINCT AirportId), count(DISTINCT w_ts::DATE), NULL FROM wc"
    " UNION ALL SELECT 'airport_timezone_clean', count(*), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,"
    " count(DISTINCT AirportId), NULL, count(DISTINCT WBAN) FROM sm"
)


# the same with the stations of all airports, and so the weather of all
QUALITY_WHOLE = QUALITY.replace(" WHERE a <= 32767 ", " WHERE a IS NOT NULL ")


def job_reports() -> str:
    columns = re.findall(r"AS ((?:rows|non_null_\w+|distinct_\w+))", QUALITY.partition("'flight_clean' AS dataset")[2].partition(" UNION ALL ")[0])
    parts = [f"SELECT 'report' AS kind, dataset AS name, '{c}' AS item, {c} AS value FROM q" for c in columns]
    for name in ("flight_clean", "join_intermediate_lag2", "join_flat_lag2"):
        parts.append(f"SELECT 'months', '{name}', FL_DATE[:7], count(*) FROM fc GROUP BY FL_DATE[:7]")
    parts.append("SELECT 'months', 'weather_clean', strftime(w_ts, '%Y-%m'), count(*) FROM wc GROUP BY 3")
    for name, rows in (("flight_clean", "fc"), ("weather_clean", "wc"), ("airport_timezone_clean", "sm")):
        parts.append(f"SELECT 'catalog', '{name}', 'rows', count(*) FROM {rows}")
    cte, _, query = QUALITY.partition(" SELECT 'flight_clean' AS dataset")
    return f"{cte}, q AS (SELECT 'flight_clean' AS dataset{query}) " + " UNION ALL ".join(parts)


def quality_close() -> str:
    """The exact counts, each with a flag that holds wherever there is a count."""
    counts = re.findall(r"AS ((?:rows|non_null_\w+|distinct_\w+))", QUALITY.partition("'flight_clean' AS dataset")[2].partition(" UNION ALL ")[0])
    flags = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN true END AS close_{c}" for c in counts)
    return f"SELECT *, {flags} FROM ({QUALITY_WHOLE})"


ALL = {
    "asof_latest": (
        f"WITH {FLIGHTS}, {OBS} SELECT f.event_id, CASE WHEN o.ots >= f.ts - INTERVAL 12 HOUR THEN o.obs_id END"
        " AS obs_id, CASE WHEN o.ots >= f.ts - INTERVAL 12 HOUR THEN epoch_us(o.ots) END AS obs_us"
        " FROM flights f ASOF LEFT JOIN obs o ON f.user_id = o.user_id AND f.ts >= o.ots"
    ),
    "asof_latest_dest": (
        f"WITH {FLIGHTS}, {OBS}, f AS (SELECT *, ts + to_seconds(trunc(value * 60)::BIGINT) AS arr FROM flights)"
        " SELECT f.event_id, epoch_us(f.arr) AS arr_us, CASE WHEN o.ots >= f.arr - INTERVAL 12 HOUR THEN o.obs_id END"
        " AS obs_id FROM f ASOF LEFT JOIN obs o ON f.dest_id = o.user_id AND f.arr >= o.ots"
    ),
    "asof_lags7": lag_rows(7),
    "asof_hot_keys": lag_rows(7, **folded("ts", 3)),
    "asof_many_segments": lag_rows(7, **folded("ts", 1)),
    "asof_hot_instants": lag_rows(3, hours=24, **folded("day", 2)),
    "interval_join_pairs": (
        f"WITH {FLIGHTS}, {OBS} SELECT f.event_id, o.obs_id FROM flights f LEFT JOIN obs o ON o.user_id = f.user_id"
        " AND o.ots <= f.ts AND o.ots >= f.ts - INTERVAL 12 HOUR"
    ),
    "time_pruned_scan": (
        "WITH b AS (SELECT min(o_orderdate) - INTERVAL 12 HOUR AS lo, max(o_orderdate) AS hi FROM orders)"
        " SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, epoch_us(l_shipdate) AS ship_us"
        " FROM lineitem WHERE l_shipdate BETWEEN (SELECT lo FROM b) AND (SELECT hi FROM b)"
    ),
    "lag_flatten": LAG_FLATTEN,
    "lag_stats": LAG_STATS,
    "lenient_casts": LENIENT_CASTS,
    "hhmm_timestamp": (
        "WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 31 = 0 THEN '19970230' ELSE"
        " strftime(o_orderdate, '%Y%m%d') END AS day, lpad((o_orderkey * 37 % 2500)::VARCHAR, 4, '0') AS padded"
        f" FROM orders) SELECT o_orderkey, padded, epoch_us({clock_time('day', 'padded', '%Y%m%d')}) AS at_us FROM t"
    ),
    "presence_and_default": (
        "SELECT o_orderkey, o_orderkey % 3 < 2 AS has_value,"
        " CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice ELSE 0 END AS v FROM orders"
    ),
    "arrival_times": (
        "SELECT event_id, epoch_us(ts + to_seconds(trunc(value * 60)::BIGINT)) AS arr_us,"
        " epoch_us(ts + to_seconds(trunc(value * 10000000.0 * 60)::BIGINT)) AS far_us,"
        " epoch_us(ts - INTERVAL 12 HOUR) AS from_us FROM events"
    ),
    "sky_features": SKY_FEATURES,
    "weather_scores": WEATHER_SCORES,
    "flag_filter": "SELECT o_orderkey, '0.00' AS flag FROM orders WHERE o_orderstatus = 'O'",
    "clean_flights": (
        f"WITH {SHIFTED}, {CLEAN_FLIGHTS} SELECT FL_DATE, OP_CARRIER, CRS_DEP_TIME, OP_CARRIER_FL_NUM,"
        " ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID, CRS_ELAPSED_TIME, ARR_DELAY_NEW, WEATHER_DELAY, NAS_DELAY,"
        " HAS_WEATHER_DELAY, HAS_NAS_DELAY, epoch_us(dep) AS dep_us FROM fc"
    ),
    "clean_station_map": f"WITH {CLEAN_STATIONS} SELECT AirportId, WBAN, TimeZone::BIGINT AS TimeZone FROM sm",
    "allowed_keys": (
        f"WITH {SHIFTED}, {CLEAN_FLIGHTS}, {CLEAN_STATIONS}, {ALLOWED} SELECT WBAN, AirportId FROM al"
    ),
    "clean_weather": CLEAN_WEATHER_ROWS,
    "restrict_and_attach": (
        "SELECT l_suppkey, n_name, l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_quantity FROM lineitem"
        " JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey < 2"
    ),
    "dedup_subset": (
        "SELECT l_suppkey, l_returnflag, l_quantity AS q, l_extendedprice FROM (SELECT *, row_number() OVER"
        " (PARTITION BY l_suppkey, l_returnflag ORDER BY l_extendedprice, l_quantity) AS r FROM lineitem"
        " WHERE l_discount > 0.02) WHERE r = 1"
    ),
    "top_n_newest": (
        "SELECT o_custkey, o_orderkey, rk FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey"
        " ORDER BY o_orderdate DESC, o_orderkey DESC) AS rk FROM orders) WHERE rk <= 5"
    ),
    "collect_newest": (
        "SELECT o_custkey, rk - 1 AS k, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER"
        " (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rk FROM orders) WHERE rk <= 3"
    ),
    "shaped_columns": (
        "SELECT p_partkey, 'part' AS data_set, p_size::BIGINT AS \"size_cm_\", p_name AS name FROM part"
    ),
    "picked_features": (
        "SELECT l_suppkey AS apt_id, epoch_us(l_shipdate) AS w_us, l_quantity * 2 AS q_2, l_tax, l_quantity AS q_1"
        " FROM lineitem"
    ),
    "enrich_two_sided": per_flight(),
    "enrich_hot": per_flight(),
    "enrich_zone_shift": per_flight(shift=True),
    "enrich_single": single(),
    "flat_features": flat(),
    "quality_counts": (
        "SELECT 'orders' AS dataset, count(*) AS rows, count(CASE WHEN o_totalprice > 250000 THEN 1 END)"
        " AS non_null_big, count(o_custkey) AS non_null_o_custkey, NULL::BIGINT AS non_null_l_shipdate FROM orders"
        " UNION ALL SELECT 'lineitem', count(*), NULL, NULL, count(l_shipdate) FROM lineitem"
        " UNION ALL SELECT 'customer', count(*), NULL, NULL, NULL FROM customer"
    ),
    "quality_exact": QUALITY_WHOLE,
    "quality_approx": quality_close(),
    "month_counts": "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1",
    "month_count_files": "SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n FROM lineitem GROUP BY 1",
    "capped_table_rows": (
        "SELECT o_orderstatus, count(*) AS n, (SELECT count(*) FROM orders) AS written FROM orders GROUP BY 1"
    ),
    "pipeline_month": per_flight(month="202401"),
    "pipeline_all": per_flight(),
    "pipeline_reports": job_reports(),
    "enrich_all_features": all_features(),
    "enrich_legacy": legacy(),
    "enrich_hot_instants": per_flight(fold=True),
    "enrich_in_reach": per_flight(),
    "flat_all_features": flat_all(),
    "measured_write": (
        "SELECT 'lineitem' AS dataset, count(*) AS rows, count(CASE WHEN l_shipdate > TIMESTAMP '1998-01-01' THEN 1 END) AS non_null_late,"
        " count(DISTINCT l_suppkey) AS suppliers, true AS close, epoch_us(min(l_shipdate)) AS first_us, epoch_us(max(l_shipdate)) AS last_us FROM lineitem"
    ),
    "month_tables": (
        "WITH t AS (SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%Y%m') AS month, o_totalprice + CASE WHEN strftime(o_orderdate, '%Y%m') ="
        " (SELECT max(strftime(o_orderdate, '%Y%m')) FROM orders) THEN 1 ELSE 0 END AS price FROM orders)"
        " SELECT 'catalog' AS read, o_orderkey, month, round(price, 2) AS price FROM t UNION ALL SELECT 'within', o_orderkey, month, round(price, 2) FROM t"
        " WHERE o_orderdate BETWEEN (SELECT min(o_orderdate) + INTERVAL 180 DAY FROM orders) AND (SELECT max(o_orderdate) - INTERVAL 180 DAY FROM orders)"
    ),
    "colocated_flights": CLEAN + (
        " SELECT OP_CARRIER_FL_NUM AS fl_num, ORIGIN_AIRPORT_ID AS airport, epoch_us(dep) AS dep_us FROM fc"
        " WHERE ORIGIN_AIRPORT_ID IN (SELECT AirportId FROM wc)"
    ),
    "month_sketches": "SELECT strftime(o_orderdate, '%Y') AS span, count(DISTINCT o_custkey) AS customers, true AS close FROM orders GROUP BY 1",
    "quarantined_lines": (
        "SELECT CASE WHEN o_orderkey % 40 > 1 THEN o_orderkey::VARCHAR END AS o_orderkey, CASE WHEN o_orderkey % 40 > 1 THEN o_orderstatus END AS o_orderstatus,"
        " CASE WHEN o_orderkey % 40 > 1 THEN o_orderpriority END AS o_orderpriority, CASE o_orderkey % 40 WHEN 0 THEN o_orderkey || ',' || o_orderstatus"
        " WHEN 1 THEN o_orderkey || ',' || o_orderstatus || ',' || o_orderpriority || ',more' END AS line FROM orders"
    ),
}
