"""The same queries as SQL for DuckDB.

Fixed values: the output names of the two views, of the scoring rows and of the trailing
features, and the joins the views are defined by.
"""

from __future__ import annotations

_TS = "l_shipdate + to_hours(CAST(l_orderkey % 24 AS INTEGER))"

_FOOTFALL = f"""footfall AS (
  SELECT l_linestatus AS city, l_returnflag AS footfall_location, {_TS} AS "timestamp",
         CAST(sum(l_quantity) AS BIGINT) AS total_footfall
  FROM lineitem GROUP BY ALL)"""


def _measures(nullable: bool) -> str:
    rain, snow = "round(l_discount * 100)", "round(l_tax * 100)"
    if nullable:
        rain = f"CASE WHEN l_suppkey % 3 <> 0 THEN {rain} END"
        snow = f"CASE WHEN l_suppkey % 3 <> 1 THEN {snow} END"
    return f"""CAST(sum(l_suppkey) AS BIGINT) AS pressure, CAST(sum(l_partkey) AS BIGINT) AS humidity,
         CAST(max(l_linenumber) AS BIGINT) AS clouds, CAST(count(*) AS DOUBLE) AS wind,
         sum({rain}) AS rain, sum({snow}) AS snow"""




def _weather(date: str = "date") -> str:
    return f"""weather AS (
  SELECT * REPLACE ({date} AS date) FROM (
    SELECT l_linestatus AS city, {_TS} AS date, CAST(sum(l_quantity) AS DOUBLE) / 4 AS temp, {_measures(True)}
    FROM lineitem GROUP BY 1, 2))"""


def _forecasts(date: str = "date", condition: str = "") -> str:
    return f"""forecasts AS (
  SELECT * REPLACE ({date} AS date) FROM (
    SELECT l_linestatus AS city, CAST(l_shipdate AS DATE) AS date,
           min(l_quantity) AS min_temp, max(l_quantity) AS max_temp, {_measures(False)}
    FROM lineitem {condition} GROUP BY 1, 2))"""


def _holidays(date: str = "date") -> str:
    return f"""holidays AS (
  SELECT DISTINCT {date} AS date, name FROM (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS name FROM orders))"""


# All rows of the tables; and, for joins and scoring, inputs in which some hours and days are off the counted ones.
_ALL_WEATHER, _ALL_FORECASTS, _ALL_HOLIDAYS = _weather(), _forecasts(), _holidays()
_WEATHER = _weather("CASE WHEN day(date) = 13 THEN date + INTERVAL 30 MINUTE ELSE date END")
_FORECASTS = _forecasts("CASE WHEN day(date) = 7 THEN date + 365 ELSE date END", "WHERE l_shipdate >= DATE '2001-06-01' AND l_shipdate < DATE '2001-07-01'")
_HOLIDAYS = _holidays("CASE WHEN day(date) = 1 THEN date ELSE date + 36525 END")

ROLLING = """hourly AS (
  SELECT *, row_number() OVER (PARTITION BY footfall_location, city ORDER BY "timestamp", total_footfall, temp, pressure,
      humidity, clouds, wind, rain NULLS FIRST, snow NULLS FIRST) AS place
  FROM (SELECT f.*, w.* EXCLUDE (city, date) FROM footfall f JOIN weather w ON f."timestamp" = w.date AND f.city = w.city)),
rolling AS (
  SELECT * EXCLUDE (place),
    coalesce(avg(total_footfall) OVER (PARTITION BY footfall_location, city, hour("timestamp") ORDER BY place
      ROWS BETWEEN 90 PRECEDING AND 1 PRECEDING), total_footfall) AS footfall_90_day_average,
    coalesce(sum(coalesce(snow, 0)) OVER w24, snow, 0) AS snow_24_hour_total,
    coalesce(sum(coalesce(rain, 0)) OVER w24, rain, 0) AS rain_24_hour_total
  FROM hourly
  WINDOW w24 AS (PARTITION BY footfall_location, city ORDER BY place ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))"""


def _round(value: str, digits: int = 0) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(28, 6)), {digits}) AS DOUBLE)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_MEANS = {
    "temp": "w.temp", "pressure": "w.pressure", "humidity": "w.humidity", "clouds": "w.clouds", "wind": "w.wind",
    "current_rain": "coalesce(w.rain, 0)", "rain_24_hour": "coalesce(r.rain_24_hour_total, 0)",
    "current_snow": "coalesce(w.snow, 0)", "snow_24_hour": "coalesce(r.snow_24_hour_total, 0)",
}

_VIEW_FROM = """FROM footfall f
  LEFT JOIN rolling r ON f.city = r.city AND f.footfall_location = r.footfall_location AND f."timestamp" = r."timestamp"
  LEFT JOIN holidays h ON CAST(f."timestamp" AS DATE) = h.date
  JOIN weather w ON f."timestamp" = w.date AND f.city = w.city"""

# The two views over tables footfall, weather and holidays, with the self-join spelled out.
REPORTING = f"""SELECT f.city,
  f.footfall_location, CAST(f."timestamp" AS DATE) AS date, year(f."timestamp") AS year,
  month(f."timestamp") AS month, CAST(strftime(f."timestamp", '%U') AS BIGINT) AS week, h.name AS bank_holiday,
  CAST(sum(f.total_footfall) AS BIGINT) AS total_footfall,
  {_round("sum(r.footfall_90_day_average)")} AS rolling_footfall,
  {", ".join(f"{_round(f'avg({v})', 2)} AS {n}" for n, v in _MEANS.items())}
{_VIEW_FROM} GROUP BY ALL"""
TRAINING = f"""SELECT f.city, f.footfall_location,
  strftime(f."timestamp", '%A') AS weekday, strftime(f."timestamp", '%b') AS month,
  CASE WHEN h.name IS NOT NULL THEN 1 ELSE 0 END AS bank_holiday,
  CAST(sum(f.total_footfall) AS BIGINT) AS total_footfall,
  {_round("sum(r.footfall_90_day_average)")} AS rolling_footfall,
  {", ".join(f"avg({v}) AS {n}" for n, v in _MEANS.items())}
{_VIEW_FROM}
WHERE f."timestamp" NOT BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-31' GROUP BY ALL"""

# ---- raw count files, as the events they were made of ---------------------------

_EVENT_COUNT = "CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)"
_H, _HH = "CAST(hour(ts) AS VARCHAR)", "lpad(CAST(hour(ts) AS VARCHAR), 2, '0')"
_DMY = "strftime(ts, '%d/%m/%y')"

# layout: (sorted column names, date text, hour text, count text)
_LAYOUTS = {
    0: ("Date, Hour, LocationName, Month, TotalCount, Unnamed: 5", "strftime(ts, '%d-%b-%y')", _H, _EVENT_COUNT),
    1: ("Date, Hour, LocationName, TotalCount, WeekDay", _DMY, f"{_H} || ':00'", _EVENT_COUNT),
    2: ("Date, Hour, InCount, LocationName, OutCount", "strftime(ts, '%Y-%m-%d')", _HH, _EVENT_COUNT),
    3: ("Date, Hour, InCount, Location, ReportCount", "strftime(ts, '%d/%m/%Y')", f"{_H} || '.0'", _EVENT_COUNT),
    4: ("Date, Hour, LocationName, Note, ReportCount", "strftime(ts, '%-d/%-m/%y')", _H, _EVENT_COUNT),
    5: ("Date, Hour, LocationName, ReportCount", _DMY, "CAST(NULL AS VARCHAR)", _EVENT_COUNT),
    6: ("Count, Date, Hour, LocationName, Unnamed: 4", _DMY, f"{_HH} || ':00'", f"{_EVENT_COUNT} || '.0'"),
}


def _by_layout(place: int) -> str:
    cases = " ".join(
        f"WHEN {i} THEN '{l[0]}'" if place == 0 else f"WHEN {i} THEN {l[place]}" for i, l in _LAYOUTS.items()
    )
    return f"CASE event_id % 7 {cases} END"


_SOURCE = "'counts-' || (event_id % 7) || CASE WHEN day(ts) <= 15 THEN 'a' ELSE 'b' END || '.csv'"

_CLEANED = f"""cleaned AS (
  SELECT 'Leeds' AS city, event_type AS footfall_location, date_trunc('hour', ts) AS "timestamp",
         CAST(floor(value) AS BIGINT) AS total_footfall, {_SOURCE} AS source_file
  FROM events
  WHERE event_id % 7 <> 5 AND NOT (event_id % 7 = 4 AND event_id % 5 = 0))"""

_SUMMARY_ALL = f"""summary AS (
  SELECT {_SOURCE} AS filename, {_by_layout(0)} AS columns_str, count(*) AS rows FROM events GROUP BY ALL)"""
_SUMMARY = f"""summary AS (
  SELECT {_SOURCE} AS filename,
         list_aggregate(list_filter(string_split({_by_layout(0)}, ', '), lambda c: NOT contains(c, 'Unnamed')),
                        'string_agg', ', ') AS columns_str,
         count(*) AS rows
  FROM events GROUP BY ALL)"""
_COLUMNS_CNT = "CAST(len(string_split(columns_str, ', ')) AS BIGINT)"

_YORK = """SELECT 'York' AS city, event_type AS footfall_location, date_trunc('hour', ts) AS "timestamp",
  CASE WHEN CAST(floor(value) AS BIGINT) % 4 <> 0 THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS total_footfall
FROM events"""

_KELVIN = "CAST(273.15 AS DOUBLE)"
_FLAT_FORECAST = _with(_ALL_FORECASTS) + f"""SELECT city, date, min_temp + {_KELVIN} - {_KELVIN} AS min_temp,
  max_temp + {_KELVIN} - {_KELVIN} AS max_temp, pressure, humidity, clouds, wind, rain, snow FROM forecasts"""
# The service's rounding of a temperature that went through kelvin.
_FLAT_TEMP = f"round_even(temp + {_KELVIN} - {_KELVIN}, 1)"
_FLAT_HOLIDAYS = _with(_ALL_HOLIDAYS) + "SELECT date, name FROM holidays WHERE name[1] <> '2'"


def _slice(start: str, end: str) -> str:
    return f"""slice AS (
  SELECT * REPLACE (temp + 1 AS temp) FROM weather
  WHERE date >= TIMESTAMP '{start}' AND date < TIMESTAMP '{end}' AND hour(date) % 3 <> 2)"""


_MERGED = """SELECT * FROM slice
UNION ALL SELECT w.* FROM weather w
WHERE NOT EXISTS (SELECT 1 FROM slice s WHERE s.city = w.city AND s.date = w.date)"""

ORACLE: dict[str, str] = {
    "csv_layout_read": f"""SELECT {_by_layout(0)} AS columns_str, {_SOURCE} AS source_file, event_type AS location_text,
  {_by_layout(1)} AS date_text, {_by_layout(2)} AS hour_text, {_by_layout(3)} AS count_text FROM events""",
    "catalogue_filter": """WITH files AS (
  SELECT p_partkey // 50 AS doc_id, lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS resource_id, p_partkey % 4 AS kind,
         replace(p_brand, '#', '%20') || '%20' || p_type || '.csv' AS address_name, p_partkey FROM part),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, address_name ORDER BY resource_id DESC) AS place FROM files
  WHERE kind <> 0 AND address_name NOT IN ('Brand%207%20ECONOMY.csv', 'Brand%2012%20SMALL.csv'))
SELECT CAST(doc_id AS BIGINT) AS doc_id, replace(address_name, '%20', '_') AS file_name, resource_id,
  'https://data.example/files/' || p_partkey || '/' || address_name AS url
FROM kept WHERE place = 1""",
    "forecast_flatten": _FLAT_FORECAST,
    "json_landing_roundtrip": _FLAT_FORECAST,
    "forecast_load": _FLAT_FORECAST,
    "history_flatten": _with(_ALL_WEATHER) + f"""SELECT city, date, {_FLAT_TEMP} AS temp, pressure, humidity, clouds, wind,
  coalesce(rain, 0) AS rain, coalesce(snow, 0) AS snow FROM weather""",
    "holiday_flatten": _FLAT_HOLIDAYS,
    "holiday_load": _FLAT_HOLIDAYS,
    "footfall_complete": _with(_FOOTFALL) + """SELECT DISTINCT * FROM footfall WHERE hour("timestamp") < 16
UNION ALL SELECT DISTINCT * FROM footfall WHERE hour("timestamp") >= 8""",
    "typed_sink_roundtrip": _with(_FOOTFALL) + "SELECT * FROM footfall",
    "csv_sink_roundtrip": _with(_FOOTFALL) + """SELECT *, footfall_location || '.csv' AS source_file FROM footfall
UNION ALL SELECT *, 'run' FROM footfall""",
    "history_slice_replace": _with(_ALL_WEATHER, _slice("2001-05-20", "2001-06-01")) + """SELECT * FROM slice
UNION ALL SELECT * FROM weather WHERE CAST(date AS DATE) NOT IN (SELECT CAST(date AS DATE) FROM slice)""",
    "history_refresh": _with(_ALL_WEATHER, _slice("2001-05-20", "2001-06-01")) + _MERGED,
    "history_refresh_range": _with(
        _ALL_WEATHER,
        _slice("2001-05-15", "2001-06-01").replace(
            "(temp + 1 AS temp)",
            f"({_FLAT_TEMP.replace('temp', '(temp + 1)')} AS temp, coalesce(rain, 0) AS rain, coalesce(snow, 0) AS snow)",
        ),
    ) + _MERGED,
    "preferred_column": """SELECT event_id, CASE WHEN user_id > 20 THEN user_id END AS total_footfall,
  event_type AS footfall_location FROM events""",
    "clean_leeds": _with(_CLEANED) + "SELECT * FROM cleaned",
    "clean_leeds_union": _with(_CLEANED) + "SELECT DISTINCT * EXCLUDE (source_file) FROM cleaned",
    "leeds_load": _with(_CLEANED) + """SELECT DISTINCT * EXCLUDE (source_file) FROM cleaned
WHERE source_file <> 'counts-3b.csv'""",
    "leeds_catalogue_load": _with(_CLEANED) + """SELECT DISTINCT * EXCLUDE (source_file) FROM cleaned
WHERE source_file NOT IN ('counts-3b.csv', 'counts-0a.csv', 'counts-6b.csv')""",
    "leeds_load_quarantine": f"""WITH rows AS (
  SELECT event_id % 8 AS fault, event_type AS location, date_trunc('hour', ts) AS moment, CAST(floor(value) AS BIGINT) AS n,
    strftime(ts, '%Y-%m-%d') AS day, {_H} AS hour, {_EVENT_COUNT} AS count FROM events)
SELECT DISTINCT 'Leeds' AS city, location AS footfall_location, moment AS "timestamp", n AS total_footfall,
  NULL::VARCHAR AS source_file, NULL::VARCHAR AS reason, NULL::VARCHAR AS record
FROM rows WHERE fault > 3
UNION ALL SELECT NULL, NULL, NULL, NULL, 'broken.csv',
  CASE fault WHEN 0 THEN 'cells' WHEN 1 THEN 'hour' WHEN 2 THEN 'date' ELSE 'count' END,
  CASE WHEN fault = 0 THEN CAST(to_json({{'LocationName': location, 'Date': day, 'Hour': hour, 'Count': count,
      '_malformed': location || ',' || day || ',' || hour || ',' || count || ',more'}}) AS VARCHAR)
    ELSE CAST(to_json({{'LocationName': location, 'Date': CASE WHEN fault = 2 THEN 'soon' ELSE day END,
      'Hour': CASE WHEN fault = 1 THEN '25' ELSE hour END, 'Count': CASE WHEN fault = 3 THEN count || '.5' ELSE count END}}) AS VARCHAR) END
FROM rows WHERE fault <= 3""",
    "clean_york": _YORK,
    "york_load": _YORK,
    "hour_text": """SELECT event_id,
  CASE WHEN user_id % 6 < 4 THEN strftime(ts, '%H') || ':00:00' END AS hour,
  CASE WHEN user_id % 6 < 4 THEN strftime(ts, '%H') || ':00:00' ELSE '00:00:00' END AS hour_or_midnight FROM events""",
    "date_text": """SELECT event_id, CASE WHEN user_id % 8 <= 4 THEN date_trunc('day', ts)
  WHEN user_id % 8 = 5 THEN date_trunc('minute', ts) WHEN user_id % 8 = 6 THEN date_trunc('second', ts)
  END AS moment FROM events""",
    "calendar_parts": """SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month,
  CAST(strftime(o_orderdate, '%U') AS BIGINT) AS week, strftime(o_orderdate, '%A') AS weekday,
  strftime(o_orderdate, '%b') AS month_name, strftime(o_orderdate, '%Y%m%d') AS day_suffix,
  CAST(epoch_ms(o_orderkey * 7200000) AS DATE) AS epoch_day FROM orders""",
    "hourly_weather_join": _with(_FOOTFALL, _WEATHER) + """SELECT f.*, w.* EXCLUDE (city, date)
FROM footfall f JOIN weather w ON f."timestamp" = w.date AND f.city = w.city""",
    "rolling_selfjoin": _with(_FOOTFALL, _WEATHER, ROLLING) + """SELECT f.*, r.footfall_90_day_average,
  r.snow_24_hour_total, r.rain_24_hour_total
FROM footfall f LEFT JOIN rolling r
  ON f.city = r.city AND f.footfall_location = r.footfall_location AND f."timestamp" = r."timestamp\"""",
    "holiday_join": _with(_FOOTFALL, _HOLIDAYS) + """SELECT f.*, CAST(f."timestamp" AS DATE) AS date,
  h.name AS holiday_name FROM footfall f LEFT JOIN holidays h ON CAST(f."timestamp" AS DATE) = h.date""",
    "rolling_same_hour_avg": _with(_FOOTFALL, _WEATHER, ROLLING) + """SELECT city, footfall_location, "timestamp",
  total_footfall, footfall_90_day_average FROM rolling""",
    "rolling_weather_24": _with(_FOOTFALL, _WEATHER, ROLLING) + """SELECT city, footfall_location, "timestamp",
  snow_24_hour_total, rain_24_hour_total FROM rolling""",
    "footfall_complete_weather": _with(_FOOTFALL, _WEATHER, _HOLIDAYS, ROLLING) + REPORTING,
    "model_input_daily": _with(_FOOTFALL, _WEATHER, _HOLIDAYS, ROLLING) + TRAINING,
    "daily_totals": _with(_FOOTFALL) + """SELECT city, footfall_location, CAST("timestamp" AS DATE) AS date,
  CAST(sum(total_footfall) AS BIGINT) AS total_footfall FROM footfall GROUP BY ALL""",
}

_LEVEL = f"""last_days AS (
  SELECT city, footfall_location, CAST("timestamp" AS DATE) AS date, sum(total_footfall) AS total_footfall
  FROM footfall WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2001-06-01' - 90 AND DATE '2001-06-01' - 1
  GROUP BY ALL),
level AS (
  SELECT city, footfall_location, {_round("avg(total_footfall)")} AS rolling_footfall FROM last_days GROUP BY ALL)"""

_CARRY = """carry AS (
  SELECT f.date, f.city, f.rain, f.snow,
    coalesce(lag(f.rain) OVER (PARTITION BY f.city ORDER BY f.date), sum(w.rain)) AS rain_24_hour,
    coalesce(lag(f.snow) OVER (PARTITION BY f.city ORDER BY f.date), sum(w.snow)) AS snow_24_hour
  FROM forecasts f LEFT JOIN weather w ON CAST(w.date AS DATE) = f.date - 1 AND f.city = w.city
  GROUP BY f.date, f.city, f.rain, f.snow)"""

ORACLE |= {
    "trailing_level": _with(_FOOTFALL, _LEVEL) + "SELECT * FROM level",
    "weather_carry": _with(_FORECASTS, _WEATHER, _CARRY) + "SELECT * FROM carry",
    "scoring_input": _with(_FOOTFALL, _WEATHER, _FORECASTS, _HOLIDAYS, _LEVEL, _CARRY) + f"""SELECT l.city,
  l.footfall_location, f.date, strftime(f.date, '%A') AS weekday, strftime(f.date, '%b') AS month,
  CASE WHEN h.name IS NOT NULL THEN 1 ELSE 0 END AS bank_holiday, l.rolling_footfall,
  {_round("(f.min_temp + f.max_temp) / 2", 2)} AS temp, f.pressure, f.humidity, f.clouds, f.wind,
  f.rain AS current_rain, {_round("c.rain_24_hour", 2)} AS rain_24_hour, f.snow AS current_snow, c.snow_24_hour
FROM level l LEFT JOIN forecasts f ON l.city = f.city
  LEFT JOIN carry c ON c.date = f.date AND c.city = f.city
  LEFT JOIN holidays h ON f.date = h.date""",
    "file_summary": _with(_SUMMARY_ALL) + f"""SELECT filename, columns_str, {_COLUMNS_CNT} AS columns_cnt, rows
FROM summary""",
    "layout_profile": _with(_SUMMARY) + """SELECT columns_str, row_number() OVER (ORDER BY columns_str) - 1 AS column_group,
  count(*) AS total_files, CAST(sum(rows) AS BIGINT) AS total_rows FROM summary GROUP BY columns_str""",
    "layout_sample": _with(_SUMMARY) + f"""SELECT columns_str, filename, {_COLUMNS_CNT} AS columns_cnt, rows FROM summary
QUALIFY row_number() OVER (PARTITION BY columns_str ORDER BY filename) = 1""",
    "layout_preview": f"""WITH rows AS (
  SELECT {_by_layout(0)} AS columns_str, {_SOURCE} AS source_file, event_type AS location_text,
    {_by_layout(1)} AS date_text, {_by_layout(2)} AS hour_text, {_by_layout(3)} AS count_text FROM events),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY columns_str, source_file
    ORDER BY location_text, date_text, hour_text NULLS LAST, count_text) AS place FROM rows
  QUALIFY source_file = min(source_file) OVER (PARTITION BY columns_str))
SELECT * FROM placed WHERE place <= 5""",
    "hourly_profile": _with(_FOOTFALL) + """SELECT hour("timestamp") AS hour, avg(total_footfall) AS mean_footfall
FROM footfall GROUP BY 1""",
    "quality_duplicates": _with(_CLEANED) + """SELECT
  (SELECT count(*) FROM cleaned) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (source_file) FROM cleaned))
  AS total_duplicates""",
    "quality_missing": _with(_ALL_WEATHER) + "SELECT *, city + date + temp + pressure + humidity + clouds + wind + rain + snow"
    " AS total_missing FROM (SELECT "
    + ", ".join(
        f"count(*) - count({c}) AS {c}"
        for c in ["city", "date", "temp", "pressure", "humidity", "clouds", "wind", "rain", "snow"]
    )
    + " FROM weather)",
    "quality_reconcile": _with(_CLEANED) + """SELECT
  (SELECT count(*) FROM events) AS raw_rows,
  (SELECT count(*) FROM events WHERE event_id % 7 = 5) AS daily_totals,
  (SELECT count(*) FROM events WHERE event_id % 7 = 4 AND event_id % 5 = 0) AS null_rows,
  (SELECT count(*) FROM cleaned) - (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (source_file) FROM cleaned))
    AS duplicates,
  (SELECT count(*) FROM (SELECT DISTINCT * EXCLUDE (source_file) FROM cleaned)) AS cleaned_rows,
  CAST(0 AS BIGINT) AS unexplained""",
}

_SCORED = ORACLE["scoring_input"]
_TRAINING_ROWS = ORACLE["model_input_daily"]
_CATEGORIES = ["city", "footfall_location", "weekday", "month"]
_NUMBERS = ["bank_holiday", "rolling_footfall", *_MEANS]

# A forest is no SQL; what any forest must do, and what it is fitted on, is.
ORACLE |= {
    "train_model": f"SELECT *, true AS prediction_is_whole, true AS prediction_in_range FROM ({_TRAINING_ROWS})",
    "predict": f"SELECT *, true AS prediction_is_whole, true AS prediction_in_range FROM ({_SCORED})",
    "model_roundtrip": f"SELECT *, true AS same FROM ({_SCORED})",
    "model_encoding": f"WITH rows AS ({_TRAINING_ROWS}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, avg(total_footfall) AS mean, count(*) AS n FROM rows GROUP BY {c}" for c in _CATEGORIES
    ),
    "model_cross_means": f"""WITH rows AS (SELECT *, CAST('0x' || substr(md5(concat_ws('|',
      {", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in [*_CATEGORIES, "bank_holiday"])})), 1, 4) AS INTEGER) % 5 AS fold FROM ({_TRAINING_ROWS})),
    own AS ({" UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value, fold, sum(total_footfall) AS s, count(*) AS n FROM rows GROUP BY {c}, fold" for c in _CATEGORIES)}),
    folds AS (SELECT fold, sum(total_footfall) AS s, count(*) AS n FROM rows GROUP BY fold),
    rest AS (SELECT a.fold, sum(b.s) / sum(b.n) AS mean FROM folds a JOIN folds b ON a.fold <> b.fold GROUP BY a.fold)
    SELECT "column", value, o.fold, round((sum(s) OVER w - s + 5 * r.mean) / (sum(n) OVER w - n + 5), 6) AS mean
    FROM own o JOIN rest r ON o.fold = r.fold WINDOW w AS (PARTITION BY "column", value)""",
    "model_filled": f"WITH rows AS ({_TRAINING_ROWS}) "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean FROM rows" for c in _NUMBERS),
}
