"""DuckDB oracle: for each registered query, an independent SQL statement over
the driver's pre-registered tables. The derived views (fixtures) and the core
chain are shared CTE text; every statement is ``WITH <all CTEs> <select>``.

Arithmetic is written to give the same bits as the Spark plan: sums go
through DECIMAL and are cast to DOUBLE last, rounding is
``floor(x * 10^d + 0.5) / 10^d``, and expressions keep Spark's operand order.
"""

from __future__ import annotations

import math

from loadsplit.plans.queries import DAY, LOADED_BEFORE, LOADED_BEFORE_FILE, RANGE
from loadsplit.sources.fixtures import FIXED_CENTROIDS, SQL_VIEWS, VIEW_ORDER

FEATS = ("usage_kwh", "hour_sin", "hour_cos", "temp_c", "ac_proxy_int")
W24 = f"CAST({2 * math.pi / 24!r} AS DOUBLE)"


def r(x: str, digits: int) -> str:
    return f"(floor(({x}) * 1e{digits} + 0.5) / 1e{digits})"


def dsum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,6))) AS DOUBLE)"


def davg(x: str) -> str:
    return f"({dsum(x)} / count({x}))"


def fill(src: str, part: str = "", backward: bool = False, value: str = "temp_c", ts: str = "datetime") -> str:
    """Linear-in-time gap fill (W3 / W6) over ``src``."""
    pb = f"PARTITION BY {part} " if part else ""
    w1 = f"OVER ({pb}ORDER BY {ts} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    w2 = f"OVER ({pb}ORDER BY {ts} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    back = "WHEN _nt IS NOT NULL THEN _nv" if backward else ""
    return f"""
        SELECT * EXCLUDE (_pt, _pv, _nt, _nv, {value}),
               CASE WHEN {value} IS NOT NULL THEN {value}
                    WHEN _pt IS NOT NULL AND _nt IS NOT NULL
                      THEN (_nv - _pv) / CAST(date_diff('second', _pt, _nt) AS DOUBLE)
                           * CAST(date_diff('second', _pt, {ts}) AS DOUBLE) + _pv
                    WHEN _pt IS NOT NULL THEN _pv
                    {back}
               END AS {value}
        FROM (SELECT *,
                     last_value(CASE WHEN {value} IS NOT NULL THEN {ts} END IGNORE NULLS) {w1} AS _pt,
                     last_value({value} IGNORE NULLS) {w1} AS _pv,
                     first_value(CASE WHEN {value} IS NOT NULL THEN {ts} END IGNORE NULLS) {w2} AS _nt,
                     first_value({value} IGNORE NULLS) {w2} AS _nv
              FROM {src})"""


def bronze_sql(src: str) -> str:
    day = "CAST(try_strptime(USAGE_DATE, '%m/%d/%Y') AS DATE)"
    return f"""
        SELECT trim(regexp_replace(trim(ESIID), '^''+', '')) AS esiid,
               {day} AS usage_date,
               try_strptime(REVISION_DATE, '%m/%d/%Y %H:%M:%S') AS revision_date,
               trim(USAGE_START_TIME) AS interval_start,
               trim(USAGE_END_TIME) AS interval_end,
               try_strptime(CAST({day} AS VARCHAR) || ' ' || trim(USAGE_START_TIME), '%Y-%m-%d %H:%M')
                 AS interval_start_dt,
               CASE WHEN isfinite(TRY_CAST(USAGE_KWH AS DOUBLE)) THEN TRY_CAST(USAGE_KWH AS DOUBLE) END AS usage_kwh,
               ESTIMATED_ACTUAL AS estimated_actual,
               CONSUMPTION_SURPLUSGENERATION AS flow_direction,
               source_file
        FROM {src}"""


ROW_ERROR = """(
    (USAGE_DATE IS NOT NULL AND try_strptime(USAGE_DATE, '%m/%d/%Y') IS NULL)
 OR (REVISION_DATE IS NOT NULL AND try_strptime(REVISION_DATE, '%m/%d/%Y %H:%M:%S') IS NULL)
 OR (USAGE_START_TIME IS NOT NULL
     AND NOT coalesce(regexp_full_match(USAGE_DATE, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}')
                      AND regexp_full_match(trim(USAGE_START_TIME), '([01]?[0-9]|2[0-3]):[0-5]?[0-9]'), false)))"""


def cooling(t: str) -> str:
    return (f"CASE WHEN {t} < 22.0 THEN 0.0 WHEN {t} < 26.0 THEN ({t} - 22.0) / 4.0 * 0.8 "
            f"WHEN {t} < 32.0 THEN 0.8 + ({t} - 26.0) / 6.0 * 1.2 "
            f"WHEN {t} IS NOT NULL THEN least(2.0 + ({t} - 32.0) * 0.25, 3.5) END")


def _dist(row) -> str:
    terms = []
    for c, v in zip(FEATS, row[1:]):
        lit = f"CAST({float(v)!r} AS DOUBLE)"
        terms.append(f"(z_{c} - {lit}) * (z_{c} - {lit})")
    return " + ".join(terms)


def core(p: str, intervals: str) -> list[tuple[str, str]]:
    """silver -> daily -> features -> z -> scored -> mapping -> labeled ->
    gold -> summary -> bands, with CTE names prefixed by ``p``."""
    hs = r(f"sin(hour_of_day * {W24})", 6)
    hc = r(f"cos(hour_of_day * {W24})", 6)
    s1 = ", ".join(f"{dsum(c)} AS s1_{c}, "
                   f"CAST(sum(CAST({c} AS DECIMAL(18,6)) * CAST({c} AS DECIMAL(18,6))) AS DOUBLE) AS s2_{c}"
                   for c in FEATS)
    st = ", ".join(f"s1_{c} / n AS mean_{c}, sqrt(greatest(0.0, s2_{c} / n - (s1_{c} / n) * (s1_{c} / n))) AS std_{c}"
                   for c in FEATS)
    zc = ", ".join(r(f"CASE WHEN std_{c} > 0 THEN ({c} - mean_{c}) / std_{c} ELSE 0.0 END", 6) + f" AS z_{c}"
                   for c in FEATS)
    ds = ", ".join(f"{_dist(row)} AS d{row[0]}" for row in FIXED_CENTROIDS)
    ids = [row[0] for row in FIXED_CENTROIDS]
    pick = "CASE " + " ".join(f"WHEN d{i} = _m THEN {i}" for i in ids) + " ELSE -1 END"
    dcols = ", ".join(f"d{i}" for i in ids)
    means = ", ".join(f"{davg(c)} AS {c}" for c in FEATS)
    sums = (f"{r(dsum('estimated_kwh'), 4)} AS total_kwh, "
            + ", ".join(f"{r(dsum(f'CASE WHEN appliance = {chr(39)}{a}{chr(39)} THEN estimated_kwh ELSE 0.0 END'), 4)}"
                        f" AS {a}_kwh" for a in ("hvac", "washer", "dryer", "cooking", "baseline")))
    hot = "coalesce(temp_c > 23.0, false)"
    return [
        (f"{p}silver", f"""
            SELECT m.esiid, m.interval_start_dt, CAST(m.usage_kwh AS DOUBLE) AS usage_kwh,
                   CAST(hour(m.interval_start_dt) AS INTEGER) AS hour_of_day,
                   CAST(isodow(m.interval_start_dt) - 1 AS INTEGER) AS day_of_week,
                   isodow(m.interval_start_dt) >= 6 AS is_weekend,
                   hour(m.interval_start_dt) >= 6 AND hour(m.interval_start_dt) < 21 AS is_peak,
                   w.temp_c,
                   coalesce(w.temp_c > 23.0, false) AS ac_proxy
            FROM {intervals} m LEFT JOIN wdedup w ON date_trunc('hour', m.interval_start_dt) = w.datetime
            WHERE m.flow_direction = 'Consumption'"""),
        (f"{p}daily", f"""
            SELECT esiid, usage_date, total_kwh, peak_kwh, offpeak_kwh,
                   CASE WHEN total_kwh > 0 THEN peak_kwh / total_kwh END AS peak_ratio, max_interval_kwh
            FROM (SELECT esiid, CAST(interval_start_dt AS DATE) AS usage_date,
                         coalesce({dsum('usage_kwh')}, 0.0) AS total_kwh,
                         coalesce({dsum('CASE WHEN is_peak THEN usage_kwh END')}, 0.0) AS peak_kwh,
                         coalesce({dsum('CASE WHEN NOT is_peak THEN usage_kwh END')}, 0.0) AS offpeak_kwh,
                         max(usage_kwh) AS max_interval_kwh
                  FROM {p}silver GROUP BY 1, 2)"""),
        (f"{p}feat0", f"""
            SELECT *, temp_c AS temp_raw, {hs} AS hour_sin, {hc} AS hour_cos,
                   CAST(coalesce(ac_proxy, false) AS INTEGER) AS ac_proxy_int
            FROM {p}silver WHERE usage_kwh IS NOT NULL"""),
        (f"{p}feat", f"""
            SELECT * REPLACE (coalesce(temp_c, (SELECT {r(davg('temp_c'), 6)} FROM {p}feat0)) AS temp_c)
            FROM {p}feat0"""),
        (f"{p}zst", f"SELECT {st} FROM (SELECT count(*) AS n, {s1} FROM {p}feat)"),
        (f"{p}z", f"SELECT {p}feat.*, {zc} FROM {p}feat, {p}zst"),
        (f"{p}scored", f"""
            SELECT * EXCLUDE ({dcols}, _m), {pick} AS cluster, {r('sqrt(_m)', 6)} AS distance
            FROM (SELECT *, least({dcols}) AS _m FROM (SELECT *, {ds} FROM {p}z))"""),
        (f"{p}cent", f"SELECT cluster, {means} FROM {p}scored GROUP BY cluster"),
        (f"{p}c0", f"SELECT *, ac_proxy_int * temp_c AS hvac_score FROM {p}cent"),
        (f"{p}mb", f"SELECT cluster FROM {p}c0 ORDER BY usage_kwh, cluster LIMIT 1"),
        (f"{p}r1", f"SELECT * FROM {p}c0 WHERE cluster NOT IN (SELECT cluster FROM {p}mb)"),
        (f"{p}mh", f"SELECT cluster FROM {p}r1 ORDER BY hvac_score DESC, cluster LIMIT 1"),
        (f"{p}r2", f"SELECT * FROM {p}r1 WHERE cluster NOT IN (SELECT cluster FROM {p}mh)"),
        (f"{p}mc", f"SELECT cluster FROM {p}r2 ORDER BY hour_sin, cluster LIMIT 1"),
        (f"{p}r3", f"SELECT * FROM {p}r2 WHERE cluster NOT IN (SELECT cluster FROM {p}mc)"),
        (f"{p}mapping", f"""
            SELECT cluster, 'baseline' AS appliance FROM {p}mb
            UNION ALL SELECT cluster, 'hvac' FROM {p}mh
            UNION ALL SELECT cluster, 'cooking' FROM {p}mc
            UNION ALL SELECT cluster,
                   CASE WHEN row_number() OVER (ORDER BY usage_kwh, cluster) = 1 THEN 'washer' ELSE 'dryer' END
            FROM {p}r3"""),
        (f"{p}lab0", f"SELECT s.*, mp.appliance FROM {p}scored s LEFT JOIN {p}mapping mp USING (cluster)"),
        (f"{p}maxd", f"SELECT cluster, greatest(max(distance), 1e-9) AS max_distance FROM {p}scored GROUP BY 1"),
        (f"{p}labeled", f"""
            SELECT l.*, m.max_distance,
                   {r('CASE WHEN l.distance IS NOT NULL THEN greatest(0.3, 1.0 - l.distance / m.max_distance) END', 6)}
                     AS confidence
            FROM {p}lab0 l LEFT JOIN {p}maxd m USING (cluster)"""),
        (f"{p}gold", f"""
            SELECT esiid, CAST(interval_start_dt AS DATE) AS usage_date, appliance,
                   {dsum('usage_kwh')} AS estimated_kwh, {davg('confidence')} AS confidence
            FROM {p}labeled GROUP BY 1, 2, 3"""),
        (f"{p}dtemp", f"""
            SELECT CAST(interval_start_dt AS DATE) AS usage_date, {davg('temp_c')} AS temp_c
            FROM {p}silver GROUP BY 1"""),
        (f"{p}summary", f"""
            SELECT g.*, {r('t.temp_c', 2)} AS avg_temp_c
            FROM (SELECT usage_date, {sums} FROM {p}gold GROUP BY usage_date) g
            JOIN {p}dtemp t USING (usage_date)"""),
        (f"{p}dmean", f"""
            SELECT esiid, CAST(interval_start_dt AS DATE) AS _day, {davg('temp_c')} AS _day_temp
            FROM {p}silver GROUP BY 1, 2"""),
        (f"{p}filled", f"""
            SELECT s.* REPLACE (coalesce(s.temp_c, d._day_temp) AS temp_c)
            FROM {p}silver s LEFT JOIN {p}dmean d
              ON s.esiid = d.esiid AND CAST(s.interval_start_dt AS DATE) = d._day"""),
        (f"{p}braw", f"""
            SELECT esiid, interval_start_dt, usage_kwh, hour_of_day, temp_c,
                   CASE WHEN usage_kwh IS NOT NULL THEN least(usage_kwh, 0.15) END AS baseline,
                   CASE WHEN {hot} AND hour_of_day BETWEEN 10 AND 22
                          THEN greatest(0.0, usage_kwh * (temp_c - 23.0) / 15.0 * 0.6)
                        WHEN {hot} THEN greatest(0.0, usage_kwh * (temp_c - 23.0) / 15.0 * 0.2)
                        ELSE 0.0 END AS hvac,
                   CASE WHEN hour_of_day BETWEEN 6 AND 8 AND usage_kwh > 0.25
                          THEN greatest(0.0, usage_kwh * 0.35) ELSE 0.0 END AS morning,
                   CASE WHEN hour_of_day BETWEEN 18 AND 20 THEN greatest(0.0, usage_kwh * 0.4)
                        WHEN hour_of_day BETWEEN 12 AND 13 THEN greatest(0.0, usage_kwh * 0.25)
                        ELSE 0.0 END AS cooking,
                   CASE WHEN hour_of_day BETWEEN 8 AND 17 AND usage_kwh > 0.3
                          THEN greatest(0.0, usage_kwh * 0.2) ELSE 0.0 END AS washer,
                   CASE WHEN hour_of_day BETWEEN 9 AND 18 AND usage_kwh > 0.35
                          THEN greatest(0.0, usage_kwh * 0.25) ELSE 0.0 END AS dryer
            FROM {p}filled"""),
        (f"{p}bscale", f"""
            SELECT *, CASE WHEN (hvac + morning + cooking + washer + dryer) > greatest(0.0, usage_kwh - baseline)
                           THEN greatest(0.0, usage_kwh - baseline)
                                / greatest((hvac + morning + cooking + washer + dryer), 1e-9)
                           ELSE 1.0 END AS scale
            FROM {p}braw"""),
        (f"{p}bands0", f"""
            SELECT esiid, interval_start_dt, usage_kwh, hour_of_day, temp_c, baseline,
                   hvac * scale AS hvac, morning * scale AS morning, cooking * scale AS cooking,
                   washer * scale AS washer, dryer * scale AS dryer
            FROM {p}bscale"""),
        (f"{p}bands", f"""
            SELECT esiid, interval_start_dt, usage_kwh, hour_of_day, temp_c, baseline,
                   CASE WHEN usage_kwh IS NOT NULL THEN hvac END AS hvac,
                   CASE WHEN usage_kwh IS NOT NULL THEN morning END AS morning,
                   CASE WHEN usage_kwh IS NOT NULL THEN cooking END AS cooking,
                   CASE WHEN usage_kwh IS NOT NULL THEN washer END AS washer,
                   CASE WHEN usage_kwh IS NOT NULL THEN dryer END AS dryer,
                   CASE WHEN usage_kwh IS NOT NULL
                        THEN greatest(0.0, usage_kwh - (baseline + hvac + morning + cooking + washer + dryer)) END
                     AS other
            FROM {p}bands0"""),
    ]


def _weather_ctes() -> list[tuple[str, str]]:
    return [
        ("readings", """
            SELECT "DATE" AS reading_ts, HourlyDryBulbTemperature AS temp_c FROM station_view
            WHERE "DATE" IS NOT NULL AND HourlyDryBulbTemperature IS NOT NULL"""),
        ("hourly", """
            SELECT date_trunc('hour', reading_ts) AS datetime,
                   arg_max(temp_c, {'t': reading_ts, 'v': temp_c}) AS temp_c
            FROM readings GROUP BY 1"""),
        ("spine", """
            SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS datetime
            FROM (SELECT min(datetime) AS lo, max(datetime) AS hi FROM hourly)"""),
        ("gapped", "SELECT s.datetime, h.temp_c FROM spine s LEFT JOIN hourly h ON s.datetime = h.datetime"),
        ("interp", fill("gapped")),
        ("weather_view", "SELECT datetime, round_even(temp_c * 10, 0) / 10 AS temp_c FROM interp"),
        ("wdedup", """
            SELECT date_trunc('hour', datetime) AS datetime,
                   arg_min(temp_c, {'t': datetime, 'v': temp_c}) AS temp_c
            FROM weather_view GROUP BY 1"""),
    ]


def _ingest_ctes() -> list[tuple[str, str]]:
    return [
        ("bronze_clean", bronze_sql("raw_meter_view")),
        ("bronze_dirty", bronze_sql("dirty_raw_view")),
        ("bad_files", f"SELECT DISTINCT source_file FROM dirty_raw_view WHERE {ROW_ERROR}"),
        ("files", "SELECT source_file, count(*) AS n_rows FROM file_view GROUP BY 1"),
        ("loaded_files", f"SELECT * FROM files WHERE source_file < '{LOADED_BEFORE_FILE}'"),
        ("pk", """
            SELECT source_file, esiid, interval_start_dt, count(*) AS n,
                   count(*) FILTER (WHERE usage_kwh IS NULL) AS n_null,
                   count(*) FILTER (WHERE usage_kwh < 0) AS n_neg
            FROM bronze_dirty GROUP BY 1, 2, 3"""),
        ("fc", """
            SELECT source_file, CAST(sum(n) AS BIGINT) AS n_intervals, CAST(sum(n_null) AS BIGINT) AS null_kwh,
                   CAST(sum(n_neg) AS BIGINT) AS negative_kwh, CAST(sum(n - 1) AS BIGINT) AS duplicate_intervals
            FROM pk GROUP BY 1"""),
    ]


def _all_ctes() -> list[tuple[str, str]]:
    ctes = [(name, SQL_VIEWS[name]) for name in VIEW_ORDER]
    ctes += _weather_ctes()
    ctes += _ingest_ctes()
    ctes += core("", "meter_view")
    ctes += core("b_", "bronze_clean")
    return ctes


def with_all(select: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in _all_ctes())
    sel = select.lstrip()
    if sel[:5].upper() == "WITH ":
        return f"WITH {body},\n{sel[5:]}"
    return f"WITH {body}\n{sel}"


def _calendar(expr: str, name: str) -> str:
    return f"SELECT esiid, interval_start_dt, {expr} AS {name} FROM meter_view"


def _band(name: str) -> str:
    return f"SELECT esiid, interval_start_dt, usage_kwh, {name} FROM bands"


def _union(src: str, keys: str, cols: list[tuple[str, str]], name: str = "appliance", value: str = "kwh") -> str:
    return " UNION ALL ".join(f"SELECT {keys}, '{label}' AS {name}, {col} AS {value} FROM {src}"
                              for label, col in cols)


_STATUS = f"""
    (SELECT s.*, coalesce(l.loaded, false) AS already_loaded
     FROM (SELECT source_file, count(*) AS n_rows, bool_or({ROW_ERROR}) AS has_error
           FROM dirty_raw_view GROUP BY 1) s
     LEFT JOIN (SELECT DISTINCT source_file, true AS loaded FROM loaded_files) l USING (source_file))"""

BANDS = ["baseline", "hvac", "washer", "dryer", "cooking", "morning", "other"]
APPS = ["hvac", "washer", "dryer", "cooking", "baseline"]

SELECTS: dict[str, str] = {
    # 2.1
    "clean_esiid": "SELECT source_file, ESIID AS raw_esiid, trim(regexp_replace(trim(ESIID), '^''+', '')) AS esiid "
                   "FROM dirty_raw_view",
    "trim_times": "SELECT source_file, trim(USAGE_START_TIME) AS interval_start, trim(USAGE_END_TIME) AS interval_end "
                  "FROM raw_meter_view",
    "parse_usage_date": "SELECT source_file, USAGE_DATE AS raw_usage_date, "
                        "CAST(try_strptime(USAGE_DATE, '%m/%d/%Y') AS DATE) AS usage_date, "
                        "(USAGE_DATE IS NOT NULL AND try_strptime(USAGE_DATE, '%m/%d/%Y') IS NULL) AS bad_date "
                        "FROM dirty_raw_view",
    "parse_revision_ts": "SELECT source_file, REVISION_DATE AS raw_revision_date, "
                         "try_strptime(REVISION_DATE, '%m/%d/%Y %H:%M:%S') AS revision_date FROM raw_meter_view",
    "build_interval_start": "SELECT source_file, usage_date, interval_start, interval_start_dt FROM bronze_clean",
    "coerce_kwh": "SELECT source_file, USAGE_KWH AS raw_kwh, CASE WHEN regexp_full_match(USAGE_KWH, "
                  "'[+-]?[0-9]*\\.?[0-9]+([eE][+-]?[0-9]+)?') THEN CAST(USAGE_KWH AS DOUBLE) END AS usage_kwh "
                  "FROM dirty_raw_view",
    "to_bronze": "SELECT * FROM bronze_clean",
    "read_station_readings": "SELECT * FROM readings",
    "filter_flow": "SELECT esiid, interval_start_dt, usage_kwh, flow_direction FROM bronze_clean "
                   "WHERE flow_direction = 'Consumption'",
    "new_files_only": "SELECT * FROM files WHERE source_file NOT IN (SELECT source_file FROM loaded_files)",
    "quarantine_bad_files": "SELECT * FROM dirty_raw_view WHERE source_file NOT IN (SELECT source_file FROM bad_files)",
    "ingest_report": f"""
        SELECT CAST(coalesce(sum(CASE WHEN NOT already_loaded AND NOT has_error THEN n_rows END), 0) AS BIGINT)
                 AS rows_loaded,
               count(*) FILTER (WHERE NOT already_loaded AND NOT has_error) AS files_loaded,
               count(*) FILTER (WHERE already_loaded) AS files_skipped,
               count(*) FILTER (WHERE NOT already_loaded AND has_error) AS files_in_error
        FROM {_STATUS}""",
    # 2.2
    "check_interval_count": "SELECT source_file, count(*) AS n_intervals FROM bronze_dirty GROUP BY 1 "
                            "HAVING count(*) != 96",
    "check_null_kwh": "SELECT source_file, count(*) FILTER (WHERE usage_kwh IS NULL) AS null_kwh FROM bronze_dirty "
                      "GROUP BY 1 HAVING count(*) FILTER (WHERE usage_kwh IS NULL) > 0",
    "check_negative_kwh": "SELECT source_file, count(*) FILTER (WHERE usage_kwh < 0) AS negative_kwh "
                          "FROM bronze_dirty GROUP BY 1 HAVING count(*) FILTER (WHERE usage_kwh < 0) > 0",
    "check_duplicates": "SELECT source_file, duplicate_intervals FROM fc WHERE duplicate_intervals > 0",
    "quality_report": """
        SELECT *, concat_ws('; ',
            CASE WHEN n_intervals != 96 THEN 'file holds ' || CAST(n_intervals AS VARCHAR) || ' rows instead of 96' END,
            CASE WHEN null_kwh > 0 THEN 'kWh missing in ' || CAST(null_kwh AS VARCHAR) || ' rows' END,
            CASE WHEN negative_kwh > 0 THEN 'kWh below zero in ' || CAST(negative_kwh AS VARCHAR) || ' rows' END,
            CASE WHEN duplicate_intervals > 0 THEN CAST(duplicate_intervals AS VARCHAR) || ' rows repeat a meter and slot' END)
              AS issues
        FROM fc""",
    "missing_weather_count": "SELECT count(*) AS n_intervals, count(*) FILTER (WHERE temp_c IS NULL) AS missing_temp "
                             "FROM silver",
    "reconcile_totals": f"""
        SELECT coalesce(g.esiid, d.esiid) AS esiid, coalesce(g.usage_date, d.usage_date) AS usage_date,
               g.attributed_kwh, d.total_kwh AS silver_kwh,
               {r('coalesce(g.attributed_kwh, 0.0) - coalesce(d.total_kwh, 0.0)', 6)} AS diff_kwh
        FROM (SELECT esiid, usage_date, {dsum('estimated_kwh')} AS attributed_kwh FROM gold GROUP BY 1, 2) g
        FULL OUTER JOIN daily d ON g.esiid = d.esiid AND g.usage_date = d.usage_date""",
    "hvac_temperature_response": f"""
        WITH dt AS (SELECT esiid, CAST(interval_start_dt AS DATE) AS usage_date, {davg('temp_c')} AS avg_temp_c
                    FROM silver GROUP BY 1, 2),
             hv AS (SELECT esiid, usage_date,
                           {dsum("CASE WHEN appliance = 'hvac' THEN estimated_kwh ELSE 0.0 END")} AS hvac_kwh
                    FROM gold GROUP BY 1, 2),
             dd AS (SELECT * FROM dt JOIN hv USING (esiid, usage_date) WHERE avg_temp_c IS NOT NULL),
             bk AS (SELECT floor(avg_temp_c / 2.0) * 2.0 AS temp_bucket, count(*) AS n_days,
                           {r(davg('hvac_kwh'), 6)} AS mean_hvac_kwh
                    FROM dd GROUP BY 1)
        SELECT *, {r('mean_hvac_kwh - lag(mean_hvac_kwh) OVER (ORDER BY temp_bucket)', 6)} AS delta_kwh FROM bk""",
    "table_stats": "SELECT count(*) AS n_rows, count(DISTINCT CAST(interval_start_dt AS DATE)) AS n_days, "
                   "count(DISTINCT esiid) AS n_meters FROM silver",
    "weather_stats": "SELECT count(*) AS n_hours, min(temp_c) AS min_temp_c, max(temp_c) AS max_temp_c, "
                     "min(datetime) AS first_hour, max(datetime) AS last_hour FROM weather_view",
    "summary_stats": "SELECT count(*) AS n_days, min(avg_temp_c) AS min_avg_temp_c, "
                     "max(avg_temp_c) AS max_avg_temp_c FROM summary",
    "daily_kwh_range": f"""
        SELECT count(*) AS n_days, min(day_kwh) AS min_day_kwh, max(day_kwh) AS max_day_kwh,
               {r(davg('day_kwh'), 6)} AS avg_day_kwh
        FROM (SELECT usage_date, {dsum('usage_kwh')} AS day_kwh FROM meter_view GROUP BY 1)""",
    # 2.3
    "last_of_hour": "SELECT * FROM hourly",
    "hourly_spine": "SELECT * FROM gapped",
    "interpolate_linear": "SELECT * FROM interp",
    "round_half_even": "SELECT reading_ts, temp_c, round_even(temp_c * 10, 0) / 10 AS temp_c_1dp FROM readings",
    "dedupe_hour": "SELECT date_trunc('hour', reading_ts) AS datetime, "
                   "arg_min(temp_c, {'t': reading_ts, 'v': temp_c}) AS temp_c FROM readings GROUP BY 1",
    "daily_hour_grid": """
        WITH onh AS (SELECT datetime, temp_c FROM hourly WHERE minute(datetime) = 0 AND second(datetime) = 0),
             days AS (SELECT DISTINCT CAST(datetime AS DATE) AS usage_date FROM hourly),
             grid AS (SELECT usage_date, make_timestamp(year(usage_date), month(usage_date), day(usage_date),
                                                         h, 0, 0) AS datetime
                      FROM (SELECT usage_date, unnest(generate_series(0, 23)) AS h FROM days)),
             joined AS (SELECT g.usage_date, g.datetime, o.temp_c FROM grid g LEFT JOIN onh o USING (datetime))
        """ + fill("joined", part="usage_date", backward=True),
    "cooling_load_kw": f"SELECT datetime, temp_c, {cooling('temp_c')} AS cooling_kw FROM weather_view",
    "expected_cooling_kwh": f"""
        SELECT esiid, interval_start_dt, temp_c,
               ({cooling('temp_c')}) * CASE WHEN hour_of_day < 7 OR hour_of_day >= 23 THEN 0.3 ELSE 1.0 END * 0.25
                 AS expected_cooling_kwh
        FROM silver""",
    "celsius_to_fahrenheit": "SELECT datetime, temp_c, temp_c * 9 / 5 + 32 AS temp_f FROM weather_view",
    # 2.4
    "hour_of_day": _calendar("CAST(hour(interval_start_dt) AS INTEGER)", "hour_of_day"),
    "day_of_week": _calendar("CAST(isodow(interval_start_dt) - 1 AS INTEGER)", "day_of_week"),
    "is_weekend": _calendar("isodow(interval_start_dt) >= 6", "is_weekend"),
    "is_peak": _calendar("hour(interval_start_dt) >= 6 AND hour(interval_start_dt) < 21", "is_peak"),
    "hour_floor": _calendar("date_trunc('hour', interval_start_dt)", "hour_dt"),
    "join_weather": """
        SELECT m.esiid, m.interval_start_dt, date_trunc('hour', m.interval_start_dt) AS hour_dt, w.temp_c
        FROM meter_view m LEFT JOIN wdedup w ON date_trunc('hour', m.interval_start_dt) = w.datetime
        WHERE m.flow_direction = 'Consumption'""",
    "ac_proxy": "SELECT esiid, interval_start_dt, temp_c, ac_proxy FROM silver",
    "interval_features": "SELECT * FROM silver",
    "daily_features": "SELECT * FROM daily",
    "peak_ratio": "SELECT esiid, usage_date, peak_kwh, total_kwh, peak_ratio FROM daily",
    "append_new_dates": f"""
        SELECT d.* FROM daily d
        WHERE NOT EXISTS (SELECT 1 FROM daily t WHERE t.usage_date < DATE '{LOADED_BEFORE}'
                          AND t.esiid = d.esiid AND t.usage_date = d.usage_date)""",
    # 2.5
    "cyclical_hour": f"SELECT esiid, interval_start_dt, hour_of_day, {r(f'sin(hour_of_day * {W24})', 6)} AS hour_sin, "
                     f"{r(f'cos(hour_of_day * {W24})', 6)} AS hour_cos FROM silver",
    "ac_proxy_int": "SELECT esiid, interval_start_dt, ac_proxy, CAST(coalesce(ac_proxy, false) AS INTEGER) "
                    "AS ac_proxy_int FROM silver",
    "impute_mean": "SELECT esiid, interval_start_dt, temp_raw, temp_c FROM feat",
    "standardize": "SELECT esiid, interval_start_dt, " + ", ".join(f"z_{c}" for c in FEATS) + " FROM z",
    "fit_clusters": "SELECT 5::BIGINT AS n_clusters, 0.0::DOUBLE AS centroid_off, count(*) AS n_rows, 0::BIGINT AS rows_nearer_elsewhere FROM z",
    "assign_cluster": "SELECT esiid, interval_start_dt, cluster, distance FROM scored",
    "distance_to_centroid": "SELECT esiid, interval_start_dt, cluster, distance FROM scored",
    "centroids_original_units": "SELECT * FROM cent",
    "map_clusters": "SELECT * FROM mapping",
    "label_appliance": "SELECT esiid, interval_start_dt, cluster, appliance FROM lab0",
    "max_distance_per_cluster": "SELECT esiid, interval_start_dt, cluster, distance, max_distance "
                                "FROM scored JOIN maxd USING (cluster)",
    "confidence": "SELECT esiid, interval_start_dt, appliance, distance, confidence FROM labeled",
    "estimate_daily": "SELECT * FROM gold",
    "cluster_diagnostics": f"""
        SELECT cluster, appliance, count(*) AS n_intervals, {r(davg('usage_kwh'), 6)} AS mean_kwh,
               {r(davg('hour_of_day'), 6)} AS mean_hour, {r(davg('temp_raw'), 6)} AS mean_temp_c,
               {r(davg('ac_proxy_int') + ' * 100', 6)} AS ac_pct
        FROM labeled GROUP BY 1, 2""",
    "appliance_share": f"""
        SELECT appliance, {r('avg_kwh', 6)} AS avg_kwh,
               {r(f"avg_kwh / (SELECT {davg('total_kwh')} FROM daily) * 100", 6)} AS share_pct
        FROM (SELECT appliance, {davg('estimated_kwh')} AS avg_kwh FROM gold GROUP BY 1)""",
    "mean_confidence_by_appliance": f"SELECT appliance, {r(davg('confidence'), 6)} AS mean_confidence "
                                    f"FROM gold GROUP BY 1",
    "first_day_estimates": "SELECT * FROM gold WHERE usage_date = (SELECT min(usage_date) FROM gold)",
    "model_metrics": f"""
        WITH per AS (SELECT appliance, {r(davg('estimated_kwh'), 6)} AS avg_kwh FROM gold GROUP BY 1)
        SELECT appliance, {r('avg_kwh', 3)} AS avg_kwh,
               {r(f"avg_kwh / (SELECT {dsum('avg_kwh')} FROM per) * 100", 1)} AS pct,
               (SELECT {r('CAST(sum(CAST(distance AS DECIMAL(18,6)) * CAST(distance AS DECIMAL(18,6))) AS DOUBLE)', 3)}
                FROM scored) AS training_cost
        FROM per""",
    "persist_model": "SELECT * FROM gold",
    # 2.6
    "appliance_profile": f"""
        SELECT g.usage_date, g.appliance, {r('g.estimated_kwh', 4)} AS estimated_kwh,
               {r('g.estimated_kwh / nullif(t._day_total, 0)', 6)} AS pct_of_daily_total
        FROM gold g JOIN (SELECT usage_date, {dsum('estimated_kwh')} AS _day_total FROM gold GROUP BY 1) t
          USING (usage_date)""",
    "daily_temperature": "SELECT * FROM dtemp",
    "daily_summary": "SELECT * FROM summary",
    "daily_summary_with_confidence": "SELECT usage_date, "
        + f"{r(dsum('estimated_kwh'), 2)} AS total_kwh, "
        + ", ".join(f"{r(dsum(f'CASE WHEN appliance = {chr(39)}{a}{chr(39)} THEN estimated_kwh ELSE 0.0 END'), 2)}"
                    f" AS {a}_kwh" for a in APPS)
        + f", {r(davg('confidence'), 3)} AS avg_confidence FROM gold GROUP BY usage_date",
    "write_table": "SELECT * FROM gold",
    "reset_table": "SELECT * FROM daily",
    "write_csv": "SELECT * FROM summary",
    "format_meter_export": "SELECT * FROM raw_meter_view",
    "expand_runs_to_intervals": f"""
        SELECT run_date, CAST(slot AS INTEGER) AS slot, {dsum('kw')} * 0.25 AS kwh
        FROM (SELECT run_date, unnest(generate_series(start_slot, least(start_slot + n_slots, 96) - 1)) AS slot, kw
              FROM runs_view WHERE n_slots > 0 AND start_slot >= 0 AND start_slot < 96)
        GROUP BY 1, 2""",
    # 2.7
    "day_intervals": f"""
        SELECT esiid, interval_start_dt, usage_kwh, hour_of_day, temp_c FROM silver
        WHERE interval_start_dt >= TIMESTAMP '{DAY}' AND interval_start_dt < TIMESTAMP '{DAY}' + INTERVAL 1 DAY""",
    "date_bounds": "SELECT min(usage_date) AS date_min, max(usage_date) AS date_max FROM summary",
    "filter_dates": f"SELECT * FROM summary WHERE usage_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'",
    "fill_day_mean_temp": "SELECT esiid, interval_start_dt, temp_c FROM filled",
    "band_baseline": _band("baseline"),
    "band_hvac": _band("hvac"),
    "band_morning": _band("morning"),
    "band_cooking": _band("cooking"),
    "band_washer": _band("washer"),
    "band_dryer": _band("dryer"),
    "scale_to_headroom": "SELECT esiid, interval_start_dt, usage_kwh, scale FROM bscale",
    "band_other": _band("other"),
    "load_bands": "SELECT * FROM bands",
    "bands_long": _union("bands", "esiid, interval_start_dt", [(b, b) for b in BANDS]),
    "breakdown_long": _union("summary", "usage_date", [(a, f"{a}_kwh") for a in APPS]),
    "average_attribution": f"""
        WITH per AS (SELECT appliance, {r(davg('kwh'), 6)} AS avg_kwh
                     FROM ({_union('summary', 'usage_date', [(a, f'{a}_kwh') for a in APPS])}) GROUP BY 1)
        SELECT appliance, {r('avg_kwh', 2)} AS avg_kwh_day,
               {r(f"avg_kwh / (SELECT {dsum('avg_kwh')} FROM per) * 100", 1)} AS share_pct
        FROM per""",
    "total_metrics": f"""
        SELECT {r(davg('total_kwh'), 6)} AS avg_kwh_day, max(total_kwh) AS max_kwh_day,
               min(total_kwh) AS min_kwh_day, count(*) AS n_days
        FROM summary WHERE usage_date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'""",
    "hvac_vs_temperature": "SELECT usage_date, avg_temp_c * 9 / 5 + 32 AS avg_temp_display, hvac_kwh, total_kwh "
                           "FROM summary",
    "days_above_threshold": "SELECT count(*) FILTER (WHERE avg_temp_c * 9 / 5 + 32 > 73.4) AS days_above, "
                            "count(*) AS n_days FROM summary",
    "day_header": f"""
        SELECT CAST(interval_start_dt AS DATE) AS usage_date, {dsum('usage_kwh')} AS day_total_kwh,
               {r(davg('temp_c'), 6)} AS avg_temp_display
        FROM silver GROUP BY 1""",
    # 2.8
    "build_weather": "SELECT * FROM weather_view",
    "run_ingest": "SELECT * FROM bronze_dirty WHERE source_file NOT IN (SELECT source_file FROM bad_files)",
    "ingest_incremental": "SELECT * FROM bronze_dirty WHERE source_file NOT IN (SELECT source_file FROM bad_files)",
    "run_features": "SELECT * FROM b_daily",
    "run_export": "SELECT * FROM b_summary",
    "run_disaggregate": "SELECT esiid, usage_date, total_kwh AS attributed_kwh, true AS appliances_ok, "
                        "true AS confidence_ok FROM b_daily",
    "run_all": "SELECT usage_date, total_kwh, avg_temp_c FROM b_summary",
    "run_incremental": "SELECT d.*, d.total_kwh AS attributed_kwh, s.total_kwh AS published_total_kwh, "
                       "s.avg_temp_c AS published_avg_temp_c, 'v2' AS model_version, true AS rerun_wrote_nothing "
                       "FROM b_daily d JOIN b_summary s USING (usage_date)",
    "read_meter_csv": "SELECT * FROM raw_meter_view",
    "reload_replaced_files": "SELECT *, (SELECT count(DISTINCT source_file) FROM raw_meter_view "
                             "WHERE source_file < '2024/01/20240111.csv') AS reloaded FROM bronze_clean",
    "read_snapshot": f"""
        WITH early AS (SELECT esiid, usage_date, coalesce({dsum('usage_kwh')}, 0.0) AS total_kwh, max(usage_kwh) AS max_interval_kwh
                      FROM bronze_clean WHERE flow_direction = 'Consumption' AND estimated_actual <> 'E' GROUP BY 1, 2),
             day AS (SELECT usage_date, {r(dsum('total_kwh'), 4)} AS then_kwh FROM early GROUP BY 1)
        SELECT t.*, then_kwh, s.total_kwh AS now_kwh FROM early t JOIN day USING (usage_date) JOIN b_summary s USING (usage_date)""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_all(sel) for name, sel in SELECTS.items()}
