"""DuckDB twins of the registered queries (the correctness oracle).

Each statement recomputes the expected result directly from the driver
tables (``nation``, ``orders``, ``events``, ``documents``) with plain SQL:
range joins, window functions and GROUP BY instead of the engine's plans, so
agreement is an independent check.  Fixture views are shared CTEs.
"""

from __future__ import annotations

from flightlake.sources.airports import BUSY_AIRPORT_LIST

# ------------------------------------------------------------------ shared CTEs
_AIRPORTS = """
airports_v AS (
  SELECT CAST(n_nationkey AS INTEGER) AS airport_id, n_name AS name,
         'City ' || n_nationkey || ', R' || n_regionkey AS city,
         'Country ' || n_regionkey AS country,
         CAST(n_nationkey AS VARCHAR) AS iata, 'ICAO' || n_nationkey AS icao,
         CAST((n_nationkey * 37) % 121 - 60 AS DOUBLE) AS latitude,
         CAST((n_nationkey * 53) % 301 - 150 AS DOUBLE) AS longitude,
         CAST(n_nationkey * 10 AS INTEGER) AS altitude,
         '0' AS timezone, 'U' AS dst, 'Etc/UTC' AS tz
  FROM nation
  UNION ALL
  SELECT CAST(n_nationkey + 1000 AS INTEGER), n_name || '_DUP',
         'City ' || n_nationkey || ', R' || n_regionkey, 'Country ' || n_regionkey,
         CAST(n_nationkey AS VARCHAR), 'ICAO' || n_nationkey,
         CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), CAST(n_nationkey * 10 AS INTEGER),
         '0', 'U', 'Etc/UTC'
  FROM nation WHERE n_nationkey IN (3, 7)
),
uniq AS (
  SELECT iata AS code, round(min(latitude), 4) AS lat, round(min(longitude), 4) AS lon
  FROM airports_v WHERE iata IS NOT NULL
  GROUP BY iata
  HAVING count(*) = 1 AND count(latitude) = 1 AND count(longitude) = 1
)"""

_FLIGHTS = """
fl AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority,
         1705363200 + (o_orderkey % 240) * 3600 AS dep_e,
         1705363200 + (o_orderkey % 240) * 3600 + ((o_orderkey % 11) - 1) * 3600 AS arr_e,
         o_custkey % 27 AS dep_code, (o_orderkey * 7) % 25 AS arr_code
  FROM orders
),
flights AS (
  SELECT k, 'FL' || k AS flight_iata,
         CASE o_orderstatus WHEN 'O' THEN 'scheduled' WHEN 'F' THEN 'landed' END AS flight_status,
         CAST(dep_code AS VARCHAR) AS departure_iata, CAST(arr_code AS VARCHAR) AS arrival_iata,
         'Airport ' || dep_code AS departure_airport, 'Airport ' || arr_code AS arrival_airport,
         dep_e AS departure_epoch, arr_e AS arrival_epoch
  FROM fl
)"""

_LEGS = """
legs_all AS (
  SELECT f.*, d.lat AS departure_lat, d.lon AS departure_lon,
         a.lat AS arrival_lat, a.lon AS arrival_lon
  FROM flights f JOIN uniq d ON f.departure_iata = d.code JOIN uniq a ON f.arrival_iata = a.code
),
hav AS (
  SELECT *, least(
      sin((radians(arrival_lat) - radians(departure_lat)) / 2)
        * sin((radians(arrival_lat) - radians(departure_lat)) / 2)
      + cos(radians(departure_lat)) * cos(radians(arrival_lat))
        * (sin((radians(arrival_lon) - radians(departure_lon)) / 2)
           * sin((radians(arrival_lon) - radians(departure_lon)) / 2)),
      CAST(1 AS DOUBLE)) AS hav_a
  FROM legs_all
),
legs_m AS (
  SELECT * EXCLUDE (hav_a),
         round(CAST(6371.0 AS DOUBLE) * (2 * atan2(sqrt(hav_a), sqrt(1 - hav_a))), 4) AS airport_distance
  FROM hav
),
legs AS (SELECT * FROM legs_m WHERE flight_status = 'scheduled')"""


def _points(src: str, name: str, segments: str = "3") -> str:
    """Path points of ``src`` legs (``segments`` is SQL for the segment count)."""
    return f"""
{name}_n AS (SELECT *, CAST({segments} AS INTEGER) AS nseg FROM {src}),
{name}_f AS (
  SELECT l.*, CAST(r.i AS INTEGER) AS idx,
         CASE WHEN r.i = l.nseg THEN CAST(1 AS DOUBLE)
              ELSE CAST(r.i AS DOUBLE) * (CAST(1 AS DOUBLE) / CAST(l.nseg AS DOUBLE)) END AS frac
  FROM {name}_n l, LATERAL range(0, l.nseg + 1) r(i)
),
{name} AS (
  SELECT *,
    round_even(degrees(radians(departure_lat) + frac * (radians(arrival_lat) - radians(departure_lat)))
               * CAST(100000 AS DOUBLE), 0) / CAST(100000 AS DOUBLE) AS lat,
    round_even(degrees(radians(departure_lon) + frac * (radians(arrival_lon) - radians(departure_lon)))
               * CAST(100000 AS DOUBLE), 0) / CAST(100000 AS DOUBLE) AS lon,
    CAST(trunc(CAST(departure_epoch AS DOUBLE) + frac * CAST(arrival_epoch - departure_epoch AS DOUBLE)
               + CAST(0.5 AS DOUBLE)) AS BIGINT) AS t
  FROM {name}_f
)"""


_WEATHER = """
wv AS (
  SELECT CAST(least(floor(((event_id * 13) % 121 - 60 + 90) / 10), 17) * 36
              + floor(((event_id * 29) % 301 - 150 + 180) / 10) % 36 AS BIGINT) AS cell,
         e - (e % 3600) AS ts_hour,
         round(sum(value), 2) AS precipitation, round(max(value), 2) AS visibility,
         round(min(value), 2) AS snow_depth
  FROM (SELECT event_id, value, CAST(floor(epoch(ts)) AS BIGINT) AS e FROM events)
  GROUP BY 1, 2
)"""

_KEYS = """
wp AS (
  SELECT flight_iata, idx, lat, lon, t, least(departure_epoch, arrival_epoch) AS leg_start,
         CAST(least(floor((lat + 90) / 10), 17) * 36 + floor((lon + 180) / 10) % 36 AS BIGINT) AS cell
  FROM pts
),
wk AS (
  SELECT *, leg_start - (leg_start % 86400) AS day0,
         leg_start - (leg_start % 86400)
           + (CAST(trunc(CAST(t - leg_start AS DOUBLE) / CAST(3600 AS DOUBLE)) AS BIGINT)) * 3600 AS fts
  FROM wp
),
keys AS (SELECT DISTINCT cell, day0, fts FROM wk),
sc AS (
  SELECT k.*, w.precipitation AS s_precipitation, w.visibility AS s_visibility,
         w.snow_depth AS s_snow_depth
  FROM keys k LEFT JOIN wv w ON w.cell = k.cell AND w.ts_hour = k.fts
),
hc AS (
  SELECT k.cell, k.day0, k.fts, count(h.cell) AS n_hist,
    max(k.s_precipitation) AS s_precipitation,
    count(*) FILTER (WHERE h.cell IS NOT NULL AND (h.precipitation IS NULL OR isnan(h.precipitation))) AS bad_precipitation,
    count(*) FILTER (WHERE NOT (h.precipitation IS NULL OR isnan(h.precipitation)) AND h.precipitation < k.s_precipitation) AS lt_precipitation,
    count(*) FILTER (WHERE NOT (h.precipitation IS NULL OR isnan(h.precipitation)) AND h.precipitation <= k.s_precipitation) AS le_precipitation,
    max(k.s_visibility) AS s_visibility,
    count(*) FILTER (WHERE h.cell IS NOT NULL AND (h.visibility IS NULL OR isnan(h.visibility))) AS bad_visibility,
    count(*) FILTER (WHERE NOT (h.visibility IS NULL OR isnan(h.visibility)) AND h.visibility < k.s_visibility) AS lt_visibility,
    count(*) FILTER (WHERE NOT (h.visibility IS NULL OR isnan(h.visibility)) AND h.visibility <= k.s_visibility) AS le_visibility,
    max(k.s_snow_depth) AS s_snow_depth,
    count(*) FILTER (WHERE h.cell IS NOT NULL AND (h.snow_depth IS NULL OR isnan(h.snow_depth))) AS bad_snow_depth,
    count(*) FILTER (WHERE NOT (h.snow_depth IS NULL OR isnan(h.snow_depth)) AND h.snow_depth < k.s_snow_depth) AS lt_snow_depth,
    count(*) FILTER (WHERE NOT (h.snow_depth IS NULL OR isnan(h.snow_depth)) AND h.snow_depth <= k.s_snow_depth) AS le_snow_depth
  FROM sc k LEFT JOIN wv h
    ON h.cell = k.cell AND h.ts_hour >= k.day0 - 90 * 86400 AND h.ts_hour < k.day0 + 86400
  GROUP BY k.cell, k.day0, k.fts
),
pc AS (
  SELECT *,
    CASE WHEN s_precipitation IS NULL OR isnan(s_precipitation) OR bad_precipitation > 0 OR n_hist = 0
         THEN CAST(-1 AS DOUBLE)
         ELSE (lt_precipitation + le_precipitation + CASE WHEN lt_precipitation < le_precipitation THEN 1 ELSE 0 END)
              * (CAST(50 AS DOUBLE) / CAST(n_hist AS DOUBLE)) END AS pct_precipitation,
    CASE WHEN s_visibility IS NULL OR isnan(s_visibility) OR bad_visibility > 0 OR n_hist = 0
         THEN CAST(-1 AS DOUBLE)
         ELSE (lt_visibility + le_visibility + CASE WHEN lt_visibility < le_visibility THEN 1 ELSE 0 END)
              * (CAST(50 AS DOUBLE) / CAST(n_hist AS DOUBLE)) END AS pct_visibility,
    CASE WHEN s_snow_depth IS NULL OR isnan(s_snow_depth) OR bad_snow_depth > 0 OR n_hist = 0
         THEN CAST(-1 AS DOUBLE)
         ELSE (lt_snow_depth + le_snow_depth + CASE WHEN lt_snow_depth < le_snow_depth THEN 1 ELSE 0 END)
              * (CAST(50 AS DOUBLE) / CAST(n_hist AS DOUBLE)) END AS pct_snow_depth
  FROM hc
),
kr AS (
  SELECT *, round_even(greatest(pct_precipitation, pct_visibility, pct_snow_depth) * CAST(10 AS DOUBLE), 0)
            / CAST(10 AS DOUBLE) AS risk
  FROM pc
),
scored AS (
  SELECT w.flight_iata, w.idx, w.lat, w.lon, w.t, coalesce(r.risk, CAST(-1 AS DOUBLE)) AS risk
  FROM wk w LEFT JOIN kr r ON r.cell = w.cell AND r.day0 = w.day0 AND r.fts = w.fts
),
banded AS (
  SELECT *, CASE WHEN risk >= 90 THEN 'red' WHEN risk >= 75 THEN 'orange' ELSE 'white' END AS band
  FROM scored
)"""

_BOARD = """
board_v AS (
  SELECT o_orderkey AS pos,
         CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE 'F' || o_orderkey END AS id,
         'CS' || (o_custkey % 200) AS callsign, o_orderpriority AS airline,
         CAST(o_custkey % 25 AS VARCHAR) AS airport_code,
         'Origin ' || ((o_orderkey * 7) % 25) AS origin,
         'Dest ' || (o_custkey % 25) AS destination,
         CASE WHEN o_orderkey % 2 = 0 THEN 'departures' ELSE 'arrivals' END AS flight_type,
         1705363200 + (o_orderkey % 240) * 3600 AS sched_dep,
         1705363200 + (o_orderkey % 240) * 3600 + ((o_orderkey % 11) + 1) * 3600 AS sched_arr
  FROM orders
)"""

_TRAILS = """
trails_v AS (
  SELECT CAST(user_id AS VARCHAR) AS flight_id, event_id,
         CAST(floor(epoch(ts)) AS BIGINT) AS time,
         CAST((event_id * 13) % 121 - 60 AS DOUBLE) AS lat,
         CAST((event_id * 29) % 301 - 150 AS DOUBLE) AS lng,
         CAST(event_id % 400 * 100 AS INTEGER) AS alt,
         CAST(event_id % 500 AS INTEGER) AS spd,
         CAST(event_id % 360 AS INTEGER) AS hd
  FROM events
),
trail_rn AS (
  SELECT *, row_number() OVER (PARTITION BY flight_id ORDER BY time DESC, event_id DESC) - 1 AS rn
  FROM trails_v
),
sampled AS (SELECT * FROM trail_rn WHERE rn % 10 = 0)"""

_ISO = """
iso AS (
  SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS e,
    CASE event_id % 3
      WHEN 0 THEN strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')
      WHEN 1 THEN strftime(make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00'
      ELSE strftime(make_timestamp((CAST(floor(epoch(ts)) AS BIGINT) + 19800) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+05:30'
    END AS iso_text
  FROM events
)"""


def _iso_sql(epoch: str, variant: str) -> str:
    return (f"CASE {variant} WHEN 0 THEN strftime(make_timestamp(({epoch}) * 1000000), '%Y-%m-%d %H:%M:%S') "
            f"WHEN 1 THEN strftime(make_timestamp(({epoch}) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' "
            f"ELSE strftime(make_timestamp(({epoch} + 19800) * 1000000), '%Y-%m-%dT%H:%M:%S') || '+05:30' END")


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


_TXT = "strftime(make_timestamp(({e}) * 1000000), '%Y-%m-%d %H:%M:%S')"


def _txt(e: str) -> str:
    return _TXT.format(e=e)


def _pad(k: str) -> str:
    return (f"CASE {k} % 4 WHEN 0 THEN '  ' WHEN 1 THEN chr(9) "
            f"WHEN 2 THEN ' ' || chr(160) || ' ' ELSE ' ' END")


_PLANNED = _with(_AIRPORTS, _FLIGHTS, _LEGS, _points("legs", "pts"), _WEATHER, _KEYS)

ORACLE_SQL: dict[str, str] = {}

# ------------------------------------------------------------------ sources and sinks
ORACLE_SQL["scan_nested_schedule"] = _with(_FLIGHTS) + f"""
SELECT (k // 100) * 100 AS page_offset,
       count(*) OVER (PARTITION BY k // 100) AS page_count,
       strftime(make_timestamp(departure_epoch * 1000000), '%Y-%m-%d') AS flight_date,
       flight_status, departure_iata,
       {_iso_sql('departure_epoch', 'k % 3')} AS departure_scheduled,
       arrival_iata,
       {_iso_sql('arrival_epoch', 'k % 3')} AS arrival_scheduled,
       flight_iata, o.o_orderpriority AS airline_name
FROM flights JOIN orders o ON o.o_orderkey = flights.k
"""

ORACLE_SQL["scan_airports"] = _with(_AIRPORTS) + "SELECT * FROM airports_v"

ORACLE_SQL["board_union"] = _with(_BOARD) + """
SELECT airport_code, flight_type, id AS flight_id, callsign, airline, origin,
       sched_dep, sched_arr
FROM board_v
"""

ORACLE_SQL["board_newest_pull"] = _with(_BOARD) + """
SELECT airport_code, flight_type, id AS flight_id, sched_arr,
       CASE WHEN CAST(airport_code AS BIGINT) % 2 = 0 THEN '2' ELSE '1' END AS pull
FROM board_v
"""

ORACLE_SQL["flight_detail_flat"] = _with(_FLIGHTS) + """
SELECT 'F' || k AS id, 'CS' || (o.o_custkey % 200) AS callsign,
       'Model ' || (k % 7) AS aircraft_modelname, 'M' || (k % 7) AS aircraft_modelcode,
       o.o_orderpriority AS airline_name,
       'Airport ' || departure_iata AS origin_airport_name,
       departure_iata AS origin_airport_iata,
       CASE WHEN CAST(departure_iata AS BIGINT) < 25
            THEN CAST((CAST(departure_iata AS BIGINT) * 37) % 121 - 60 AS DOUBLE) END AS origin_airport_lat,
       CASE WHEN CAST(departure_iata AS BIGINT) < 25
            THEN CAST((CAST(departure_iata AS BIGINT) * 53) % 301 - 150 AS DOUBLE) END AS origin_airport_lon,
       CASE WHEN CAST(departure_iata AS BIGINT) < 25
            THEN CAST(CAST(departure_iata AS BIGINT) * 10 AS DOUBLE) END AS origin_airport_alt,
       CASE WHEN CAST(departure_iata AS BIGINT) < 25
            THEN 'Country ' || (CAST(departure_iata AS BIGINT) % 5) END AS origin_airport_country,
       CASE WHEN k % 13 <> 0 THEN 'Airport ' || arrival_iata END AS destination_airport_name,
       CASE WHEN k % 13 <> 0 THEN arrival_iata END AS destination_airport_iata,
       CASE WHEN k % 13 <> 0
            THEN CAST((CAST(arrival_iata AS BIGINT) * 37) % 121 - 60 AS DOUBLE) END AS destination_airport_lat,
       CASE WHEN k % 13 <> 0
            THEN CAST((CAST(arrival_iata AS BIGINT) * 53) % 301 - 150 AS DOUBLE) END AS destination_airport_lon,
       CASE WHEN k % 13 <> 0
            THEN CAST(CAST(arrival_iata AS BIGINT) * 10 AS DOUBLE) END AS destination_airport_alt,
       CASE WHEN k % 13 <> 0
            THEN 'Country ' || (CAST(arrival_iata AS BIGINT) % 5) END AS destination_airport_country,
       departure_epoch AS scheduled_departure_time, arrival_epoch AS scheduled_arrival_time,
       departure_epoch + (k % 9) * 60 AS real_departure_time,
       arrival_epoch + (k % 9) * 60 AS real_arrival_time,
       departure_epoch + 60 AS estimated_departure_time,
       arrival_epoch + 120 AS estimated_arrival_time,
       CAST(arrival_epoch - departure_epoch AS VARCHAR) AS historical_flighttime,
       CAST((k % 9) * 60 AS VARCHAR) AS historical_delay
FROM flights JOIN orders o ON o.o_orderkey = flights.k
"""

ORACLE_SQL["trail_rows"] = _with(_TRAILS) + """
SELECT flight_id, lat, lng, alt, spd, time, hd FROM trails_v
"""

ORACLE_SQL["weather_unpivot_hours"] = _with(_WEATHER) + """
SELECT cell, ts_hour,
       CAST(row_number() OVER (PARTITION BY cell, ts_hour // 86400 ORDER BY ts_hour) - 1 AS INTEGER) AS hour_index,
       precipitation, visibility, snow_depth
FROM wv
"""

ORACLE_SQL["path_json_roundtrip"] = _PLANNED + "SELECT flight_iata, idx, lat, lon, t FROM pts"

ORACLE_SQL["latest_nonempty_snapshot"] = """
SELECT event_type AS source,
       arg_max(event_id, (epoch_us(ts), event_id)) AS snapshot_id,
       max(epoch_us(ts)) AS ingest_us,
       CAST(1 AS INTEGER) AS n_records
FROM events WHERE event_id % 3 <> 0
GROUP BY event_type
"""

ORACLE_SQL["busy_airport_semi"] = _with(_AIRPORTS, _BOARD) + """
SELECT pos, airport_code FROM board_v
WHERE airport_code IN (SELECT iata FROM airports_v WHERE CAST(iata AS INTEGER) < 10)
"""

_BUSY = ", ".join(f"'{code}'" for _, code in BUSY_AIRPORT_LIST)
ORACLE_SQL["busy_list_boards"] = _with(_BOARD) + f"""
SELECT pos, list_extract([{_BUSY}], CAST(pos % 60 AS INTEGER) + 1) AS airport_code FROM board_v WHERE pos % 60 < 50
"""

ORACLE_SQL["trail_to_json"] = _with(_TRAILS) + """
SELECT flight_id, rn,
       CAST(to_json(struct_pack(lat := lat, lng := lng, alt := alt, spd := spd, time := time, hd := hd)) AS VARCHAR) AS fix_json
FROM sampled
"""

# ------------------------------------------------------------------ projections
ORACLE_SQL["flatten_by_map"] = _with(_FLIGHTS) + f"""
SELECT strftime(make_timestamp(departure_epoch * 1000000), '%Y-%m-%d') AS flight_date,
       flight_status,
       'Airport' || {_pad('k')} || departure_iata || ' ' AS departure_airport,
       departure_iata, 'ICAO' || departure_iata AS departure_icao,
       {_iso_sql('departure_epoch', 'k % 3')} AS departure_scheduled,
       CAST(NULL AS VARCHAR) AS departure_estimated,
       ' Airport' || {_pad('k')} || arrival_iata AS arrival_airport,
       arrival_iata, 'ICAO' || arrival_iata AS arrival_icao,
       {_iso_sql('arrival_epoch', 'k % 3')} AS arrival_scheduled,
       CAST(NULL AS VARCHAR) AS arrival_estimated,
       o.o_orderpriority AS airline_name,
       'A' || substr(o.o_orderpriority, 1, 1) AS airline_iata,
       'AL' || substr(o.o_orderpriority, 1, 1) AS airline_icao,
       CAST(k AS VARCHAR) AS flight_number, flight_iata, 'FLT' || k AS flight_icao
FROM flights JOIN orders o ON o.o_orderkey = flights.k
"""

ORACLE_SQL["flatten_dotted"] = _with(_BOARD) + """
SELECT airport_code, id AS flight_identification_id, callsign AS flight_identification_callsign,
       airline AS flight_airline_name, origin AS flight_airport_origin_name,
       destination AS flight_airport_destination_name,
       sched_dep AS flight_time_scheduled_departure, sched_arr AS flight_time_scheduled_arrival,
       sched_arr + 300 AS flight_time_estimated_arrival
FROM board_v
"""

ORACLE_SQL["leg_metrics"] = _with(_AIRPORTS, _FLIGHTS, _LEGS) + """
SELECT flight_iata, departure_iata, arrival_iata, departure_lat, departure_lon,
       arrival_lat, arrival_lon, departure_epoch, arrival_epoch, airport_distance
FROM legs
"""

ORACLE_SQL["arrivals_table"] = _with(_AIRPORTS, _BOARD) + f"""
SELECT airport_code, id AS flight_id, callsign AS flight_number, airline, origin,
       {_txt('sched_dep')} AS departure_time, {_txt('sched_arr')} AS arrival_time
FROM board_v
WHERE flight_type <> 'departures' AND id IS NOT NULL AND id <> ''
  AND airport_code IN (SELECT code FROM uniq)
"""

ORACLE_SQL["planner_detail_subset"] = _PLANNED + """
SELECT l.flight_iata, l.arrival_epoch, l.departure_epoch,
       string_agg(CAST(b.risk AS VARCHAR), '|' ORDER BY b.idx) AS risk_path
FROM legs l JOIN banded b ON b.flight_iata = l.flight_iata
GROUP BY l.flight_iata, l.arrival_epoch, l.departure_epoch
"""

ORACLE_SQL["path_coords"] = _PLANNED + "SELECT flight_iata, idx, lat, lon FROM pts"

ORACLE_SQL["normalize_whitespace"] = r"""
SELECT doc_id, md5(n) AS text_md5, CAST(length(n) AS INTEGER) AS n_chars
FROM (
  SELECT doc_id,
    trim(regexp_replace(text,
      '[\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+',
      ' ', 'g')) AS n
  FROM documents
)
"""

ORACLE_SQL["flight_label"] = _with(_FLIGHTS) + f"""
SELECT flight_iata,
       'Flight: ' || flight_iata || '<br>Departure Time: ' || {_txt('departure_epoch')}
       || '<br>Arrival Time ' || {_txt('arrival_epoch')} AS label
FROM flights
"""

# ------------------------------------------------------------------ filters
ORACLE_SQL["drop_null_status"] = _with(_FLIGHTS) + """
SELECT flight_iata, flight_status FROM flights WHERE flight_status IS NOT NULL
"""

ORACLE_SQL["scheduled_only"] = _with(_FLIGHTS) + """
SELECT flight_iata, flight_status FROM flights WHERE flight_status = 'scheduled'
"""

ORACLE_SQL["resolve_airports"] = _with(_AIRPORTS, _FLIGHTS, _LEGS) + """
SELECT flight_iata, departure_iata, arrival_iata, departure_lat, departure_lon,
       arrival_lat, arrival_lon
FROM legs_all
"""

ORACLE_SQL["quality_report"] = _with(_AIRPORTS, _FLIGHTS) + """
SELECT 'departure_lat' AS column_name, count(*) AS before, count(u.lat) AS after,
       count(*) - count(u.lat) AS difference,
       CASE WHEN count(*) > 0
            THEN round(CAST(count(*) - count(u.lat) AS DOUBLE) * CAST(100 AS DOUBLE)
                       / CAST(count(*) AS DOUBLE), 6) END AS pct_loss
FROM flights f LEFT JOIN uniq u ON f.departure_iata = u.code
"""

ORACLE_SQL["forecast_lookup"] = _PLANNED + """
SELECT w.flight_iata, w.idx, w.cell, w.fts, v.precipitation AS s_precipitation,
       v.visibility AS s_visibility, v.snow_depth AS s_snow_depth
FROM wk w LEFT JOIN wv v ON v.cell = w.cell AND v.ts_hour = w.fts
"""

ORACLE_SQL["forecast_issue_asof"] = _PLANNED + """,
asked AS (
  SELECT cell, day0, fts, day0 - (1 + cell % 3) * 86400 + ((fts // 3600) % 7) * 3600 AS asked FROM keys
),
issues AS (
  SELECT cell, ts_hour, k, ts_hour - ts_hour % 86400 - k * 86400 + (1 - cell % 2) * 21600 AS issue,
         precipitation + k AS precipitation, visibility - k AS visibility, snow_depth + 10 * k AS snow_depth
  FROM wv, (SELECT unnest([1, 2, 3]) AS k) WHERE k > 1 OR (ts_hour // 3600) % 4 <> 0
),
found AS (
  SELECT a.*, i.precipitation, i.visibility, i.snow_depth,
         row_number() OVER (PARTITION BY a.cell, a.day0, a.fts ORDER BY i.issue DESC NULLS LAST) AS r
  FROM asked a LEFT JOIN issues i ON i.cell = a.cell AND i.ts_hour = a.fts AND i.issue <= a.asked
)
SELECT cell, day0, fts, CAST(asked AS BIGINT) AS asked, precipitation AS s_precipitation, visibility AS s_visibility,
       snow_depth AS s_snow_depth
FROM found WHERE r = 1
"""

ORACLE_SQL["nearest_weather_point"] = _PLANNED + """,
places AS (SELECT DISTINCT lat, lon FROM pts),
points AS (
  SELECT CAST(s_suppkey AS BIGINT) AS station, CAST((s_suppkey * 37) % 181 - 90 AS DOUBLE) AS slat,
         CAST((s_suppkey * 97) % 361 - 180 AS DOUBLE) AS slon FROM supplier
),
far AS (
  SELECT lat, lon, station,
    least(pow(sin((radians(slat) - radians(lat)) / 2), 2)
          + cos(radians(lat)) * cos(radians(slat)) * pow(sin((radians(slon) - radians(lon)) / 2), 2), CAST(1 AS DOUBLE)) AS a
  FROM places, points
),
near AS (
  SELECT lat, lon, station, round(CAST(6371.0 AS DOUBLE) * (2 * atan2(sqrt(a), sqrt(1 - a))), 4) AS km,
         row_number() OVER (PARTITION BY lat, lon ORDER BY round(CAST(6371.0 AS DOUBLE) * (2 * atan2(sqrt(a), sqrt(1 - a))), 4), station) AS r
  FROM far
)
SELECT p.flight_iata, p.idx, n.station, n.km AS station_km
FROM pts p LEFT JOIN near n ON n.lat = p.lat AND n.lon = p.lon AND n.r = 1 AND n.km <= 900
"""

# ------------------------------------------------------------------ joins
ORACLE_SQL["valid_code_semi"] = _with(_AIRPORTS, _BOARD) + """
SELECT pos, airport_code FROM board_v WHERE airport_code IN (SELECT code FROM uniq)
"""

ORACLE_SQL["invalid_code_anti"] = _with(_AIRPORTS, _FLIGHTS) + """
SELECT flight_iata, departure_iata FROM flights
WHERE NOT EXISTS (SELECT 1 FROM uniq WHERE uniq.code = flights.departure_iata)
"""

ORACLE_SQL["trailing_history_join"] = _PLANNED + """
SELECT cell, day0, fts, n_hist,
       s_precipitation, bad_precipitation, lt_precipitation, le_precipitation,
       s_visibility, bad_visibility, lt_visibility, le_visibility,
       s_snow_depth, bad_snow_depth, lt_snow_depth, le_snow_depth
FROM hc
"""

# ------------------------------------------------------------------ aggregations
ORACLE_SQL["percentile_of_score"] = _PLANNED + """
SELECT cell, day0, fts, pct_precipitation, pct_visibility, pct_snow_depth FROM pc
"""

ORACLE_SQL["weather_risk"] = _PLANNED + "SELECT cell, day0, fts, risk FROM kr"

ORACLE_SQL["airport_markers"] = _with(_AIRPORTS, _FLIGHTS, _LEGS) + """
SELECT 'departure' AS direction, departure_airport AS airport,
       arg_min(departure_lat, flight_iata) AS lat, arg_min(departure_lon, flight_iata) AS lon
FROM legs GROUP BY departure_airport
UNION ALL
SELECT 'arrival', arrival_airport, arg_min(arrival_lat, flight_iata), arg_min(arrival_lon, flight_iata)
FROM legs GROUP BY arrival_airport
"""

ORACLE_SQL["flight_picker_lastwins"] = _with(_AIRPORTS, _BOARD) + """
, listed AS (
  SELECT *, pos // 100 AS page,
         row_number() OVER (PARTITION BY airport_code, pos // 100, flight_type ORDER BY pos) - 1 AS idx
  FROM board_v
),
arr AS (SELECT * FROM listed WHERE flight_type <> 'departures' AND id IS NOT NULL AND id <> ''
                                 AND airport_code IN (SELECT code FROM uniq))
SELECT airport_code, callsign AS flight_number, arg_max(id, pos) AS flight_id,
       CAST(arg_min(page, pos) AS BIGINT) AS first_page, CAST(arg_min(idx, pos) AS INTEGER) AS first_idx
FROM arr GROUP BY airport_code, callsign
"""

ORACLE_SQL["path_with_risk"] = _PLANNED + """
SELECT flight_iata, CAST(count(*) AS INTEGER) AS n_points,
       string_agg(CAST(risk AS VARCHAR), '|' ORDER BY idx) AS risk_path,
       string_agg(band, '|' ORDER BY idx) AS band_path
FROM banded GROUP BY flight_iata
"""

# ------------------------------------------------------------------ windows / sort / limit
ORACLE_SQL["trail_every_nth"] = _with(_TRAILS) + """
SELECT rn, flight_id, lat, lng, alt, spd, time, hd FROM sampled
"""

ORACLE_SQL["latest_position"] = _with(_TRAILS) + """
SELECT flight_id, lat, lng, alt, spd, time, hd FROM trail_rn WHERE rn = 0
"""

ORACLE_SQL["top_n_departures"] = _with(_AIRPORTS, _FLIGHTS, _LEGS) + """
SELECT flight_iata, departure_epoch, arrival_epoch FROM legs_m
WHERE flight_status IS NOT NULL
ORDER BY departure_epoch, flight_iata LIMIT 20
"""

# ------------------------------------------------------------------ scalar functions
ORACLE_SQL["leg_distance"] = _with(_AIRPORTS, _FLIGHTS, _LEGS) + """
SELECT flight_iata, airport_distance FROM legs_m
"""

ORACLE_SQL["flight_path_points"] = _with(_AIRPORTS, _FLIGHTS, _LEGS, _points("legs_m", "ap")) + """
SELECT flight_iata, idx, lat, lon, t FROM ap
"""

ORACLE_SQL["adaptive_segments"] = _with(
    _AIRPORTS, _FLIGHTS, _LEGS,
    _points("legs_m", "ap", "least(greatest(CAST(floor(airport_distance / 10.0) AS INTEGER), 1), 30)")) + """
SELECT flight_iata, nseg AS n_segments, idx, lat, lon, t FROM ap
"""

ORACLE_SQL["future_path"] = _with(_AIRPORTS, _TRAILS) + """
, latest AS (SELECT flight_id, lat, lng, time FROM trail_rn WHERE rn = 0),
dest AS (
  SELECT CAST(user_id AS VARCHAR) AS flight_id,
         CAST(user_id % 25 AS VARCHAR) AS destination_iata,
         1706659200 + (user_id % 24) * 3600 AS scheduled_arrival
  FROM (SELECT DISTINCT user_id FROM events)
),
fp AS (
  SELECT l.flight_id, l.lat AS departure_lat, l.lng AS departure_lon, u.lat AS arrival_lat,
         u.lon AS arrival_lon, l.time AS departure_epoch, d.scheduled_arrival AS arrival_epoch
  FROM latest l JOIN dest d ON d.flight_id = l.flight_id JOIN uniq u ON u.code = d.destination_iata
),""" + _points("fp", "fpp").strip("\n") + """
SELECT flight_id, idx, lat, lon, t FROM fpp
"""

ORACLE_SQL["iso_to_epoch"] = _with(_ISO) + "SELECT event_id, iso_text, e AS epoch FROM iso"

ORACLE_SQL["epoch_to_date"] = _with(_FLIGHTS) + """
SELECT flight_iata, strftime(make_timestamp(departure_epoch * 1000000), '%Y-%m-%d') AS departure_date
FROM flights
"""

ORACLE_SQL["epoch_to_text"] = _with(_BOARD) + f"""
SELECT pos, {_txt('sched_dep')} AS departure_time, {_txt('sched_arr')} AS arrival_time FROM board_v
"""

ORACLE_SQL["hour_offset"] = _with(_FLIGHTS) + """
SELECT flight_iata,
       CAST(trunc(CAST(greatest(departure_epoch, arrival_epoch) - least(departure_epoch, arrival_epoch) AS DOUBLE)
                  / CAST(3600 AS DOUBLE)) AS BIGINT) + 1 AS hour_offset
FROM flights
"""

ORACLE_SQL["trailing_bounds"] = _with(_FLIGHTS) + """
SELECT flight_iata,
       strftime(make_timestamp(least(departure_epoch, arrival_epoch) * 1000000), '%Y-%m-%d') AS start_date,
       strftime(CAST(make_timestamp(least(departure_epoch, arrival_epoch) * 1000000) AS DATE)
                - INTERVAL 90 DAY, '%Y-%m-%d') AS history_start
FROM flights
"""

ORACLE_SQL["ordered_leg_times"] = _with(_FLIGHTS) + """
SELECT flight_iata, least(departure_epoch, arrival_epoch) AS leg_start,
       greatest(departure_epoch, arrival_epoch) AS leg_end,
       arrival_epoch < departure_epoch AS is_reversed
FROM flights
"""

ORACLE_SQL["risk_band"] = _PLANNED + "SELECT flight_iata, idx, risk, band FROM banded"

ORACLE_SQL["regex_extract_times"] = _with(_BOARD) + r"""
SELECT pos,
  CAST(regexp_extract(regexp_extract(t, 'a(.+?),', 0), '\d+', 0) AS BIGINT) AS arrival_epoch,
  CAST(regexp_extract(regexp_extract(t, 'd(.+?)\}', 0), '\d+', 0) AS BIGINT) AS departure_epoch,
  substr(m, 7, length(m) - 7) AS origin_name
FROM (
  SELECT pos, '{arrival=' || sched_arr || ', departure=' || sched_dep || '}' AS t,
         regexp_extract('{name=' || origin || ', code={iata=X}}', '^(.+?),', 0) AS m
  FROM board_v
)
"""

# ------------------------------------------------------------------ pulls, leg identity and options
ORACLE_SQL["weather_latest_pull"] = _with(_WEATHER) + """
SELECT cell, ts_hour,
       precipitation + CASE WHEN (ts_hour // 3600) % 3 = 0 THEN 1 ELSE 0 END AS precipitation,
       visibility, snow_depth,
       CAST(CASE WHEN (ts_hour // 3600) % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS pull
FROM wv
"""

ORACLE_SQL["trail_repeated_pull"] = ORACLE_SQL["trail_every_nth"]

_OMIT = _PLANNED.replace("""leg_start - (leg_start % 86400)
           + (CAST(trunc(CAST(t - leg_start AS DOUBLE) / CAST(3600 AS DOUBLE)) AS BIGINT)) * 3600 AS fts""",
                         "t - (t % 3600) AS fts")
_OMIT = _OMIT.replace("round(max(value), 2) AS visibility",
                      "CASE WHEN (e - (e % 3600)) % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE round(max(value), 2) END AS visibility")
_OMIT = _OMIT.replace("h.visibility < k.s_visibility", "h.visibility > k.s_visibility")
_OMIT = _OMIT.replace("h.visibility <= k.s_visibility", "h.visibility >= k.s_visibility")
for _m in ("precipitation", "visibility", "snow_depth"):
    _OMIT = _OMIT.replace(f"OR bad_{_m} > 0 OR n_hist = 0", f"OR n_hist - bad_{_m} = 0")
    _OMIT = _OMIT.replace(f"CASE WHEN lt_{_m} < le_{_m} THEN 1 ELSE 0 END)\n              * (CAST(50 AS DOUBLE) / CAST(n_hist AS DOUBLE))",
                          f"CASE WHEN lt_{_m} < le_{_m} THEN 1 ELSE 0 END)\n              * (CAST(50 AS DOUBLE) / CAST(n_hist - bad_{_m} AS DOUBLE))")
ORACLE_SQL["weather_risk_options"] = _OMIT + "SELECT cell, day0, fts, risk FROM kr"

ORACLE_SQL["epoch_to_text_zone"] = _with(_BOARD) + f"""
SELECT pos, {_txt('sched_dep + 19800')} AS departure_time FROM board_v
"""

# Repeated and missing flight numbers: legs are told apart by the order key.
_REPEATS = _PLANNED.replace("'FL' || k AS flight_iata", "CAST(k AS VARCHAR) AS flight_iata")
_NUMBER = "CASE WHEN l.k % 17 <> 0 THEN 'FL' || (l.k % 500) END"

ORACLE_SQL["planner_table"] = _REPEATS + f"""
SELECT strftime(make_timestamp(l.departure_epoch * 1000000), '%Y-%m-%d') AS flight_date, l.flight_status,
       l.departure_airport, l.departure_iata, 'ICAO' || l.departure_iata AS departure_icao,
       {_iso_sql('l.departure_epoch', 'l.k % 3')} AS departure_scheduled, CAST(NULL AS VARCHAR) AS departure_estimated,
       l.arrival_airport, l.arrival_iata, 'ICAO' || l.arrival_iata AS arrival_icao,
       {_iso_sql('l.arrival_epoch', 'l.k % 3')} AS arrival_scheduled, CAST(NULL AS VARCHAR) AS arrival_estimated,
       o.o_orderpriority AS airline_name, 'A' || substr(o.o_orderpriority, 1, 1) AS airline_iata,
       'AL' || substr(o.o_orderpriority, 1, 1) AS airline_icao, CAST(l.k AS VARCHAR) AS flight_number,
       {_NUMBER} AS flight_iata, 'FLT' || l.k AS flight_icao,
       l.departure_lat, l.departure_lon, l.arrival_lat, l.arrival_lon, l.departure_epoch, l.arrival_epoch,
       l.airport_distance, p.n_points, p.path_times, p.risk_path, p.band_path
FROM legs l JOIN orders o ON o.o_orderkey = l.k JOIN (
  SELECT flight_iata, CAST(count(*) AS INTEGER) AS n_points, string_agg(CAST(t AS VARCHAR), '|' ORDER BY idx) AS path_times,
         string_agg(CAST(risk AS VARCHAR), '|' ORDER BY idx) AS risk_path, string_agg(band, '|' ORDER BY idx) AS band_path
  FROM banded GROUP BY flight_iata) p ON p.flight_iata = l.flight_iata
"""

ORACLE_SQL["leg_rejects"] = _with(_AIRPORTS, _FLIGHTS) + """
SELECT CAST(l.k AS VARCHAR) AS flight_number, CASE WHEN l.k % 17 <> 0 THEN 'FL' || (l.k % 500) END AS flight_iata,
       l.departure_iata, l.arrival_iata,
       CASE WHEN d.code IS NULL THEN 'departure_code' ELSE 'arrival_code' END AS reject_reason
FROM flights l LEFT JOIN uniq d ON l.departure_iata = d.code LEFT JOIN uniq a ON l.arrival_iata = a.code
WHERE d.code IS NULL OR a.code IS NULL
"""

ORACLE_SQL["sorted_markers"] = ORACLE_SQL["airport_markers"].replace("arg_min(departure_lat, flight_iata)", "min(departure_lat)") \
    .replace("arg_min(departure_lon, flight_iata)", "min(departure_lon)").replace("arg_min(arrival_lat, flight_iata)", "min(arrival_lat)") \
    .replace("arg_min(arrival_lon, flight_iata)", "min(arrival_lon)")

# ------------------------------------------------------------------ user-level
ORACLE_SQL["planner_flagship"] = _PLANNED + """
SELECT flight_iata, idx, lat, lon, t, risk, band FROM banded
"""
