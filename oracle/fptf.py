"""DuckDB oracle SQL for FPTF documents (P*): the rows that the documents were made from, straight from the tables."""

from __future__ import annotations

from . import core
from .ingest import js_round
from .views import with_views

BASE = ["""
line AS (SELECT t.trip_id, CAST(t.trip_id AS BIGINT) AS kk, t.trip_short_name AS line_fahrtnr, r.route_id AS line_id,
           r.route_short_name AS line_name, r.route_type AS product_name, a.agency_id AS operator_id, a.agency_name AS operator_name
         FROM trips t JOIN routes r ON t.route_id = r.route_id JOIN agency a ON r.agency_id = a.agency_id)""", """
ev AS (
  SELECT s.trip_id, s.stop_sequence AS seq, s.stop_id, u.departure_delay AS dly, d.day, d.day + to_seconds(CAST(departure_s AS BIGINT)) AS pd,
    d.day + to_seconds(CAST(arrival_s AS BIGINT)) AS pa, s.stop_sequence = 7 AS off,
    CASE WHEN CAST(s.stop_id AS INTEGER) % 4 = 0 THEN 'low-to-medium' END AS stop_load,
    CASE WHEN s.stop_sequence % 4 = 2 THEN 'low' END AS own_load,
    row_number() OVER (PARTITION BY s.trip_id ORDER BY s.stop_sequence) AS k, count(*) OVER (PARTITION BY s.trip_id) AS len
  FROM stop_times s JOIN stops p ON s.stop_id = p.stop_id
  JOIN (SELECT trip_id, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(CAST(trip_id AS BIGINT) % 28 AS INTEGER)) AS day FROM trips) d
    ON s.trip_id = d.trip_id
  LEFT JOIN updates u ON s.trip_id = u.trip_id AND s.stop_sequence = u.stop_sequence)""", """
calls AS (
  SELECT trip_id, seq, k, len, stop_id, day, dep, off, coalesce(stop_load, own_load) AS load,
    CASE WHEN dep THEN pd ELSE pa END AS scheduled, CASE WHEN dep THEN pd + to_seconds(dly) END AS projected, CASE WHEN dep THEN dly END AS delay
  FROM ev, (VALUES (true), (false)) AS e(dep))""", """
doc AS (SELECT trip_id, kk, concat('t', trip_id) AS response_key, day + INTERVAL 4 HOUR AS sample_time,
          CASE kk % 4 WHEN 0 THEN 'trip' WHEN 1 THEN 'journeys' WHEN 2 THEN 'refreshJourney' ELSE 'radar' END AS type,
          CASE WHEN kk % 5 = 0 AND kk % 4 <> 3 THEN '[{"type":"hint","code":"bicycle","text":"Bicycles allowed"}]' END AS remarks
        FROM line JOIN (SELECT DISTINCT trip_id, day FROM ev) e USING (trip_id))""", """
found AS (
  -- own departure and arrival of trips and legs
  SELECT response_key, type, d.trip_id AS line_of, d.trip_id, stop_id, true AS dep, pd AS scheduled, pd + to_seconds(dly) AS projected, dly AS delay,
    kk % 23 = 0 AND dly IS NULL AS off, stop_load AS load, sample_time, remarks FROM doc d JOIN ev ON ev.trip_id = d.trip_id AND k = 1 WHERE kk % 4 <> 3
  UNION ALL
  SELECT response_key, type, d.trip_id, d.trip_id, stop_id, false, pa, NULL, NULL, kk % 23 = 0, stop_load, sample_time, remarks
  FROM doc d JOIN ev ON ev.trip_id = d.trip_id AND k = len WHERE kk % 4 <> 3
  UNION ALL  -- stopovers: of movements all, of trips and legs all but the first
  SELECT response_key, type, d.trip_id, d.trip_id, stop_id, dep, scheduled, projected, delay, off, load, sample_time, remarks
  FROM doc d JOIN calls c ON c.trip_id = d.trip_id WHERE kk % 4 = 3 OR k > 1
  UNION ALL  -- alternatives
  SELECT response_key, type, d.trip_id, concat('alt', d.trip_id), stop_id, true, pd + INTERVAL 10 MINUTE,
    CASE WHEN kk % 5 = 0 THEN pd + INTERVAL 15 MINUTE END, CASE WHEN kk % 5 = 0 THEN 300 END, kk % 7 = 0,
    CASE WHEN kk % 2 = 1 AND stop_load IS NOT NULL THEN stop_load ELSE 'high' END, sample_time, NULL
  FROM doc d JOIN ev ON ev.trip_id = d.trip_id AND k = 1 WHERE kk % 4 <> 3 AND kk % 3 = 0
  UNION ALL
  SELECT response_key, type, d.trip_id, concat('alt', d.trip_id), stop_id, dep, scheduled, projected, delay, off, load, sample_time, NULL
  FROM doc d JOIN calls c ON c.trip_id = d.trip_id AND k = len WHERE kk % 4 <> 3 AND kk % 3 = 0
  UNION ALL  -- boards
  SELECT response_key, type, trip_id, trip_id, stop_id, dep, scheduled, CASE WHEN seq % 3 = 0 THEN scheduled + to_seconds(coalesce(dly, 0)) END,
    CASE WHEN seq % 3 = 0 THEN dly END, false, coalesce(stop_load, CASE WHEN seq % 5 = 0 THEN 'full' END), sample_time, NULL FROM board
  UNION ALL
  SELECT b.response_key, b.type, b.trip_id, b.trip_id, c.stop_id, c.dep, c.scheduled, c.projected, c.delay, c.off, c.load, b.sample_time, NULL
  FROM board b JOIN calls c ON c.trip_id = b.trip_id AND ((b.seq % 3 = 2 AND c.k = b.k - 1) OR (b.seq % 3 = 1 AND c.k = b.k + 1)))""", """
fptf AS (
  SELECT response_key, type, f.trip_id, stop_id AS station_id, dep AS is_departure, scheduled AS scheduled_time, projected AS projected_time,
    CAST(delay AS INTEGER) AS delay_seconds, off AS cancelled, load AS load_factor, line_name, operator_id, sample_time, operator_name,
    line_fahrtnr, line_id, 'regional' AS product_type, product_name, remarks
  FROM found f JOIN line ON line.trip_id = f.line_of)"""]

BOARD = """
board AS (
  SELECT trip_id, seq, k, stop_id, dly, stop_load, dep, scheduled, CASE WHEN dep THEN 'departures' ELSE 'arrivals' END AS type,
    concat(CASE WHEN dep THEN 'd' ELSE 'a' END, stop_id, '@', strftime(scheduled, '%Y%m%d%H')) AS response_key,
    CASE WHEN CAST(stop_id AS INTEGER) % 2 = 0 THEN date_trunc('hour', scheduled) END AS sample_time
  FROM (SELECT *, CASE WHEN dep THEN pd ELSE pa END AS scheduled FROM ev, (VALUES (true), (false)) AS e(dep)) x
  WHERE trip_id IN (SELECT trip_id FROM line))"""

PLACE = """'{"type":"location","id":"' || stop_id || '","latitude":' || stop_lat || ',"longitude":' || stop_lon || '}'"""
STATION = """'{"type":"station","id":"' || parent_station || '","name":"Station ' || parent_station || '","location":' || place || '}'"""

STATIONS = [f"""
place AS (SELECT *, {PLACE} AS place FROM stops)""", f"""
known AS (SELECT stop_id, stop_name, stop_lon, stop_lat, parent_station, CASE WHEN parent_station IS NOT NULL THEN {STATION} END AS station,
  concat('{{"type":"stop","id":"', stop_id, '","name":"', stop_name, '","location":', place,
         CASE WHEN parent_station IS NOT NULL THEN concat(',"station":', {STATION}) END,
         CASE WHEN CAST(stop_id AS INTEGER) % 4 = 0 THEN ',"loadFactor":"low-to-medium"' END, '}}') AS details FROM place)""", """
seen AS (SELECT DISTINCT response_key, type, station_id FROM fptf UNION
         SELECT concat('l', coalesce(parent_station, stop_id)), 'locations', stop_id FROM stops)"""]

# from rows to stored samples: fallback time, relevance, ids of natural keys, one of equal rows
STORED = [f"""
norm AS (SELECT *, {js_round("CAST(epoch_us(coalesce(projected_time, scheduled_time)) - epoch_us(seen_at) AS DOUBLE) / 60000000.0")} AS ttl_minutes
         FROM (SELECT *, coalesce(sample_time, response_ts - INTERVAL 2 MINUTE) AS seen_at, {js_round("CAST(delay_seconds AS DOUBLE) / 60.0")} AS delay_minutes
               FROM (SELECT *, CASE WHEN contains(response_key, '@') THEN strptime(split_part(response_key, '@', 2), '%Y%m%d%H') + INTERVAL 30 MINUTE END
                       AS response_ts FROM fptf) x) y)""", """
rel AS (SELECT * FROM norm WHERE seen_at IS NOT NULL AND abs(ttl_minutes) <= 1440)""", *[f"""
{name} AS (SELECT {key} AS key, row_number() OVER (ORDER BY {key}) AS id FROM (SELECT DISTINCT {key} FROM rel WHERE {key} IS NOT NULL) k)"""
          for name, key in (("operators", "operator_id"), ("loads", "load_factor"), ("products", "product_type"))], """
uniq AS (SELECT DISTINCT scheduled_time, delay_minutes, cancelled, seen_at AS sample_time, ttl_minutes, trip_id, line_name, line_fahrtnr,
           p.id AS product_type_id, product_name, station_id, o.id AS operator_id, is_departure, md5(remarks) AS remarks_hash, l.id AS load_factor_id
         FROM rel LEFT JOIN operators o ON rel.operator_id = o.key LEFT JOIN loads l ON rel.load_factor = l.key
         LEFT JOIN products p ON rel.product_type = p.key)""", """
sample AS (SELECT *, CAST(NULL AS SMALLINT) AS scheduled_duration_minutes, CAST(NULL AS SMALLINT) AS projected_duration_minutes,
             CAST('0x' || substr(md5(concat_ws('|', trip_id, station_id, CAST(is_departure AS VARCHAR), epoch_us(scheduled_time), epoch_us(sample_time),
               ttl_minutes, delay_minutes, CAST(cancelled AS VARCHAR), line_name, operator_id, load_factor_id, remarks_hash)), 1, 15) AS BIGINT) AS id
           FROM uniq)""", "subs AS (SELECT '' AS remarks_hash WHERE false)"]

SAMPLE = ("response_key, type, trip_id, station_id, is_departure, scheduled_time, projected_time, delay_seconds, cancelled, load_factor, "
          "line_name, operator_id, sample_time")


def queries() -> dict[str, str]:
    base = with_views("trips", "routes", "agency", "stops", "stop_times", "updates", extra=[*BASE[:4], BOARD, *BASE[4:]])
    q = {"fptf_samples": base + f"SELECT {SAMPLE} FROM fptf"}
    for name, types in (("board", "'departures', 'arrivals'"), ("trip", "'trip'"), ("journeys", "'journeys', 'refreshJourney'"), ("radar", "'radar'")):
        q[f"fptf_{name}"] = base + f"SELECT {SAMPLE} FROM fptf WHERE type IN ({types})"
    q["fptf_metadata"] = base + ("SELECT response_key, trip_id, station_id, is_departure, cancelled, load_factor, operator_id, operator_name, "
                                 "line_name, line_fahrtnr, line_id, product_type, product_name, remarks FROM fptf")
    q["fptf_stopovers"] = base + ("SELECT is_departure, count(*) AS rows, count(delay_seconds) AS with_delay FROM fptf WHERE type = 'trip' "
                                  "GROUP BY is_departure")
    ttl = js_round("CAST(epoch_us(coalesce(projected_time, scheduled_time)) - epoch_us(sample_time) AS DOUBLE) / 60000000.0")
    q["fptf_normalised"] = base + f"""
SELECT response_key, trip_id, station_id, is_departure, scheduled_time, {js_round("CAST(delay_seconds AS DOUBLE) / 60.0")} AS delay_minutes,
  {ttl} AS ttl_minutes, cancelled FROM fptf WHERE sample_time IS NOT NULL AND abs({ttl}) <= 1440"""
    q["fptf_stations"] = base.rstrip() + "," + ",".join(STATIONS) + """
SELECT DISTINCT response_key, type, stop_id AS station_id, stop_name AS name, stop_lon AS lon, stop_lat AS lat, parent_station AS parent, details
FROM seen JOIN known ON seen.station_id = known.stop_id
UNION
SELECT DISTINCT response_key, type, parent_station, concat('Station ', parent_station), stop_lon, stop_lat, NULL, station
FROM seen JOIN known ON seen.station_id = known.stop_id WHERE parent_station IS NOT NULL"""
    chain = [*STORED, core.THR, *core.latest_cte(True), f"facts AS ({core.facts_body()})", f"h AS ({core.hist_sql('by_hour')})"]
    q["ingest_fptf"] = base.rstrip() + ",\n" + ",\n".join(c.strip() for c in chain) + "\nSELECT * FROM h"
    q["ingest_fptf_log"] = base.rstrip() + ",\n" + ",\n".join(c.strip() for c in STORED[:2]) + """
SELECT response_id, CAST(CASE type WHEN 'journeys' THEN 0 WHEN 'departures' THEN 1 WHEN 'arrivals' THEN 2 WHEN 'trip' THEN 3
    WHEN 'refreshJourney' THEN 4 WHEN 'radar' THEN 6 END AS SMALLINT) AS type, coalesce(response_ts, last + INTERVAL 2 MINUTE) AS response_time,
  response_ts IS NULL AS response_time_estimated, false AS sample_time_estimated, sample_count, 'fixture' AS source
FROM (SELECT response_key AS response_id, any_value(type) AS type, any_value(response_ts) AS response_ts, count(*) AS sample_count,
        max(CASE WHEN seen_at IS NOT NULL AND abs(ttl_minutes) <= 1440 THEN seen_at END) AS last FROM norm GROUP BY response_key) g
WHERE last IS NOT NULL"""
    return q
