"""DuckDB oracle SQL for the GTFS chain (G*, S12-S14)."""

from __future__ import annotations

import re

from . import core
from .views import hms, with_views


def secs(x: str) -> str:
    return (f"((CAST(split_part({x}, ':', 1) AS INTEGER) * 60 + CAST(split_part({x}, ':', 2) AS INTEGER)) * 60 "
            f"+ CAST(split_part({x}, ':', 3) AS INTEGER))")


def lead_int(x: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({x}, '^\\s*([+-]?\\d+)', 1), '') AS BIGINT)"


def product(rt: str, name: str) -> str:
    i = lead_int(f"CAST({rt} AS VARCHAR)")
    n = f"coalesce({name}, '')"
    return f"""CAST(CASE
  WHEN {i} = 3 OR ({i} >= 700 AND {i} < 800) THEN 700
  WHEN {i} >= 200 AND {i} < 300 THEN 200
  WHEN {i} = 1 OR ({i} >= 400 AND {i} < 500) THEN 400
  WHEN {i} = 0 OR ({i} >= 900 AND {i} < 1000) THEN 900
  WHEN ({i} = 2 AND starts_with({n}, 'ICE')) OR {i} = 101 THEN 101
  WHEN {i} = 2 AND (starts_with({n}, 'IC') OR starts_with({n}, 'EC')) THEN 102
  WHEN {i} = 102 OR {i} = 105 THEN 102
  WHEN ({i} = 2 AND starts_with({n}, 'S')) OR ({i} >= 109 AND {i} < 110) THEN 109
  WHEN {i} >= 100 AND {i} < 104 THEN 100
  WHEN {i} = 2 OR ({i} >= 104 AND {i} < 109) THEN 104
  ELSE 1000 END AS INTEGER)"""


OP = f"CAST(CASE WHEN {lead_int('agency_id')} IS NULL OR {lead_int('agency_id')} > 30000 THEN 0 ELSE {lead_int('agency_id')} END AS INTEGER)"

INST = [f"""
rt AS (SELECT r.route_id, a.operator_id, r.route_short_name AS line_name, r.route_type AS product_name,
         {product('r.route_type', 'r.route_short_name')} AS product_type_id
       FROM routes r JOIN (SELECT agency_id, {OP} AS operator_id FROM agency) a ON r.agency_id = a.agency_id)""",
        """
inst AS (SELECT tu.* EXCLUDE (run), t.route_id, t.trip_short_name AS line_fahrtnr, rt.operator_id, rt.line_name, rt.product_name,
           rt.product_type_id
         FROM trip_updates tu JOIN trips t ON tu.trip_id = t.trip_id JOIN rt ON t.route_id = rt.route_id
         WHERE tu.trip_schedule_relationship IN ('SCHEDULED', 'CANCELED')
           AND tu.trip_id IN (SELECT trip_id FROM gtfs_stop_times))"""]

def mins(later: str, earlier: str) -> str:
    return f"CAST(floor(CAST(epoch_us({later}) - epoch_us({earlier}) AS DOUBLE) / 60000000.0 + 0.5) AS INTEGER)"


I = "trip_id, start_date, feed_ts"
SAME = "u{n}.trip_id = w.trip_id AND u{n}.start_date = w.start_date AND u{n}.feed_ts = w.feed_ts"
HIT = "coalesce(u{n}.stop = s.stop_id, false) OR coalesce(u{n}.seq = s.stop_sequence, false)"


def events(inst: str, updates: str) -> list[str]:
    """A pointer walks along the stops of each run; what it carries is written as recursion, one stop a step."""
    up = (f"up AS (SELECT *, row_number() OVER (PARTITION BY {I} ORDER BY pos) - 1 AS n FROM stop_time_updates)" if updates else
          "up AS (SELECT '' AS trip_id, '' AS start_date, TIMESTAMP '2000-01-01' AS feed_ts, '' AS stop, 0 AS seq, '' AS rel, "
          "NULL::BIGINT AS ad, NULL::BIGINT AS at_, NULL::BIGINT AS dd, NULL::BIGINT AS dt, 0 AS n WHERE false)")
    later = "coalesce({own}, CAST({at} - epoch_us(sched) // 1000000 AS BIGINT))"
    return [f"""
st AS (SELECT trip_id, stop_sequence, stop_id, {secs('arrival_time')} AS arr_s, {secs('departure_time')} AS dep_s,
         row_number() OVER (PARTITION BY trip_id ORDER BY stop_sequence) AS k, count(*) OVER (PARTITION BY trip_id) AS len
       FROM gtfs_stop_times)""", up, f"""
org AS (SELECT i.*, make_timestamp(CAST(substr(start_date, 1, 4) AS BIGINT), CAST(substr(start_date, 5, 2) AS BIGINT),
                       CAST(substr(start_date, 7, 2) AS BIGINT), 12, 0, 0)
          + to_hours(CAST(floor((coalesce({secs('start_time')}, s.dep_s) - s.dep_s) / 3600.0 + 0.5) AS BIGINT))
          - INTERVAL 12 HOUR AS origin
        FROM {inst} i JOIN st s ON i.trip_id = s.trip_id AND s.k = 1)""", f"""
walk AS (
  SELECT {I}, 0::BIGINT AS k, 0::BIGINT AS j, NULL::BIGINT AS hit, false AS off FROM org
  UNION ALL
  SELECT w.trip_id, w.start_date, w.feed_ts, s.k,
    CASE WHEN {HIT.format(n=1)} THEN w.j + 1 ELSE w.j END,
    CASE WHEN {HIT.format(n=1)} THEN w.j + 1 WHEN w.j = 0 AND ({HIT.format(n=0)}) THEN 0 END,
    CASE WHEN {HIT.format(n=1)} THEN u1.rel = 'SKIPPED' WHEN w.j = 0 AND ({HIT.format(n=0)}) THEN u0.rel = 'SKIPPED'
         ELSE w.off END
  FROM walk w JOIN st s ON s.trip_id = w.trip_id AND s.k = w.k + 1
  LEFT JOIN up u1 ON {SAME.format(n=1)} AND u1.n = w.j + 1
  LEFT JOIN up u0 ON {SAME.format(n=0)} AND u0.n = 0)""", f"""
ev AS (
  SELECT o.*, s.stop_id, s.stop_sequence, s.k, s.len, w.hit, w.off OR trip_schedule_relationship = 'CANCELED' AS cancelled,
    e.dep, o.origin + to_seconds(CAST(CASE WHEN e.dep THEN s.dep_s ELSE s.arr_s END AS BIGINT)) AS sched, u.ad, u.at_, u.dd, u.dt
  FROM walk w JOIN org o ON o.trip_id = w.trip_id AND o.start_date = w.start_date AND o.feed_ts = w.feed_ts
  JOIN st s ON s.trip_id = w.trip_id AND s.k = w.k, (VALUES (false), (true)) AS e(dep)
  LEFT JOIN up u ON {SAME.format(n='').replace('u.', 'u.')} AND u.n = w.hit
  WHERE (e.dep AND s.k < s.len) OR (NOT e.dep AND s.k > 1))""", f"""
ev2 AS (SELECT *, last_value(CASE WHEN dep THEN {later.format(own='dd', at='dt')} ELSE {later.format(own='ad', at='at_')} END
                             IGNORE NULLS) OVER (PARTITION BY {I} ORDER BY k, dep
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS delay
        FROM ev WHERE sched IS NOT NULL)""", f"""
ev3 AS (SELECT *, sched + to_seconds(delay) AS real_t, lead(sched) OVER w AS sched_next,
          lead(sched + to_seconds(delay)) OVER w AS real_next
        FROM ev2 WINDOW w AS (PARTITION BY {I} ORDER BY k, dep))""", f"""
events AS (
SELECT {'feed_ts' if updates else 'offline_sample_time'} AS sample_time, trip_id, start_date, line_name, line_fahrtnr,
  product_type_id, product_name, operator_id, cancelled, stop_id AS station_id, stop_sequence AS stop_number,
  sched AS scheduled_time, CAST(floor(delay / 60.0 + 0.5) AS INTEGER) AS delay_minutes,
  {mins('coalesce(real_t, sched)', 'feed_ts' if updates else 'offline_sample_time')} AS ttl_minutes, dep AS is_departure,
  {mins('sched_next', 'sched')} AS scheduled_duration_minutes, {mins('real_next', 'real_t')} AS projected_duration_minutes,
  hit IS NOT NULL AS has_update
FROM ev3 WHERE stop_id IN (SELECT stop_id FROM stops))"""]


def fraction(seed: int) -> str:
    return (f"(('0x' || substr(md5(trip_id || '|' || start_date || '|{seed}'), 1, 7))::BIGINT / 268435456.0::DOUBLE)")


EV_KEY = "trip_id, start_date, sample_time, stop_number, is_departure"


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    base = with_views("trip_updates", "trips", "routes", "agency", "gtfs_stop_times", extra=INST)
    q["gtfs_trip_join"] = base + ("SELECT trip_id, start_date, route_id, operator_id, product_type_id, line_name, "
                                  "line_fahrtnr, trip_schedule_relationship, feed_ts FROM inst")
    q["gtfs_product_type"] = with_views("routes") + (
        f"SELECT route_id, route_type, route_short_name, {product('route_type', 'route_short_name')} "
        "AS product_type_id FROM routes")
    q["gtfs_time_seconds"] = with_views("gtfs_stop_times") + (
        f"SELECT trip_id, stop_sequence, arrival_time, {secs('arrival_time')} AS arrival_s, departure_time, "
        f"{secs('departure_time')} AS departure_s FROM gtfs_stop_times")
    q["service_day_start"] = base + f"""
SELECT i.trip_id, i.start_date, i.feed_ts, i.start_time, s.fd AS first_departure_s,
  make_timestamp(CAST(substr(i.start_date, 1, 4) AS BIGINT), CAST(substr(i.start_date, 5, 2) AS BIGINT),
                 CAST(substr(i.start_date, 7, 2) AS BIGINT), 12, 0, 0)
    + to_hours(CAST(floor((coalesce({secs('i.start_time')}, s.fd) - s.fd) / 3600.0 + 0.5) AS BIGINT))
    - INTERVAL 12 HOUR AS service_start
FROM inst i JOIN (SELECT trip_id, arg_min({secs('departure_time')}, stop_sequence) AS fd
                  FROM gtfs_stop_times GROUP BY trip_id) s ON i.trip_id = s.trip_id"""
    ev = with_views("trip_updates", "trips", "routes", "agency", "gtfs_stop_times", "stops", "stop_time_updates",
                    extra=INST + events("inst", "stop_time_updates")).replace("WITH ", "WITH RECURSIVE ", 1)
    offline = f"""
off_inst AS (SELECT *, feed_ts - to_seconds(CAST(floor({fraction(42)} * 36000.0 + 0.5) AS BIGINT)) AS offline_sample_time
             FROM (SELECT *, row_number() OVER (PARTITION BY trip_id, start_date ORDER BY feed_ts) AS rn FROM inst) x WHERE rn = 1)"""
    q["offline_samples"] = with_views("trip_updates", "trips", "routes", "agency", "gtfs_stop_times", "stops",
                                      extra=INST + [offline] + events("off_inst", "")).replace(
        "WITH ", "WITH RECURSIVE ", 1) + "SELECT * EXCLUDE (has_update) FROM events"
    q["bus_sampling"] = base + f"SELECT * FROM inst WHERE product_type_id <> 700 OR {fraction(42)} < 0.1"
    q["stop_events"] = ev + "SELECT * EXCLUDE (has_update) FROM events"
    q["delay_propagation"] = ev + f"SELECT {EV_KEY}, scheduled_time, delay_minutes, ttl_minutes FROM events"
    q["stop_update_match"] = ev + f"SELECT {EV_KEY}, has_update FROM events"
    q["cancel_propagation"] = ev + f"SELECT {EV_KEY}, cancelled FROM events"
    q["event_durations"] = ev + (f"SELECT {EV_KEY}, scheduled_duration_minutes, projected_duration_minutes "
                                 "FROM events")
    q["gtfs_operators"] = with_views("agency") + f"""
SELECT * FROM (SELECT {OP} AS operator_id, agency_id AS id, agency_name AS name FROM agency) a
WHERE operator_id <> 0
UNION ALL SELECT 0, '0', 'Other'"""
    q["gtfs_stations"] = with_views("stops") + """
SELECT stop_id AS station_id, stop_name AS name, CAST(stop_lon AS DOUBLE) AS lon, CAST(stop_lat AS DOUBLE) AS lat,
  CASE WHEN coalesce(parent_station, '') <> '' THEN parent_station END AS parent FROM stops"""
    q["feed_file_sampling"] = with_views("feed_files") + """
SELECT path, mtime, event_id FROM (SELECT *, row_number() OVER (ORDER BY path) AS rn FROM feed_files) x
WHERE rn % 3 = 0"""
    # versions as parts of the trip's name: the same recursion then keeps them apart
    named = with_views("trip_updates", "trips", "routes", "agency", "stop_times", "stops", "stop_time_updates", "gtfs_versions")
    for name in ("trip_updates", "trips", "stop_time_updates"):
        named = re.sub(rf"\b{name}\b", f"{name}0", named)
    versioned = [f"""
v3 AS (SELECT version, mtime, row_number() OVER (ORDER BY version) - 1 AS k FROM gtfs_versions WHERE substr(version, 12, 2) IN ('01', '10', '20'))""", """
v4 AS (SELECT version, k, until, lag(until) OVER (ORDER BY version) AS since FROM (
  SELECT version, k, date_trunc('day', lead(mtime) OVER (ORDER BY version)) + INTERVAL 14 HOUR AS until FROM v3) x)""", """
ver AS (SELECT t.trip_id, t.start_date, t.feed_ts, v.version FROM trip_updates0 t JOIN v4 v
        ON t.feed_ts <= v.until AND (v.since IS NULL OR t.feed_ts > v.since))""", """
trip_updates AS (SELECT t.* REPLACE (concat(t.trip_id, '#', version) AS trip_id) FROM trip_updates0 t JOIN ver USING (trip_id, start_date, feed_ts))""", """
stop_time_updates AS (SELECT u.* REPLACE (concat(u.trip_id, '#', version) AS trip_id)
                      FROM stop_time_updates0 u JOIN ver USING (trip_id, start_date, feed_ts))""", """
trips AS (SELECT concat(trip_id, '#', version) AS trip_id, route_id,
            CASE WHEN k = 1 THEN concat('M', trip_short_name) ELSE trip_short_name END AS trip_short_name FROM trips0, v3)""", f"""
gtfs_stop_times AS (SELECT concat(trip_id, '#', version) AS trip_id, stop_sequence, stop_id,
                      {hms('(arrival_s + 300 * k)')} AS arrival_time, {hms('(departure_s + 300 * k)')} AS departure_time
                    FROM stop_times, v3 WHERE k <> 1 OR stop_sequence <> 5)"""]
    chain = [c.strip() for c in versioned + INST + events("inst", "stop_time_updates")]
    q["stop_events_versioned"] = named.rstrip().replace("WITH ", "WITH RECURSIVE ", 1) + ",\n" + ",\n".join(chain) + (
        "\nSELECT * EXCLUDE (has_update) REPLACE (split_part(trip_id, '#', 1) AS trip_id) FROM events")
    # the same events, relevant ones, folded with the timetable's profile
    stored = ["""
stored AS (SELECT DISTINCT split_part(trip_id, '#', 1) AS trip_id, * EXCLUDE (trip_id, start_date, has_update) FROM events WHERE abs(ttl_minutes) <= 1440)""", """
sample AS (SELECT *, CAST(NULL AS SMALLINT) AS load_factor_id, CAST(NULL AS VARCHAR) AS remarks_hash,
             CAST('0x' || substr(md5(concat_ws('|', trip_id, station_id, CAST(is_departure AS VARCHAR), epoch_us(scheduled_time), epoch_us(sample_time),
               ttl_minutes, delay_minutes, CAST(cancelled AS VARCHAR), stop_number)), 1, 15) AS BIGINT) AS id FROM stored)""", core.THR,
              *core.latest_cte(False), f"facts AS ({core.facts_body('de_gtfsde')})", f"h AS ({core.hist_sql('by_day', 'de_gtfsde')})"]
    q["ingest_gtfs"] = q["stop_events_versioned"].rsplit("\nSELECT * EXCLUDE", 1)[0] + ",\n" + ",\n".join(c.strip() for c in stored) + (
        "\nSELECT * FROM h")
    q["gtfs_static_join"] = with_views("routes", "agency", "trips", "gtfs_stop_times", "stops") + """
SELECT t.trip_id, r.route_id, r.route_short_name, r.route_type, a.agency_name, CAST(NULL AS VARCHAR) AS agency_lang, t.trip_short_name,
  p.stops, p.first_stop, p.last_time
FROM trips t JOIN routes r ON t.route_id = r.route_id JOIN agency a ON r.agency_id = a.agency_id
JOIN (SELECT trip_id, count(*) AS stops, arg_min(stop_name, stop_sequence) AS first_stop, max(departure_time) AS last_time
      FROM gtfs_stop_times s JOIN stops USING (stop_id) GROUP BY trip_id) p ON t.trip_id = p.trip_id"""
    q["gtfs_version_asof"] = with_views("feed_files", "gtfs_versions", extra=["""
vv AS (SELECT version, lag(valid_until) OVER (ORDER BY version) AS valid_from, valid_until FROM (
  SELECT version, date_trunc('day', lead(mtime) OVER (ORDER BY version)) + INTERVAL 14 HOUR AS valid_until
  FROM gtfs_versions) x)"""]) + """
SELECT f.path, f.mtime AS feed_ts, v.version
FROM feed_files f LEFT JOIN (SELECT * FROM vv WHERE valid_until IS NOT NULL) v
  ON f.mtime > coalesce(v.valid_from, TIMESTAMP '0001-01-01 00:00:00') AND f.mtime <= v.valid_until"""
    return q
