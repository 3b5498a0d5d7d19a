"""DuckDB text of the adapter views and bucket functions, for the SQL oracle.

Independent of the Spark code paths: plain ANSI/DuckDB SQL over the
pre-registered driver tables.
"""

from __future__ import annotations

# Fixed values, written out here on their own: left edges and labels of the buckets.
DELAY_CUTS = (-90, -75, -60, -45, -30, -25, -20, -15, -10, -9, -8, -7, -6, -5, -4, -3, -2, -1, 0, 1, 2, 3, 4, 5, 6, 7,
              8, 9, 10, 11, 16, 21, 26, 31, 46, 61, 76, 91)
DELAY_LABELS = (
    "(,-90)", "[-90,-75)", "[-75,-60)", "[-60,-45)", "[-45,-30)", "[-30,-25)", "[-25,-20)", "[-20,-15)", "[-15,-10)",
    "[-10,-9)", "[-9,-8)", "[-8,-7)", "[-7,-6)", "[-6,-5)", "[-5,-4)", "[-4,-3)", "[-3,-2)", "[-2,-1)", "[-1,0)", "[0,1)",
    "[1,2)", "[2,3)", "[3,4)", "[4,5)", "[5,6)", "[6,7)", "[7,8)", "[8,9)", "[9,10)", "[10,11)", "[11,16)", "[16,21)",
    "[21,26)", "[26,31)", "[31,46)", "[46,61)", "[61,76)", "[76,91)", "[91,)")
TTL_CUTS = (-20, -15, -10, -5, 0, 5, 10, 15, 20, 25, 30, 45, 60, 75, 90, 120, 150, 180, 240, 300, 360)
TTL_LABELS = (
    "(,-20)", "[-20,-15)", "[-15,-10)", "[-10,-5)", "[-5,0)", "[0,5)", "[5,10)", "[10,15)", "[15,20)", "[20,25)", "[25,30)",
    "[30,45)", "[45,60)", "[60,75)", "[75,90)", "[90,120)", "[120,150)", "[150,180)", "[180,240)", "[240,300)", "[300,360)",
    "[360,)")

BASE = "TIMESTAMP '2024-01-01 00:00:00'"


def add_min(ts: str, n: str) -> str:
    return f"({ts} + to_minutes(CAST({n} AS BIGINT)))"


def case_bucket(expr: str, cuts, labels) -> str:
    parts = [f"WHEN {expr} IS NULL THEN NULL"]
    for c, lab in zip(cuts, labels):
        parts.append(f"WHEN {expr} < {c} THEN '{lab}'")
    parts.append(f"ELSE '{labels[-1]}'")
    return "(CASE " + " ".join(parts) + " END)"


def lies_in(label: str, low: int | None, high: int | None) -> str:
    """SQL: is the range a label names inside [low, high)? Edges are read from the label itself."""
    lo = f"TRY_CAST(nullif(regexp_extract({label}, '^[\\[(](-?\\d*),', 1), '') AS INTEGER)"
    hi = f"TRY_CAST(nullif(regexp_extract({label}, ',(-?\\d*)\\)$', 1), '') AS INTEGER)"
    parts = ([f"coalesce({lo} >= {low}, false)"] if low is not None else []) + \
        ([f"coalesce({hi} <= {high}, false)"] if high is not None else [])
    return f"({label} IS NOT NULL AND " + " AND ".join(parts) + ")"


def delay_b(expr: str) -> str:
    return case_bucket(expr, DELAY_CUTS, DELAY_LABELS)


def ttl_b(expr: str) -> str:
    return case_bucket(expr, TTL_CUTS, TTL_LABELS)


SAMPLE = f"""
sample AS (
WITH base AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.o_custkey,
         CAST(min(l.l_quantity) AS INT) AS qty
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, o.o_custkey),
b2 AS (
  SELECT *,
    {add_min(BASE, "(l_orderkey % 28) * 1440 + (l_orderkey * 37) % 1440")} AS scheduled_time,
    (l_suppkey % 17 = 0) AS cancelled,
    CASE WHEN l_suppkey % 17 = 0 OR l_partkey % 4 = 0 THEN NULL
         WHEN l_partkey % 10 < 8 THEN CAST((l_partkey * 7 + l_suppkey) % 6 - 1 AS SMALLINT)
         ELSE CAST((l_partkey * 7 + l_suppkey) % 221 - 100 AS SMALLINT) END AS delay_minutes,
    CAST(qty * 9 - 40 + l_linenumber AS SMALLINT) AS ttl_minutes
  FROM base)
SELECT
  ((l_orderkey * 8 + l_linenumber) * 20001 + l_partkey) * 1001 + l_suppkey AS id,
  scheduled_time,
  CAST(l_partkey % 61 AS SMALLINT) AS scheduled_duration_minutes,
  CASE WHEN l_partkey % 4 = 0 THEN NULL
       ELSE CAST(l_partkey % 61 + l_suppkey % 7 - 3 AS SMALLINT) END AS projected_duration_minutes,
  delay_minutes, cancelled,
  {add_min("scheduled_time", "coalesce(delay_minutes, 0) - ttl_minutes")} AS sample_time,
  ttl_minutes,
  CASE WHEN (l_orderkey * 8 + l_linenumber) % 211 <> 0 THEN concat('T', CAST(l_orderkey AS VARCHAR)) END AS trip_id,
  concat('L', CAST(o_custkey % 25 AS VARCHAR)) AS line_name,
  CAST(l_orderkey % 3 AS SMALLINT) AS product_type_id,
  concat('S', CAST(o_custkey % 40 AS VARCHAR)) AS station_id,
  CAST(o_custkey % 4 AS SMALLINT) AS operator_id,
  (l_linenumber % 2 = 0) AS is_departure,
  CASE WHEN l_linenumber >= 5 THEN md5(concat('r', CAST(l_suppkey AS VARCHAR))) END AS remarks_hash,
  CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE CAST(l_suppkey % 4 AS SMALLINT) END AS load_factor_id
FROM b2)"""

REMARKS = """
remarks AS (
SELECT md5(concat('r', CAST(s_suppkey AS VARCHAR))) AS remarks_hash,
  concat('[{"type":"', CASE WHEN s_suppkey % 2 = 0 THEN 'hint' ELSE 'status' END, '","code":"',
    CASE WHEN s_suppkey % 6 = 0 THEN 'alternative-trip' ELSE 'a' END, '","text":"',
    CASE s_suppkey % 6 WHEN 1 THEN 'Ersatzfahrt fuer RE 5' WHEN 2 THEN 'ICE 2901 replaces' WHEN 3 THEN 'IC 2950'
      WHEN 4 THEN 'a substitute runs' ELSE 'WLAN' END, '","summary":"', s_name, '"}]') AS remarks
FROM supplier)"""

STOPS = """
stops AS (
SELECT CAST(s_suppkey AS VARCHAR) AS stop_id, s_name AS stop_name,
  CAST(6 + s_suppkey % 90 * 0.1 AS DOUBLE) AS stop_lon, CAST(47 + s_suppkey % 70 * 0.1 AS DOUBLE) AS stop_lat,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_suppkey - s_suppkey % 5 AS VARCHAR) END AS parent_station
FROM supplier)"""

AGENCY = """
agency AS (
SELECT CASE WHEN n_nationkey % 6 = 0 THEN concat('x', CAST(n_nationkey AS VARCHAR))
            WHEN n_nationkey % 6 = 1 THEN CAST(30000 + n_nationkey AS VARCHAR)
            ELSE CAST(n_nationkey AS VARCHAR) END AS agency_id, n_name AS agency_name
FROM nation)"""

ROUTES = """
routes AS (
SELECT CAST(p_partkey AS VARCHAR) AS route_id,
  CASE WHEN p_partkey % 25 % 6 = 0 THEN concat('x', CAST(p_partkey % 25 AS VARCHAR))
       WHEN p_partkey % 25 % 6 = 1 THEN CAST(30000 + p_partkey % 25 AS VARCHAR)
       ELSE CAST(p_partkey % 25 AS VARCHAR) END AS agency_id,
  concat(CASE p_partkey % 5 WHEN 0 THEN 'ICE ' WHEN 1 THEN 'IC ' WHEN 2 THEN 'EC ' WHEN 3 THEN 'S' ELSE 'RE ' END,
         CAST(p_partkey % 90 AS VARCHAR)) AS route_short_name,
  CAST(CASE p_partkey % 14 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 2 WHEN 5 THEN 101
       WHEN 6 THEN 102 WHEN 7 THEN 105 WHEN 8 THEN 106 WHEN 9 THEN 109 WHEN 10 THEN 200 WHEN 11 THEN 103
       WHEN 12 THEN 715 ELSE 1500 END AS VARCHAR) AS route_type
FROM part)"""

TRIPS = """
trips AS (
SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_custkey AS VARCHAR) AS route_id,
  concat('N', CAST(o_orderkey % 997 AS VARCHAR)) AS trip_short_name
FROM orders)"""

STOP_TIMES = """
stop_times AS (
SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, l_linenumber AS stop_sequence,
  CAST(min(l_suppkey) AS VARCHAR) AS stop_id,
  18000 + (l_orderkey % 20) * 3600 + l_linenumber * 600 - 60 AS arrival_s,
  18000 + (l_orderkey % 20) * 3600 + l_linenumber * 600 AS departure_s,
  max(l_partkey) AS upd
FROM lineitem GROUP BY l_orderkey, l_linenumber)"""

UPDATES = """
updates AS (
SELECT trip_id, stop_sequence, stop_id,
  CASE WHEN upd % 11 = 0 THEN 'SKIPPED' ELSE 'SCHEDULED' END AS schedule_relationship,
  CASE WHEN upd % 11 = 0 THEN NULL ELSE upd % 1500 - 300 END AS departure_delay
FROM stop_times WHERE upd % 3 <> 0)"""

RESPONSES = """
responses AS (
SELECT event_id,
  md5(concat('e', CAST(CASE WHEN event_id % 50 = 1 THEN event_id - event_id % 3 ELSE event_id END AS VARCHAR))) AS hash,
  CASE event_type WHEN 'view' THEN 'departures' WHEN 'click' THEN 'arrivals'
                  WHEN 'signup' THEN 'trip' WHEN 'purchase' THEN CASE WHEN event_id % 4 = 3 THEN 'radar' ELSE 'journeys' END
                  END AS type, concat('{"board":[', repeat('{"dTimeR":"1"},', CAST(event_id % 7 AS INTEGER)), '{}]}') AS raw,
  ts
FROM events)"""

VIEWS = {"sample": SAMPLE, "remarks": REMARKS, "stops": STOPS, "agency": AGENCY, "routes": ROUTES,
         "trips": TRIPS, "stop_times": STOP_TIMES, "updates": UPDATES, "responses": RESPONSES}
# views that read other views
DEPENDS = {"updates": ["stop_times"]}


def with_views(*names: str, extra: list[str] | None = None) -> str:
    """``WITH`` prefix holding the named views (dependencies first) plus extra CTEs."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [VIEWS[n].strip() for n in order] + [e.strip() for e in (extra or [])]
    return "WITH " + ",\n".join(ctes) + "\n"

RAW = """
raw AS (
SELECT r0.*, e.hash, e.type AS response_type, e.ts AS response_ts FROM (
  SELECT id AS sample_id, id % (SELECT max(event_id) + 1 FROM events) AS response_id, trip_id, station_id, is_departure, scheduled_time,
    CASE WHEN delay_minutes IS NOT NULL
         THEN scheduled_time + to_seconds(CAST(CAST(delay_minutes AS INTEGER) * 60 + id % 61 - 30 AS BIGINT)) END
      AS projected_time,
    CASE WHEN delay_minutes IS NOT NULL THEN CAST(delay_minutes AS INTEGER) * 60 + id % 61 - 30 END AS delay_seconds,
    CASE WHEN id % 7 <> 0 THEN cancelled END AS cancelled,
    CASE WHEN id % 13 <> 0 THEN sample_time END AS sample_time,
    line_name, product_type_id, operator_id, remarks_hash, load_factor_id,
    scheduled_duration_minutes, projected_duration_minutes
  FROM sample) r0
LEFT JOIN responses e ON r0.response_id = e.event_id)"""

VIEWS["raw"] = RAW
DEPENDS["raw"] = ["sample", "responses"]


def hms(sec: str) -> str:
    return (f"concat_ws(':', lpad(CAST(CAST(floor({sec} / 3600) AS BIGINT) AS VARCHAR), 2, '0'), "
            f"lpad(CAST(CAST(floor({sec} % 3600 / 60) AS BIGINT) AS VARCHAR), 2, '0'), "
            f"lpad(CAST({sec} % 60 AS VARCHAR), 2, '0'))")


VIEWS["gtfs_stop_times"] = f"""
gtfs_stop_times AS (
SELECT trip_id, stop_sequence, stop_id, {hms("arrival_s")} AS arrival_time, {hms("departure_s")} AS departure_time
FROM stop_times)"""
DEPENDS["gtfs_stop_times"] = ["stop_times"]

VIEWS["trip_updates"] = """
trip_updates AS (
SELECT CAST(o_orderkey AS VARCHAR) AS trip_id, strftime(d, '%Y%m%d') AS start_date,
  CASE WHEN o_orderkey % 7 = 0 THEN '06:00:00' END AS start_time,
  CASE WHEN o_orderkey % 23 = 0 THEN 'CANCELED' WHEN o_orderkey % 29 = 0 THEN 'ADDED' ELSE 'SCHEDULED' END
    AS trip_schedule_relationship,
  d + to_seconds(CAST((o_orderkey % 20) * 3600 + 14400 + CASE WHEN run = 2 THEN 3600 ELSE 0 END AS BIGINT)) AS feed_ts, run
FROM (SELECT o_orderkey, run, TIMESTAMP '2024-01-01 00:00:00'
        + to_days(CAST(o_orderkey % 28 + CASE WHEN run = 1 THEN 1 ELSE 0 END AS INTEGER)) AS d
      FROM orders, (VALUES (0), (1), (2)) AS r(run)
      WHERE run = 0 OR (run = 1 AND o_orderkey % 3 = 0) OR (run = 2 AND o_orderkey % 5 = 0)) x)"""

VIEWS["stop_time_updates"] = """
stop_time_updates AS (
SELECT trip_id, start_date, feed_ts, stop_sequence AS pos,
  CASE WHEN bogus THEN 99 WHEN u % 4 <> 1 THEN stop_sequence END AS seq,
  CASE WHEN bogus THEN 'nowhere' WHEN u % 4 <> 2 THEN stop_id END AS stop,
  CASE WHEN u % 11 = 0 THEN 'SKIPPED' ELSE 'SCHEDULED' END AS rel,
  CASE WHEN u % 11 <> 0 AND u % 6 = 2 THEN u % 900 - 100 END AS ad,
  CASE WHEN u % 11 <> 0 AND u % 6 = 4 THEN epoch_us(feed_ts) // 1000000 + u % 7200 END AS at_,
  CASE WHEN u % 11 <> 0 AND u % 5 <> 1 THEN u % 1500 - 300 END AS dd,
  CASE WHEN u % 11 <> 0 AND u % 5 = 1 THEN epoch_us(feed_ts) // 1000000 + u % 7200 END AS dt
FROM (SELECT t.trip_id, t.start_date, t.feed_ts, s.stop_sequence, s.stop_id, s.upd + t.run * 7 AS u,
        CAST(s.trip_id AS BIGINT) % 37 = 0 AND s.stop_sequence = 3 AS bogus
      FROM stop_times s JOIN trip_updates t ON s.trip_id = t.trip_id) x
WHERE u % 3 <> 0 OR bogus)"""
DEPENDS["stop_time_updates"] = ["stop_times", "trip_updates"]

VIEWS["feed_files"] = """
feed_files AS (
SELECT concat('feeds/', strftime(ts, '%Y%m%dT%H%M%S.%f'), '-', CAST(event_id AS VARCHAR), '.pb') AS path,
  ts AS mtime, event_id
FROM events)"""

VIEWS["gtfs_versions"] = """
gtfs_versions AS (
SELECT concat('gtfs-', strftime(d, '%Y%m%d'), '.zip') AS version,
  d + to_hours(CAST(day(d) % 5 * 5 AS BIGINT)) AS mtime
FROM (SELECT DISTINCT date_trunc('day', ts) AS d FROM events) x)"""

VIEWS["official_station_list"] = """
official_station_list AS (
SELECT CAST(CASE WHEN s_suppkey % 9 = 0 THEN s_suppkey + 100000 ELSE s_suppkey END AS VARCHAR) AS EVA_NR,
  concat('de:', CAST(s_suppkey AS VARCHAR)) AS IFOPT, concat('Official ', s_name) AS NAME,
  replace(CAST(CAST(6 + s_suppkey % 90 * 0.1 + (s_suppkey % 3) * 0.003 AS DOUBLE) AS VARCHAR), '.', ',') AS Laenge,
  CASE WHEN s_suppkey % 11 <> 0 THEN replace(CAST(CAST(47 + s_suppkey % 70 * 0.1 AS DOUBLE) AS VARCHAR), '.', ',')
  END AS Breite
FROM supplier)"""

_MONTH_COLS = ", ".join(f'max(CASE WHEN m = {m} THEN v END) AS "{m}"' for m in range(1, 13))
_SUM = " + ".join(f'coalesce("{m}", 0.0)' for m in range(1, 13))
_CNT = " + ".join(f'CASE WHEN "{m}" IS NOT NULL THEN 1 ELSE 0 END' for m in range(1, 13))

VIEWS["official_punctuality_csv"] = f"""
official_punctuality_csv AS (
SELECT JAHR, BEREICH, threshold AS "< VERSPÄTUNG", {", ".join(f'"{m}"' for m in range(1, 13))},
  CASE WHEN ({_CNT}) > 0 THEN (0.0 + {_SUM}) / ({_CNT}) END AS "AVG JAHR"
FROM (
  SELECT JAHR, BEREICH, threshold, {_MONTH_COLS} FROM (
    SELECT JAHR, BEREICH, threshold, m,
      CASE WHEN (JAHR + m) % 7 <> 0 THEN CAST(n % 1000 AS DOUBLE) / 10.0 END AS v
    FROM (SELECT JAHR, BEREICH, threshold, m, count(*) AS n FROM (SELECT year(o_orderdate) + 29 AS JAHR,
            CASE WHEN o_custkey % 3 = 0 THEN 'db-total' WHEN o_custkey % 3 = 1 THEN 'db-fernverkehr'
                 ELSE 'db-regio' END AS BEREICH,
            CASE WHEN o_orderkey % 2 = 0 THEN 5 ELSE 15 END AS threshold, month(o_orderdate) AS m FROM orders) o
    GROUP BY ALL) c) g
  GROUP BY JAHR, BEREICH, threshold) w)"""

VIEWS["official_operator_mapping"] = """
official_operator_mapping AS (
SELECT CASE WHEN operator IN ('0', '1') THEN 'db-fernverkehr' ELSE 'db-regio' END AS category, operator
FROM (SELECT DISTINCT CAST(operator_id AS VARCHAR) AS operator FROM sample) o
UNION ALL
SELECT 'db-total' AS category, operator FROM (SELECT DISTINCT CAST(operator_id AS VARCHAR) AS operator FROM sample) o)"""
DEPENDS["official_operator_mapping"] = ["sample"]

_INNER = """concat('{"svcResL":[{"meth":"',
  CASE WHEN event_type IN ('view', 'click') THEN 'StationBoard' WHEN event_type = 'signup' THEN 'JourneyDetails'
       WHEN event_type = 'purchase' THEN 'TripSearch' WHEN event_id % 3 = 0 THEN 'JourneyGeoPos'
       WHEN event_id % 3 = 1 THEN 'LocMatch' ELSE 'Unknown' END,
  '","res":{"type":"', CASE WHEN event_type = 'click' THEN 'ARR' ELSE 'DEP' END, '","jnyL":[',
  repeat('{"stbStop":{"dTimeR":"120000"}},', CAST(event_id % 4 AS INTEGER)), '{}', ']}}]}')"""

VIEWS["hafas_log_lines"] = f"""
hafas_log_lines AS (
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN concat('[0,"res","', replace(inner_json, '"', '\\"'), '"]')
  WHEN event_id % 5 = 1 THEN concat('{{"log":"', replace(inner_json, '"', '\\"'), '"}}')
  WHEN event_id % 5 = 2 THEN inner_json WHEN event_id % 5 = 3 THEN '{{"other":1}}' ELSE 'not json' END AS value
FROM (SELECT event_id, {_INNER} AS inner_json FROM events) e)"""

VIEWS["access_log_lines"] = """
access_log_lines AS (
SELECT event_id, concat('[', strftime(ts, '%d/%b/%Y:%H:%M:%S'), ' +0000] "GET /',
  CASE event_type WHEN 'view' THEN 'departures' WHEN 'click' THEN 'arrivals' WHEN 'signup' THEN 'trips'
                  WHEN 'purchase' THEN 'journeys' ELSE 'radar' END,
  '?id=', CAST(user_id AS VARCHAR), ' HTTP/1.1" ', CASE WHEN event_id % 9 = 0 THEN '404' ELSE '200' END, ' 1234')
  AS value
FROM events)"""
