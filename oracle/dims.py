"""DuckDB oracle SQL for dimensions, stations and official figures (D*, T*, S16-S18, C6)."""

from __future__ import annotations

from . import core
from .gtfs import OP
from .ingest import NORM
from .views import lies_in, with_views

STATION_DIM = """
station_dim AS (SELECT stop_id AS station_id, stop_name AS name,
  CASE WHEN CAST(stop_id AS INTEGER) % 3 <> 0 THEN concat('{"id":"', stop_id, '"}') END AS details FROM stops)"""
STATION_NEW = """
station_new AS (SELECT stop_id AS station_id, concat('new ', stop_name) AS name,
  concat('{"new":"', stop_id, '"}') AS details FROM stops WHERE CAST(stop_id AS INTEGER) % 2 = 0)"""
OLD = "old AS (SELECT * FROM station_dim WHERE CAST(station_id AS INTEGER) % 5 <> 1)"

OFFICIAL = """
official AS (SELECT CAST(EVA_NR AS VARCHAR) AS eva, IFOPT AS ifopt, NAME AS name,
  CAST(replace(Laenge, ',', '.') AS DOUBLE) AS lon, CAST(replace(Breite, ',', '.') AS DOUBLE) AS lat
  FROM official_station_list)"""
OURS = """
ours AS (SELECT stop_id AS station_id, stop_name AS name, CAST(stop_lon AS DOUBLE) AS lon,
  CAST(stop_lat AS DOUBLE) AS lat FROM stops)"""


def dist(lon1, lat1, lon2, lat2):
    x = (f"sin(radians({lat1})) * sin(radians({lat2})) + cos(radians({lat1})) * cos(radians({lat2})) "
         f"* cos(radians({lon2} - {lon1}))")
    return f"(acos(greatest(-1.0, least(1.0, {x}))) * 6371000.0)"


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["zip_unnest"] = "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem"
    line_dim = """
line_dim AS (SELECT CAST(n + 1 AS SMALLINT) AS line_id, line_name FROM (
  SELECT DISTINCT line_name, CAST(NULLIF(regexp_extract(line_name, '^L(\\d+)$', 1), '') AS INTEGER) AS n FROM sample) s
  WHERE n < 10)"""
    dim2 = """
dim2 AS (SELECT line_id, line_name FROM line_dim UNION ALL
  SELECT CAST((SELECT coalesce(max(line_id), 0) FROM line_dim) + row_number() OVER (ORDER BY line_name) AS SMALLINT),
    line_name
  FROM (SELECT DISTINCT line_name FROM sample WHERE line_name IS NOT NULL
        AND line_name NOT IN (SELECT line_name FROM line_dim)) m)"""
    q["surrogate_keys"] = with_views("sample", extra=[line_dim, dim2]) + "SELECT line_id, line_name FROM dim2"
    q["surrogate_key_lookup"] = with_views("sample", extra=[line_dim, dim2]) + (
        "SELECT s.id, d.line_id FROM sample s LEFT JOIN dim2 d ON s.line_name = d.line_name")
    four = with_views("sample", extra=["""
vals AS (SELECT id, 'O' || operator_id AS operator, 'Operator ' || operator_id AS operator_name, 'LF' || load_factor_id AS load_factor,
           'P' || product_type_id AS product_type, CASE id % 3 WHEN 0 THEN 'calculated' WHEN 1 THEN 'prognosed' END AS prognosis_type
         FROM sample)""", """
stored AS (SELECT 'operator' AS dim, CAST(r_regionkey * 3 + 1 AS INTEGER) AS id, 'O' || (r_regionkey * 2) AS key, r_name AS name FROM region
           UNION ALL SELECT DISTINCT 'product_type', 5, product_type, NULL FROM vals WHERE product_type = 'P1')""", """
seen AS (SELECT dim, key, min(name) AS name FROM (
  SELECT 'operator' AS dim, operator AS key, operator_name AS name FROM vals UNION ALL SELECT 'load_factor', load_factor, NULL FROM vals
  UNION ALL SELECT 'product_type', product_type, NULL FROM vals UNION ALL SELECT 'prognosis_type', prognosis_type, NULL FROM vals) x
  WHERE key IS NOT NULL GROUP BY dim, key)""", """
dims AS (SELECT dim, id, key, name FROM stored UNION ALL
  SELECT dim, CAST(coalesce((SELECT max(id) FROM stored t WHERE t.dim = s.dim), 0) + row_number() OVER (PARTITION BY dim ORDER BY key) AS INTEGER),
    key, name
  FROM seen s WHERE NOT EXISTS (SELECT 1 FROM stored t WHERE t.dim = s.dim AND t.key = s.key))"""])
    q["dimension_keys"] = four + "SELECT dim, id, key, name FROM dims"
    q["dimension_lookup"] = four + "SELECT vals.id" + "".join(
        f", (SELECT d.id FROM dims d WHERE d.dim = '{k}' AND d.key = vals.{k}) AS {k}_id"
        for k in ("operator", "load_factor", "product_type", "prognosis_type")) + " FROM vals"
    up = with_views("stops", extra=[STATION_DIM, STATION_NEW, OLD])
    q["station_upsert"] = up + """
SELECT coalesce(o.station_id, n.station_id) AS station_id,
  CASE WHEN o.station_id IS NOT NULL THEN o.name ELSE n.name END AS name,
  CASE WHEN n.station_id IS NOT NULL THEN n.details ELSE o.details END AS details
FROM old o FULL OUTER JOIN station_new n ON o.station_id = n.station_id"""
    q["station_upsert_if_null"] = up + """
SELECT coalesce(o.station_id, n.station_id) AS station_id,
  CASE WHEN o.station_id IS NOT NULL THEN o.name ELSE n.name END AS name,
  CASE WHEN o.station_id IS NULL THEN n.details ELSE coalesce(o.details, n.details) END AS details
FROM old o FULL OUTER JOIN station_new n ON o.station_id = n.station_id"""
    ops = f"ops AS (SELECT {OP} AS operator_id, agency_id AS id, agency_name AS name FROM agency WHERE {OP} <> 0 " \
          "UNION ALL SELECT 0, '0', 'Other')"
    q["insert_ignore"] = with_views("agency", extra=[ops, """
old AS (SELECT operator_id, id, concat('old ', name) AS name FROM ops WHERE operator_id % 2 = 0)"""]) + """
SELECT * FROM old UNION ALL SELECT * FROM ops WHERE operator_id NOT IN (SELECT operator_id FROM old)"""
    q["first_per_key"] = with_views("raw") + """
SELECT response_id, station_id, sample_id, line_name FROM (
  SELECT response_id, station_id, sample_id, line_name,
    row_number() OVER (PARTITION BY response_id, station_id ORDER BY sample_id) AS rn FROM raw) x WHERE rn = 1"""
    rel = "(sample_time IS NOT NULL AND abs(ttl_minutes) <= 1440)"
    q["last_response_time"] = with_views("raw", extra=[NORM]) + f"""
SELECT max(coalesce(response_ts, last_sample_time + to_seconds(CAST(120 AS BIGINT)))) AS response_time FROM (
  SELECT response_id, any_value(response_ts) AS response_ts, max(CASE WHEN {rel} THEN sample_time END)
    AS last_sample_time, count(*) FILTER (WHERE {rel}) AS n_rel FROM norm GROUP BY response_id) g WHERE n_rel > 0"""
    q["station_lines"] = with_views("stops", "gtfs_stop_times", "trips", "routes") + """
SELECT s.stop_id AS station_id, s.stop_name AS name, l.lines FROM stops s LEFT JOIN (
  SELECT station_id, list_sort(list(DISTINCT line_name)) AS lines FROM (
    SELECT st.stop_id AS station_id, r.route_short_name AS line_name FROM gtfs_stop_times st
    JOIN trips t ON st.trip_id = t.trip_id JOIN routes r ON t.route_id = r.route_id) x
  WHERE line_name IS NOT NULL GROUP BY station_id) l ON s.stop_id = l.station_id"""
    sv = with_views("stops", "official_station_list", extra=[OFFICIAL, OURS])
    q["official_stations"] = sv + "SELECT * FROM official"
    q["geo_distance"] = sv + (f"SELECT s.station_id, round({dist('s.lon', 's.lat', 'o.lon', 'o.lat')}, 3) "
                              "AS distance_m FROM ours s JOIN official o ON s.station_id = o.eva")
    d = dist("s.lon", "s.lat", "o.lon", "o.lat")
    rep = f"(o.lon IS NOT NULL AND o.lat IS NOT NULL AND {d} > 300.0)"
    q["station_repair"] = sv + f"""
SELECT s.station_id, s.name, CASE WHEN {rep} THEN o.lon ELSE s.lon END AS lon,
  CASE WHEN {rep} THEN o.lat ELSE s.lat END AS lat, o.ifopt AS official_id, 1.0 AS weight,
  coalesce({rep}, false) AS repaired, CASE WHEN o.lon IS NOT NULL THEN round({d}, 3) END AS distance_m
FROM ours s LEFT JOIN official o ON s.station_id = o.eva"""
    served = with_views("stops", "official_station_list", "gtfs_stop_times", "trips", "routes", extra=[OFFICIAL, OURS, """
served AS (SELECT station_id, list_sort(list(DISTINCT line_name)) AS lines FROM (
  SELECT st.stop_id AS station_id, r.route_short_name AS line_name FROM gtfs_stop_times st
  JOIN trips t ON st.trip_id = t.trip_id JOIN routes r ON t.route_id = r.route_id) x WHERE line_name IS NOT NULL GROUP BY station_id)"""])
    q["station_documents"] = served + f"""
SELECT s.station_id, s.station_id AS id, s.name, 'station' AS type, CASE WHEN {rep} THEN o.lon ELSE s.lon END AS lon,
  CASE WHEN {rep} THEN o.lat ELSE s.lat END AS lat, o.ifopt AS ifopt_id, l.lines, CAST(1 AS DOUBLE) AS weight
FROM ours s LEFT JOIN official o ON s.station_id = o.eva LEFT JOIN served l ON s.station_id = l.station_id"""
    q["repaired_stations"] = sv + f"""
SELECT s.station_id, s.lon, s.lat FROM ours s JOIN official o ON s.station_id = o.eva WHERE {rep}"""
    q["missing_stations"] = sv + """
SELECT * FROM official WHERE lat IS NOT NULL AND NOT isnan(lat) AND eva NOT IN (SELECT station_id FROM ours)"""
    months = " UNION ALL ".join(
        f'SELECT CAST(JAHR AS SMALLINT) AS year, CAST({m} AS SMALLINT) AS month, BEREICH AS category, '
        f'CAST("< VERSPÄTUNG" AS INTEGER) AS threshold, CAST("{m}" AS DOUBLE) AS pct FROM official_punctuality_csv'
        for m in range(1, 13))
    q["official_stats_unpivot"] = with_views("official_punctuality_csv") + months
    stats = f"""
stats AS (SELECT year, month, category, max(CASE WHEN threshold = 5 THEN pct END) AS delay_percentage_5min,
  max(CASE WHEN threshold = 15 THEN pct END) AS delay_percentage_15min FROM ({months}) l GROUP BY ALL)"""
    extra = [core.SUBS, core.THR] + core.latest_cte(True) + [f"facts AS ({core.facts_body('de_db')})",
                                                              f"h AS ({core.hist_sql('by_day')})", stats]
    q["official_comparison"] = with_views("sample", "remarks", "official_punctuality_csv",
                                          "official_operator_mapping", extra=extra) + f""",
bm AS (SELECT CAST(year(scheduled_time) AS SMALLINT) AS year, CAST(month(scheduled_time) AS SMALLINT) AS month,
  product_type_id, operator_id, is_departure, prior_ttl_bucket, prior_delay_bucket, latest_sample_ttl_bucket,
  latest_sample_delay_bucket, CAST(sum(sample_count) AS BIGINT) AS sample_count FROM h GROUP BY ALL),
own AS (SELECT year, month, category, CAST(sum(sample_count) AS BIGINT) AS stop_events,
  CAST(sum(CASE WHEN {lies_in('latest_sample_delay_bucket', None, 6)} THEN sample_count ELSE 0 END) AS BIGINT)
    AS on_time_6,
  CAST(sum(CASE WHEN {lies_in('latest_sample_delay_bucket', None, 16)} THEN sample_count ELSE 0 END) AS BIGINT)
    AS on_time_16
  FROM bm JOIN official_operator_mapping m ON CAST(bm.operator_id AS VARCHAR) = m.operator
  WHERE prior_ttl_bucket IS NULL AND latest_sample_delay_bucket IS NOT NULL AND latest_sample_delay_bucket <> '(,)'
  GROUP BY ALL)
SELECT own.year, own.month, own.category, stop_events, on_time_6, on_time_16,
  CAST(on_time_6 AS DOUBLE) * 100.0 / CAST(stop_events AS DOUBLE) AS own_percentage_6min,
  CAST(on_time_16 AS DOUBLE) * 100.0 / CAST(stop_events AS DOUBLE) AS own_percentage_16min,
  delay_percentage_5min, delay_percentage_15min
FROM own JOIN stats ON own.year = stats.year AND own.month = stats.month AND own.category = stats.category"""
    return q
