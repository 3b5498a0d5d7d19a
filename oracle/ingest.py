"""DuckDB oracle SQL for normalisation and counters (N*)."""

from __future__ import annotations

from .views import with_views

JSR = "CAST(floor({x} + 0.5) AS {t})"


def js_round(x: str, t: str = "INTEGER") -> str:
    return JSR.format(x=x, t=t)


DELAY_MIN = js_round("CAST(delay_seconds AS DOUBLE) / 60.0", "INTEGER")

NORM = f"""
norm AS (
SELECT *, {js_round("CAST(epoch_us(coalesce(projected_time, scheduled_time)) - epoch_us(sample_time) AS DOUBLE) / 60000000.0")}
    AS ttl_minutes
FROM (
  SELECT * EXCLUDE (delay_seconds, cancelled, sample_time), delay_seconds,
    {DELAY_MIN} AS delay_minutes,
    coalesce(cancelled, false) AS cancelled,
    sample_time IS NULL AS sample_time_fallback,
    coalesce(sample_time, response_ts - to_seconds(CAST(120 AS BIGINT))) AS sample_time
  FROM raw) n0)"""

REL = "(sample_time IS NOT NULL AND abs(ttl_minutes) <= 1440)"


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    wn = with_views("raw", extra=[NORM])
    q["delay_minutes"] = with_views("raw") + f"SELECT sample_id, delay_seconds, {DELAY_MIN} AS delay_minutes FROM raw"
    q["ttl_minutes"] = wn + "SELECT sample_id, sample_time, ttl_minutes FROM norm"
    q["fallback_sample_time"] = wn + ("SELECT sample_id, sample_time, sample_time_fallback, ttl_minutes, cancelled "
                                      "FROM norm WHERE sample_time IS NOT NULL")
    q["relevant_samples"] = wn + f"SELECT sample_id, ttl_minutes, delay_minutes, cancelled FROM norm WHERE {REL}"
    q["response_validation"] = with_views("raw") + """
SELECT status, count(*) AS responses FROM (
  SELECT CASE WHEN r.type IS NULL THEN 'err'
              WHEN r.type NOT IN ('journeys','departures','arrivals','trip','refreshJourney','locations','radar',
                                  'gtfsrtTripUpdate') THEN 'unknown_type'
              WHEN coalesce(c.n, 0) = 0 THEN 'empty' ELSE 'ok' END AS status
  FROM responses r LEFT JOIN (SELECT response_id, count(*) AS n FROM raw GROUP BY response_id) c
    ON r.event_id = c.response_id) t
GROUP BY status"""
    q["response_dedup"] = with_views("responses") + """
SELECT hash, event_id, type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY hash ORDER BY event_id) AS rn
  FROM responses WHERE ts >= TIMESTAMP '2024-01-15 00:00:00') b
WHERE rn = 1 AND hash NOT IN (SELECT hash FROM responses WHERE ts < TIMESTAMP '2024-01-15 00:00:00')"""
    q["sample_dedup"] = with_views("sample") + """
SELECT DISTINCT * EXCLUDE (id) FROM (SELECT * FROM sample UNION ALL SELECT * FROM sample WHERE id % 3 = 0) s"""
    q["response_type_name"] = with_views("responses") + """
SELECT event_id, type_id, CASE type_id WHEN 0 THEN 'journeys' WHEN 1 THEN 'departures' WHEN 2 THEN 'arrivals'
  WHEN 3 THEN 'trip' WHEN 4 THEN 'refreshJourney' END AS name
FROM (SELECT event_id, CAST(CASE type WHEN 'journeys' THEN 0 WHEN 'departures' THEN 1 WHEN 'arrivals' THEN 2 WHEN 'trip' THEN 3
                       WHEN 'radar' THEN 6 END AS SMALLINT) AS type_id FROM responses) r"""
    q["stream_incremental_files"] = "SELECT event_id, event_type FROM events"
    q["remarks_hash"] = with_views("sample", "remarks") + """
SELECT md5(r.remarks) AS remarks_key,
  count(*) AS samples
FROM sample s JOIN remarks r ON s.remarks_hash = r.remarks_hash GROUP BY 1"""
    q["response_log"] = wn + f"""
SELECT response_id, hash,
  CAST(CASE response_type WHEN 'journeys' THEN 0 WHEN 'departures' THEN 1 WHEN 'arrivals' THEN 2 WHEN 'trip' THEN 3
       WHEN 'refreshJourney' THEN 4 WHEN 'locations' THEN 5 WHEN 'radar' THEN 6 WHEN 'gtfsrtTripUpdate' THEN 10
       END AS SMALLINT) AS type,
  coalesce(response_ts, last_sample_time + to_seconds(CAST(120 AS BIGINT))) AS response_time,
  response_ts IS NULL AS response_time_estimated, last_sample_time IS NULL AS sample_time_estimated,
  sample_count
FROM (SELECT response_id, any_value(hash) AS hash, any_value(response_type) AS response_type,
        any_value(response_ts) AS response_ts, max(CASE WHEN {REL} THEN sample_time END) AS last_sample_time,
        CAST(count(*) AS BIGINT) AS sample_count, count(*) FILTER (WHERE {REL}) AS n_rel
      FROM norm GROUP BY response_id) g
WHERE n_rel > 0"""
    ins = "(sample_time IS NOT NULL AND abs(ttl_minutes) <= 1440)"
    q["quality_counters"] = wn + f"""
SELECT response_id, count(*) AS samples, count(delay_minutes) AS rt_samples,
  count(*) FILTER (WHERE sample_time_fallback) AS fallback_sample_time,
  count(*) FILTER (WHERE sample_time IS NULL) AS missing_sample_time,
  count(*) FILTER (WHERE sample_time IS NOT NULL AND abs(ttl_minutes) > 1440) AS outside24h,
  count(*) FILTER (WHERE sample_time IS NOT NULL AND abs(ttl_minutes) > 1440 AND delay_minutes IS NOT NULL)
    AS outside24h_with_rt,
  count(*) FILTER (WHERE sample_time IS NOT NULL AND abs(ttl_minutes) > 259200) AS outside6months,
  count(*) FILTER (WHERE {ins} AND delay_minutes > 720) AS delay_greater_12h,
  count(*) FILTER (WHERE {ins} AND delay_minutes < -50) AS delay_large_negative,
  count(*) FILTER (WHERE {ins} AND cancelled) AS cancelled,
  count(*) FILTER (WHERE {ins}) AS relevant_samples,
  count(*) FILTER (WHERE {ins} AND remarks_hash IS NOT NULL) AS remarks
FROM norm GROUP BY response_id"""
    content = ("trip_id, station_id, is_departure, scheduled_time, projected_time, delay_seconds, cancelled, sample_time, line_name, "
               "product_type_id, operator_id, remarks_hash, load_factor_id, scheduled_duration_minutes, projected_duration_minutes")
    q["load_counters"] = wn + f"""
, twice AS (SELECT * FROM norm UNION ALL SELECT * REPLACE (sample_id + 1000000000000000 AS sample_id) FROM norm WHERE sample_id % 3 = 0),
nth AS (SELECT response_id, hash, row_number() OVER (PARTITION BY {content} ORDER BY response_id, sample_id) AS n FROM twice WHERE {REL}),
known AS (SELECT DISTINCT hash FROM responses WHERE ts < TIMESTAMP '2024-01-15 00:00:00')
SELECT response_id, count(*) AS relevant_samples, count(*) FILTER (WHERE n > 1) AS duplicates,
  count(*) FILTER (WHERE n = 1 AND k.hash IS NOT NULL) AS skipped, count(*) FILTER (WHERE n = 1 AND k.hash IS NULL) AS persisted
FROM nth LEFT JOIN known k ON nth.hash = k.hash GROUP BY response_id"""
    q["rt_count_check"] = with_views("raw", "responses", extra=[NORM]) + """
SELECT count(*) FILTER (WHERE expected - actual <> 0) AS incorrect_rt_count,
  CAST(sum(greatest(expected - actual, 0)) AS BIGINT) AS missing_rts,
  CAST(sum(greatest(actual - expected, 0)) AS BIGINT) AS excess_rts,
  count(*) FILTER (WHERE samples = 0) AS empty_responses,
  CAST(sum(CASE WHEN type = 'radar' THEN samples ELSE 0 END) AS BIGINT) AS samples_from_radar,
  CAST(sum(CASE WHEN type = 'radar' THEN actual ELSE 0 END) AS BIGINT) AS rt_samples_from_radar
FROM (SELECT r.type, len(regexp_extract_all(r.raw, 'TimeR')) AS expected, coalesce(n.actual, 0) AS actual,
        coalesce(n.samples, 0) AS samples
      FROM responses r LEFT JOIN (SELECT response_id, count(delay_minutes) AS actual, count(*) AS samples
                                  FROM norm GROUP BY response_id) n ON r.event_id = n.response_id) p"""
    q["rt_diff_avg"] = wn + f"""
SELECT count(*) AS rt_diff_count, CAST(sum(epoch_us(ts) - epoch_us(last)) AS BIGINT) AS rt_diff_sum_us,
  CAST(sum(epoch_us(ts) - epoch_us(last)) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 1000000.0 AS rt_diff_avg_s
FROM (SELECT response_id, any_value(response_ts) AS ts, max(sample_time) AS last FROM norm WHERE {REL}
      GROUP BY response_id) p WHERE ts IS NOT NULL"""
    q["batch_window"] = """
WITH RECURSIVE files AS (
  SELECT event_id // 10 AS f, arg_min(ts, event_id) AS first,
    arg_max(ts, event_id) + to_minutes(CAST(event_id // 10 * 7919 % 400 AS BIGINT)) AS last
  FROM events GROUP BY event_id // 10),
ends AS (SELECT a.f, min(b.f) AS stop FROM files a LEFT JOIN files b ON b.f >= a.f AND b.last > a.first + INTERVAL 5 DAY GROUP BY a.f),
run AS (
  SELECT 0 AS batch, f, stop FROM ends WHERE f = (SELECT min(f) FROM files)
  UNION ALL
  SELECT r.batch + 1, e.f, e.stop FROM run r JOIN ends e ON e.f = r.stop + 1)
SELECT concat('feeds/', lpad(CAST(files.f AS VARCHAR), 9, '0')) AS path, first, last, CAST(max(batch) AS INTEGER) AS batch
FROM files JOIN run ON run.f <= files.f GROUP BY files.f, first, last"""
    q["pending_files"] = with_views("feed_files") + """
SELECT * FROM feed_files
WHERE path > (SELECT path FROM feed_files WHERE event_id = (SELECT max(event_id) FROM events) // 3)
  AND path < (SELECT path FROM feed_files WHERE event_id = 2 * (SELECT max(event_id) FROM events) // 3)"""
    q["stream_resume_files"] = """
SELECT event_id, event_type FROM (SELECT *, dense_rank() OVER (ORDER BY CAST(ts AS DATE)) AS day FROM events) e
WHERE day > 10 AND day < 20"""
    q["batch_grid"] = wn + f"""
, rel AS (SELECT * FROM norm WHERE {REL})
SELECT CAST(floor(CAST(epoch_us(sample_time) - epoch_us((SELECT min(sample_time) FROM rel)) AS DOUBLE)
                  / (5 * 86400000000.0)) AS INTEGER) AS batch,
  count(*) AS samples, min(sample_time) AS first_sample_time, max(sample_time) AS last_sample_time
FROM rel GROUP BY 1"""
    return q
