"""DuckDB oracle SQL for response readers."""

from __future__ import annotations

from .views import with_views

UNWRAP = """
env AS (
SELECT event_id, value, CASE WHEN json_valid(value) THEN coalesce(
    CASE WHEN json_extract_string(value, '$[1]') = 'res' THEN json_extract_string(value, '$[2]') END,
    CASE WHEN json_extract(json_extract_string(value, '$.log'), '$.svcResL') IS NOT NULL
         THEN json_extract_string(value, '$.log') END,
    CASE WHEN json_extract(value, '$.svcResL') IS NOT NULL THEN value END) END AS res
FROM hafas_log_lines)"""

TYPE = """CASE CASE WHEN json_extract_string(res, '$.svcResL[0].meth') = 'StationBoard'
                    AND json_extract(res, '$.svcResL[0].res') IS NOT NULL
               THEN json_extract_string(res, '$.svcResL[0].res.type')
               ELSE json_extract_string(res, '$.svcResL[0].meth') END
  WHEN 'DEP' THEN 'departures' WHEN 'ARR' THEN 'arrivals' WHEN 'JourneyDetails' THEN 'trip'
  WHEN 'TripSearch' THEN 'journeys' WHEN 'JourneyGeoPos' THEN 'radar' WHEN 'LocMatch' THEN 'locations'
  WHEN 'Reconstruction' THEN 'refreshJourney' END"""


def queries() -> dict[str, str]:
    q: dict[str, str] = {}
    h = with_views("hafas_log_lines", extra=[UNWRAP])
    q["hafas_envelope"] = h + ("SELECT event_id, json_extract_string(res, '$.svcResL[0].meth') AS meth, "
                               "md5(value) AS hash FROM env WHERE res IS NOT NULL")
    q["hafas_response_type"] = h + f"SELECT event_id, {TYPE} AS type FROM env WHERE res IS NOT NULL"
    q["expected_rt_count"] = h + ("SELECT event_id, CAST((length(value) - length(replace(value, 'TimeR', ''))) / 5 "
                                  "AS INTEGER) AS expected_rt_count FROM env WHERE res IS NOT NULL")
    q["access_log_meta"] = with_views("access_log_lines") + """
SELECT event_id, strptime(split_part(m1, ' ', 1), '%d/%b/%Y:%H:%M:%S') AS ts,
  NULLIF(regexp_extract(m2, '/(departures|arrivals|trips|journeys)', 1), '') AS type
FROM (SELECT event_id, regexp_extract(value, '^\\[(.*?)\\] "GET (.*?)" 200', 1) AS m1,
        regexp_extract(value, '^\\[(.*?)\\] "GET (.*?)" 200', 2) AS m2 FROM access_log_lines) x
WHERE m1 <> ''"""
    q["log_entries"] = """
SELECT date_trunc('second', ts) AS ts,
  CASE event_type WHEN 'view' THEN 'departures' WHEN 'click' THEN 'arrivals' WHEN 'signup' THEN 'trips'
                  WHEN 'purchase' THEN 'journeys' END AS type,
  CASE WHEN event_id % 50 <> 7 THEN md5(concat('{"departures":[{"delay":', CAST(user_id AS VARCHAR), '}],', chr(10), '"id":',
                                                CAST(event_id AS VARCHAR), '}')) END AS hash,
  CASE WHEN event_id % 50 = 7 THEN 'BadGzipFile' END AS err
FROM events"""
    return q
