"""Raw response readers: HAFAS log envelopes and access-log headers.

Line-oriented text is read with ``spark.read.text`` (bz2 splits, gzip does
not) and every function here is a per-row column expression: no parsing
library, no Python in the data path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: HAFAS method / board type -> response type
HAFAS_TYPES = {"DEP": "departures", "ARR": "arrivals", "JourneyDetails": "trip", "TripSearch": "journeys",
               "JourneyGeoPos": "radar", "LocMatch": "locations", "Reconstruction": "refreshJourney"}
HAFAS_RT_MARKER = "TimeR"
FPTF_RT_PATTERN = r'elay": \d+'
ACCESS_LOG_RE = r'^\[(.*?)\] "GET (.*?)" 200'
ACCESS_LOG_TS = "dd/MMM/yyyy:HH:mm:ss Z"
ACCESS_LOG_TYPES = r"/(departures|arrivals|trips|journeys)"


def unwrap_envelope(value: Column) -> Column:
    """The HAFAS response JSON inside one log line, or NULL.

    ``[_, "res", "<json>"]`` -> element 2; ``{"log": "<json>"}`` with ``svcResL`` -> log;
    bare ``{"svcResL": ...}`` -> the line itself.
    """
    arr_res = F.when(F.get_json_object(value, "$[1]") == "res", F.get_json_object(value, "$[2]"))
    log = F.get_json_object(value, "$.log")
    log_res = F.when(F.get_json_object(log, "$.svcResL").isNotNull(), log)
    bare = F.when(F.get_json_object(value, "$.svcResL").isNotNull(), value)
    return F.coalesce(arr_res, log_res, bare)


def response_type(res: Column) -> Column:
    """``svcResL[0].meth``; a StationBoard takes its ``res.type``; mapped, else NULL."""
    meth = F.get_json_object(res, "$.svcResL[0].meth")
    board = F.get_json_object(res, "$.svcResL[0].res.type")
    has_res = F.get_json_object(res, "$.svcResL[0].res").isNotNull()
    key = F.when((meth == "StationBoard") & has_res, board).otherwise(meth)
    out = F.lit(None).cast("string")
    for k, v in HAFAS_TYPES.items():
        out = F.when(key == F.lit(k), F.lit(v)).otherwise(out)
    return out


def expected_rt(raw: Column, kind: str = "hafas") -> Column:
    """Number of realtime fields announced in the raw text."""
    if kind == "hafas":
        return F.regexp_count(raw, F.lit(HAFAS_RT_MARKER)).cast("int")
    return F.regexp_count(raw, F.lit(FPTF_RT_PATTERN)).cast("int")


def hafas_responses(lines: DataFrame, value: str = "value") -> DataFrame:
    """S5-S7 over a text DataFrame: one row per recognised response (others skipped)."""
    v = F.col(value)
    res = unwrap_envelope(v)
    df = lines.select("*", res.alias("res")).where(F.col("res").isNotNull())
    return df.select("*", response_type(F.col("res")).alias("type"), expected_rt(v).alias("expected_rt_count"),
                     F.md5(v).alias("hash"))


def log_meta(line: Column) -> Column:
    """Access-log header -> struct<ts, type> (NULL if not a 200 GET line; ``ts`` NULL if it is no date)."""
    ts_txt = F.regexp_extract(line, ACCESS_LOG_RE, 1)
    path = F.regexp_extract(line, ACCESS_LOG_RE, 2)
    ts = F.try_to_timestamp(ts_txt, F.lit(ACCESS_LOG_TS)).cast("timestamp_ntz")
    typ = F.regexp_extract(path, ACCESS_LOG_TYPES, 1)
    return F.when(ts_txt != "", F.struct(ts.alias("ts"), F.when(typ != "", typ).alias("type")))
