"""Normalise, filter, deduplicate and measure extracted samples.

Everything here is row-local (``select``/``where``) except the per-response
counters, which are one ``groupBy(response)`` with partial aggregation, and the
dedupes, which hash-partition on the dedupe key (``dropDuplicates`` keeps one
row per key map-side before the shuffle, so a repeated hash never piles up).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.buckets import js_round, minutes_from_seconds

# fixed values of the ingest path
FALLBACK_RT_DIFF_S = 120          # sample time fallback: response time minus this
RELEVANT_TTL_MIN = 24 * 60        # samples further than this from the event are dropped
OUTSIDE_6_MONTHS_MIN = 6 * 30 * 24 * 60
DELAY_12H_MIN = 12 * 60
DELAY_LARGE_NEGATIVE_MIN = -50
BATCH_DAYS = 5
RESPONSE_TYPE_IDS = {"journeys": 0, "departures": 1, "arrivals": 2, "trip": 3, "refreshJourney": 4,
                     "locations": 5, "radar": 6, "gtfsrtTripUpdate": 10}


def minutes_between(later: Column, earlier: Column) -> Column:
    """(later - earlier) in minutes, JS-rounded."""
    return js_round(F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(60_000_000.0))


def normalise(raw: DataFrame, response_ts: str = "response_ts") -> DataFrame:
    """Minutes, cancel flag, fallback sample time, ttl (after the fallback)."""
    st = F.col("sample_time")
    fallback = F.timestamp_add("SECOND", F.lit(-FALLBACK_RT_DIFF_S), F.col(response_ts))
    return raw.withColumns({
        "delay_minutes": minutes_from_seconds(F.col("delay_seconds")),
        "cancelled": F.coalesce(F.col("cancelled"), F.lit(False)),
        "sample_time_fallback": st.isNull(),
        "sample_time": F.coalesce(st, fallback),
    }).withColumn(
        "ttl_minutes",
        minutes_between(F.coalesce(F.col("projected_time"), F.col("scheduled_time")), F.col("sample_time"))
        .try_cast("int"))


def with_sample_time(df: DataFrame) -> DataFrame:
    """Drop rows still without a sample time."""
    return df.where(F.col("sample_time").isNotNull())


def relevant(df: DataFrame) -> DataFrame:
    """Keep samples within a day of the event (abs(ttl) <= 1440)."""
    return with_sample_time(df).where(F.abs(F.col("ttl_minutes")) <= F.lit(RELEVANT_TTL_MIN))


def response_status(responses: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Error / unknown type / empty / ok per response."""
    r = responses
    if samples is not None:
        cnt = samples.groupBy("response_id").agg(F.count(F.lit(1)).alias("_n"))
        r = r.join(cnt, r.event_id == cnt.response_id, "left").drop("response_id")
        empty = F.coalesce(F.col("_n"), F.lit(0)) == 0
    else:
        empty = F.lit(False)
    known = F.col("type").isin(list(RESPONSE_TYPE_IDS))
    status = (F.when(F.col("type").isNull(), "err").when(~known, "unknown_type").when(empty, "empty")
              .otherwise("ok"))
    return r.withColumn("status", status).drop("_n")


def new_responses(batch: DataFrame, stored_log: DataFrame, order: str = "event_id") -> DataFrame:
    """First response per hash in the batch, minus hashes already stored."""
    w = Window.partitionBy("hash").orderBy(F.col(order))
    first = batch.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    return first.join(stored_log.select("hash"), "hash", "left_anti")


def dedup_samples(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop samples identical in every (content) column."""
    return df.dropDuplicates(cols) if cols else df.dropDuplicates()


def remarks_key(remarks_json: Column) -> Column:
    """md5 of the whole remarks array as compact JSON text, every field of it."""
    return F.md5(F.get_json_object(remarks_json, "$"))


def response_type_id(col: Column) -> Column:
    out = F.lit(None).cast("smallint")
    for k, v in RESPONSE_TYPE_IDS.items():
        out = F.when(col == F.lit(k), F.lit(v).cast("smallint")).otherwise(out)
    return out


def response_log(norm: DataFrame) -> DataFrame:
    """One log row per response holding relevant samples.

    Time falls back to the last relevant sample time + 120 s; ``sample_count``
    counts every extracted sample of the response.
    """
    rel = F.col("sample_time").isNotNull() & (F.abs(F.col("ttl_minutes")) <= F.lit(RELEVANT_TTL_MIN))
    g = norm.groupBy("response_id").agg(
        F.first("hash").alias("hash"), F.first("response_type").alias("response_type"),
        F.first("response_ts").alias("response_ts"),
        F.max(F.when(rel, F.col("sample_time"))).alias("last_sample_time"),
        F.count(F.lit(1)).cast("bigint").alias("sample_count"),
        F.count_if(rel).alias("_relevant")).where(F.col("_relevant") > 0)
    return g.select(
        "response_id", "hash", response_type_id(F.col("response_type")).alias("type"),
        F.coalesce(F.col("response_ts"), F.timestamp_add("SECOND", F.lit(FALLBACK_RT_DIFF_S), F.col("last_sample_time")))
        .alias("response_time"),
        F.col("response_ts").isNull().alias("response_time_estimated"),
        F.col("last_sample_time").isNull().alias("sample_time_estimated"),
        "sample_count")


def quality(norm: DataFrame) -> DataFrame:
    """Quality counters per response, one aggregation."""
    d, ttl, st = F.col("delay_minutes"), F.abs(F.col("ttl_minutes")), F.col("sample_time")
    has_t = st.isNotNull()
    inside = has_t & (ttl <= RELEVANT_TTL_MIN)
    return norm.groupBy("response_id").agg(
        F.count(F.lit(1)).alias("samples"),
        F.count(d).alias("rt_samples"),
        F.count_if(F.col("sample_time_fallback")).alias("fallback_sample_time"),
        F.count_if(~has_t).alias("missing_sample_time"),
        F.count_if(has_t & (ttl > RELEVANT_TTL_MIN)).alias("outside24h"),
        F.count_if(has_t & (ttl > RELEVANT_TTL_MIN) & d.isNotNull()).alias("outside24h_with_rt"),
        F.count_if(has_t & (ttl > OUTSIDE_6_MONTHS_MIN)).alias("outside6months"),
        F.count_if(inside & (d > DELAY_12H_MIN)).alias("delay_greater_12h"),
        F.count_if(inside & (d < DELAY_LARGE_NEGATIVE_MIN)).alias("delay_large_negative"),
        F.count_if(inside & F.col("cancelled")).alias("cancelled"),
        F.count_if(inside).alias("relevant_samples"),
        F.count_if(inside & F.col("remarks_hash").isNotNull()).alias("remarks"),
    )


def load_counters(norm: DataFrame, stored_log: DataFrame, content: list[str]) -> DataFrame:
    """Per response, relevant samples that are ``duplicates``, ``skipped`` (their response is stored already) or ``persisted``.

    A sample is a duplicate of an earlier one (by response, then sample id) with the same MD5 of its ``content``; a
    response whose hash the log has is skipped with all that is left of it. Samples are dealt out once, by the MD5's bytes,
    and counted by response and hash; the log meets the counts, not the samples.
    """
    rel = relevant(norm).select("response_id", "sample_id", "hash", F.unhex(F.md5(F.to_json(
        F.struct(*content), {"ignoreNullFields": "false"}))).alias("_md5"))
    w = Window.partitionBy("_md5").orderBy("response_id", "sample_id")
    again = F.row_number().over(w) > 1
    known = stored_log.select(F.col("hash").alias("_hash")).distinct()
    per = rel.withColumn("_again", again).groupBy("response_id", "hash").agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(F.col("_again")).alias("_twice"))
    per = per.join(known, F.col("hash") == F.col("_hash"), "left")
    rest, stored = F.col("_all") - F.col("_twice"), F.col("_hash").isNotNull()
    return per.groupBy("response_id").agg(
        F.sum("_all").alias("relevant_samples"), F.sum("_twice").alias("duplicates"),
        F.sum(F.when(stored, rest).otherwise(0)).alias("skipped"), F.sum(F.when(stored, 0).otherwise(rest)).alias("persisted"))


def rt_count_check(responses: DataFrame, norm: DataFrame) -> DataFrame:
    """Expected (S7, ``expected_rt_count``) vs extracted realtime count per response, then totals.

    Driven by the responses, so one without any sample counts as empty.
    """
    n = norm.groupBy("response_id").agg(F.count("delay_minutes").alias("_rt"), F.count(F.lit(1)).alias("_all"))
    per = (responses.join(n, responses.event_id == n.response_id, "left")
           .select("type", F.col("expected_rt_count").alias("expected"), F.coalesce("_rt", F.lit(0)).alias("actual"),
                   F.coalesce("_all", F.lit(0)).alias("samples")))
    diff = F.col("expected") - F.col("actual")
    radar = F.col("type") == "radar"
    return per.agg(
        F.count_if(diff != 0).alias("incorrect_rt_count"),
        F.sum(F.greatest(diff, F.lit(0))).cast("bigint").alias("missing_rts"),
        F.sum(F.greatest(-diff, F.lit(0))).cast("bigint").alias("excess_rts"),
        F.count_if(F.col("samples") == 0).alias("empty_responses"),
        F.sum(F.when(radar, F.col("samples")).otherwise(0)).cast("bigint").alias("samples_from_radar"),
        F.sum(F.when(radar, F.col("actual")).otherwise(0)).cast("bigint").alias("rt_samples_from_radar"))


def rt_diff_avg(norm: DataFrame) -> DataFrame:
    """Mean lag between response time and its last relevant sample time.

    Summed as exact integer microseconds, divided once at the end.
    """
    per = relevant(norm).groupBy("response_id").agg(F.first("response_ts").alias("ts"),
                                                   F.max("sample_time").alias("last"))
    lag = F.timestamp_diff("MICROSECOND", F.col("last"), F.col("ts"))
    g = per.where(F.col("ts").isNotNull()).agg(F.count(F.lit(1)).alias("rt_diff_count"),
                                               F.sum(lag).cast("bigint").alias("rt_diff_sum_us"))
    return g.withColumn("rt_diff_avg_s", F.col("rt_diff_sum_us").cast("double") / F.col("rt_diff_count").cast("double")
                        / F.lit(1e6))


def batch_id(sample_time: Column, origin: Column, days: int = BATCH_DAYS) -> Column:
    """Index of the ``days``-wide batch of sample time since ``origin``."""
    return F.floor(F.timestamp_diff("MICROSECOND", origin, sample_time) / F.lit(days * 86_400_000_000.0)).cast("int")
