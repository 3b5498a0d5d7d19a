"""Latest sample per stop event and the per-sample fact rows.

Plan shape (scale notes):

* ``latest_samples``: rows with realtime data or a cancel flag, top-1 per stop
  event by (sample_time desc, ttl asc, id asc). Written as ``row_number() = 1``
  so Catalyst inserts a partial WindowGroupLimit before the shuffle: a hot stop
  event sends at most one row per map task over the network.
* ``facts``: every frozen sample next to the latest of its stop event by one unordered window on
  the four identity columns: one scan and one shuffle of the samples.
* The substitute lookup runs on the hash of cancelled latest samples only.
* Buckets stay small integer ids here (``functions.buckets``); labels are made
  after the histograms aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import buckets as B
from ..profiles import DE_DB, Profile

KEY = ["trip_id", "scheduled_time", "station_id", "is_departure"]

# A8 fixed values: substitute-service markers in remarks
SUBSTITUTE_CODE = "alternative-trip"
SUBSTITUTE_TEXT_PATTERNS = ("%CE 29%", "%C 29%", "%Ersatzfahrt%", "%substitute%")

REMARKS_SCHEMA = "array<struct<code:string,text:string>>"


def freeze_threshold_col(sample: DataFrame) -> Column:
    """A6 as a scalar subquery: hour-truncated (max scheduled_time - 2 days)."""
    thr = F.date_trunc("hour", F.max("scheduled_time") - F.expr("INTERVAL 2 DAYS")).cast("timestamp_ntz")
    return sample.select(thr.alias("freeze_threshold")).scalar()


def freeze_threshold(sample: DataFrame) -> DataFrame:
    """A6 as a one-row DataFrame."""
    thr = F.date_trunc("hour", F.max("scheduled_time") - F.expr("INTERVAL 2 DAYS")).cast("timestamp_ntz")
    return sample.agg(thr.alias("freeze_threshold"))


def substitute_hashes(remarks: DataFrame) -> DataFrame:
    """Distinct remark hashes announcing a substitute service."""
    r = remarks.select("remarks_hash", F.from_json("remarks", REMARKS_SCHEMA).alias("arr"))

    def marks(x: Column) -> Column:
        cond = x["code"] == F.lit(SUBSTITUTE_CODE)
        for p in SUBSTITUTE_TEXT_PATTERNS:
            cond = cond | x["text"].like(p)
        return F.coalesce(cond, F.lit(False))

    return r.where(F.exists("arr", marks)).select("remarks_hash").distinct()


def identified(sample: DataFrame) -> DataFrame:
    """Samples that belong to a stop event: all four key columns known (a NULL equals nothing, and no key may gather them)."""
    return sample.dropna(subset=KEY)


def latest_samples(sample: DataFrame, remarks: DataFrame | None = None,
                   profile: Profile = DE_DB) -> DataFrame:
    """One row per stop event holding its latest informative sample."""
    informative = sample.where(F.col("delay_minutes").isNotNull() | F.col("cancelled"))
    w = Window.partitionBy(*KEY).orderBy(F.col("sample_time").desc(), F.col("ttl_minutes").asc(), F.col("id").asc())
    top = (informative.select(*KEY, "id", "sample_time", "ttl_minutes", "delay_minutes", "cancelled",
                              "projected_duration_minutes", "remarks_hash")
           .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1))
    if profile.substitute_detection and remarks is not None:
        subs = substitute_hashes(remarks).select(F.col("remarks_hash").alias("_sub_hash"))
        top = top.join(subs, top.remarks_hash == subs._sub_hash, "left")
        has_sub = F.col("_sub_hash").isNotNull()
    else:
        has_sub = F.lit(False)
    return top.select(
        *KEY,
        F.col("id").alias("latest_id"),
        F.col("sample_time").alias("latest_sample_time"),
        F.col("ttl_minutes").alias("latest_ttl_minutes"),
        F.when(~F.col("cancelled"), F.col("delay_minutes")).alias("latest_delay_minutes"),
        F.col("projected_duration_minutes").alias("latest_projected_duration_minutes"),
        F.when(F.col("cancelled") & has_sub, True).when(F.col("cancelled"), False)
        .cast("boolean").alias("cancelled_with_substitute"),
    )


def with_latest(sample: DataFrame, remarks: DataFrame | None = None, profile: Profile = DE_DB) -> DataFrame:
    """A7 + A9 in one pass: every sample next to the latest informative one of its stop event.

    One unordered window on the stop event, so the samples are read and shuffled once; the latest is the
    greatest (sample time, -ttl, -id) of the informative rows. Stop events without one drop out, and so do rows
    with a NULL in the key. A stop event
    holds the observations of one arrival or departure, some hundred rows; its window buffer spills.
    """
    own = ["id", "ttl_minutes", "delay_minutes", "cancelled", "projected_duration_minutes", "remarks_hash"]
    s = identified(sample).select(*KEY, *own, "sample_time", "scheduled_duration_minutes", "line_name", "product_type_id",
                      "operator_id", "load_factor_id")
    rank = [F.col("sample_time").alias("t"), F.coalesce(-F.col("ttl_minutes").cast("int"), F.lit(1 << 30)).alias("ttl_first"),
            (-F.col("id")).alias("id_first")]
    informative = F.col("delay_minutes").isNotNull() | F.col("cancelled")
    latest = F.max(F.when(informative, F.struct(*rank, *own))).over(Window.partitionBy(*KEY))
    j = s.withColumn("_latest", latest).where(F.col("_latest").isNotNull())
    has_sub = F.lit(False)
    if profile.substitute_detection and remarks is not None:
        subs = substitute_hashes(remarks).select(F.col("remarks_hash").alias("_sub_hash"))
        gone = F.when(F.col("_latest.cancelled"), F.col("_latest.remarks_hash"))  # only these rows need the lookup
        j = j.withColumn("_gone", gone).join(subs, F.col("_gone") == F.col("_sub_hash"), "left")
        has_sub = F.col("_sub_hash").isNotNull()
    gone = F.col("_latest.cancelled")
    return j.withColumns({
        "latest_id": F.col("_latest.id"), "latest_ttl_minutes": F.col("_latest.ttl_minutes"),
        "latest_delay_minutes": F.when(~gone, F.col("_latest.delay_minutes")),
        "latest_projected_duration_minutes": F.col("_latest.projected_duration_minutes"),
        "cancelled_with_substitute": F.when(gone & has_sub, True).when(gone, False).cast("boolean")})


def _relative_bucket(is_latest: Column, own: Column, latest: Column, cws: Column) -> Column:
    rel = F.when(is_latest | own.isNull(), latest.cast("int")).otherwise(latest.cast("int") - own.cast("int"))
    return F.when(cws == F.lit(True), F.lit(B.SUBSTITUTE_ID).cast("tinyint")).otherwise(B.delay_bucket_id(rel))


def facts(sample: DataFrame, remarks: DataFrame | None = None, profile: Profile = DE_DB,
          threshold: Column | None = None) -> DataFrame:
    """A9 + A10: one fact row per frozen sample (bucket ids, ``sample_count``).

    ``threshold`` defaults to the A6 scalar over the same ``sample``.
    """
    thr = freeze_threshold_col(sample) if threshold is None else threshold
    frozen = sample.where(F.col("scheduled_time") < thr)
    j = with_latest(frozen, remarks, profile)
    j = j.where(~F.col("cancelled") | (F.col("latest_id") == F.col("id")))
    is_latest = F.col("latest_id") == F.col("id")
    cws = F.col("cancelled_with_substitute")
    latest_ttl = B.ttl_bucket_id(F.col("latest_ttl_minutes"))
    if profile.reduced_latest_ttl:
        pairs = [(i, B.REDUCED_TTL_TARGETS.index(lab)) for i, lab in B.REDUCED_OF_TTL_ID.items() if lab]
        hooked = F.lit(None).cast("tinyint")
        for i, r in pairs:
            hooked = F.when(latest_ttl == F.lit(i), F.lit(r).cast("tinyint")).otherwise(hooked)
    else:
        hooked = latest_ttl
    if profile.gtfs_rollup:
        sched = F.date_trunc("hour", F.col("scheduled_time")).cast("timestamp_ntz")
        line, station, oper = (F.lit(None).cast("string"), F.lit(None).cast("string"),
                               F.lit(None).cast("smallint"))
    else:
        sched, line, station, oper = (F.col("scheduled_time"), F.col("line_name"), F.col("station_id"),
                                      F.col("operator_id"))
    out = j.select(
        sched.alias("scheduled_time"),
        line.alias("line_name"),
        "product_type_id",
        station.alias("station_id"),
        oper.alias("operator_id"),
        "is_departure",
        "load_factor_id",
        F.when(~is_latest, B.ttl_bucket_id(F.col("ttl_minutes"))).alias("prior_ttl_bucket"),
        F.when(~is_latest, B.delay_bucket_id(F.col("delay_minutes"))).alias("prior_delay_bucket"),
        B.delay_bucket_id(F.col("scheduled_duration_minutes")).alias("prior_scheduled_duration_bucket"),
        F.when(~is_latest, B.delay_bucket_id(F.col("projected_duration_minutes"))).alias("prior_projected_duration_bucket"),
        latest_ttl.alias("latest_sample_ttl_bucket"),
        hooked.alias("latest_sample_ttl_bucket_h"),
        _relative_bucket(is_latest, F.col("delay_minutes"), F.col("latest_delay_minutes"), cws)
        .alias("latest_sample_delay_bucket"),
        _relative_bucket(is_latest, F.col("projected_duration_minutes"),
                         F.col("latest_projected_duration_minutes"), cws).alias("latest_sample_duration_bucket"),
        F.lit(1).cast("bigint").alias("sample_count"),
    )
    if profile.gtfs_rollup:
        dims = [c for c in out.columns if c != "sample_count"]
        out = out.groupBy(*dims).agg(F.count(F.lit(1)).cast("bigint").alias("sample_count"))
    return out


def retain(sample: DataFrame, threshold: Column | None = None) -> DataFrame:
    """Samples still open (scheduled at or after the freeze threshold)."""
    thr = freeze_threshold_col(sample) if threshold is None else threshold
    return sample.where(F.col("scheduled_time") >= thr)


def label_facts(df: DataFrame, profile: Profile = DE_DB) -> DataFrame:
    """Replace bucket ids by range labels (output edge)."""
    return df.select(*[label_column(c, profile).alias(c) if c in LABEL_KIND else F.col(c) for c in df.columns])


LABEL_KIND = {
    "prior_ttl_bucket": "ttl",
    "prior_delay_bucket": "delay",
    "prior_scheduled_duration_bucket": "delay",
    "prior_projected_duration_bucket": "delay",
    "latest_sample_ttl_bucket": "ttl",
    "latest_sample_ttl_bucket_h": "ttl_h",
    "latest_sample_delay_bucket": "delay",
    "latest_sample_duration_bucket": "delay",
}


def label_column(name: str, profile: Profile = DE_DB, kind: str | None = None) -> Column:
    kind = kind or LABEL_KIND[name]
    c = F.col(name)
    if kind == "delay":
        return B.delay_label(c)
    if kind == "ttl_h" and profile.reduced_latest_ttl:
        return B._label_of(c, list(B.REDUCED_TTL_TARGETS))
    return B.ttl_label(c)
