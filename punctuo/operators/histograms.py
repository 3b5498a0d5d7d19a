"""Histograms over the fact rows.

Every histogram is an additive ``sum(sample_count)`` over a dimension set, so
Spark's partial (map-side) aggregation shrinks the facts before the shuffle
and a hot dimension value never concentrates rows in one task.
``all_histograms`` computes the four refresh tables in a single pass with
GROUPING SETS (one scan/join of the facts, one shuffle), whose output is
histogram-sized and therefore cheap to persist and split.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..profiles import DE_DB, Profile
from .facts import label_column

BUCKETS_HOUR = ["prior_ttl_bucket", "prior_delay_bucket", "latest_sample_ttl_bucket", "latest_sample_delay_bucket"]
BUCKETS_DURATION = ["prior_ttl_bucket", "prior_delay_bucket", "prior_scheduled_duration_bucket",
                    "prior_projected_duration_bucket", "latest_sample_ttl_bucket", "latest_sample_delay_bucket",
                    "latest_sample_duration_bucket"]

# kind -> (non-bucket dimensions, bucket columns, latest ttl uses the profile hook)
KINDS = {
    "by_hour": (["day_of_week", "hour", "product_type_id", "operator_id", "is_departure", "load_factor_id"],
                BUCKETS_HOUR, True),
    "by_day": (["scheduled_time", "product_type_id", "operator_id", "is_departure"], BUCKETS_HOUR, True),
    "by_station": (["line_name", "product_type_id", "station_id", "operator_id", "is_departure", "load_factor_id"],
                   BUCKETS_HOUR, True),
    "by_duration": (["product_type_id", "is_departure"], BUCKETS_DURATION, False),
}


def _with_time_parts(facts: DataFrame) -> DataFrame:
    return facts.withColumns({
        "day_of_week": (F.dayofweek("scheduled_time") - 1).cast("smallint"),
        "hour": F.hour("scheduled_time").cast("smallint"),
        "_day": F.date_trunc("day", "scheduled_time").cast("timestamp_ntz"),
    })


def _dim_expr(kind: str, name: str):
    if kind == "by_day" and name == "scheduled_time":
        return F.col("_day").alias("scheduled_time")
    return F.col(name)


def _bucket_src(name: str, hooked: bool) -> str:
    if hooked and name == "latest_sample_ttl_bucket":
        return "latest_sample_ttl_bucket_h"
    return name


def histogram(facts: DataFrame, kind: str, profile: Profile = DE_DB, labelled: bool = True) -> DataFrame:
    """A11 by_hour, A12 by_day, A13 by_station, A14 by_duration from fact rows."""
    dims, bcols, hooked = KINDS[kind]
    if kind == "by_station" and profile.gtfs_rollup:
        raise ValueError("by_station is not kept in the GTFS profile")
    f = _with_time_parts(facts) if kind in ("by_hour", "by_day") else facts
    keys = [_dim_expr(kind, d) for d in dims] + [F.col(_bucket_src(b, hooked)).alias(b) for b in bcols]
    h = f.groupBy(*keys).agg(F.sum("sample_count").cast("bigint").alias("sample_count"))
    if not labelled:
        return h
    kinds = {b: ("ttl_h" if hooked and b == "latest_sample_ttl_bucket" else None) for b in bcols}
    return h.select(*dims, *[label_column(b, profile, kinds[b]).alias(b) for b in bcols], "sample_count")


def all_histograms(facts: DataFrame, profile: Profile = DE_DB,
                   keep: Callable[[DataFrame], DataFrame] = DataFrame.persist) -> dict[str, DataFrame]:
    """The four refresh histograms from ONE aggregation (GROUPING SETS).

    Returns labelled DataFrames sharing one histogram-sized parent, kept by ``keep`` (persisted
    unless told otherwise); call ``.unpersist()`` on ``result['_all']`` when done.
    """
    kinds = [k for k in KINDS if not (k == "by_station" and profile.gtfs_rollup)]
    f = _with_time_parts(facts).withColumn("latest_sample_ttl_bucket_raw", F.col("latest_sample_ttl_bucket"))
    cols = []
    sets = []
    for k in kinds:
        dims, bcols, hooked = KINDS[k]
        s = []
        for d in dims:
            src = "_day" if (k == "by_day" and d == "scheduled_time") else d
            s.append(src)
        for b in bcols:
            src = _bucket_src(b, hooked)
            if b == "latest_sample_ttl_bucket" and not hooked:
                src = "latest_sample_ttl_bucket_raw"
            s.append(src)
        sets.append(s)
        cols += [c for c in s if c not in cols]
    view = f"_punctuo_facts_{uuid.uuid4().hex[:12]}"  # unique: concurrent refreshes share a session
    f.createOrReplaceTempView(view)
    spark = facts.sparkSession
    gs = ", ".join("(" + ", ".join(s) + ")" for s in sets)
    agg = spark.sql(
        f"SELECT {', '.join(cols)}, grouping_id() AS _gid, CAST(sum(sample_count) AS BIGINT) AS sample_count "
        f"FROM {view} GROUP BY GROUPING SETS ({gs})")
    agg = keep(agg)
    out: dict[str, DataFrame] = {"_all": agg}
    n = len(cols)
    for k, s in zip(kinds, sets):
        gid = sum(1 << (n - 1 - i) for i, c in enumerate(cols) if c not in s)
        dims, bcols, hooked = KINDS[k]
        part = agg.where(F.col("_gid") == gid)
        sel = []
        for d, src in zip(dims, s[:len(dims)]):
            sel.append(F.col(src).alias(d))
        for b, src in zip(bcols, s[len(dims):]):
            kind = "ttl_h" if (hooked and b == "latest_sample_ttl_bucket") else None
            sel.append(label_column(src, profile, kind or ("ttl" if "ttl" in b else "delay")).alias(b))
        out[k] = part.select(*sel, "sample_count")
    return out


def summed(hist: DataFrame) -> DataFrame:
    """Counts of equal dimensions added up."""
    dims = [c for c in hist.columns if c != "sample_count"]
    return hist.groupBy(*dims).agg(F.sum("sample_count").cast("bigint").alias("sample_count"))


def merge_histogram(stored: DataFrame, delta: DataFrame) -> DataFrame:
    """Additive merge of a stored histogram with new partial counts."""
    return summed(stored.unionByName(delta.select(*stored.columns)))


def without_time(src: DataFrame) -> DataFrame:
    """Roll-up to (product, operator, direction, buckets)."""
    dims = ["product_type_id", "operator_id", "is_departure"] + BUCKETS_HOUR
    return src.groupBy(*dims).agg(F.sum("sample_count").cast("bigint").alias("sample_count"))


def by_month(by_day: DataFrame) -> DataFrame:
    """Roll-up of by_day to (year, month, ...)."""
    return (by_day.groupBy(F.year("scheduled_time").cast("smallint").alias("year"),
                           F.month("scheduled_time").cast("smallint").alias("month"),
                           "product_type_id", "operator_id", "is_departure", *BUCKETS_HOUR)
            .agg(F.sum("sample_count").cast("bigint").alias("sample_count")))


FULL_DIMS = ["scheduled_time", "year", "month", "day", "day_of_week", "hour", "line_name", "product_type_id",
             "station_id", "operator_id", "is_departure"]


def full_histogram(facts: DataFrame, profile: Profile = DE_DB) -> DataFrame:
    """The documented n-dimensional histogram, time parts in UTC."""
    t = F.col("scheduled_time")
    f = facts.select(
        F.date_trunc("hour", t).cast("timestamp_ntz").alias("scheduled_time"),
        F.year(t).cast("smallint").alias("year"), F.month(t).cast("smallint").alias("month"),
        F.dayofmonth(t).cast("smallint").alias("day"), (F.dayofweek(t) - 1).cast("smallint").alias("day_of_week"),
        F.hour(t).cast("smallint").alias("hour"), "line_name", "product_type_id", "station_id", "operator_id",
        "is_departure", *[c for c in BUCKETS_HOUR if c != "latest_sample_ttl_bucket"],
        F.col("latest_sample_ttl_bucket_h").alias("latest_sample_ttl_bucket"), "sample_count")
    h = f.groupBy(*FULL_DIMS, *BUCKETS_HOUR).agg(F.sum("sample_count").cast("bigint").alias("sample_count"))
    kinds = {"latest_sample_ttl_bucket": "ttl_h"}
    return h.select(*FULL_DIMS, *[label_column(b, profile, kinds.get(b)).alias(b) for b in BUCKETS_HOUR],
                    "sample_count")


def with_total(hist: DataFrame) -> DataFrame:
    """Total over all dimensions except operator and the latest delay bucket."""
    from pyspark.sql import Window
    part = [c for c in hist.columns if c not in ("operator_id", "latest_sample_delay_bucket", "sample_count")]
    return hist.withColumn("total_sample_count",
                           F.sum("sample_count").over(Window.partitionBy(*part)).cast("bigint"))
