"""Answering the question (C1-C5): distributions read off the histograms.

All of these read histogram-sized inputs: the ratio windows partition by a
handful of bucket columns whose cardinality is fixed by the bucket edges,
not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import buckets as B

GROUP = ["product_type_id", "is_departure"]


def _distribution(h: DataFrame, cond_cols: list[str]) -> DataFrame:
    keys = GROUP + cond_cols
    g = h.groupBy(*keys, "latest_sample_delay_bucket").agg(F.sum("sample_count").cast("bigint").alias("sample_count"))
    tot = F.sum("sample_count").over(Window.partitionBy(*keys)).cast("bigint")
    return (g.withColumn("total_sample_count", tot)
            .withColumn("probability", F.col("sample_count").cast("double") / F.col("total_sample_count").cast("double")))


def _accuracy(h: DataFrame, accuracy: str | None) -> DataFrame:
    if accuracy is None:
        return h
    return h.where(B.contained_in(F.col("latest_sample_ttl_bucket"), accuracy))


def conditional_delay(hist: DataFrame, prior_ttl: str | None = None, prior_delay: str | None = None,
                      accuracy: str | None = None) -> DataFrame:
    """P(final delay bucket | prior delay bucket, prior ttl bucket).

    ``hist`` is any histogram with the four bucket columns and product/direction
    (by_hour, without_time, ...). Optional literal filters pick one condition.
    """
    h = _accuracy(hist.where(F.col("prior_delay_bucket").isNotNull()), accuracy)
    if prior_ttl is not None:
        h = h.where(F.col("prior_ttl_bucket") == prior_ttl)
    if prior_delay is not None:
        h = h.where(F.col("prior_delay_bucket") == prior_delay)
    return _distribution(h, ["prior_ttl_bucket", "prior_delay_bucket"])


def final_delay(hist: DataFrame, accuracy: str | None = None) -> DataFrame:
    """Unconditional final delay distribution (rows of the latest samples)."""
    h = _accuracy(hist.where(F.col("prior_ttl_bucket").isNull()), accuracy)
    return _distribution(h, [])


def accuracy_filter(hist: DataFrame, accuracy: str = "(-10,10]") -> DataFrame:
    """C1 restricted to latest samples taken inside ``accuracy`` of the event."""
    return conditional_delay(hist, accuracy=accuracy)


def cancellation_rate(by_day: DataFrame) -> DataFrame:
    """C4: per day and product, final outcomes split into running / cancelled / substituted."""
    h = by_day.where(F.col("prior_ttl_bucket").isNull())
    b = F.col("latest_sample_delay_bucket")
    g = h.groupBy("scheduled_time", "product_type_id").agg(
        F.sum("sample_count").cast("bigint").alias("stop_events"),
        F.sum(F.when(b.isNull(), F.col("sample_count")).otherwise(0)).cast("bigint").alias("cancelled"),
        F.sum(F.when(b == B.UNBOUNDED, F.col("sample_count")).otherwise(0)).cast("bigint")
        .alias("cancelled_with_substitute"))
    return g.withColumn("cancelled_share", F.col("cancelled").cast("double") / F.col("stop_events").cast("double"))


def rt_availability(sample: DataFrame) -> DataFrame:
    """Share of samples carrying realtime data per ttl bucket and product."""
    g = sample.groupBy(B.ttl_bucket_id(F.col("ttl_minutes")).alias("_t"), "product_type_id").agg(
        F.count(F.lit(1)).cast("bigint").alias("samples"),
        F.count("delay_minutes").cast("bigint").alias("rt_samples"),
        F.count_if(F.col("cancelled")).cast("bigint").alias("cancelled_samples"))
    return g.select(B.ttl_label(F.col("_t")).alias("ttl_bucket"), "product_type_id", "samples", "rt_samples",
                    "cancelled_samples",
                    (F.col("rt_samples").cast("double") / F.col("samples").cast("double")).alias("rt_share"))
