"""Official punctuality figures (S16) and the comparison with own statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import buckets as B

MONTHS = [str(m) for m in range(1, 13)]
THRESHOLD_COL = "< VERSPÄTUNG"
# own punctuality uses the delay bucket edges 6 and 16 (there is no edge at 5 or 15)
OWN_EDGES = {5: "(,6)", 15: "(,16)"}


def read_official_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read the published CSV (header row, a blank second line, missing cells allowed)."""
    raw = spark.read.csv(path, header=True, encoding="UTF-8")
    return raw.where(F.col(raw.columns[0]).isNotNull() & (F.trim(F.col(raw.columns[0])) != ""))


def official_long(wide: DataFrame) -> DataFrame:
    """Wide (year, area, threshold, 12 months) -> long (year, month, category, threshold, pct)."""
    stacked = wide.select(
        F.col(wide.columns[0]).cast("smallint").alias("year"), F.col(wide.columns[1]).alias("category"),
        F.col(THRESHOLD_COL).cast("int").alias("threshold"),
        *[F.col(f"`{m}`").cast("double").alias(f"m{m}") for m in MONTHS])
    long = stacked.unpivot(["year", "category", "threshold"], [f"m{m}" for m in MONTHS], "mname", "pct")
    return long.select("year", F.substring("mname", 2, 2).cast("smallint").alias("month"), "category", "threshold",
                       "pct")


def official_delay_stats(long: DataFrame) -> DataFrame:
    """Table shape of the reference: one row per (year, month, category), both thresholds as columns."""
    return long.groupBy("year", "month", "category").agg(
        F.max(F.when(F.col("threshold") == 5, F.col("pct"))).alias("delay_percentage_5min"),
        F.max(F.when(F.col("threshold") == 15, F.col("pct"))).alias("delay_percentage_15min"))


def official_comparison(by_month: DataFrame, stats: DataFrame, mapping: DataFrame) -> DataFrame:
    """Own monthly punctuality per official category next to the official figures.

    Own share = final (latest-sample) delays below 6 resp. 16 minutes among
    stop events that ran (cancelled rows excluded), in percent.
    """
    h = by_month.where(F.col("prior_ttl_bucket").isNull() & F.col("latest_sample_delay_bucket").isNotNull()
                       & (F.col("latest_sample_delay_bucket") != B.UNBOUNDED))
    h = h.withColumn("operator", F.col("operator_id").cast("string"))
    b = F.col("latest_sample_delay_bucket")
    j = h.join(mapping, "operator")
    own = j.groupBy("year", "month", "category").agg(
        F.sum("sample_count").cast("bigint").alias("stop_events"),
        F.sum(F.when(B.contained_in(b, OWN_EDGES[5]), F.col("sample_count")).otherwise(0)).cast("bigint")
        .alias("on_time_6"),
        F.sum(F.when(B.contained_in(b, OWN_EDGES[15]), F.col("sample_count")).otherwise(0)).cast("bigint")
        .alias("on_time_16"))
    own = own.withColumns({
        "own_percentage_6min": F.col("on_time_6") * F.lit(100.0) / F.col("stop_events"),
        "own_percentage_16min": F.col("on_time_16") * F.lit(100.0) / F.col("stop_events")})
    return own.join(stats, ["year", "month", "category"], "inner")
