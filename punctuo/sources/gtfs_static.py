"""GTFS static tables from their CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_static(spark: SparkSession, path: str, columns: list[str], key: str | None = None, version: str | None = None) -> DataFrame:
    """A GTFS table: only ``columns`` (NULL where the file lacks one), text as it is.

    A byte order mark before the first name is dropped. Of rows with the same ``key`` the last of the
    file wins (files are read in path order). ``version`` becomes the ``gtfs_version`` column that keeps the
    tables of several timetables apart.
    """
    raw = spark.read.option("header", True).option("escape", '"').option("multiLine", False).csv(path)
    have = {c.lstrip("﻿").strip(): c for c in raw.columns}
    cols = [F.col(f"`{have[c]}`").alias(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns]
    tag = [F.lit(version).alias("gtfs_version")] if version is not None else []
    if key is None:
        return raw.select(*tag, *cols)
    df = raw.select(*tag, *cols, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"),
                    F.monotonically_increasing_id().alias("_nr"))
    w = Window.partitionBy(key).orderBy(F.col("_file").desc(), F.col("_at").desc(), F.col("_nr").desc())
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_file", "_at", "_nr")
