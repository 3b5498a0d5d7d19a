"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuo.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the cluster names in ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts lineage, survives lost executors.

    The schema is known, so no job looks for it in the files.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(spark: SparkSession) -> int:
    """Partitions for a keyed shuffle: the session's setting, which the cluster sizes to its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def schema_with(df: DataFrame, *more: str) -> str:
    """DDL of ``df`` with further columns ``name type`` behind it."""
    own = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return ", ".join([*own, *more])


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def one_row_each(rows: DataFrame, keep: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``rows`` whose ``keys`` are in ``keep`` (nulls alike), one for each key; all columns of ``rows``.

    The keys are one struct, so the window runs on the join's own partitioning and order, and it streams
    (row_number has no frame to hold): the rows are shuffled once.
    """
    from pyspark.sql import Window

    key, nth = fresh(rows, "of"), fresh(rows, "nth")
    of = F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keys)])
    joined = rows.withColumn(key, of).join(keep.select(of.alias(key)).distinct(), key, "left_semi")
    w = Window.partitionBy(key).orderBy(key)
    return joined.withColumn(nth, F.row_number().over(w)).filter(F.col(nth) == 1).drop(key, nth)
