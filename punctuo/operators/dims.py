"""Dimension maintenance: surrogate keys, upserts, first-per-key.

Without a table format every write is "build the new version, then swap"
(``sinks.commit``); these functions compute the new version.
Dimensions are small next to the facts, but nothing here assumes it: key
assignment numbers the *new* keys only (distinct values, not rows) in two passes and lookups are equi-joins that AQE may broadcast by runtime size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Keys of a dictionary that is sent to all executors, some MB at most.
BROADCAST_KEYS = 50_000


def zip_rows(df: DataFrame, arrays: list[str], names: list[str] | None = None) -> DataFrame:
    """Parallel arrays -> one row per index (``UNNEST(a, b, ...)``)."""
    names = names or arrays
    z = F.arrays_zip(*[F.col(a).alias(n) for a, n in zip(arrays, names)])
    keep = [c for c in df.columns if c not in arrays]
    return df.select(*keep, F.inline(z))


def numbered(df: DataFrame, order: str) -> DataFrame:
    """``df`` with ``_nr``, 1, 2, ... in ``order``, without all rows in one task.

    Rows are range-partitioned and sorted; the partitions are numbered locally, and the sum of the counts of
    the partitions before (one number for each partition) is added. The checkpoint keeps the range
    bounds the same for both passes.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = F.monotonically_increasing_id()  # (partition << 33) + place
    rows = (df.repartitionByRange(n, order).sortWithinPartitions(order)
            .select("*", F.shiftright(low, 33).alias("_part"), low.bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"))
            .checkpoint())
    count = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    base = count.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    return (rows.join(base, "_part").withColumn("_nr", F.col("_before") + F.col("_place") + 1)
            .drop("_part", "_place", "_before"))


def assign_ids(dim: DataFrame, values: DataFrame, key: str, id_col: str) -> tuple[DataFrame, DataFrame]:
    """D3: add unseen natural keys to ``dim`` with ids after max(id); map ``values.key`` to ids.

    Returns (new dimension, values with ``id_col`` replacing ``key``). NULL keys stay NULL.
    """
    seen = values.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    missing = seen.join(dim.select(key), key, "left_anti")
    base = dim.select(F.coalesce(F.max(id_col), F.lit(0)).alias("_base"))
    new = (numbered(missing, key).crossJoin(base)
           .select((F.col("_base") + F.col("_nr")).cast(dim.schema[id_col].dataType).alias(id_col), key))
    dim2 = dim.select(id_col, key).unionByName(new)
    mapped = values.join(dim2.withColumnRenamed(key, "_k"), F.col(key) == F.col("_k"), "left").drop("_k", key)
    return dim2, mapped


def assign_all(stored: DataFrame, values: DataFrame, columns: dict[str, str], names: dict[str, str] | None = None,
               auto_ids: bool = True) -> tuple[DataFrame, DataFrame]:
    """D3 for several dimensions in one pass: (new ``stored``, ``values`` with an id column for each natural key).

    ``stored`` holds all dimensions, ``dim, id, key, name``. ``columns`` says which column of ``values`` has a dimension's
    keys, ``names`` which has their names. The columns are unpivoted to (dim, key, name) and made distinct in hash maps before
    the shuffle (a minimum of texts alone would sort every row); keys not stored yet get the ids behind their dimension's
    greatest, in key order, by one numbering for all dimensions. The written dictionary then replaces each column by
    ``<dim>_id``: broadcast where it has at most ``BROADCAST_KEYS`` keys, so that ``values`` isn't dealt out by columns of
    few values, else by equi-joins; NULL stays NULL. Without ``auto_ids`` (the job gives ids itself) both stay as they are.
    """
    if not auto_ids:
        return stored, values
    names = names or {}
    null = F.lit(None).cast("string")
    each = F.array(*[F.struct(F.lit(dim).alias("dim"), F.col(c).cast("string").alias("key"),
                              (F.col(names[dim]).cast("string") if dim in names else null).alias("name")) for dim, c in columns.items()])
    seen = (values.select(F.inline(F.filter(each, lambda x: x["key"].isNotNull()))).distinct()
            .groupBy("dim", "key").agg(F.min("name").alias("name")))
    missing = seen.join(stored.select("dim", "key"), ["dim", "key"], "left_anti")
    nr = numbered(missing.withColumn("_order", F.concat_ws("\u0001", "dim", "key")), "_order").drop("_order")
    # a row for each dimension: the number before its first new key, and its greatest stored id
    first = nr.groupBy("dim").agg((F.min("_nr") - 1).alias("_before"))
    most = stored.groupBy("dim").agg(F.max("id").alias("_most"))
    new = (nr.join(first, "dim").join(most, "dim", "left")
           .select("dim", (F.coalesce("_most", F.lit(0)) + F.col("_nr") - F.col("_before")).cast(stored.schema["id"].dataType).alias("id"),
                   "key", "name"))
    ensure_checkpoint_dir(values.sparkSession)
    every = stored.select("dim", "id", "key", "name").unionByName(new).checkpoint()
    out, few = values, every.count() <= BROADCAST_KEYS
    for dim, c in columns.items():
        of = every.where(F.col("dim") == dim).select(F.col("key").alias("_key"), F.col("id").alias(f"{dim}_id"))
        out = out.join(F.broadcast(of) if few else of, F.col(c).cast("string") == F.col("_key"), "left").drop("_key", c, *([names[dim]] if dim in names else []))
    return every, out


def upsert(old: DataFrame, new: DataFrame, key: str, update: list[str], only_if_null: bool = False) -> DataFrame:
    """Insert new keys; for existing keys replace ``update`` columns (optionally only where NULL)."""
    o = old.alias("o")
    n = new.alias("n")
    j = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    cols = []
    for c in old.columns:
        if c == key:
            cols.append(F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c))
        elif c in update:
            oc, nc = F.col(f"o.{c}"), F.col(f"n.{c}")
            if only_if_null:
                cols.append(F.when(F.col(f"o.{key}").isNull(), nc).otherwise(F.coalesce(oc, nc)).alias(c))
            else:
                cols.append(F.when(F.col(f"n.{key}").isNotNull(), nc).otherwise(oc).alias(c))
        else:
            cols.append(F.when(F.col(f"o.{key}").isNotNull(), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
    return j.select(*cols)


def insert_ignore(old: DataFrame, new: DataFrame, key: str | list[str]) -> DataFrame:
    """Insert rows whose key is not stored yet; conflicts, also among the new rows, are ignored."""
    keys = [key] if isinstance(key, str) else key
    rest = [F.col(c) for c in old.columns if c not in keys]
    fresh = new.select(*old.columns).join(old.select(*keys), keys, "left_anti").select(*old.columns)
    return old.unionByName(first_per_key(fresh, keys, rest) if rest else fresh.dropDuplicates(keys))


def first_per_key(df: DataFrame, key: str | list[str], order: list[Column] | Column) -> DataFrame:
    """First row per key under ``order`` (top-1, partial limit before the shuffle)."""
    keys = [key] if isinstance(key, str) else key
    w = Window.partitionBy(*keys).orderBy(*(order if isinstance(order, list) else [order]))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def last_response_time(log: DataFrame) -> DataFrame:
    """Time of the latest stored response."""
    return log.agg(F.max("response_time").alias("response_time"))
