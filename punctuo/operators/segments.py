"""Greedy batches of files (N14): a run reads on until what it has read spans more than five days.

A batch starts at a file and ends with the first one whose last sample time is more than ``days`` after the batch's
first sample time; the next batch starts behind it. That is a sequence of decisions, but each file's answer to "if a
batch started here, where would the next one start?" needs no other answer, so it is worked out for all files side by
side and the starts are found by pointer jumping:

1. files are numbered in path order (two passes over range partitions);
2. the greatest last time of 1, 2, 4, ... files from each one on (a table for each power of two), and a descent through
   these tables, give the file that ends a batch from each start;
3. next-start pointers are squared; from the first file on, jumps by falling powers of two mark all starts;
4. a start covers the files up to the next one; files meet their batch by blocks of numbers.

Every step is an equi-join of narrow rows; their number is logarithmic in the files. Both sides are as long as the listing, so
all are merge joins: a table of a few MB would else be collected by the driver and broadcast, once for each step. Files without sample times belong to
the batch they lie in and neither start the clock nor end it: a batch counts from its first file with a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dims import numbered
from .normalise import BATCH_DAYS

COVER = 1024  # numbers in a block


def next_starts(files: DataFrame, n: int, days: int) -> DataFrame:
    """``nr, next``: where the next batch starts (``n + 1``: nowhere) if one starts at ``nr``; files with a time only, ``nr`` 1 to ``n``."""
    level = files.select("nr", F.col("last").alias("m")).checkpoint()
    tables, width = [level], 1
    while 2 * width <= n:
        other = level.select((F.col("nr") - width).alias("nr"), F.col("m").alias("m2"))
        level = level.join(other.hint("merge"), "nr", "left").select("nr", F.greatest("m", "m2").alias("m")).checkpoint()
        tables.append(level)
        width *= 2
    limit = F.col("first") + F.make_dt_interval(F.lit(days))
    state = files.select("nr", limit.alias("limit"), F.col("nr").alias("at"))
    for k in reversed(range(len(tables))):  # greatest last time of 2 ** k files
        table = tables[k].select(F.col("nr").alias("at"), "m")
        skip = F.coalesce(F.col("m") <= F.col("limit"), F.lit(False))
        state = state.join(table.hint("merge"), "at", "left").select("nr", "limit", F.when(skip, F.col("at") + (1 << k)).otherwise(F.col("at")).alias("at"))
        state = state.checkpoint()
    return state.select("nr", F.least(F.col("at") + 1, F.lit(n + 1)).alias("next"))


def starts(pointers: DataFrame, n: int) -> DataFrame:
    """``nr, next`` of the files that a batch starts at: those that the first one leads to."""
    jumps = [pointers.checkpoint()]
    while jumps[-1].where("nr = 1").first()["next"] <= n:
        there = jumps[-1].select(F.col("nr").alias("next"), F.col("next").alias("then"))
        jumps.append(jumps[-1].join(there.hint("merge"), "next", "left").select("nr", F.coalesce("then", F.lit(n + 1)).alias("next")).checkpoint())
    found = jumps[0].where("nr = 1").select("nr")
    for jump in reversed(jumps):
        found = found.union(found.join(jump.hint("merge"), "nr").select(F.col("next").alias("nr")).where(F.col("nr") <= n)).distinct().checkpoint()
    return found.join(jumps[0].hint("merge"), "nr")


def greedy_batches(files: DataFrame, days: int = BATCH_DAYS) -> DataFrame:
    """``files`` (``path``, ``first`` and ``last`` sample time, NULL where it has none) with ``batch``: 0, 1, ... in path order."""
    every = numbered(files, "path").withColumnRenamed("_nr", "_all").checkpoint()
    timed = numbered(every.where(F.col("first").isNotNull() & F.col("last").isNotNull()), "path")
    timed = timed.select(F.col("_nr").alias("nr"), "_all", "first", "last").checkpoint()
    n = timed.count()
    if not n:
        return every.select(*files.columns, F.lit(0).cast("int").alias("batch"))
    found = numbered(starts(next_starts(timed, n, days), n), "nr").select(
        "nr", "next", (F.col("_nr") - 1).cast("int").alias("batch"))
    # a start's files: from its own number (the first batch: from the first file) up to that of the next start
    at = timed.select("nr", "_all")
    spans = (found.join(at.hint("merge"), "nr").join(at.select(F.col("nr").alias("next"), F.col("_all").alias("_end")).hint("merge"), "next", "left")
             .select("batch", F.when(F.col("nr") == 1, 1).otherwise(F.col("_all")).alias("_from"),
                     F.coalesce("_end", F.lit(every.count() + 1)).alias("_end")))
    block = lambda c: F.floor(c / COVER)
    spans = spans.select("*", F.explode(F.sequence(block(F.col("_from")), block(F.col("_end") - 1))).alias("_block"))
    inside = (block(F.col("_all")) == F.col("_block")) & (F.col("_all") >= F.col("_from")) & (F.col("_all") < F.col("_end"))
    return every.join(spans.hint("merge"), inside).select(*files.columns, "batch")
