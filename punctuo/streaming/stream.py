"""Structured Streaming ingest and refresh.

* Files arrive in a folder; the file source with a checkpoint remembers which
  files were processed (S2), ``trigger(availableNow=True)`` drains what is
  there and stops, like one run of the reference's batch loop.
* ``foreachBatch`` folds each batch into the state (``plans.fold``): repeats of stored samples, frozen or not, add
  nothing (N8), late rows count as if they had come in time, and the batch id is committed with it (D7), so a
  retried batch is recognised and not counted twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import sinks
from ..plans import fold as FO
from ..profiles import DE_DB, Profile

def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                 max_files: int | None = None) -> DataFrame:
    """Incremental file source (progress lives in the query checkpoint; a new one starts over)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def new_samples(batch: DataFrame, current: DataFrame | None) -> DataFrame:
    """Open and new samples without repeats, equal in all columns but ``id``.

    Repeats are looked for among the stored open samples, which hold two days, so no watermark is
    needed and no late row is dropped: one that comes after its stop event froze is folded in with its batch.
    """
    both = batch if current is None else current.select(*batch.columns).unionByName(batch)
    return both.dropDuplicates([c for c in both.columns if c != "id"])


def ingest_and_refresh(spark: SparkSession, source: DataFrame, state: str, checkpoint: str,
                       remarks: DataFrame | None = None, profile: Profile = DE_DB,
                       on_batch: Callable[[int], None] | None = None) -> StreamingQuery:
    """Each micro-batch is folded in and committed under its batch id."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if sinks.committed(sinks.manifest(spark, state), batch_id):
            return
        FO.fold(spark, batch, remarks, state, profile, batch_id=batch_id)
        if on_batch:
            on_batch(batch_id)

    return (source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
