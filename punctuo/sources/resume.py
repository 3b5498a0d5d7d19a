"""Input files from where the last run stopped.

Files are taken in the order of their paths. A run goes on behind the last file that was read to its end, found by its name
without slot marker; where that file isn't there any more nothing is read, or everything again with ``restart``. A file
named ``up_to`` and those behind it wait.

``pending`` says it of a listing in a DataFrame. ``FileNames`` is a streaming source with offsets of its own (the last
file's name) that lists files and gives their names, bounded and small; ``follow`` hands the names of each batch to Spark's own
readers, so no file's content passes through Python, and the query's checkpoint is the record of what was read.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from .files import SLOT_RE

#: Names in a partition of a batch.
NAMES = 10_000


def pending(listing: DataFrame, last: str | None = None, up_to: str | None = None, restart: bool = False) -> DataFrame:
    """The rows of ``listing`` (with ``path``) that a run after ``last`` reads, in any order."""
    key = lambda c: F.regexp_replace(c, SLOT_RE, "")
    rows = listing
    at = F.lit(None).cast("string")
    if last is not None:
        at = listing.where(key(F.col("path")) == key(F.lit(last))).select(F.min("path")).scalar()
        rows = rows.where(F.when(at.isNotNull(), F.col("path") > at).otherwise(F.lit(restart)))
    if up_to is not None:
        stop = listing.where(F.col("path") == up_to).select(F.max("path")).scalar()
        rows = rows.where(stop.isNull() | (F.col("path") < stop) | F.coalesce(at >= stop, F.lit(False)))
    return rows


def names_after(paths: list[str], last: str | None, up_to: str | None, restart: bool) -> list[str]:
    """As ``pending``, of sorted paths."""
    import re
    plain = lambda p: re.sub(SLOT_RE, "", p)
    at = None
    if last:
        at = next((i for i, p in enumerate(paths) if plain(p) == plain(last)), None)
        if at is None and not restart:
            return []
    first = 0 if at is None else at + 1
    stop = paths.index(up_to) if up_to in paths else len(paths)
    return paths[first:stop] if stop >= first else paths[first:]


def listed(glob: str) -> list[tuple[str, float, int]]:
    """(path, time of change, bytes) of the files that ``glob`` matches, by path; any store that Arrow opens by its URI."""
    from pathlib import PurePosixPath

    from pyarrow import fs
    scheme = glob.split("://", 1)[0] + "://" if "://" in glob else "file:" if glob.startswith("file:") else ""
    fixed = glob.split("*", 1)[0].split("?", 1)[0].split("[", 1)[0].rsplit("/", 1)[0] or "/"
    store, base = fs.FileSystem.from_uri(fixed) if scheme else (fs.LocalFileSystem(), fixed)
    pattern = base + glob[len(fixed):]
    found = [f for f in store.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
             if f.type == fs.FileType.File and PurePosixPath(f.path).full_match(pattern) and not f.base_name.startswith(("_", "."))]
    return sorted((fixed + f.path[len(base):], f.mtime.timestamp(), f.size) for f in found)


class Names(InputPartition):
    def __init__(self, rows: list[tuple[str, float, int]]):
        self.rows = rows


class NamesReader(DataSourceStreamReader):
    """The offset is the last file given; the checkpoint keeps it, so a stopped query goes on behind it."""

    def __init__(self, options: dict):
        self.glob, self.after, self.up_to = options["path"], options.get("after"), options.get("upto")
        self.restart, self.last = options.get("restart", "false").lower() == "true", None

    def _pending(self, last: str | None) -> list[tuple[str, float, int]]:
        files = listed(self.glob)
        wanted = set(names_after([f[0] for f in files], last, self.up_to, self.restart))
        return [f for f in files if f[0] in wanted]

    def initialOffset(self) -> dict:
        return {"last": self.after or ""}

    def latestOffset(self) -> dict:
        last = self.last if self.last is not None else self.after or ""
        new = self._pending(last or None)
        self.last = new[-1][0] if new else last
        return {"last": self.last}

    def partitions(self, start: dict, end: dict) -> list[Names]:
        if self.last is None:  # a query that starts again plans its last batch first, which says where it was
            self.last = end["last"]
        rows = [f for f in self._pending(start["last"] or None) if f[0] <= end["last"]] if start != end else []
        return [Names(rows[i:i + NAMES]) for i in range(0, max(1, len(rows)), NAMES)]

    def read(self, partition: Names) -> Iterator[tuple]:
        import datetime as dt
        for path, changed, size in partition.rows:
            yield path, dt.datetime.fromtimestamp(changed, dt.timezone.utc), size


class FileNames(DataSource):
    """Streaming source ``file_names``: options ``path`` (a glob), ``after``, ``upTo``, ``restart``."""

    @classmethod
    def name(cls) -> str:
        return "file_names"

    def schema(self) -> str:
        return "path string, mtime timestamp, length long"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return NamesReader(self.options)


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def file_names(spark: SparkSession, glob: str, after: str | None = None, up_to: str | None = None, restart: bool = False) -> DataFrame:
    """The streaming DataFrame of names."""
    spark.dataSource.register(FileNames)
    given = {"path": glob, "after": after, "upTo": up_to, "restart": str(restart).lower()}
    return spark.readStream.format("file_names").options(**{k: v for k, v in given.items() if v is not None}).load()


def follow(spark: SparkSession, names: DataFrame, checkpoint: str, read: Callable[[list[str]], DataFrame],
           handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Each batch of names read by ``read`` and given to ``handle`` with its batch id; drains what is there and ends."""
    def batch(rows: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in rows.select("path").orderBy("path").collect()]  # names only
        if paths:
            handle(read(paths), batch_id)

    return names.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
