"""File discovery and archive readers.

Listing and reading are Spark's own (``binaryFile``, ``text``, path globs);
Python (tar/zip members, gzipped log entries) runs inside tasks, so archives are
unpacked where they are read and never pass the driver.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import tarfile
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .envelopes import ACCESS_LOG_RE, log_meta

SLOT_RE = r"\.slot\d\."   # fixed value: slot marker ignored when comparing file names


def list_inputs(spark: SparkSession, glob: str, up_to: str | None = None) -> DataFrame:
    """Files matching ``glob`` (path, mtime, length), sorted; stop before ``up_to``."""
    df = (spark.read.format("binaryFile").load(glob)
          .select(F.col("path"), F.col("modificationTime").alias("mtime"), F.col("length")))
    if up_to is not None:
        df = df.where(F.regexp_replace("path", SLOT_RE, "") < F.regexp_replace(F.lit(up_to), SLOT_RE, ""))
    return df.orderBy("path")


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """S3: line files, bz2/gzip decompressed by the reader (bz2 splits, gzip does not)."""
    return spark.read.text(paths).withColumn("path", F.col("_metadata.file_path"))


MEMBER_SCHEMA = "path string, member string, content binary"


def _unpack(batches):
    for pdf in batches:
        rows = []
        for path, content in zip(pdf["path"], pdf["content"]):
            buf = io.BytesIO(bytes(content))
            if path.endswith(".zip"):
                with zipfile.ZipFile(buf) as z:
                    for name in sorted(z.namelist()):
                        if not name.endswith("/"):
                            rows.append((path, name, z.read(name)))
            else:
                with tarfile.open(fileobj=buf, mode="r:*") as t:
                    for m in sorted(t.getmembers(), key=lambda m: m.name):
                        if m.isfile():
                            rows.append((path, m.name, t.extractfile(m).read()))
        yield pd.DataFrame(rows, columns=["path", "member", "content"])


def unpack(files: DataFrame) -> DataFrame:
    """Archives (tar[.bz2|.gz], zip) -> one row per member."""
    return files.select("path", "content").mapInPandas(_unpack, MEMBER_SCHEMA)


ENTRY_SCHEMA = "path string, ts timestamp_ntz, type string, body string, hash string, err string"


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gzipped bodies to text, their MD5, or the kind of error; an entry each."""
    for b in batches:
        text, digest, err = [], [], []
        for known, body in zip(b.column("err").to_pylist(), b.column("body")):
            try:
                raw = None if known else gzip.decompress(body.as_py()).decode("utf-8")
                text.append(raw)
                digest.append(None if known else hashlib.md5(raw.encode()).hexdigest())
                err.append(known)
            except Exception as ex:  # quarantined, not dropped
                text.append(None)
                digest.append(None)
                err.append(type(ex).__name__)
        yield pa.RecordBatch.from_arrays([b.column("path"), b.column("ts"), b.column("type"), pa.array(text, pa.string()),
                                          pa.array(digest, pa.string()), pa.array(err, pa.string())],
                                         names=["path", "ts", "type", "body", "hash", "err"])


def read_log(spark: SparkSession, paths) -> DataFrame:
    """Access logs whose entries are a header line and a gzipped body, one response per entry (errors in ``err``).

    Logs are read as lines, so a large one splits over tasks. A body holds line feeds of its own, so its pieces are put
    together again: every line gets the number of the last header before it, counted within its split, plus
    the headers of the file's splits before (one number a split), and is grouped by file and header number. Lines
    before a file's first header are an entry with ``err`` ``NoHeader``.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(  # bytes as they are: only the line feed divides
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), "value", F.col("value").rlike(ACCESS_LOG_RE).cast("long").alias("header"))
    split = Window.partitionBy("path", "block").orderBy("place")
    headers = lines.groupBy("path", "block").agg(F.sum("header").alias("n"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    base = headers.select("path", "block", F.coalesce(before, F.lit(0)).alias("before"))
    so_far = F.sum("header").over(split.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered_ = lines.withColumn("entry", so_far).join(base, ["path", "block"]).withColumn("entry", F.col("entry") + F.col("before"))
    entries = numbered_.groupBy("path", "entry").agg(F.sort_array(F.collect_list(F.struct("block", "place", "value"))).alias("of"))
    texts = F.transform("of", lambda x: x["value"])
    first = F.col("entry") == 0
    meta = log_meta(F.get("texts", F.lit(0)))
    entries = entries.select("path", first.alias("first"), texts.alias("texts")).select(
        "path", F.when(~F.col("first"), meta["ts"]).alias("ts"), F.when(~F.col("first"), meta["type"]).alias("type"),
        _body(F.col("first"), F.col("texts")).cast("binary").alias("body"), F.when(F.col("first"), "NoHeader").alias("err"))
    return entries.where(F.col("err").isNull() | (F.length("body") > 0)).mapInArrow(_bodies, ENTRY_SCHEMA)


def _body(leading: Column, texts: Column) -> Column:
    """Lines to bytes: all of leading ones, else those behind the header, without line feeds at the end."""
    lines = F.when(leading, texts).otherwise(F.slice(texts, F.lit(2), F.size(texts)))
    return F.rtrim(F.array_join(lines, "\n"), F.lit("\n"))
