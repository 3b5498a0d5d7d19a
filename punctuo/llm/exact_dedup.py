"""Exact dedup (6): skew-safe combining with full content compared at every stage.

1. Each task removes repeats within its own rows: a dict from digest to the contents seen, contents
   compared as whole byte strings. One row per different content leaves the task, its content as a
   Zstandard frame (equal bytes in, equal frame out), with the largest id and the row count.
2. Groups of (digest, salt, content) are merged; the salt comes from the task, so copies in a third of
   all rows spread over ``SALTS`` groups.
3. The salt winners, at most ``SALTS`` for each content, are merged to one by (digest, content).

Membership is a narrow join on the digests, which AQE splits where a digest is hot. A class is named by
the grouping digest and the SHA-256 of its content; contents that collide in the first are told apart
by stages 1-3 and joined by the second.

Defined cases: null text counts as empty; a null id never wins over another id; rows repeated with id
and text count one by one in ``group_size`` and exactly one of them is ``kept``; an empty table gives an
empty result; extra columns are ignored (``survivors`` keeps them).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, one_row_each, schema_with, written

SALTS = 32
#: Bytes of different contents a task holds before it sends them on.
HELD_BYTES = 32 << 20


def blake(content: bytes) -> bytes:
    import hashlib
    return hashlib.blake2b(content, digest_size=16).digest()


def _contents(column: pa.Array) -> list[bytes]:
    """A-Z lower-cased, all else as it is; null is empty."""
    return [(x or b"").lower() for x in column.cast(pa.large_binary()).to_pylist()]


def _digest_rows(id_col: str, text_col: str, digest: Callable[[bytes], bytes], names: list[str], whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        for b in batches:
            got = _contents(b.column(text_col))
            keys = pa.array([digest(x) for x in got], pa.binary())
            sha = pa.array([hashlib.sha256(x).digest() for x in got], pa.binary())
            cols, own = (list(b.columns), list(b.schema.names)) if whole else ([b.column(id_col)], ["id"])
            yield pa.RecordBatch.from_arrays([*cols, keys, sha], names=[*own, *names])
    return run


def _local(salts: int, digest: Callable[[bytes], bytes], held_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        import zstandard
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % salts
        press = zstandard.ZstdCompressor(level=1, write_content_size=True)
        seen: dict[bytes, list[list]] = {}
        held, id_type = 0, None

        def flush() -> pa.RecordBatch:
            rows = [(k, hashlib.sha256(c).digest(), salt, press.compress(c), best, n)
                    for k, found in seen.items() for c, best, n in found]
            seen.clear()
            cols = list(zip(*rows)) if rows else [()] * 6
            types = [pa.binary(), pa.binary(), pa.int32(), pa.binary(), id_type, pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              names=["__key", "__sha", "salt", "z", "id", "n"])

        for b in batches:
            ids, id_type = b.column(0).to_pylist(), b.schema.field(0).type
            for doc, c in zip(ids, _contents(b.column(1))):
                found = seen.setdefault(digest(c), [])
                for entry in found:
                    if entry[0] == c:
                        if doc is not None and (entry[1] is None or doc > entry[1]):
                            entry[1] = doc
                        entry[2] += 1
                        break
                else:
                    found.append([c, doc, 1])
                    held += len(c) + 200
                    if held >= held_bytes:
                        yield flush()
                        held = 0
        if seen:
            yield flush()
    return run


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
            digest: Callable[[bytes], bytes] = blake, held_bytes: int = HELD_BYTES) -> DataFrame:
    """One row for each different content: ``__key, __sha, keep_id, group_size``."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    local = rows.mapInArrow(_local(salts, digest, held_bytes),
                            f"__key binary, __sha binary, salt int, z binary, id {kind}, n long")
    salted = local.groupBy("__key", "__sha", "salt", "z").agg(F.max("id").alias("id"), F.sum("n").alias("n"))
    return (salted.groupBy("__key", "__sha", "z").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"))
            .drop("z"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                digest: Callable[[bytes], bytes] = blake, held_bytes: int = HELD_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    members = rows.mapInArrow(_digest_rows("id", "text", digest, ["__key", "__sha"], False), f"id {kind}, __key binary, __sha binary")
    # a row's own number tells rows apart that repeat each other: none of them is gathered anywhere, and one of them stays
    members = written(members.withColumn("row", F.monotonically_increasing_id()), "exact-members")
    stays = members.groupBy("__key", "__sha").agg(F.max(F.struct("id", (-F.col("row")).alias("row"))).alias("stays"))
    found = classes(docs, id_col, text_col, salts, digest, held_bytes).join(stays, ["__key", "__sha"])
    return members.join(found, ["__key", "__sha"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == -F.col("stays.row")).alias("kept"),
        F.lower(F.hex("__sha")).alias("text_sha256"))


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``."""
    key, sha = fresh(docs, "key"), fresh(docs, "sha")
    keyed = docs.mapInArrow(_digest_rows(id_col, text_col, blake, [key, sha], True),
                            schema_with(docs, f"{key} binary", f"{sha} binary"))
    keep = classes(docs, id_col, text_col).select(F.col("keep_id").alias(id_col), F.col("__key").alias(key),
                                                  F.col("__sha").alias(sha))
    return one_row_each(keyed, keep, [id_col, key, sha]).drop(key, sha)


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
