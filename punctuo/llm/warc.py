"""WARC (3): archives of Zstandard frames, one record a frame, dictionary in the leading skippable frame.

Writing: narrow rows (id, digests, length) say which record of equal payloads is the response; the others
are revisits of it, without payload. Spark's text writer puts the frames into files, so any file system
that Spark knows will do: a row is a frame's bytes, and the line separator is itself an empty skippable
frame. A file has ``RECORDS`` rows: the dictionary, records and, once it holds ``ARCHIVE_BYTES``, empty
skippable frames as filling, so the dictionary leads every file.

Reading: ``binaryFile`` rows, at most about ``ARCHIVE_BYTES`` and a record each. The first frame must be
the dictionary's (magic number 0x184D2A5D); other skippable frames are passed over; every frame is
decoded alone and must hold one whole record: version, header fields, ``Content-Length`` against
the block and its end, digests of block and payload against their bytes. What is wrong stands in ``problem``.

Defined cases: null html is an empty payload; null urls are left out of the header; rows repeated with id
and payload are all responses (none revisits itself); null ids are never the larger one; an empty table
writes archives without records; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch

#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 0
RECORDS = 4096
ARCHIVE_BYTES = 8 << 20
#: Pages that train the dictionary, at most, and bytes of each.
SAMPLE_ROWS, SAMPLE_BYTES, DICT_BYTES = 128, 16384, 32768
DATE = "2000-01-01T00:00:00Z"
DICT_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528  # fixed: formats of WARC-in-Zstandard and Zstandard
#: An empty skippable frame; all of its bytes are ASCII, so it can be a line separator.
GAP = (0x184D2A50).to_bytes(4, "little") + bytes(4)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------- records

def record(page: str, url: str | None, payload: bytes, digest: str, refers: str | None) -> bytes:
    """A response, or a revisit of the record ``refers``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}", f"WARC-Record-ID: <urn:x-page:{page}>",
            f"WARC-Date: {DATE}"]
    if url is not None:
        plain = "".join(chr(c) if 32 < c < 127 else f"%{c:02X}" for c in url.encode())
        head.append(f"WARC-Target-URI: {plain}")
    if refers is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers}>", f"WARC-Profile: {PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_32(block)}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of a record; ``problem`` says what is wrong with it."""
    out = dict.fromkeys(("record_type", "record_id", "target_uri", "refers_to", "payload_digest", "payload_bytes",
                         "payload", "problem"))
    head, end, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if lines[0] not in ("WARC/1.0", "WARC/1.1") or not end:
        return out | {"problem": "no WARC header"}
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            return out | {"problem": "header line without a field"}
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            return out | {"problem": f"no {name}"}
    size = fields["content-length"]
    if not size.isdecimal() or len(rest) != int(size) + 4 or rest[-4:] != b"\r\n\r\n":
        return out | {"problem": "Content-Length is not the block's"}
    block = rest[:-4]
    mark = lambda x: None if x is None else x.removeprefix("<urn:x-page:").removesuffix(">")
    out |= {"record_type": fields["warc-type"], "record_id": mark(fields["warc-record-id"]),
            "target_uri": fields.get("warc-target-uri"), "refers_to": mark(fields.get("warc-refers-to")),
            "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None}
    if fields.get("warc-block-digest", "sha1:" + sha1_32(block)) != "sha1:" + sha1_32(block):
        return out | {"problem": "block digest differs"}
    if out["record_type"] not in ("response", "revisit"):
        return out | {"payload": block, "payload_bytes": len(block)}
    http, end, payload = block.partition(b"\r\n\r\n")
    told = [x[15:].strip() for x in http.split(b"\r\n")[1:] if x[:15].lower() == b"content-length:"]
    if not end or len(told) != 1 or not told[0].isdigit():
        return out | {"problem": "no length in the HTTP header"}
    out["payload_bytes"] = int(told[0])
    if out["record_type"] == "revisit":
        if payload or not out["refers_to"] and "warc-refers-to" not in fields:
            return out | {"problem": "a revisit has a payload or refers to nothing"}
        return out
    if len(payload) != out["payload_bytes"]:
        return out | {"problem": "payload length differs"}
    if out["payload_digest"] != sha1_32(payload):
        return out | {"problem": "payload digest differs"}
    return out | {"payload": payload}


# ---------------------------------------------------------------- frames

def dictionary(samples: list[bytes]) -> bytes:
    """Dictionary from sample pages; their plain bytes where there are too few to train one."""
    import zstandard
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


def dictionary_frame(data: bytes) -> bytes:
    import zstandard
    packed = zstandard.ZstdCompressor(level=9).compress(data)
    return DICT_MAGIC.to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed


def frames(data: memoryview | bytes) -> Iterator[tuple[bytes, str | None]]:
    """(content, None) of each frame of an archive, or (b"", problem) once where it can't be read on."""
    import zstandard
    data, at = memoryview(data), 0
    word = lambda i: int.from_bytes(data[i:i + 4], "little")
    use = None
    while at < len(data):
        if len(data) - at < 8:
            yield b"", "bytes behind the last frame"
            return
        magic = word(at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            size = word(at + 4)
            if magic == DICT_MAGIC and at == 0:
                held = bytes(data[8:8 + size])
                if int.from_bytes(held[:4], "little") == FRAME_MAGIC:
                    held = zstandard.ZstdDecompressor().decompress(held, max_output_size=1 << 27)
                use = zstandard.ZstdCompressionDict(held)
            at += 8 + size
            if at > len(data):
                yield b"", "a skippable frame is cut off"
                return
            continue
        if magic != FRAME_MAGIC:
            yield b"", "no Zstandard frame"
            return
        one, out = (zstandard.ZstdDecompressor(dict_data=use) if use else zstandard.ZstdDecompressor()).decompressobj(), []
        try:
            while not one.eof and at < len(data):
                step = data[at:at + 65536]
                out.append(one.decompress(step))
                at += len(step)
        except zstandard.ZstdError as e:
            yield b"", f"frame can't be decoded: {e}"
            return
        if not one.eof:
            yield b"", "a frame is cut off"
            return
        at -= len(one.unused_data)
        yield b"".join(out), None


# ---------------------------------------------------------------- Spark

def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [x.as_py() or b"" for x in b.column("html").cast(pa.large_binary())]
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), b.column("url"), b.column("html"), pa.array([hashlib.sha256(x).digest() for x in got], pa.binary()),
             pa.array([len(x) for x in got], pa.int64())], names=["id", "url", "html", "sha", "size"])


def _archived(shared, records: int, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        data = shared.value
        press = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(data))
        lead = dictionary_frame(data)
        rows, size = 0, 0

        def packed(some: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], names=["frame"])

        out: list[bytes] = []
        for b in batches:
            cols = [b.column(c) for c in ("id", "url", "html", "is_revisit", "leader")]
            for i in range(b.num_rows):
                page, url, html, revisit, leader = (c[i].as_py() for c in cols)
                payload = (html or "").encode()
                if not rows:
                    out.append(lead)
                    rows = 1
                text = lambda x: "" if x is None else str(x)
                frame = press.compress(record(text(page), url, payload, sha1_32(payload), text(leader) if revisit else None))
                out.append(frame)
                rows, size = rows + 1, size + len(frame)
                if size >= archive_bytes:
                    out += [GAP] * (records - rows)
                    rows = records
                if rows >= records:
                    rows = size = 0
            yield packed(out)
            out = []
    return run


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               least_bytes: int = LEAST_BYTES, records: int = RECORDS, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Archives of all rows of ``pages`` under ``path``."""
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"))
    kind = rows.schema["id"].dataType.simpleString()
    # numbers choose the sample, so tasks send no texts; then only the texts of those numbers, one each, are fetched
    hashed = rows.filter("length(html) > 0").select(F.xxhash64("id", "url").alias("o"), "html")
    chosen = [r["o"] for r in hashed.select("o").distinct().orderBy("o").limit(SAMPLE_ROWS).collect()]
    sample = (hashed.filter(F.col("o").isin(chosen)).groupBy("o").agg(F.min(F.substring("html", 1, SAMPLE_BYTES)).alias("html"))
              .orderBy("o").collect())
    shared = pages.sparkSession.sparkContext.broadcast(dictionary([r["html"].encode() for r in sample]))
    keyed = rows.mapInArrow(_digests, f"id {kind}, url string, html string, sha binary, size long")
    lead = (keyed.filter(F.col("size") >= least_bytes).groupBy("sha").agg(F.max("id").alias("leader"), F.count("*").alias("n"))
            .filter("n > 1").drop("n"))
    typed = keyed.join(lead, "sha", "left").select("id", "url", "html", "leader", (
        F.col("leader").isNotNull() & ~F.col("id").eqNullSafe(F.col("leader"))).alias("is_revisit"))
    (typed.mapInArrow(_archived(shared, records, archive_bytes), "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", GAP.decode("ascii")).option("compression", "none").option("maxRecordsPerFile", records).text(path))


def _records(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"path": pa.string(), "record_type": pa.string(), "record_id": pa.string(), "target_uri": pa.string(),
                 "refers_to": pa.string(), "payload_digest": pa.string(), "payload_bytes": pa.int64(), "payload": pa.binary(),
                 "problem": pa.string()}
        for b in batches:
            for name, data in zip(b.column("path"), b.column("content")):
                rows, held = [], 0
                for content, problem in frames(data.as_buffer()):
                    row = {"problem": problem} if problem else parse(content)
                    if not with_payload:
                        row["payload"] = None
                    rows.append(row | {"path": name.as_py()})
                    held += len(row.get("payload") or b"") + 300
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))
    return run


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``; ``problem`` is null where it is sound."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_records(with_payload), "path string, record_type string, record_id string, target_uri string, "
                            "refers_to string, payload_digest string, payload_bytes long, payload binary, problem string")


def op3_warc(spark, sf_dir: str) -> DataFrame:
    from .common import table
    pages = table(spark, sf_dir, "pages")
    path = scratch(spark, "warc")
    write_warc(pages, path)
    kind = pages.schema["page_id"].dataType.simpleString()
    got = read_warc(spark, path, with_payload=False)
    sound = lambda c: F.when(F.col("problem").isNull(), c).otherwise(F.raise_error(F.col("problem")))
    page = lambda c: F.when(F.col(c) != "", F.col(c).cast(kind))
    return got.select(sound(page("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      page("refers_to").alias("refers_to"))


SQL = """
WITH d AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS x, max(page_id) OVER (PARTITION BY b) AS lead FROM d)
SELECT page_id, payload_bytes,
       list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(x, (i // 4) * 5 + 1, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1)::INTEGER, 1)),
           lambda a, c: a || c) AS payload_digest,
       CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> lead THEN lead END AS refers_to
FROM h
"""
