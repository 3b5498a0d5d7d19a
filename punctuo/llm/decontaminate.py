"""Benchmark decontamination (5): one Aho-Corasick automaton over normalised test items.

Normal form of a text: A-Z lower-cased, its words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with one blank
before, between and behind. A window of ``window`` consecutive item words (an item of fewer words is one
window) is a pattern with blanks at both ends, so it matches whole words only. Each text is scanned
once; a match's offset in the normal form maps back to words and, in ``spans``, to places in the
original text.

The automaton is broadcast. What it holds is bounded: beyond ``PATTERN_CHARS`` pattern characters the
items are dealt over several automata, each read and broadcast alone, and the table of documents passes
through them one after the other, hits so far riding along; it is written between two of them, so that a task
holds one automaton at a time. No step shuffles.

Defined cases: null and empty texts have no words and are never contaminated; null or wordless items
match nothing; items of one id count once in ``n_items``; items without an id match but count in neither ``n_items`` nor
the digest; empty benchmark: nothing is hit; a null ``doc_id`` stays null; extra columns are kept, but for those
named like a result of ``decontaminate``, which the result replaces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, schema_with, written

WINDOW = 13
#: Contaminated: at least this share of the words is hit, as (words hit) * SHARE >= words.
SHARE = 20
#: Pattern characters of one automaton; about 60 bytes of memory each at most.
PATTERN_CHARS = 4_000_000
#: Bytes of a text in UTF-8: A-Z lower-cased, all that aren't part of a word to blanks.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_STATE = "struct<words:int,lo:array<int>,hi:array<int>,items:array<string>,start:array<int>,stop:array<int>>"
RESULTS = ("n_words", "n_hit", "n_items", "item_ids", "spans", "contaminated")


def patterns(text: str | None, window: int = WINDOW) -> list[str]:
    words = (text or "").encode().translate(NORMAL).decode("latin-1").split(" ")
    words = [w for w in words if w]
    if not words:
        return []
    return [f" {' '.join(words[i:i + window])} " for i in range(max(1, len(words) - window + 1))]


def automaton(items: list[tuple[str | None, str | None]], window: int = WINDOW):
    """``items``: (item id as string, text). Payload of a pattern: words, ids."""
    import ahocorasick
    held: dict[str, set[str | None]] = {}
    for item, text in items:
        for p in patterns(text, window):
            held.setdefault(p, set()).add(item)
    ac = ahocorasick.Automaton()
    for p, who in held.items():
        ac.add_word(p, (p.count(" ") - 1, who))
    ac.make_automaton()
    return ac


def scan(ac, data: bytes) -> tuple[int, list[tuple[int, int]], set[str], list[tuple[int, int]]]:
    """Of a text in UTF-8: its words, hit word ranges [lo, hi) merged, ids of items found, and the ranges' places in the text."""
    plain = data.translate(NORMAL)
    words = [w for w in plain.split(b" ") if w]
    if not words or not len(ac):
        return len(words), [], set(), []
    found, items = [], set()
    for end, (n, who) in ac.iter(b" ".join([b"", *words, b""]).decode("latin-1")):  # a character a byte
        found.append((end, n))
        items |= who
    if not found:
        return len(words), [], set(), []
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)  # place of the blank behind each word
    last = np.searchsorted(ends, [e for e, _ in found]) + 1
    merged: list[tuple[int, int]] = []
    for lo, hi in sorted((int(h) - n, int(h)) for h, (_, n) in zip(last, found)):
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    word = np.frombuffer(b" " + plain + b" ", np.uint8) != 32
    begin, end = np.flatnonzero(~word[:-1] & word[1:]), np.flatnonzero(word[:-1] & ~word[1:])
    chars = np.r_[0, np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)]  # characters before a byte
    return len(words), merged, items - {None}, [(int(chars[begin[lo]]), int(chars[end[hi - 1]])) for lo, hi in merged]


def _union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _pass(shared, text_col: str, state: str, first: bool):
    kind = pa.struct([("words", pa.int32()), ("lo", pa.list_(pa.int32())), ("hi", pa.list_(pa.int32())),
                      ("items", pa.list_(pa.string())),
                      ("start", pa.list_(pa.int32())), ("stop", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ac = shared.value
        for b in batches:
            olds = [None] * b.num_rows if first else b.column(state).to_pylist()
            out = []
            for x, old in zip(b.column(text_col).cast(pa.large_binary()), olds):
                n, hits, items, at = scan(ac, x.as_py() or b"")
                if old:
                    hits = _union(hits + list(zip(old["lo"], old["hi"])))
                    at = _union(at + list(zip(old["start"], old["stop"])))
                    items |= set(old["items"])
                out.append({"words": n, "lo": [r[0] for r in hits], "hi": [r[1] for r in hits],
                            "items": sorted(items),
                            "start": [r[0] for r in at], "stop": [r[1] for r in at]})
            keep = [(c, n) for c, n in zip(b.columns, b.schema.names) if n != state]
            yield pa.RecordBatch.from_arrays([*(c for c, _ in keep), pa.array(out, kind)],
                                             names=[*(n for _, n in keep), state])
    return run


def shards(items: DataFrame, id_col: str, text_col: str, window: int, limit: int):
    """The items in lists of (id, text) whose patterns hold about ``limit`` characters each.

    The size is summed on the cluster; one list at a time is on the driver.
    """
    rows = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").alias("text"))
    chars = rows.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-chars * window // limit))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for i in range(n):
        yield [(r["item"], r["text"]) for r in rows.filter(part == i).orderBy("item", "text").collect()]


def find_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
              item_text: str = "text", window: int = WINDOW, limit: int = PATTERN_CHARS) -> tuple[DataFrame, str]:
    """``docs`` with a struct column of hits behind its columns, and that column's name."""
    state, first = fresh(docs, "hits"), True
    schema = schema_with(docs, f"{state} {_STATE}")
    for part in shards(items, item_id, item_text, window, limit):
        shared = docs.sparkSession.sparkContext.broadcast(automaton(part, window))
        docs = docs if first else written(docs, "decontaminate-pass")
        docs, first = docs.mapInArrow(_pass(shared, text_col, state, first), schema), False
    return docs, state


def _hit_words(state: str):
    return F.aggregate(F.arrays_zip(F.col(f"{state}.lo").alias("lo"), F.col(f"{state}.hi").alias("hi")), F.lit(0),
                       lambda n, r: n + r["hi"] - r["lo"])


def contaminated(state: str, share: int = SHARE):
    hit = _hit_words(state).cast("long")
    return (hit > 0) & (F.lit(share) * hit >= F.col(f"{state}.words"))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", share: int = SHARE, **kw) -> DataFrame:
    """``docs`` with ``n_words, n_hit, n_items, item_ids, spans`` (places in the text) and ``contaminated``."""
    found, h = find_hits(docs, items, text_col, **kw)
    spans = F.arrays_zip(F.col(f"{h}.start").alias("start"), F.col(f"{h}.stop").alias("stop"))
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULTS]
    return found.select(*own, F.col(f"{h}.words").cast("long").alias("n_words"), _hit_words(h).cast("long").alias("n_hit"),
                        F.size(f"{h}.items").cast("long").alias("n_items"), F.array_sort(f"{h}.items").alias("item_ids"),
                        spans.alias("spans"), contaminated(h, share).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't contaminated, with the columns of ``docs``."""
    found, h = find_hits(docs, items, text_col)
    return found.filter(~contaminated(h)).drop(h)


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    from .common import table
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


SQL = """
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS s
  FROM item, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS u(i) WHERE len(w) > 0),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
gram AS (
  SELECT doc_id, i, k.n, array_to_string(w[i:i + k.n - 1], ' ') AS s
  FROM doc, (SELECT DISTINCT n FROM win) k, unnest(range(1, len(w) - k.n + 2)) AS u(i)),
found AS (SELECT g.doc_id, g.i, g.n, win.item_id FROM gram g JOIN win ON g.s = win.s AND g.n = win.n),
words AS (SELECT DISTINCT doc_id, j FROM found, unnest(range(i, i + n)) AS u(j)),
hit AS (SELECT doc_id, count(*) AS n_hit FROM words GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
               array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS ids FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
