"""Suffix-array dedup (1): column-wise construction over many short texts at a time.

Every byte is removed that a string of ``LEAST`` bytes covers which also starts earlier (smaller id, or same
document and earlier place). Strings are judged on the input, matches never cross documents.

**Construction** (``column_bwt``). A collection of m texts gets its Burrows-Wheeler transform and its array of
common prefixes column by column, from the last symbol to the first: a round inserts one symbol and one
common-prefix value per text. Where they go follows from the transform alone (its symbols in stable
order), so a round reads the transform and the prefix array once from front to back and writes both anew,
longer by m. These two byte files per collection are all that a round keeps. They are buffers of the
task: a collection is bounded to ``COLLECTION_BYTES``, and files on one executor's disk would not
survive it. Runs of common prefixes >= ``LEAST`` are the sets of equal strings.

**Dealing out the collections.** Rounds over whole long documents can't be shared out, so the corpus is cut
into pieces that can:

1. Copies of whole texts are folded (all of a later copy is covered); different texts are kept, compressed,
   partitioned by id and persisted, so no later step shuffles them again.
2. Each string of ``LEAST`` bytes is known by the smallest hash of its ``GRAM``-byte grams. Equal strings
   have equal smallest hashes, so a string whose hash occurs once in the corpus can't repeat. Hashes go
   to buckets, packed, folded per task; what occurs again goes back to its documents.
3. Runs of strings with one repeated hash are pieces (at most ``LEAST + STRINGS - 1`` bytes), dealt out by
   that hash. Equal pieces fold to their first place. Hashes that still have several pieces, or one that
   repeats itself, go into collections, where the construction decides. A hash with over ``HOT_BYTES`` of different pieces (a passage in a third of all
   documents, in as many contexts) is dealt out once more by a deeper hash, of grams two bytes shorter than a string: however
   many contexts there are, the different strings around one such gram are bounded by the alphabet, and so are the collections.

Defined cases: null and empty texts have nothing to remove; rows repeated with id and text are one document
and share its result; different texts under one id are ordered by place only (equal places of them are no
earlier than one another); null ids come first; ids must be integers; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spread, written

LEAST = 100
GRAM = 50
#: Strings of a piece, at most.
STRINGS = 64
COLLECTION_BYTES = 1 << 19
HOT_BYTES = 2 << 20
DEEPER = 2  # bytes by which a deeper gram is shorter than a string
#: Bytes of text a task folds before it sends on.
HELD_BYTES = 12 << 20
#: Bytes of text for each hash bucket.
BUCKET_BYTES = 16 << 20
NO_ID = -(1 << 63)


# ---------------------------------------------------------------- construction

def _by_symbol(bwt: np.ndarray) -> np.ndarray:
    """Rows in stable order of their symbols (a counting sort)."""
    import pyarrow.compute as pc
    # not from Arrow's own pool: it keeps the freed buffers of all rounds, each a little longer than the last
    return pc.array_sort_indices(pa.array(bwt), memory_pool=pa.system_memory_pool()).to_numpy().view(np.int64)


def column_bwt(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Transform (bytes + 1; 0 ends a text) and common prefixes (at most 255) of all suffixes, the empty ones first."""
    m = len(texts)
    size = np.fromiter(map(len, texts), np.int64, m)
    flat = np.frombuffer(b"".join(texts), np.uint8)
    stop = np.cumsum(size)

    def symbol(who: np.ndarray, j: int) -> np.ndarray:
        """The j-th symbol from the end; bytes of UTF-8 end at 0xF4, so one more fits."""
        return np.where(size[who] > j, flat[np.maximum(stop[who] - 1 - j, 0)] + 1, 0).astype(np.uint8) if len(flat) \
            else np.zeros(len(who), np.uint8)

    bwt, lcp = symbol(np.arange(m), 0), np.zeros(m, np.uint8)
    who, at = np.arange(m), np.arange(m)  # texts that still grow, and the rows of their last symbols
    for j in range(1, int(size.max(initial=0)) + 1):
        grows = bwt[at] > 0
        who, at = who[grows], at[grows]
        order = _by_symbol(bwt)  # suffixes after this round: the empty ones, then symbol by symbol
        ends = len(bwt) - np.count_nonzero(bwt)
        new = np.zeros(len(bwt), bool)
        new[at] = True
        t = np.flatnonzero(new[order])  # their places among all symbols
        row = order[t]
        by_row = np.argsort(at)
        who = who[by_row[np.searchsorted(at[by_row], row)]]
        place = m + t - ends
        # common prefixes of a new suffix with the one before, and of the one behind with it: one symbol more
        # than their rests have in common, the least value between the rests' rows
        late = np.union1d(t, t + 1)
        late = late[(late > ends) & (late < len(order))]
        late = late[bwt[order[late]] == bwt[order[late - 1]]]
        longer = np.zeros(len(bwt) + len(t) + 1, np.uint8)
        if len(late):
            low, high = order[late - 1] + 1, order[late] + 1
            cut = np.column_stack([low, high]).ravel()
            over = cut >= len(lcp)
            least = np.minimum.reduceat(np.append(lcp, np.uint8(255)), np.where(over, len(lcp), cut))[::2]
            longer[m + late - ends] = np.minimum(least, 254) + 1
        old = np.ones(len(bwt) + len(t), bool)
        old[place] = False
        bwt_, lcp_ = np.empty(len(old), np.uint8), np.empty(len(old), np.uint8)
        bwt_[old], lcp_[old] = bwt, lcp
        bwt_[place] = symbol(who, j)
        changed = np.union1d(place, place + 1)
        changed = changed[changed < len(old)]
        lcp_[changed] = longer[changed]
        bwt, lcp, at = bwt_, lcp_, place
    return bwt, lcp


def equal_strings(texts: list[bytes], least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set, text, place) of all strings of ``least`` bytes, equal ones in one set."""
    bwt, lcp = column_bwt(texts)
    group = np.cumsum(lcp < least)
    order = _by_symbol(bwt)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.count_nonzero(bwt == 0)
    back = np.empty(len(bwt), np.int64)
    back[order] = np.arange(len(bwt)) + len(texts) - ends  # row of the suffix that is longer by a row's symbol
    who, row, out = np.arange(len(texts)), np.arange(len(texts)), []
    for j in range(1, int(size.max(initial=0)) + 1):
        grows = size[who] >= j
        who, row = who[grows], back[row[grows]]
        if j >= least:
            out.append((group[row], who, size[who] - j))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def later(pieces: dict[bytes, tuple[int, int, int]], least: int) -> Iterator[tuple[int, int, bytes]]:
    """(doc, tag, ranges) to remove from different pieces at (doc, tag, place)."""
    texts, spots = list(pieces), list(pieces.values())
    group, who, off = equal_strings(texts, least)
    if not len(group):
        return
    doc = np.array([s[0] for s in spots], np.int64)[who]
    place = np.array([s[2] for s in spots], np.int64)[who] + off
    order = np.lexsort((place, doc, group))
    g, d, p, w, o = group[order], doc[order], place[order], who[order], off[order]
    head = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    first = np.repeat(head, np.diff(np.r_[head, len(g)]))
    gone = (d != d[first]) | (p != p[first])
    w, o = w[gone], o[gone]
    by = np.lexsort((o, w))
    w, o = w[by], o[by]
    start = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (o[1:] != o[:-1] + 1)]) if len(w) else np.zeros(0, np.int64)
    stop = np.r_[start[1:], len(w)] - 1
    for a, b in zip(start.tolist(), stop.tolist()):
        d0, tag, p0 = spots[w[a]]
        yield d0, tag, struct.pack("<QQ", p0 + int(o[a]), p0 + int(o[b]) + least)


# ---------------------------------------------------------------- hashes of strings

def smallest_hashes(data: bytes, least: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Per string the smallest gram hash; and the hashes of all grams that are smallest in some string."""
    a = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    base = 0x9E3779B97F4A7C15
    power = np.full(len(a), base, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    total = np.r_[np.uint64(0), np.cumsum(a * power)]
    turn = np.full(len(a) - gram + 1, pow(base, -1, 1 << 64), np.uint64)
    turn[0] = 1
    h = (total[gram:] - total[:-gram]) * np.cumprod(turn)
    for shift, times in ((29, 0xBF58476D1CE4E5B9), (32, 0x94D049BB133111EB)):  # even out the bits
        h ^= h >> np.uint64(shift)
        h *= np.uint64(times)
    h ^= h >> np.uint64(31)

    def slide(x: np.ndarray, width: int, pick) -> np.ndarray:
        s = 1
        while s * 2 <= width:
            x, s = pick(x[:-s], x[s:]), s * 2
        return pick(x[:s - width], x[width - s:]) if s < width else x

    width = least - gram + 1
    low = slide(h, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    most = slide(np.concatenate([pad, low, pad]), width, np.maximum)
    return low, h[h == most]


def short(h: np.ndarray) -> np.ndarray:
    """The 40 bits of a hash that a bucket sees; the rest names the bucket."""
    return h >> np.uint64(24)


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return (h & np.uint64(0xFFFFFF)) % np.uint64(buckets)


def _pack5(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _unpack5(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8")


# ---------------------------------------------------------------- tasks

def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [x.as_py() or b"" for x in b.column("text").cast(pa.large_binary())]
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), pa.array([hashlib.sha256(x).digest() for x in got], pa.binary()),
             pa.array(map(len, got), pa.int64())], names=["id", "sha", "size"])


def _different(held_bytes: int, least: int):
    """Texts that can have something to remove, one of each task's copies, compressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        press = zstandard.ZstdCompressor(level=3, write_content_size=True)
        seen: dict[bytes, list] = {}
        held = 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([v[0] for v in seen.values()], pa.int64()), pa.array(seen, pa.binary()),
                                              pa.array([v[1] for v in seen.values()], pa.binary())], names=["doc", "sha", "z"])
            seen.clear()
            return out

        for b in batches:
            for doc, x in zip(b.column("id").to_pylist(), b.column("text").cast(pa.large_binary())):
                data = x.as_py() or b""
                if len(data) < least:
                    continue
                doc, sha = NO_ID if doc is None else doc, hashlib.sha256(data).digest()
                if sha in seen:
                    seen[sha][0] = min(seen[sha][0], doc)
                    continue
                seen[sha] = [doc, press.compress(data)]
                held += len(data)
                if held >= held_bytes:
                    yield flush()
                    held = 0
        if seen:
            yield flush()
    return run


def _hashes(buckets: int, held_bytes: int, least: int, gram: int):
    """Rows (bucket, entries) for buckets and (slot, answers) of what repeats within the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        unpress, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        docs, values, more, held = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            h, m = np.concatenate(values), np.concatenate(more)
            d = np.repeat(np.array(docs, np.int64), [len(v) for v in values])
            order = np.argsort(h, kind="stable")
            h, d, m = h[order], d[order], m[order]
            head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            count = np.diff(np.r_[head, len(h)])
            again = np.maximum.reduceat(m, head) | (count > 1)
            back = np.repeat(again, count)
            rows = [(None, *a) for a in _answers(d[back], short(h[back]), buckets)]
            bucket = bucket_of(h[head], buckets)
            for part in np.split(np.lexsort((d[head], bucket)), np.flatnonzero(np.diff(np.sort(bucket))) + 1):
                here = head[part]
                gaps = np.diff(d[here], prepend=0)
                data = struct.pack("<I", len(here)) + _pack5(short(h[here])) + gaps.tobytes() + again[part].tobytes()
                rows.append((int(bucket[part[0]]), None, press.compress(data)))
            yield _table(rows, [("bucket", pa.int64()), ("slot", pa.int64()), ("data", pa.binary())])

        for b in batches:
            for doc, z in zip(b.column("doc").to_pylist(), b.column("z")):
                data = unpress.decompress(z.as_py())
                found, count = np.unique(smallest_hashes(data, least, gram)[1], return_counts=True)
                docs.append(doc)
                values.append(found)
                more.append(count > 1)
                held += len(data)
                if held >= held_bytes:
                    yield from flush()
                    docs, values, more, held = [], [], [], 0
        if docs:
            yield from flush()
    return run


def _table(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


def _answers(d: np.ndarray, h40: np.ndarray, slots: int) -> Iterator[tuple[int, bytes]]:
    """(slot, documents and hashes) with the documents dealt over ``slots``: a row a slot, not a row a document."""
    import zstandard
    press = zstandard.ZstdCompressor(level=1)
    slot = d.view(np.uint64) % np.uint64(slots)
    order = np.lexsort((d, slot))
    d, h40, slot = d[order], h40[order], slot[order]
    for part in np.split(np.arange(len(d)), np.flatnonzero(np.diff(slot)) + 1):
        if len(part):
            yield int(slot[part[0]]), press.compress(struct.pack("<I", len(part)) + d[part].tobytes() + _pack5(h40[part]))


def _by_document(slot: pa.Table) -> pa.Table:
    """A slot's answers, one row a document."""
    import zstandard
    unpress, d, h = zstandard.ZstdDecompressor(), [], []
    for x in slot.column("data"):
        data = unpress.decompress(x.as_py())
        n = struct.unpack_from("<I", data)[0]
        d.append(np.frombuffer(data, np.int64, n, 4))
        h.append(_unpack5(data[4 + 8 * n:]))
    d, h = np.concatenate(d), np.concatenate(h)
    order = np.argsort(d, kind="stable")
    d, h = d[order], h[order]
    head = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
    parts = zip(head.tolist(), [*head[1:].tolist(), len(d)])
    return pa.Table.from_batches([_table([(int(d[a]), _pack5(h[a:b])) for a, b in parts],
                                         [("doc", pa.int64()), ("said", pa.binary())])])


def _again(buckets: int):
    def run(bucket: pa.Table) -> pa.Table:
        return _repeated(bucket, buckets)
    return run


def _repeated(bucket: pa.Table, slots: int) -> pa.Table:
    """A bucket's hashes that several tasks have, back to their documents' slots."""
    import zstandard
    unpress = zstandard.ZstdDecompressor()
    h, d, m = [], [], []
    for x in bucket.column("data"):
        data = unpress.decompress(x.as_py())
        n = struct.unpack_from("<I", data)[0]
        h.append(_unpack5(data[4:4 + 5 * n]))
        d.append(np.cumsum(np.frombuffer(data, np.int64, n, 4 + 5 * n)))
        m.append(np.frombuffer(data, bool, n, 4 + 13 * n))
    h, d, m = map(np.concatenate, (h, d, m))
    order = np.argsort(h, kind="stable")
    h, d, m = h[order], d[order], m[order]
    head = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    count = np.diff(np.r_[head, len(h)])
    back = np.repeat(count > 1, count) & ~m  # the others have been told by their own task
    return pa.Table.from_batches([_table([*_answers(d[back], h[back], slots)], [("slot", pa.int64()), ("data", pa.binary())])])


_PIECE = [("key", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("place", pa.int64()), ("piece", pa.binary()),
          ("ranges", pa.binary())]
_PIECE_DDL = "key long, doc long, tag long, place long, piece binary, ranges binary"


def _pieces(held_bytes: int, least: int, gram: int, strings: int):
    """Pieces with a repeated hash; one that an earlier equal piece of the task makes redundant is a range at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        unpress = zstandard.ZstdDecompressor()
        seen: dict[bytes, tuple] = {}
        gone: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            rows = [(k, d, t, p, x, None) for x, (d, p, t, k) in seen.items()] + gone
            seen.clear()
            gone.clear()
            return _table(rows, _PIECE)

        for b in batches:
            for doc, sha, z, said in zip(b.column("doc").to_pylist(), b.column("sha"), b.column("z"), b.column("said")):
                data, tag = unpress.decompress(z.as_py()), int.from_bytes(sha.as_py()[:8], "little", signed=True)
                low, _ = smallest_hashes(data, least, gram)
                head = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
                stop = np.r_[head[1:], len(low)]
                wanted = np.isin(short(low[head]), _unpack5(said.as_py()))
                for s, e, k in zip(head[wanted].tolist(), stop[wanted].tolist(), low[head[wanted]].view(np.int64).tolist()):
                    for at in range(s, e, strings):
                        to = min(at + strings, e) + least - 1
                        x = data[at:to]
                        old = seen.get(x)
                        if old is None:
                            seen[x] = (doc, at, tag, k)
                            held += len(x) + 300
                            continue
                        if (doc, at) < old[:2]:
                            seen[x] = (doc, at, tag, k)
                            lost = old
                        else:
                            lost = (doc, at, tag, k)
                        if lost[:2] != seen[x][:2]:
                            gone.append((None, lost[0], lost[2], None, None, struct.pack("<QQ", lost[1], lost[1] + len(x))))
                            held += 300
                if held >= held_bytes:
                    yield flush()
                    held = 0
        if seen or gone:
            yield flush()
    return run


def _decide(collection_bytes: int, hot_bytes: int, least: int):
    """Pieces sorted by hash: ranges to remove; pieces of a hot hash cut by deeper ones (key set, ranges null).

    ``hot_bytes`` 0: no hash is hot.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        done: dict[bytes, tuple[int, int, int]] = {}  # pieces of hashes that are complete
        open_: dict[bytes, tuple[int, int, int]] = {}
        state = {"key": None, "size": 0, "done": 0, "hot": False}

        def repeats(x: bytes) -> bool:
            return len({x[o:o + least] for o in range(len(x) - least + 1)}) <= len(x) - least

        def strings_of(x: bytes, spot: tuple[int, int, int]) -> None:
            low, _ = smallest_hashes(x, least, max(1, least - DEEPER))
            head = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
            for s, e, k in zip(head.tolist(), [*head[1:].tolist(), len(low)], low[head].view(np.int64).tolist()):
                rows.append((k, spot[0], spot[1], spot[2] + s, x[s:e + least - 1], None))

        def close() -> None:
            # a piece alone with its hash has its equals, if any, within itself
            if not state["hot"] and (len(open_) > 1 or any(map(repeats, open_))):
                done.update(open_)
                state["done"] += state["size"]
            open_.clear()
            state.update(size=0, hot=False)

        def solve() -> None:
            rows.extend((None, d, t, None, None, r) for d, t, r in later(done, least))
            done.clear()
            state["done"] = 0

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("key", "doc", "tag", "place", "piece")]
            for key, doc, tag, place, x in zip(*cols):
                if key != state["key"]:
                    close()
                    state["key"] = key
                    if state["done"] >= collection_bytes:
                        solve()
                spot = (doc, tag, place)
                old = open_.get(x)
                if old is not None:
                    first, lost = (spot, old) if (doc, place) < (old[0], old[2]) else (old, spot)
                    open_[x] = first
                    if (lost[0], lost[2]) != (first[0], first[2]):
                        rows.append((None, lost[0], lost[1], None, None, struct.pack("<QQ", lost[2], lost[2] + len(x))))
                    if state["hot"] and first is spot:
                        strings_of(x, spot)
                elif state["hot"]:
                    strings_of(x, spot)
                else:
                    open_[x] = spot
                    state["size"] += len(x)
                    if hot_bytes and state["size"] > hot_bytes:
                        state["hot"] = True
                        for y, s in open_.items():
                            strings_of(y, s)
                            if len(rows) > 20_000:
                                yield _table(rows, _PIECE)
                                rows.clear()
                if len(rows) > 20_000:
                    yield _table(rows, _PIECE)
                    rows.clear()
        close()
        solve()
        yield _table(rows, _PIECE)
    return run


def _removed(with_text: bool):
    """Per text the merged ranges, their bytes, and digest (or bytes) of what stays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        unpress = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for doc, sha, z, said in zip(b.column("doc").to_pylist(), b.column("sha"), b.column("z"), b.column("said").to_pylist()):
                tag = int.from_bytes(sha.as_py()[:8], "little", signed=True)
                pairs = np.frombuffer(b"".join(x["ranges"] for x in said if x["tag"] == tag), "<u8").reshape(-1, 2).astype(np.int64)
                if not len(pairs):
                    continue
                data = unpress.decompress(z.as_py())
                edge = np.zeros(len(data) + 1, np.int32)
                np.add.at(edge, pairs[:, 0], 1)
                np.subtract.at(edge, pairs[:, 1], 1)
                gone = np.cumsum(edge[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out.append((doc, sha.as_py(), int(gone.sum()), turns.reshape(-1, 2).tolist(), hashlib.sha256(kept).digest(),
                            kept if with_text else None))
            yield _table(out, [("doc", pa.int64()), ("sha", pa.binary()), ("n_removed", pa.int64()),
                               ("spans", pa.list_(pa.list_(pa.int64()))), ("kept_sha", pa.binary()), ("kept", pa.binary())])
    return run


# ---------------------------------------------------------------- operator

def route(tag: Column | None = None) -> Column:
    """What a text and its answers meet by: its id; texts without one, however many, spread by a tag from their digest."""
    if tag is None:
        digits = F.hex(F.substring("sha", 1, 8))  # the tag's bytes, least first
        tag = F.conv(F.concat(*[F.substring(digits, at, 2) for at in range(15, 0, -2)]), 16, -10).cast("long")
    return F.when(F.col("doc") == NO_ID, tag).otherwise(F.col("doc"))


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, gram: int = GRAM,
                 strings: int = STRINGS, collection_bytes: int = COLLECTION_BYTES, hot_bytes: int = HOT_BYTES,
                 held_bytes: int = HELD_BYTES, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, spans`` (pairs of bytes), ``kept_sha256``, ``kept``.

    ``kept`` (bytes) only if ``with_text``; null where all of the text stays.
    """
    spark = docs.sparkSession
    n = spread(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    members = written(rows.mapInArrow(_marks, "id long, sha binary, size long"), "suffix-members")
    doc = F.coalesce("id", F.lit(NO_ID)).alias("doc")
    first = members.filter(F.col("size") >= least).select("sha", doc).groupBy("sha").agg(F.min("doc").alias("doc"))
    first = first.select(route().alias("route"), "sha").groupBy("route").agg(F.collect_list("sha").alias("own"))
    texts = (rows.mapInArrow(_different(held_bytes, least), "doc long, sha binary, z binary").withColumn("route", route())
             .repartition(n, "route").sortWithinPartitions("route").persist(StorageLevel.DISK_ONLY))
    total = members.agg(F.sum("size").alias("n")).first()["n"] or 0
    buckets = max(n, -(-total // BUCKET_BYTES))

    own = texts.join(first, "route").filter(F.array_contains("own", F.col("sha"))).drop("own")
    told = written(own.select(F.col("route").alias("doc"), "z").mapInArrow(
        _hashes(buckets, held_bytes, least, gram), "bucket long, slot long, data binary"), "suffix-hashes")
    answers = (told.filter("slot is not null").select("slot", "data")
               .unionByName(told.filter("bucket is not null").select("bucket", "data").repartition(n, "bucket")
                            .groupBy("bucket").applyInArrow(_again(buckets), "slot long, data binary"))
               .groupBy("slot").applyInArrow(_by_document, "doc long, said binary").withColumnRenamed("doc", "route"))
    pieces = written(texts.join(first, "route").filter(F.array_contains("own", F.col("sha"))).drop("own").join(answers, "route")
                     .mapInArrow(_pieces(held_bytes, least, gram, strings), _PIECE_DDL), "suffix-pieces")

    def decided(some: DataFrame, hot_bytes: int) -> DataFrame:
        dealt = some.select("key", "doc", "tag", "place", "piece").repartition(n, "key").sortWithinPartitions("key")
        return written(dealt.mapInArrow(_decide(collection_bytes, hot_bytes, least), _PIECE_DDL), "suffix-ranges")

    once = decided(pieces.filter("key is not null"), hot_bytes)
    parts = [pieces, once]
    hot = once.filter("key is not null")
    if not hot.isEmpty():
        parts.append(decided(hot, 0))
    ranges = None
    for part in parts:
        got = part.filter("ranges is not null").select(route(F.col("tag")).alias("route"), F.struct("tag", "ranges").alias("r"))
        ranges = got if ranges is None else ranges.unionByName(got)
    ranges = ranges.groupBy("route").agg(F.collect_list("r").alias("said"))
    removed = written(texts.join(ranges, "route").mapInArrow(
        _removed(with_text), "doc long, sha binary, n_removed long, spans array<array<bigint>>, kept_sha binary, kept binary"), "suffix-removed")
    texts.unpersist()

    lead = members.select("sha", doc).groupBy("sha").agg(F.min("doc").alias("lead"))
    all_ = members.select("id", doc, "sha", "size").join(lead, "sha")
    all_ = all_.join(removed.dropDuplicates(["doc", "sha"]), ["doc", "sha"], "left")  # a repeated row's text may be there twice
    copy = (F.col("doc") > F.col("lead")) & (F.col("size") >= least)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return all_.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), F.col("size").alias("n_bytes"),
        F.when(copy, F.col("size")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.array(F.array(F.lit(0).cast("long"), F.col("size"))))
        .otherwise(F.coalesce("spans", F.array().cast("array<array<bigint>>"))).alias("spans"),
        F.when(copy, nothing).otherwise(F.lower(F.hex(F.coalesce("kept_sha", "sha")))).alias("kept_sha256"),
        F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept"))


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table
    got = suffix_dedup(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
