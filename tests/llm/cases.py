"""Small tables with awkward rows, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

PASSAGE = "The quick brown fox jumps over the lazy dog while seventy-one geese fly south, and nobody minds; " * 3


def documents(seed: int = 3, n: int = 60) -> list[tuple]:
    """(doc_id, text): copies, near copies, shared passages, nulls, empty, one-letter, very long and repeated rows."""
    rng = random.Random(seed)
    words = ["lorem", "Ipsum", "dolor", "été", "naïve", "x", "42", "sit-amet", "Ωmega", "日本語"] + \
        ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(300)]
    text = lambda k: "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", ", "]) for _ in range(k))
    rows: list[tuple] = [(i, text(rng.randint(1, 120))) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(8)]
    rows += [(n + 20 + i, rows[7][1].upper() if i % 2 else rows[7][1]) for i in range(4)]
    base = text(200)
    rows += [(n + 40 + i, base[:400 + i] + "z" + base[400 + i:]) for i in range(12)]
    rows += [(n + 60 + i, text(20) + PASSAGE + text(10)) for i in range(10)]
    rows += [(n + 80, None), (n + 81, None), (n + 82, ""), (n + 83, " \n\t "), (n + 84, "a" * 700), (n + 85, "ab" * 300),
             (n + 86, text(9000)), (n + 87, "one"), (n + 88, "one two")]
    return rows


TIES = [(5, "same row " * 30), (5, "same row " * 30), (5, "another text under the id " * 10), (None, "no id " * 40),
        (None, "no id " * 40), (None, None), (9, "no id " * 40)]


def frame(spark, rows, extra: bool = True):
    """Rows as a table of four partitions, with extra columns whose names the operators use themselves."""
    kind = "doc_id long, text string" + (", id string, kept boolean, `key` int, score string, n long, simhash int, sha string, "
                                         "hits int, nth int, z double, label_ array<int>" if extra else "")
    more = ("x", None, 1, None, 2, 3, None, 4, 5, 0.5, [1]) if extra else ()
    return spark.createDataFrame([tuple(r) + more for r in rows], kind).repartition(4)


def as_bytes(text):
    return (text or "").encode()


def removed(docs, least: int = 100):
    first, out = {}, {}
    for d, t in sorted(docs, key=lambda r: r[0]):
        b = as_bytes(t)
        gone = bytearray(len(b))
        for s in range(len(b) - least + 1):
            w = b[s:s + least]
            if w in first:
                gone[s:s + least] = b"\1" * least
            first.setdefault(w, (d, s))
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())
    return out


def simhashes(docs, bits: int = 2, shingle: int = 3):
    import xxhash
    fps = []
    for d, t in docs:
        w = as_bytes(t).lower().split()
        s = [b" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        fps.append(sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)))
    low = list(range(len(docs)))
    while True:
        new = [min(low[j] for j in range(len(docs)) if (fps[i] ^ fps[j]).bit_count() <= bits) for i in range(len(docs))]
        if new == low:
            break
        low = new
    group = {}
    for i, x in enumerate(low):
        if docs[i][0] is not None:
            group[x] = min(group.get(x, docs[i][0]), docs[i][0])
    return Counter((docs[i][0], f"{fps[i]:016x}", group.get(low[i])) for i in range(len(docs)))


def hits(docs, items, window: int = 13):
    import re
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    held = []
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            held.append((item if item is None else str(item), w[i:i + window]))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for item, p in held:
            for i in range(len(w) - len(p) + 1):
                if w[i:i + len(p)] == p:
                    hit.update(range(i, i + len(p)))
                    found |= {item} - {None}
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return Counter(out)


def held_out(doc) -> bool:
    return zlib.crc32(str(doc).encode()) % 5 == 0
