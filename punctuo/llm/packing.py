"""Best-fit packing (7): a configuration linear program over the length histogram.

1. Documents become pieces of at most ``capacity`` tokens (map step; narrow rows are written once).
2. The histogram of piece lengths (at most ``capacity`` numbers, whatever the input) goes to the driver.
   Its configuration LP, min sum(x_c) with sum(x_c * c[l]) >= n_l over all ways c to fill a sequence, is
   solved by multiplicative weights on configurations and lengths: lengths covered less than they need gain weight,
   configurations worth more than a sequence are used more, steps are averaged. The weights price new
   configurations by a knapsack dynamic program over the capacity, and each pricing bounds the LP from below
   (the lengths' values over the dearest filling). It ends with solution and bound within ``GAP``. One way at all sizes.
3. Rounding: shares of the solution are cut to whole numbers, with and without the configurations that leave a
   gap, configurations are taken only as far as pieces are left, and what remains is filled in best-fit order,
   length by length; of the shares tried, and best fit alone, the one with the fewest sequences stays.
4. The plan (configuration, how often) says for the r-th piece of a length which sequence and offset it
   gets. Pieces are numbered within (length, salt), with offsets from the counts, so a length that a third
   of all pieces share is numbered by many tasks. The plan's arrays are bounded by the number of
   configurations and are broadcast.

Defined cases: null and empty texts are the end id alone; repeated rows are packed one by one; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

CAPACITY = 4096
END_ID = 1
#: Part of the lower bound that the LP's solution may be above it; pricings, at most.
GAP = 0.001
PRICINGS = 100
#: Steps of the multiplicative weights after each pricing, and their size.
STEPS = 100
STEP = 0.5
#: Worth of a configuration, in sequences, from which on it joins the pool; configurations that the pool holds, about.
NEAR = 0.98
POOL = 60_000
#: Shares of the fractional solution that the rounding takes over, the best of which stays.
SHARES = (1.0, 0.5, 0.1)
#: Rows of one numbering group, about.
GROUP_ROWS = 4096
#: Bytes that a worker holds of white-space words, and of parts of words, with their ids; bytes of an entry without its letters.
KNOWN_WORDS = 200_000_000
KNOWN_PARTS = 100_000_000
ENTRY = 200
MARK = b"\xff" * 4


# ---------------------------------------------------------------- tokens

class Known(dict):
    """Ids by string, as bytes, in about ``most`` bytes of memory. What was used since it was last half full stays."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.held, self.old = most, 0, {}

    def missing(self, keys: set[str]) -> list[str]:
        """Those that must be made; room is made and old ones are taken over."""
        new = list(filterfalse(self.__contains__, keys))
        if not new:
            return new
        self.held += ENTRY * len(new) + 3 * sum(map(len, new))
        if self.held > self.most // 2:
            self.old, new = dict(self), list(keys)
            self.clear()
            self.held = ENTRY * len(new) + 3 * sum(map(len, new))
        if old := self.old:
            again = list(filter(old.__contains__, new))
            self.update(zip(again, map(old.__getitem__, again)))
            new = list(filterfalse(old.__contains__, new))
        return new


class Encoder:
    """Ids of a text by the given vocabulary file.

    The vocabulary's rules split at white space, then into letters, single digits and other signs, and
    merge nothing across those parts. So ids are remembered for white-space words, and for their parts
    (lower case), which come from the library's merge model. The split is done here only for words below
    U+0250 without ``<|``, where lower case, composition and letter classes are settled; all other words go
    through the library whole, and so does a text with \x1c-\x1f (white space for Python only).
    """

    PART = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"  # fixed: the vocabulary file's own rule

    def __init__(self, vocabulary: str):
        self.vocabulary, self.tokenizer = vocabulary, None

    def _load(self) -> None:
        import re

        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(self.vocabulary)
        self.parts_of = regex.compile(self.PART + "|\n").findall
        self.whole = re.compile("[\u0250-\U0010ffff]|<\\|").search
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        rest = [b for b in range(256) if b not in set(plain)]  # byte-level alphabet: the others follow from U+0100 on
        self.sign = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.sign = {b: c for b, c in self.sign.items() if ord(c) != b}
        self.parts, self.words = Known(KNOWN_PARTS), Known(KNOWN_WORDS)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        raw = part if part.isascii() else part.encode().decode("latin-1").translate(self.sign)
        ids = [t.id for t in self.tokenizer.model.tokenize(raw)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, words: list[str]) -> None:
        if self.whole("\n".join(words)):
            for w in filter(self.whole, words):
                self.words[w] = self._whole(w)
            words = [w for w in words if not self.whole(w)]
        for at in range(0, len(words), 4096):
            some = words[at:at + 4096]
            parts = self.parts_of("\n".join(some).lower())
            for p in self.parts.missing(set(parts)):
                self.parts[p] = self._part(p)
            self.parts["\n"] = MARK  # no id has such bytes in it, and none that end and begin beside each other
            self.words.update(zip(some, b"".join(map(self.parts.__getitem__, parts)).split(MARK)))

    def __call__(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if self.tokenizer is None:
            self._load()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self._whole(text)
        words = text.split()
        ids = list(map(self.words.get, words))
        if None in ids:  # only what isn't at hand is looked up again
            gaps = [i for i, x in enumerate(ids) if x is None]
            if new := self.words.missing({words[i] for i in gaps}):
                self._learn(new)
            for i in gaps:
                ids[i] = self.words[words[i]]
        return b"".join(ids)


def _pieces(shared, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib
        held, end = shared.value, struct.pack("<I", end_id)  # a worker keeps the dict, and so the encoder
        encode = held.get("encoder") or held.setdefault("encoder", Encoder(held["vocabulary"]))
        for b in batches:
            ids, text = b.column(0), b.column(1)
            row, piece, start, length, crc = [], [], [], [], []
            for i in range(b.num_rows):
                tokens = encode(text[i].as_py() or "") + end
                for k, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    part = tokens[at:at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["id", "piece", "start", "length", "ids_crc32"])
    return run


# ---------------------------------------------------------------- plan (driver; sizes bounded by the capacity)

Config = tuple[tuple[int, int], ...]  # (length, how many) of one sequence


def price(lengths: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Knapsack by dynamic programming: per room its best value, the length (its place) to put in last, and the room from there.

    Room ``c`` filled best holds ``lengths[last[c]]`` and the best filling of ``rest[c]``; -1: nothing fits.
    """
    best, last, rest = np.zeros(capacity + 1), np.full(capacity + 1, -1), np.zeros(capacity + 1, np.int64)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c], last[c], rest[c] = best[c - 1], last[c - 1], rest[c - 1]
        if fits[c]:
            got = best[c - lengths[:fits[c]]] + value[:fits[c]]
            k = int(got.argmax())
            if got[k] > best[c]:
                best[c], last[c], rest[c] = got[k], k, c - lengths[k]
    return best, last, rest


def fillings(first: np.ndarray, lengths: np.ndarray, last: np.ndarray, rest: np.ndarray, capacity: int) -> np.ndarray:
    """A row for each of ``first``: its place and those of the best filling of the room it leaves; -1 behind them."""
    held, room = [first], capacity - lengths[first]
    while True:  # all fillings side by side
        k = last[room]
        if (k < 0).all():
            return np.stack(held, axis=1)
        held.append(k)
        room = np.where(k < 0, room, rest[room])


def covering(lengths: np.ndarray, need: np.ndarray, capacity: int) -> dict[bytes, float]:
    """A first solution: priced fillings, each used as often as the scarcest of its lengths lasts, until all is covered.

    Nothing is covered twice, and each configuration (its places, as bytes) uses up a length, so there are no more than lengths.
    """
    rng = np.random.default_rng(7)
    left, out = need.copy(), {}
    while len(live := np.flatnonzero(left)):
        value = lengths[live] * (1 + 0.02 * rng.random(len(live)))  # else one length fills all the gaps
        _, last, rest = price(lengths[live], value, capacity)
        for row in fillings(np.arange(len(live))[::-1], lengths[live], last, rest, capacity):
            held = np.sort(live[row[row >= 0]])
            places, counts = np.unique(held, return_counts=True)
            times = float((left[places] / counts).min())
            if times > 0:
                left[places] = np.where(left[places] - counts * times < 1e-9, 0, left[places] - counts * times)
                out[held.tobytes()] = out.get(held.tobytes(), 0.0) + times
    return out


class Pool:
    """Configurations side by side: places and counts of all of them, one behind the other, and how often each is used."""

    def __init__(self, lengths: int):
        self.lengths, self.keys, self.seen = lengths, [], set()
        self.place, self.count, self.size, self.times = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64), np.empty(0)

    def add(self, found: dict[bytes, float]) -> None:
        new = {k: t for k, t in found.items() if k not in self.seen}
        if not new:
            return
        held = [np.unique(np.frombuffer(k, np.int64), return_counts=True) for k in new]
        self.place = np.concatenate([self.place, *(p for p, _ in held)])
        self.count = np.concatenate([self.count, *(c.astype(float) for _, c in held)])
        self.size = np.concatenate([self.size, [len(p) for p, _ in held]]).astype(np.int64)
        self.times = np.concatenate([self.times, list(new.values())])
        self.keys += new
        self.seen.update(new)

    def keep(self, which: np.ndarray) -> None:
        of = np.repeat(which, self.size)
        self.place, self.count, self.size, self.times = self.place[of], self.count[of], self.size[which], self.times[which]
        self.keys = [k for k, w in zip(self.keys, which) if w]
        self.seen = set(self.keys)

    def worth(self, value: np.ndarray) -> np.ndarray:
        """Of each configuration, at these values of the lengths."""
        return np.add.reduceat(self.count * value[self.place], np.cumsum(self.size) - self.size)

    def covered(self, times: np.ndarray) -> np.ndarray:
        """Of each length, by configurations used so often."""
        return np.bincount(self.place, self.count * np.repeat(times, self.size), minlength=self.lengths)


def weighted(pool: Pool, value: np.ndarray, need: np.ndarray, steps: int, step: float) -> np.ndarray:
    """Multiplicative weights on both sides, each step looked ahead once; the averages of the steps are left in the pool and returned.

    A configuration is used more where its lengths are worth more than a sequence, a length is worth more where it is
    covered less than it needs. Both exponents are relative (to a sequence, to the need), so the step doesn't
    depend on how rare a length is.
    """
    times, many, much = pool.times, np.zeros_like(pool.times), np.zeros_like(value)
    turned = lambda x, slope: x * np.exp(step * np.clip(slope, -2, 2))
    for _ in range(steps):
        ahead = turned(times, pool.worth(value) - 1), turned(value, 1 - pool.covered(times) / need)
        slopes = pool.worth(ahead[1]) - 1, 1 - pool.covered(ahead[0]) / need
        times, value = turned(times, slopes[0]), turned(value, slopes[1])
        many, much = many + ahead[0], much + ahead[1]
    pool.times = many / steps
    return much / steps


def fractional(lengths: np.ndarray, need: np.ndarray, capacity: int, gap: float = GAP) -> tuple[list[tuple[Config, float]], float, float]:
    """Configurations and how often each is used in a solution of the LP, its value, and a lower bound of the LP.

    One pricing answers for all lengths at once: the best configuration that holds length l is l and the best
    filling of the room it leaves. Those worth about a sequence join the pool, the weights run on it, and the values
    they end with are priced next; over the dearest filling they bound the LP. It ends when solution and bound are
    within ``gap`` (or after ``PRICINGS``); what the best solution covers too little is filled up one length at a time.
    """
    pool = Pool(len(lengths))
    pool.add(covering(lengths, need, capacity))
    value, least, bound = lengths / capacity, np.inf, float(lengths @ need) / capacity
    out: list[tuple[Config, float]] = []
    for turn in range(PRICINGS):
        short = np.maximum(need - pool.covered(pool.times), 0)
        total = float(pool.times.sum() + (short / (capacity // lengths)).sum())
        if total < least:
            least, single = total, capacity // lengths
            parts = [np.unique(np.frombuffer(k, np.int64), return_counts=True) for k, t in zip(pool.keys, pool.times) if t > 1e-6]
            out = [(tuple(zip(lengths[p].tolist(), c.tolist())), float(t)) for (p, c), t in zip(parts, pool.times[pool.times > 1e-6])]
            out += [(((int(lengths[i]), int(single[i])),), float(short[i] / single[i])) for i in np.flatnonzero(short > 1e-6)]
        best, last, rest = price(lengths, value, capacity)
        bound = max(bound, float(value @ need) / best[capacity])
        if least <= bound * (1 + gap):
            break
        near = np.flatnonzero(value + best[capacity - lengths] > NEAR * min(1.0, best[capacity])) if turn else np.arange(len(lengths))
        found = {}
        for row in fillings(near, lengths, last, rest, capacity):
            held = np.sort(row[row >= 0])
            places, counts = np.unique(held, return_counts=True)
            found[held.tobytes()] = 1e-3 * float((need[places] / counts).min())
        pool.add(found)
        value = weighted(pool, value if turn else value / best[capacity], need, STEPS, STEP)
        if len(pool.keys) > POOL:
            pool.keep((pool.times > 1e-7 * least / len(lengths)) | (pool.worth(value) > 0.95))
    return out, least, bound


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[Config, int]]:
    """Best-fit decreasing on a histogram: equal sequences are opened and filled together."""
    open_: dict[int, dict[Config, int]] = {}  # room left -> configurations -> how many
    rooms = np.zeros(capacity + 1, np.int64)
    for size in sorted(left, reverse=True):
        n = left[size]
        while n > 0:
            fit = np.flatnonzero(rooms[size:])
            if len(fit):
                room = size + int(fit[0])
                config, many = next(iter(open_[room].items()))
                each = min(room // size, n)
                use = min(many, n // each)
                rooms[room] -= use
                open_[room][config] -= use
                if not open_[room][config]:
                    del open_[room][config]
            else:
                room, config, each = capacity, (), min(capacity // size, n)
                use = n // each
            room -= each * size
            rooms[room] += use
            slot, config = open_.setdefault(room, {}), (*config, (size, each))
            slot[config] = slot.get(config, 0) + use
            n -= each * use
    return [(c, n) for found in open_.values() for c, n in found.items()]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, gap: float = GAP) -> list[tuple[Config, int]]:
    """Configurations with how many sequences use each; together just the histogram."""
    if not histogram:
        return []
    lengths = np.array(sorted(histogram), np.int64)
    need = np.array([histogram[int(x)] for x in lengths], float)
    solution, _, _ = fractional(lengths, need, capacity, gap)
    return min(candidates(histogram, solution, capacity), key=lambda p: sum(n for _, n in p))


def candidates(histogram: dict[int, int], solution: list[tuple[Config, float]], capacity: int) -> list[list[tuple[Config, int]]]:
    """Plans by rounding shares of ``solution``, with the configurations that leave a gap and without; and best fit alone."""
    return [best_fit(histogram, capacity), *(rounded(histogram, solution, share, capacity) for share in SHARES),
            *(supported(histogram, solution, share, capacity) for share in SHARES)]


def rounded(histogram: dict[int, int], solution: list[tuple[Config, float]], share: float, capacity: int) -> list[tuple[Config, int]]:
    """Whole numbers for ``share`` of the solution's full configurations, best fit for what is left."""
    left, used, due = dict(histogram), {}, 0.0
    for config, times in solution:
        if sum(size * n for size, n in config) < capacity:  # see ``supported``
            continue
        due += times * share  # the fractions of one configuration pass on to the next
        n = min(int(due), min(left[size] // count for size, count in config))
        if n > 0:
            due -= n
            used[config] = used.get(config, 0) + n
            for size, count in config:
                left[size] -= count * n
        due = min(due, 1.0)
    return [*used.items(), *best_fit({k: n for k, n in left.items() if n}, capacity)]


def supported(histogram: dict[int, int], solution: list[tuple[Config, float]], share: float, capacity: int) -> list[tuple[Config, int]]:
    """Whole numbers for ``share`` of all configurations, those used most first; best fit for what is left.

    The solution may cover a length more than it needs: where its pieces are used up, the others go without it.
    """
    left, total, used = dict(histogram), {}, {}
    for config, times in solution:
        total[config] = total.get(config, 0.0) + times
    for config, times in sorted(total.items(), key=lambda c: -c[1]):
        due = int(times * share + 1e-6)
        while due and config:
            n = min(due, min(left[size] // count for size, count in config))
            if n > 0:
                due -= n
                used[config] = used.get(config, 0) + n
                for size, count in config:
                    left[size] -= count * n
            config = tuple((size, min(count, left[size])) for size, count in config if left[size])
    return [*used.items(), *best_fit({k: n for k, n in left.items() if n}, capacity)]


def runs(plan_: list[tuple[Config, int]]) -> dict[str, np.ndarray]:
    """The plan by length: piece numbers from ``first`` on go, ``count`` to a sequence, to ``sequence`` and on."""
    rows, taken, sequence = [], {}, 0
    for config, n in plan_:
        offset = 0
        for size, count in config:
            rows.append((size, taken.get(size, 0), count, sequence, offset))
            taken[size] = taken.get(size, 0) + count * n
            offset += size * count
        sequence += n
    cols = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return dict(zip(("size", "first", "count", "sequence", "offset"), cols))


def _placed(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        begin = {}
        sizes, at = np.unique(p["size"], return_index=True)
        for size, lo, hi in zip(sizes.tolist(), at.tolist(), [*at[1:].tolist(), len(p["size"])]):
            begin[size] = (lo, hi)
        for b in batches:
            length, number = (b.column(c).to_numpy() for c in ("length", "number"))
            run_ = np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(part):
                    lo, hi = begin[int(length[part[0]])]
                    run_[part] = lo + np.searchsorted(p["first"][lo:hi], number[part], side="right") - 1
            r = number - p["first"][run_]
            sequence = p["sequence"][run_] + r // p["count"][run_]
            offset = p["offset"][run_] + r % p["count"][run_] * length
            keep = [i for i, n in enumerate(b.schema.names) if n != "number"]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(sequence), pa.array(offset)],
                                             names=[*(b.schema.names[i] for i in keep), "sequence_id", "offset"])
    return run


def numbered(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``number``: 0, 1, ... among the pieces of a length, whatever task they are in."""
    rows = pieces.count()
    salts = max(1, rows // GROUP_ROWS)
    p = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(salts)))
    # a length's salts: few lengths are hot, so groups are counted first and only their counts are summed up
    count = p.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = (F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
    base = count.select("length", "salt", F.coalesce(before, F.lit(0)).alias("base"))
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32"))
    return (p.withColumn("nth", nth).join(base, ["length", "salt"])
            .withColumn("number", F.col("base") + F.col("nth") - 1).drop("salt", "nth", "base"))


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, gap: float = GAP) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:  # a file of the driver's; tasks get it by broadcast
        shared = spark.sparkContext.broadcast({"vocabulary": f.read()})
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    narrow = f"id {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = written(rows.mapInArrow(_pieces(shared, capacity, end_id), narrow), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    where = spark.sparkContext.broadcast(runs(plan(histogram, capacity, gap)))
    return (numbered(pieces).select("id", "piece", "start", "length", "ids_crc32", "number")
            .mapInArrow(_placed(where), f"{narrow}, sequence_id long, offset long")
            .withColumnRenamed("id", id_col))


def op7_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .common import table
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
