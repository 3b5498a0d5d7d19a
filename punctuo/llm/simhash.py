"""SimHash near-dedup (8): Gray-order hierarchical index over 64-bit fingerprints.

Fingerprint: majority of the bits of the XXH64 values (seed 42) of a text's word shingles.

Index over the *distinct* fingerprints:

* **Gray order.** They are numbered by Gray rank (range partitions, two passes), in which neighbours share long bit
  patterns, and cut into groups of ``GROUP`` (more where that would be over ``NODES`` groups).
* **Shared masked bit patterns as nodes.** AND and OR of a group give the bits all of it shares. The groups, then
  ``FANOUT`` of them and so on, are the upper nodes of a tree, each holding only the shared bits its parent doesn't
  hold already; inside a group the same tree goes on down to single fingerprints.
* **Pruning.** A search goes down the levels adding up differences and drops a whole node as soon as the sum
  exceeds ``bits``. Every fingerprint is searched in the upper tree (at most ``NODES`` masks and patterns, broadcast),
  which sends it to the groups that may hold a link, from its own on (a link is looked for from one side). Groups
  and what was sent to them meet by a shuffle, and the search goes on inside.

A fingerprint within ``bits`` of a group's member differs from the group's shared bits by no more, so no link is lost.
A group gives each searched fingerprint's link to one member, and links among its members to their components' smallest
(no pair lists); global components follow by large-star / small-star rounds on a table written to the shared folder each round.

Defined cases: null and empty texts (no words) have fingerprint zero and link like any other; fewer
words than a shingle make one shingle of all; null ids are never the smallest of a component unless it
has no other; an empty table gives an empty result; extra columns are ignored (``near_survivors`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuo.operators.dims import numbered

from .common import fresh, one_row_each, schema_with, spread, written

SHINGLE = 3
BITS = 2
FANOUT = 16
#: Fingerprints of a group, at least; groups in the broadcast upper tree, about; fingerprints in a row of either side.
GROUP = 4096
NODES = 65_536
ROW = 1024
#: Links in a file of the components' rounds, about, and of those that a task looks at together.
LINKS = 50_000


# ---------------------------------------------------------------- fingerprints

def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    import xxhash
    words = data.lower().split()  # bytes: A-Z only, and \x20 \x09-\x0d only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return digest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: n - 1].tolist()]
    stops = (ends[shingle - 1:] - 1).tolist()
    total = np.zeros(64, np.int64)
    for at in range(0, n, 65536):  # a very long text in slices
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at:at + 65536], stops[at:at + 65536])], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def _fingerprints(text_col: str, shingle: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(text_col).cast(pa.large_binary())
            got = np.fromiter((fingerprint(x.as_py() or b"", shingle) for x in texts), np.uint64, len(texts))
            keep = [(c, n) for c, n in zip(b.columns, b.schema.names) if n != text_col or name != "fp"]
            yield pa.RecordBatch.from_arrays([*(c for c, _ in keep), pa.array(got.view(np.int64))],
                                             names=[*(n for _, n in keep), name])
    return run


# ---------------------------------------------------------------- index

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of a code word in reflected Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayIndex:
    """Entries in Gray order under levels of shared masked bit patterns.

    Entries are distinct fingerprints, or groups of them: then ``fps`` are the ANDs of the groups in Gray order, ``anys`` the ORs.
    """

    def __init__(self, fps: np.ndarray, anys: np.ndarray | None = None, fanout: int = FANOUT):
        self.order = np.argsort(gray_rank(fps), kind="stable") if anys is None else np.arange(len(fps))
        self.fps, self.fanout = fps[self.order], fanout
        every = np.uint64(0xFFFFFFFFFFFFFFFF)
        ones, anys = [self.fps], [self.fps if anys is None else anys]
        while len(ones[-1]) > fanout:  # AND and OR of each group give the bits all of it share
            cut = np.arange(0, len(ones[-1]), fanout)
            ones.append(np.bitwise_and.reduceat(ones[-1], cut))
            anys.append(np.bitwise_or.reduceat(anys[-1], cut))
        shared = [~(a ^ o) & every for a, o in zip(anys, ones)]
        self.levels = []  # (mask, pattern), leaves first; a mask leaves out what the parent holds
        for k, (mask, one) in enumerate(zip(shared, ones)):
            own = mask & ~np.repeat(shared[k + 1], fanout)[: len(mask)] if k + 1 < len(shared) else mask
            self.levels.append((own, one & own))

    def search(self, queries: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, position in Gray order) of all entries within ``bits`` of a query."""
        top = len(self.levels[-1][0])
        q, node = np.repeat(np.arange(len(queries)), top), np.tile(np.arange(top), len(queries))
        off = np.zeros(len(q), np.uint8)
        for k in range(len(self.levels) - 1, -1, -1):
            mask, pattern = self.levels[k]
            off = off + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            live = off <= bits
            q, node, off = q[live], node[live], off[live]
            if k:  # children of the groups that are left
                below = len(self.levels[k - 1][0])
                child = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
                q, off = np.repeat(q, self.fanout), np.repeat(off, self.fanout)
                real = child < below
                q, node, off = q[real], child[real], off[real]
        return q, node


def smallest_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per item the smallest item its component holds, items 0..n-1 linked pairwise by a, b."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, low[a], m)
        np.minimum.at(new, low[b], m)
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _routed(shared, bits: int):
    """Rows of fingerprints to rows for each group that may hold a link of theirs, from their own group on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = GrayIndex(*shared.value)
        for batch in batches:
            for own, fps in zip(batch.column("group").to_pylist(), batch.column("fps")):
                fps = fps.values.to_numpy(zero_copy_only=False)
                q, group = top.search(fps.view(np.uint64), bits)
                q, group = q[group >= own], group[group >= own]
                order = np.argsort(group, kind="stable")
                q, group = q[order], group[order]
                cut = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
                lists = pa.ListArray.from_arrays(pa.array(np.r_[cut, len(q)], pa.int32()), pa.array(fps[q], pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(group[cut], pa.int64()), pa.array(np.ones(len(cut)), pa.int32()), lists],
                                                 names=["group", "kind", "fps"])
    return run


class Members:
    """A group's index, and which of its members are known to be connected."""

    def __init__(self, fps: list[np.ndarray], bits: int):
        self.index, self.bits = GrayIndex(np.concatenate(fps)), bits
        self.low = np.arange(len(self.index.fps))

    def links(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, one member) for those of ``fps`` that have a link; its other members are connected with that one."""
        q, at = self.index.search(fps, self.bits)
        other = self.index.fps[at] != fps[q]
        q, at = q[other], at[other]
        order = np.lexsort((at, q))
        q, at = q[order], at[order]
        new = np.r_[True, q[1:] != q[:-1]] if len(q) else np.empty(0, bool)
        first = at[new][np.cumsum(new) - 1]
        if (first != at).any():
            self.low = smallest_linked(len(self.low), np.r_[np.arange(len(self.low)), first], np.r_[self.low, at])
        return fps[q[new]], self.index.fps[at[new]]

    def own(self) -> tuple[np.ndarray, np.ndarray]:
        far = np.flatnonzero(self.low != np.arange(len(self.low)))
        return self.index.fps[far], self.index.fps[self.low[far]]


def _links(bits: int):
    """Rows sorted by group, its members (kind 0) before what was sent to it (kind 1), to links ``a, b``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, parts, members = None, [], None
        for batch in batches:
            out = []
            for group, kind, fps in zip(batch.column("group").to_pylist(), batch.column("kind").to_pylist(), batch.column("fps")):
                fps = fps.values.to_numpy(zero_copy_only=False).view(np.uint64)
                if group != of:
                    out += [members.own()] if members else []
                    of, parts, members = group, [], None
                if kind == 0:
                    parts.append(fps)
                else:
                    members = members or Members(parts, bits)
                    out.append(members.links(fps))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in zip(*out)], names=["a", "b"])
        if members:
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in members.own()], names=["a", "b"])
    return run


def _rank(fp: str):
    """Gray rank as a column, in the order of unsigned numbers."""
    x = F.col(fp)
    for s in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, s))
    return x.bitwiseXOR(F.lit(-(1 << 63)))


def links(fps: DataFrame, bits: int = BITS, group: int = GROUP, nodes: int = NODES) -> DataFrame:
    """Links ``a, b`` that connect just those of the distinct fingerprints ``fp`` that ``bits`` connect."""
    spark = fps.sparkSession
    size = max(group, -(-fps.count() // nodes))
    nr = F.col("_nr") - 1
    rows = (numbered(fps.select("fp", _rank("fp").alias("rank")), "rank")
            .groupBy(F.floor(nr / size).alias("group"), F.floor(nr % size / ROW).alias("row"))
            .agg(F.sort_array(F.collect_list(F.struct("_nr", "fp"))).alias("held"))
            .select("group", F.lit(0).alias("kind"), F.transform("held", lambda x: x["fp"]).alias("fps")))
    rows = written(rows, "simhash-groups")
    both = rows.select("group", F.explode("fps").alias("fp")).groupBy("group").agg(F.bit_and("fp").alias("o"), F.bit_or("fp").alias("a"))
    top = both.orderBy("group").toArrow()  # about ``nodes`` rows at most
    shared = spark.sparkContext.broadcast(tuple(top[c].to_numpy().view(np.uint64) for c in ("o", "a")))
    kind = "`group` long, kind int, fps array<long>"
    sent = rows.select("group", "fps").mapInArrow(_routed(shared, bits), kind)
    return (rows.unionByName(sent).repartition(spread(spark), "group").sortWithinPartitions("group", "kind")
            .mapInArrow(_links(bits), "a long, b long").distinct())


# ---------------------------------------------------------------- components

def _starred(most: int):
    """Links to fewer that connect the same: of about ``most`` at a time, each node's to the smallest that they connect it with."""
    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        a, b = (np.concatenate([x.column(c).to_numpy() for x in held]) for c in ("a", "b"))
        nodes, at = np.unique(np.r_[a, b], return_inverse=True)
        low = smallest_linked(len(nodes), at[:len(a)], at[len(a):])
        far = low != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[low[far]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= most:
                yield stars(held)
                held = []
        if held:
            yield stars(held)
    return run


def components(edges: DataFrame) -> DataFrame:
    """``a`` and the smallest ``b`` it is connected with, for every node that isn't itself the smallest.

    Large-star and small-star in turn until nothing changes; each round is a grouped minimum (combined
    before the shuffle) and a join that AQE splits where a node has many links. Before a round's links are written, those
    in a file connect their nodes with the smallest, so that few links take few rounds (each has some ten shuffles to plan).
    """
    def star(e: DataFrame, small: bool) -> DataFrame:
        both = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")) if small else \
            e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        moved = both.join(low, "a")
        if small:
            out = moved.select(F.col("b").alias("a"), "m").union(moved.select("a", "m"))
        else:
            out = moved.filter("b > a").select(F.col("b").alias("a"), "m")
        return out.filter("a != m").select("a", F.col("m").alias("b")).distinct()

    def kept(links: DataFrame) -> tuple[DataFrame, tuple]:
        links = written(links.mapInArrow(_starred(LINKS), "a long, b long"), "links")
        return links, tuple(links.select(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    files = spread(edges.sparkSession)
    state, told = kept(edges.filter("a != b").select("a", "b").distinct())
    while True:  # few links, few files: the links of a round are no more than twice those before
        files = max(1, min(files, 2 * told[0] // LINKS))
        state, now = kept(star(star(state, False), True).coalesce(files))
        if now == told:
            return state
        told = now


def classed(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """``fp`` and ``root``, the smallest fingerprint of its component, for each distinct ``fp`` of ``fps``."""
    each = written(fps.select("fp").distinct(), "fingerprints")
    roots = components(links(each, bits)).select(F.col("a").alias("fp"), F.col("b").alias("low"))
    return each.join(roots, "fp", "left").select("fp", F.coalesce("low", "fp").alias("root"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                  bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    marked = written(rows.mapInArrow(_fingerprints("text", shingle, "fp"), f"id {kind}, fp long"), "marked")
    return _resolve(marked, bits).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _resolve(marked: DataFrame, bits: int) -> DataFrame:
    """``id, fp, root, component_id`` of rows ``id, fp``."""
    low = marked.groupBy("fp").agg(F.min("id").alias("low_id"))
    root = classed(low, bits)
    least = low.join(root, "fp").groupBy("root").agg(F.min("low_id").alias("component_id"))
    known = written(root.join(least, "root").select("fp", "root", "component_id"), "component-of")
    return marked.join(known, "fp")


def near_survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   bits: int = BITS) -> DataFrame:
    """The row of ``docs`` with the smallest id of every component, with the columns of ``docs``."""
    fp = fresh(docs, "simhash")
    marked = written(docs.mapInArrow(_fingerprints(text_col, shingle, fp), schema_with(docs, f"{fp} long")), "marked")
    known = _resolve(marked.select(F.col(f"`{id_col}`").alias("id"), F.col(fp).alias("fp")), bits)
    lead = known.filter(F.col("id").eqNullSafe(F.col("component_id")))
    keep = (lead.groupBy("root").agg(F.first("component_id").alias("id"), F.min("fp").alias("fp"))
            .select(F.col("id").alias(id_col), F.col("fp").alias(fp)))
    return one_row_each(marked, keep, [id_col, fp]).drop(fp)


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    from .common import table
    return simhash_dedup(table(spark, sf_dir, "documents"))
