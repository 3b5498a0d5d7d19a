"""Hard-negative mining (11) with bounds along a spanning tree of anchors.

Vectors become integers, ``floor(scale * x)``; a score is an integer inner product. Anchors lie in blocks of
at most ``BLOCK`` near ones (numbered in the order of the signs of random projections), each with a minimum spanning tree
over its anchors. A candidate ``c`` is scored against the tree's root; along an edge from ``p`` to ``a``

    score(p, c) - |a - p| |c|  <=  score(a, c)  <=  score(p, c) + |a - p| |c|

(bounds of the parent where it has no score), and only candidates whose interval overlaps what the anchor still asks for are
rescored, which makes their interval a point again for the anchors below. The bounds are exact, so results are too.

Two passes over the candidates for each block, which is broadcast (bounded by ``BLOCK`` vectors and their positives):

1. positives: what is asked for is the best ``positives`` scores of the anchor's own label, from the worst one kept upwards;
2. negatives: for each positive with score ``p``, scores ``s`` of other labels with ``low * p <= high * s <= high * p``,
   from the worst one kept in that window upwards.

A task keeps a bounded number a block; what the tasks keep meets in a top-k that is limited before the shuffle.

Defined cases: rows without an id, label or vector, or with a null or non-finite component, take no part; nor do vectors of
another length than the most common one (the longer on ties), and those with a squared integer length of 2**62
or more (scores of others fit a long); rows with the anchor's id are never its positives or negatives; each row with an
anchor's id is an anchor; repeated rows are positives and negatives each; ties go to the smaller id; an anchor without
positives, and a positive without negatives in its window, gives no row; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctuo.operators.dims import numbered

from .common import scratch, written
from .one_bit_search import common_length

SCALE = 256
BLOCK = 256   # anchors broadcast at once
ROWS = 4096   # candidates that a task looks at together
SIGNS = 16    # random projections that bring near anchors together
SEED = 42
LARGEST = 2.0 ** 62
EXACT = 2.0 ** 53  # doubles hold all integers up to it


def usable(rows: DataFrame, id_col: str, vec_col: str, label: Column, scale: int) -> DataFrame:
    """``id, label, vec`` (longs) of the rows that take part, but for their length."""
    scaled = F.transform("raw", lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    size = F.aggregate("vec", F.lit(0.0), lambda n, x: n + x * x)
    got = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"),
                      F.col(f"`{vec_col}`").cast("array<double>").alias("raw"))
    fine = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(2.0 ** 31)))
    got = got.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    return (got.select("id", "label", scaled.alias("vec")).filter(size < F.lit(LARGEST))
            .select("id", "label", F.col("vec").cast("array<long>").alias("vec")))


def matrix(batch, dim: int):
    import numpy as np
    return np.asarray(batch.column("vec").flatten(), dtype=np.int64).reshape(batch.num_rows, dim)


def scores(vecs, one):
    """Exact inner products of integer vectors with ``one``: in doubles where those hold them, else in longs."""
    import numpy as np
    top = np.sqrt((vecs.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0) * (one.astype(np.float64) ** 2).sum())
    if top < EXACT / 4:
        return (vecs.astype(np.float64) @ one.astype(np.float64)).astype(np.int64)
    return (vecs * one).sum(axis=1)


def spanning_tree(vecs):
    """(parent, edge length) of each anchor in an order that has parents first; the root's parent is -1."""
    import numpy as np
    points = vecs.astype(np.float64)
    near, parent, order = np.full(len(points), np.inf), np.full(len(points), -1), []
    out = np.zeros(len(points), dtype=bool)
    at = 0
    for _ in range(len(points)):
        order.append((at, int(parent[at]), float(near[at]) if parent[at] >= 0 else 0.0))
        out[at] = True
        far = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
        closer = ~out & (far < near)
        near[closer], parent[closer] = far[closer], at
        at = int(np.argmin(np.where(out, np.inf, near)))
    return order


def walk(tree: list, vecs, candidates, asked) -> Iterator:
    """For each anchor of ``tree``: (anchor, places, scores) of the candidates in its intervals' overlap with what it asks for.

    ``asked(anchor, low, high)`` says which candidates may still matter, from the bounds of their scores.
    """
    import numpy as np
    length = np.sqrt((candidates.astype(np.float64) ** 2).sum(axis=1))
    children = {}
    for _, parent, _ in tree:
        children[parent] = children.get(parent, 0) + 1
    held = {}
    for a, parent, edge in tree:
        if parent < 0:
            low = high = scores(candidates, vecs[a]).astype(np.float64)
        else:
            low, high = held[parent]
            children[parent] -= 1
            if not children[parent]:
                del held[parent]
        slack = edge * length * (1 + 1e-9) + (np.abs(low) + np.abs(high)) * 1e-15  # and what rounding may have taken
        low, high = low - slack, high + slack
        places = np.flatnonzero(asked(a, low, high))
        exact = scores(candidates[places], vecs[a])
        if children.get(a):
            low[places] = high[places] = exact
            held[a] = low, high
        yield a, places, exact


def _treed(dim: int):
    """Blocks of anchors with their spanning tree."""
    def step(batches: Iterator) -> Iterator:
        import json

        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for of in batch.column("of"):
                ids, labels, vecs = (np.array([r[c] for r in of.as_py()], dtype=np.int64) for c in ("id", "label", "vec"))
                tree = spanning_tree(vecs.reshape(len(ids), dim))
                yield pa.RecordBatch.from_arrays([*(pa.array([x.tobytes()], pa.binary()) for x in (ids, labels, vecs)),
                                                  pa.array([json.dumps(tree)])], ["ids", "labels", "vecs", "tree"])
    return step


def _cut(kept: list, k: int) -> list:
    """(key, id, score) arrays cut to the ``k`` greatest scores of each key, ties to the smaller id."""
    import numpy as np
    order = np.lexsort((kept[1], -kept[2], kept[0]))
    key = kept[0][order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    nth = np.arange(len(key)) - np.repeat(starts, np.diff(np.r_[starts, len(key)]))
    return [x[order][nth < k] for x in kept]


def _positives(shared, k: int, dim: int):
    def step(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        block = shared.value
        empty = [np.empty(0, np.int64)] * 3
        kept = {a: empty for a in range(len(block["ids"]))}
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
                ids, labels = (np.asarray(batch.column(c)) for c in ("id", "label"))
                vecs = matrix(batch, dim)

                def asked(a, low, high, ids=ids, labels=labels):
                    floor = kept[a][2][-1] if len(kept[a][2]) == k else -np.inf
                    return (high >= floor) & (labels == block["labels"][a]) & (ids != block["ids"][a])

                for a, places, exact in walk(block["tree"], block["vecs"], vecs, asked):
                    if len(places):
                        new = (np.zeros(len(places), np.int64), ids[places], exact)
                        kept[a] = _cut([np.concatenate(x) for x in zip(kept[a], new, strict=True)], k)
        rows = [np.concatenate([np.full(len(v[0]), a, np.int64) for a, v in kept.items()]),
                *(np.concatenate([v[i] for v in kept.values()]) for i in (1, 2))]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["anchor", "id", "score"])
    return step


def _negatives(shared, k: int, dim: int):
    def step(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        block = shared.value
        empty = [np.empty(0, np.int64)] * 3
        windows = block["windows"]  # of each anchor: (nth positive, least score, greatest score), none of them empty
        kept = {(a, n): empty for a, ws in enumerate(windows) for n, _, _ in ws}
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
                ids, labels = (np.asarray(batch.column(c)) for c in ("id", "label"))
                vecs = matrix(batch, dim)

                def floor(a, n, least):
                    return max(least, int(kept[a, n][2][-1])) if len(kept[a, n][2]) == k else least

                def asked(a, low, high, ids=ids, labels=labels):
                    hit = np.zeros(len(ids), dtype=bool)
                    for n, least, most in windows[a]:
                        hit |= (high >= floor(a, n, least)) & (low <= most)
                    return hit & (labels != block["labels"][a]) & (ids != block["ids"][a])

                for a, places, exact in walk(block["tree"], block["vecs"], vecs, asked):
                    for n, least, most in windows[a] if len(places) else []:
                        inside = (exact >= floor(a, n, least)) & (exact <= most)
                        if inside.any():
                            new = (np.zeros(int(inside.sum()), np.int64), ids[places[inside]], exact[inside])
                            kept[a, n] = _cut([np.concatenate(x) for x in zip(kept[a, n], new, strict=True)], k)
        held = [(a, n, i, s) for (a, n), v in kept.items() for i, s in zip(v[1].tolist(), v[2].tolist(), strict=True)]
        cols = list(zip(*held, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["anchor", "nth", "id", "score"])
    return step


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def blocks(anchors: DataFrame, block: int, dim: int, seed: int) -> DataFrame:
    """Anchors in blocks of ``block``, near ones together: numbered in the order of the signs of ``SIGNS`` random projections.

    A digest of id and row breaks ties, so copies of a vector, or of a row, spread over as many partitions as they need.
    """
    import numpy as np
    planes = np.random.default_rng(seed).integers(-8, 9, (SIGNS, dim)).tolist()
    bit = lambda p: (F.aggregate(F.zip_with("vec", F.array(*[F.lit(float(x)) for x in p]), lambda a, b: a * b),
                                 F.lit(0.0), lambda n, x: n + x) > 0).cast("int").cast("string")
    row = F.md5(F.concat_ws("-", F.col("id").cast("string"), F.monotonically_increasing_id().cast("string")))
    dealt = numbered(anchors.withColumn("near", F.concat(*[bit(p) for p in planes], row)), "near")
    one = F.sort_array(F.collect_list(F.struct("_nr", "id", "label", "vec"))).alias("of")
    return (dealt.groupBy(F.floor((F.col("_nr") - 1) / block).alias("block")).agg(one).select("of")
            .mapInArrow(_treed(dim), "ids binary, labels binary, vecs binary, tree string"))


def hard_negatives(rows: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 5,
                   low_share: int = 80, high_share: int = 100, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label", scale: int = SCALE, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for rows where ``is_anchor`` (over ``id``).

    ``label`` (over the columns of ``rows``) replaces ``label_col``.
    """
    import json

    import numpy as np
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    path = scratch(spark, "hard-negatives")
    spark.createDataFrame([], schema).write.parquet(path)
    given = usable(rows, id_col, vec_col, F.col(f"`{label_col}`") if label is None else label, scale)
    dim = common_length(given)
    if not dim:
        return spark.read.schema(schema).parquet(path)
    given = written(given.filter(F.size("vec") == dim), "hard-candidates")
    for row in written(blocks(given.filter(is_anchor), block, dim, seed), "hard-anchors").toLocalIterator():
        one = {"ids": np.frombuffer(row["ids"], np.int64), "labels": np.frombuffer(row["labels"], np.int64),
               "vecs": np.frombuffer(row["vecs"], np.int64).reshape(-1, dim), "tree": json.loads(row["tree"])}
        shared = spark.sparkContext.broadcast(one)
        found = given.mapInArrow(_positives(shared, positives, dim), "anchor long, id long, score long")
        best = _best(found, ["anchor"], positives).orderBy("anchor", "rank").collect()  # BLOCK x positives rows at most
        shared.unpersist()
        windows = [[] for _ in one["ids"]]
        for r in best:
            least = -(-low_share * r["score"] // high_share)
            if least <= r["score"]:
                windows[r["anchor"]].append((r["rank"], least, r["score"]))
        shared = spark.sparkContext.broadcast(one | {"windows": windows})
        found = given.mapInArrow(_negatives(shared, negatives, dim), "anchor long, nth long, id long, score long")
        of = spark.createDataFrame([(r["anchor"], r["rank"], int(one["ids"][r["anchor"]]), r["id"], r["score"]) for r in best],
                                   "anchor long, nth long, anchor_id long, positive_id long, positive_score long")
        (_best(found, ["anchor", "nth"], negatives).join(F.broadcast(of), ["anchor", "nth"])
         .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                 F.col("score").alias("negative_score")).write.mode("append").parquet(path))
        shared.unpersist()
    return spark.read.schema(schema).parquet(path)


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    from .common import table
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


SQL = """
WITH vec AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchor AS (SELECT * FROM vec WHERE vec_id % 100 = 0),
pair AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM anchor a JOIN vec c ON a.vec_id <> c.vec_id),
pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM pos p JOIN pair n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
