"""Approximate nearest neighbours (12) by randomly rotated one-bit codes.

A unit vector is padded, rotated by a seeded random orthonormal matrix and kept as the signs of its ``bits``
coordinates, packed to bytes, with two correction scalars: the vector's norm and ``f``, the inner product of the
unit vector with its own code. For a query, rotated alike and kept in ``PLANES``-bit steps, the code's inner product comes
from bit counts of ANDs; divided by ``f`` it estimates the true one without bias, with a deviation of about
``sqrt(1/f**2 - 1) / sqrt(bits - 1)`` of the norms. An estimate plus ``confidence`` deviations is an upper bound: a
candidate below the query's k-th best exact score so far is out, all others are rescored on the original
vectors, in double precision. More bits (the padding) narrow the bounds and so the rescoring.

1. Every vector is coded once (map step) and written with its code, narrow and codes first.
2. Queries are packed into rows of at most ``BLOCK``, dealt out evenly whatever their ids, and written. They reach the driver one row
   at a time; each is broadcast (bounded by ``BLOCK`` vectors) to one pass over the codes, in which a task
   keeps ``k`` a query. The tasks' winners meet per query, by a top-k that is limited before the shuffle.

There is no bucket, sample or probe limit: every candidate's code is looked at for every query, and only the bound,
which holds with the probability ``confidence`` stands for, can lose one (recall is measured in the tests).

Defined cases: vectors that are null, zero, or hold null or non-finite (or, of doubles, over ``MOST``) components take no part, nor do rows without an id and vectors of
another length than the most common one (the longer on ties); rows that share the query's id are its own and no
candidates; each row with a query's id is a query; repeated rows are candidates each; ties go to the smaller id; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, written

BITS = 512        # of a code, at least the vectors' length
PLANES = 4        # bits of a query's coordinate
CONFIDENCE = 2.5  # deviations that an estimate may be off
BLOCK = 1024      # queries broadcast at once
TILE = 32         # queries that a task looks at together
ROWS = 4096       # candidates that a task looks at together
MOST = 1e140      # greater components take no part: products of them aren't finite
SEED = 42


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` (doubles) of the rows that take part, but for their length."""
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(MOST)))
    return (rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec"))
            .filter(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists("vec", lambda x: x != 0)))


def common_length(rows: DataFrame) -> int:
    """The length that most vectors have; 0 of an empty table."""
    top = rows.groupBy(F.size("vec").alias("d")).count().agg(F.max_by("d", F.struct("count", "d")).alias("d")).first()
    return top["d"] or 0


def rotation(dim: int, bits: int, seed: int):
    """``bits`` x ``dim`` with orthonormal columns: a random rotation of vectors padded to ``bits``."""
    import numpy as np
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def encode(vecs, turn):
    """Packed signs (rows x bits/8 bytes), norms, and each unit vector's inner product with its code."""
    import numpy as np
    top = np.abs(vecs).max(axis=1, keepdims=True)
    norm = np.sqrt(((vecs / top) ** 2).sum(axis=1)) * top[:, 0]
    turned = (vecs / norm[:, None]).astype(np.float32) @ turn.T
    return np.packbits(turned > 0, axis=1), norm, np.abs(turned).sum(axis=1, dtype=np.float64) / np.sqrt(turn.shape[0])


def _coded(turn):
    def step(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            if batch.num_rows:
                vecs = np.asarray(batch.column("vec").flatten(), dtype=np.float64).reshape(batch.num_rows, -1)
                codes, norm, f = encode(vecs, turn)
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([c.tobytes() for c in codes], pa.binary()),
                                                  pa.array(norm), pa.array(f), batch.column("vec")], ["id", "code", "norm", "f", "vec"])
    return step


def _packed(block: int):
    def step(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for i in range(0, batch.num_rows, block):
                part = batch.slice(i, block)
                vecs = np.asarray(part.column("vec").flatten(), dtype=np.float64)
                ids = np.asarray(part.column("id"), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([ids.tobytes()], pa.binary()), pa.array([vecs.tobytes()], pa.binary())],
                                                 ["ids", "vecs"])
    return step


def prepared(ids: bytes, vecs: bytes, turn, planes: int, confidence: float) -> dict:
    """Queries made ready: rotated, in ``planes``-bit steps, as bit planes of 64-bit words."""
    import numpy as np
    ids = np.frombuffer(ids, dtype=np.int64)
    vecs = np.frombuffer(vecs, dtype=np.float64).reshape(len(ids), -1)
    norm = np.sqrt((vecs ** 2).sum(axis=1))
    turned = (vecs / norm[:, None]).astype(np.float32) @ turn.T
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / ((1 << planes) - 1), 1e-30)
    steps = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    return {"ids": ids, "vecs": vecs, "norm": norm, "low": low, "step": step, "total": steps.sum(axis=1, dtype=np.int64),
            "planes": [np.packbits(steps >> p & 1, axis=1).view(np.uint64) for p in range(planes)],
            "bits": turn.shape[0], "confidence": confidence}


def bounds(block: dict, part: slice, words, ones, norm, f):
    """Upper bounds of the inner products of the queries ``part`` with codes (queries x codes), and the estimates."""
    import numpy as np
    bits, length = block["bits"], block["norm"][part, None] * norm
    low, step, total = (block[x][part, None].astype(np.float32) for x in ("low", "step", "total"))
    hits = np.zeros(length.shape, dtype=np.int32)
    for p, plane in enumerate(block["planes"]):
        both = np.zeros(length.shape, dtype=np.uint16)
        for w in range(words.shape[0]):
            both += np.bitwise_count(plane[part, w, None] & words[w])
        hits += both.astype(np.int32) << p
    # the code's coordinates are +-1/sqrt(bits): twice the sum where the bit is set, less the sum of all
    inner = (2 * (low * ones + step * hits) - (low * bits + step * total)) / np.float32(np.sqrt(bits))
    estimate = length * (inner / f)
    spread = np.sqrt(np.maximum(1 / f ** 2 - 1, 0) / max(bits - 1, 1))
    coarse = step / (np.float32(np.sqrt(12)) * f)  # what the query's steps add
    return estimate + length * (block["confidence"] * np.hypot(spread, coarse) + 1e-5), estimate


def best(k: int, query, ids, scores):
    """Places of each query's ``k`` greatest scores, ties to the smaller id."""
    import numpy as np
    order = np.lexsort((ids, -scores, query))
    q = query[order]
    starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
    nth = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
    return order[nth < k]


def inner(a, b):
    """Row by row in double precision, the same for the same two rows wherever they stand."""
    import numpy as np
    out = np.empty(len(a))
    for i in range(0, len(a), 1 << 14):
        out[i:i + (1 << 14)] = (a[i:i + (1 << 14)] * b[i:i + (1 << 14)]).sum(axis=1)
    return out


def _merged(kept: list, block: dict, part: slice, chosen, ids, vecs, floor, k: int) -> list:
    """``kept`` with the exact scores of ``chosen`` (queries x candidates), cut to ``k`` a query; raises the floors."""
    import numpy as np
    q, c = np.nonzero(chosen)
    scores = np.empty(len(q))
    for i in range(0, len(q), 1 << 14):
        at = slice(i, i + (1 << 14))
        scores[at] = (block["vecs"][part][q[at]] * vecs[c[at]]).sum(axis=1)  # the same for the same two rows wherever they stand
    q = q + part.start
    near = scores >= floor[q]
    old = (kept[0] >= part.start) & (kept[0] < part.stop)
    query, vec_id, score = (np.concatenate([x[old], y[near]]) for x, y in zip(kept, (q, ids[c], scores), strict=True))
    top = best(k, query, vec_id, score)
    query, vec_id, score = query[top], vec_id[top], score[top]
    last = np.flatnonzero(np.r_[query[1:] != query[:-1], True]) if len(query) else top
    full = last[np.bincount(query, minlength=len(floor))[query[last]] == k]
    floor[query[full]] = score[full]
    return [np.concatenate([x[~old], y]) for x, y in zip(kept, (query, vec_id, score), strict=True)]


def _search(shared, k: int):
    """Codes to the ``k`` best of the block's queries in this task."""
    def step(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        block = shared.value
        kept = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]  # query, id, score
        floor = np.full(len(block["ids"]), -np.inf)  # the k-th best score so far
        for whole in batches:
            for batch in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
                ids, norm, f = (np.asarray(batch.column(c)) for c in ("id", "norm", "f"))
                code = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
                words = np.ascontiguousarray(code.view(np.uint64).T)
                ones = np.bitwise_count(words).sum(axis=0, dtype=np.int64).astype(np.float32)
                vecs = np.asarray(batch.column("vec").flatten(), dtype=np.float64).reshape(len(ids), -1)
                for t in range(0, len(floor), TILE):
                    part = slice(t, min(t + TILE, len(floor)))
                    upper, estimate = bounds(block, part, words, ones, norm, f.astype(np.float32))
                    open_ = ids[None, :] != block["ids"][part, None]
                    if len(ids) > k:  # the greatest estimates first: their exact scores raise the floor for the rest
                        first = estimate >= -np.partition(-estimate, k, axis=1)[:, k, None]
                        first &= open_ & (upper >= floor[part, None])
                        kept = _merged(kept, block, part, first, ids, vecs, floor, k)
                        open_ &= ~first
                    kept = _merged(kept, block, part, open_ & (upper >= floor[part, None]), ids, vecs, floor, k)
        yield pa.RecordBatch.from_arrays([pa.array(kept[0].astype(np.int32)), pa.array(block["ids"][kept[0]]), pa.array(kept[1]),
                                          pa.array(kept[2])], ["query", "query_id", "vec_id", "score"])
    return step


def nearest(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", bits: int = BITS,
            planes: int = PLANES, confidence: float = CONFIDENCE, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` (over ``id``) its ``k`` greatest inner products."""
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    path = scratch(spark, "one-bit-found")
    spark.createDataFrame([], schema).write.parquet(path)
    given = usable(rows, id_col, vec_col)
    dim = common_length(given)
    if not dim:
        return spark.read.schema(schema).parquet(path)
    turn = rotation(dim, -(-max(bits, dim) // 64) * 64, seed)
    given = given.filter(F.size("vec") == dim)
    codes = written(given.mapInArrow(_coded(turn), "id long, code binary, norm double, f double, vec array<double>"), "one-bit-codes")
    asked = codes.filter(is_query).select("id", "vec")
    even = asked.repartition(max(1, -(-asked.count() // block)))
    w = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    for row in written(even.mapInArrow(_packed(block), "ids binary, vecs binary"), "one-bit-queries").toLocalIterator():
        shared = spark.sparkContext.broadcast(prepared(row["ids"], row["vecs"], turn, planes, confidence))
        found = codes.mapInArrow(_search(shared, k), "query int, query_id long, vec_id long, score double")
        (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
         .select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path))
        shared.unpersist()
    return spark.read.schema(schema).parquet(path)


def op12_one_bit_search(spark, sf_dir: str) -> DataFrame:
    from .common import table
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
