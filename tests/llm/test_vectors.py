"""Hard negatives and nearest neighbours against brute force."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from punctuo.llm import hard_negatives, one_bit_search

KIND = "vec_id long, label int, embedding array<float>, id string, code int, score string, rank int, near string, vec int, `query` int"


def vectors(n=420, dim=12, seed=5):
    """Clusters, copies, repeated rows, ties, nulls, zeros, non-finite and other lengths."""
    import numpy as np
    rng = random.Random(seed)
    vec = lambda: [float(np.float32(rng.gauss(0, 0.4))) for _ in range(dim)]
    heads = [vec() for _ in range(6)]
    near = lambda h: [float(np.float32(x + rng.gauss(0, 0.03))) for x in h]
    rows = [(i, rng.randrange(4), near(rng.choice(heads)) if i % 3 else vec()) for i in range(n)]
    rows += [(n + i, i % 4, heads[0]) for i in range(40)]  # copies of one vector: ties
    rows += [rows[40], rows[40], rows[100], rows[3], rows[3]]
    rows += [(None, 1, vec()), (1000, None, vec()), (1100, 1, None), (1200, 1, [None] + vec()[1:]), (1300, 1, [math.nan] + vec()[1:]),
             (1400, 1, [math.inf] + vec()[1:]), (1500, 1, vec()[1:]), (1600, 1, []), (1700, 1, [0.0] * dim), (1701, -3, vec())]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2, "z", 3, 4) for r in rows], KIND).repartition(5)


def fine(rows, dim=12):
    return [r for r in rows if r[0] is not None and r[2] is not None and len(r[2]) == dim
            and all(x is not None and math.isfinite(x) for x in r[2])]


def mined(rows, every, scale=256, low=80, high=100, k=5):
    rows = [(i, math.fmod(lab + 1, 10) if i % 7 == 0 else lab, [math.floor(scale * x) for x in v]) for i, lab, v in fine(rows) if lab is not None]
    out = Counter()
    for a, lab, v in rows:
        if a % every == 0:
            near = sorted(((-sum(x * y for x, y in zip(v, w, strict=True)), i, m == lab) for i, m, w in rows if i != a))
            for ps, p, _ in [x for x in near if x[2]][:k]:
                window = [(s, i) for s, i, same in near if not same and low * -ps <= high * -s <= high * -ps]
                out.update((a, p, r + 1, i, -ps, -s) for r, (s, i) in enumerate(window[:k]))
    return out


@pytest.mark.parametrize("every,block,scale", [(20, 256, 256), (4, 3, 256), (20, 7, 30_000_000)])
def test_hard_negatives(spark, every, block, scale):
    rows = vectors()
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.hard_negatives(frame(spark, rows), F.col("id") % every == 0, label, block=block, scale=scale)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined(rows, every, scale)
    assert len(want) > 50 and Counter(map(tuple, got.collect())) == want


def test_hard_negatives_of_odd_tables(spark):
    none = frame(spark, vectors()).limit(0)
    assert hard_negatives.hard_negatives(none, F.col("id") % 2 == 0).count() == 0
    unusable = frame(spark, [(2, None, [1.0]), (4, 1, None)])
    assert hard_negatives.hard_negatives(unusable, F.col("id") % 2 == 0).count() == 0
    assert hard_negatives.hard_negatives(frame(spark, vectors()), F.col("id") < 0).count() == 0
    huge = frame(spark, [(i, i % 2, [1e30 if i == 3 else 1.0] * 12) for i in range(6)])
    got = hard_negatives.hard_negatives(huge, F.col("id") == 0)
    assert {r.negative_id for r in got.collect()} == {1, 5} and {r.positive_id for r in got.collect()} == {2, 4}


def test_bounds_hold_and_prune():
    """Each skipped candidate's true score lies outside what was asked for; near anchors skip most."""
    import numpy as np
    rng = np.random.default_rng(1)
    heads = rng.integers(-200, 200, (5, 24))
    anchors = (heads[np.arange(30) % 5] + rng.integers(-3, 4, (30, 24))).astype(np.int64)
    many = (heads[rng.integers(0, 5, 3000)] + rng.integers(-60, 60, (3000, 24))).astype(np.int64)
    tree = hard_negatives.spanning_tree(anchors)
    assert sorted(a for a, _, _ in tree) == list(range(30)) and [p for _, p, _ in tree].count(-1) == 1
    exact = many @ anchors.T
    floor = np.sort(exact, axis=0)[-20]
    looked = 0
    for a, places, got in hard_negatives.walk(tree, anchors, many, lambda a, low, high: high >= floor[a]):
        assert (got == exact[places, a]).all()
        assert set(np.flatnonzero(exact[:, a] >= floor[a])) <= set(places)
        looked += len(places)
    assert looked < 0.5 * exact.size


def nearest(rows, every, k):
    rows = [r for r in fine(rows) if any(r[2])]
    out = {}
    for n, (q, _, v) in enumerate(rows):
        if q % every == 0:
            near = sorted((-math.fsum(x * y for x, y in zip(v, w, strict=True)), i) for i, _, w in rows if i != q)
            out[n] = q, [(i, -s) for s, i in near[:k]]
    return out


@pytest.mark.parametrize("bits,block,k", [(512, 1024, 20), (64, 7, 5), (1024, 40, 600)])
def test_nearest(spark, bits, block, k):
    rows = vectors()
    got = one_bit_search.nearest(frame(spark, rows), F.col("id") % 10 == 0, k=k, bits=bits, block=block)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    got, want = got.collect(), nearest(rows, 10, k)
    asked = Counter(q for q, _ in want.values())
    per = {q: [] for q in asked}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        per[r.query_id].append(r)
    hit = total = 0
    for q, near in want.values():
        mine = per[q]
        assert len(mine) == asked[q] * len(near)
        assert Counter(r.rank for r in mine) == Counter({i + 1: asked[q] for i in range(len(near))})
        if asked[q] == 1:
            assert [(r.score, -r.vec_id) for r in mine] == sorted(((r.score, -r.vec_id) for r in mine), reverse=True)
            exact = dict(near)
            assert all(math.isclose(r.score, exact[r.vec_id], rel_tol=1e-12, abs_tol=1e-12) for r in mine if r.vec_id in exact)
            hit += sum((Counter(i for i, _ in near) & Counter(r.vec_id for r in mine)).values())
            total += len(near)
    assert hit >= 0.99 * total


def test_nearest_of_odd_tables(spark):
    none = frame(spark, vectors()).limit(0)
    assert one_bit_search.nearest(none, F.col("id") % 2 == 0).collect() == []
    assert one_bit_search.nearest(frame(spark, [(2, 1, [0.0, 0.0]), (4, 1, None)]), F.col("id") % 2 == 0).collect() == []
    one = one_bit_search.nearest(frame(spark, [(2, 1, [0.5, 1.0]), (3, 1, [-1.0, 0.25])]), F.col("id") % 2 == 0).collect()
    assert [tuple(r) for r in one] == [(2, 1, 3, -0.25)]
    flat = one_bit_search.nearest(frame(spark, [(i, 1, [1.0]) for i in range(50)]), F.col("id") % 20 == 0, k=3).collect()
    assert {(r.query_id, r.rank, r.vec_id) for r in flat} == {(0, 1, 1), (0, 2, 2), (0, 3, 3), (20, 1, 0), (20, 2, 1), (20, 3, 2),
                                                             (40, 1, 0), (40, 2, 1), (40, 3, 2)}


def test_estimates_are_unbiased_and_within_their_bounds():
    import numpy as np
    rng = np.random.default_rng(7)
    vecs, asked = rng.standard_normal((2000, 48)) * 3, rng.standard_normal((50, 48))
    turn = one_bit_search.rotation(48, 512, 1)
    code, norm, f = one_bit_search.encode(vecs, turn)
    words = np.ascontiguousarray(code.view(np.uint64).T)
    ones = np.bitwise_count(words).sum(axis=0, dtype=np.int64).astype(np.float32)
    block = one_bit_search.prepared(np.arange(50).tobytes(), asked.tobytes(), turn, 4, 3.0)
    upper, estimate = one_bit_search.bounds(block, slice(0, 50), words, ones, norm, f.astype(np.float32))
    exact = asked @ vecs.T
    assert abs((estimate - exact).mean()) < 0.02 * np.abs(exact).mean()
    assert (exact <= upper).mean() > 0.99 and (exact <= 2 * estimate - upper).mean() < 0.01
