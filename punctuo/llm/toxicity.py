"""Toxicity (10): linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the different n-grams of code points (each counted once however often it occurs) of a text,
hashed to ``2 ** HASH_BITS`` places: present or not. With p and q the smoothed shares of toxic and other
training texts that hold a feature, its scale is r = log(p / |p|) - log(q / |q|). Logistic regression on
the scaled features (L2, classes weighted alike, ``mix`` parts of the plain naive Bayes weights) gives one
weight per place; a score is the logistic of their mean over the root of the number of features.

Training reads whole texts of a bounded sample of labelled rows: at most ``PER_CLASS`` of each class,
those with the smallest hash of their id, one text of an id (that with the smallest hash). The ids (2 * ``PER_CLASS``) are
broadcast to find the texts, the tasks send back at most ``PLACES`` feature places of each (of more, those that come
first in a hashed order), so 2 * ``PER_CLASS * PLACES`` of 4 bytes at most, and the driver fits ``2 ** HASH_BITS`` weights. Scoring is a map step
without shuffle over all rows; the weights (1 MB) are broadcast.

Defined cases: null and empty texts have no feature and score by the intercept alone; labels that are null
don't train; a label of a row that occurs twice counts once; without labels of both classes every score
is the prior of the labels there are, 0.5 without any, and ``decent`` keeps all rows; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, schema_with

NGRAMS = (3, 4, 5)
HASH_BITS = 18
BASE = 16_777_619
#: Labelled rows of each class that train, and places of one of them, at most.
PER_CLASS = 2000
PLACES = 8192
FOLDS = 5
EPOCHS = 40
L2 = 1e-4


def features(text: str | None, board: np.ndarray, ngrams: tuple[int, ...] = NGRAMS, bits: int = HASH_BITS) -> np.ndarray:
    """Places of the different n-grams of a text's code points in lower case (A-Z), blanks at both ends.

    ``board`` (int32, ``2 ** bits``, any content) notes who wrote a place last: only that one counts.
    """
    b = np.frombuffer(f" {text or ''} ".encode("utf-32-le"), "<u4").astype(np.uint32)
    b += np.uint32(32) * ((b >= 65) & (b <= 90))
    found = [np.zeros(0, np.uint32)]
    h = b.copy()
    for n in range(2, max(ngrams) + 1):
        if len(b) < n:
            break
        h = h[:-1] * np.uint32(BASE) + b[n - 1:]
        if n in ngrams:
            mixed = (h ^ (h >> np.uint32(15)) ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
            found.append(mixed >> np.uint32(32 - bits))
    places = np.concatenate(found)
    number = np.arange(len(places), dtype=np.int32)
    board[places] = number
    return places[board[places] == number].astype(np.int32)


def new_board(bits: int = HASH_BITS) -> np.ndarray:
    return np.zeros(1 << bits, np.int32)


def score_of(places: np.ndarray, weights: np.ndarray, intercept: float) -> float:
    z = intercept + (float(weights[places].sum()) / np.sqrt(len(places)) if len(places) else 0.0)
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def log_count_ratios(rows: list[np.ndarray], toxic: np.ndarray, size: int) -> np.ndarray:
    p, q = np.ones(size), np.ones(size)
    for places, y in zip(rows, toxic):
        (p if y else q)[places] += 1
    return np.log(p / p.sum()) - np.log(q / q.sum())


def fit(rows: list[np.ndarray], toxic: np.ndarray, bits: int = HASH_BITS, epochs: int = EPOCHS, l2: float = L2,
        mix: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights by place and an intercept from feature places and 0/1 labels."""
    toxic = np.asarray(toxic, float)
    size = 1 << bits
    if not len(rows) or toxic.min() == toxic.max():
        share = toxic.mean() if len(rows) else 0.5
        return np.zeros(size, np.float32), float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    ratio = log_count_ratios(rows, toxic, size)
    scale = np.split(np.empty(sum(map(len, rows)), np.float32), np.cumsum([len(x) for x in rows])[:-1])  # one array: it is given back whole
    for own, x in zip(scale, rows):
        own[:] = ratio[x] / np.sqrt(max(len(x), 1))
    weight = np.where(toxic == 1, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean())) / len(rows)

    def margins(w: np.ndarray, b: float) -> np.ndarray:
        w = w.astype(np.float32)
        return np.array([b + float(x @ w[places]) for x, places in zip(scale, rows)])

    w, b = np.zeros(size), 0.0
    m_w, v_w, m_b, v_b = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, epochs + 1):  # Adam on the whole sample
        err = (1 / (1 + np.exp(-margins(w, b))) - toxic) * weight
        g = l2 * w
        for e, x, places in zip(err.astype(np.float32), scale, rows):  # a row's places are all different
            g[places] += e * x
        gb = err.sum()
        m_w, v_w = 0.9 * m_w + 0.1 * g, 0.999 * v_w + 0.001 * g * g
        m_b, v_b = 0.9 * m_b + 0.1 * gb, 0.999 * v_b + 0.001 * gb * gb
        c1, c2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        w -= 0.1 * (m_w / c1) / (np.sqrt(v_w / c2) + 1e-8)
        b -= 0.1 * (m_b / c1) / (np.sqrt(v_b / c2) + 1e-8)
    even = np.abs(w).mean()
    w = (1 - mix) * w + mix * even  # interpolation with naive Bayes: the same weight on every ratio
    z = margins(w, 0.0)
    return (w * ratio).astype(np.float32), threshold(z, toxic)


def threshold(z: np.ndarray, toxic: np.ndarray) -> float:
    """Intercept that puts score 0.5 where training rows of both classes are told apart best."""
    order = np.argsort(z)
    y = toxic[order]
    right = np.r_[0, np.cumsum(1 - y)] / (1 - toxic).sum() + (toxic.sum() - np.r_[0, np.cumsum(y)]) / toxic.sum()
    best = np.flatnonzero(right >= right.max() - 1e-12)
    k = best[len(best) // 2]
    zs = z[order]
    low, high = zs[max(k - 1, 0)], zs[min(k, len(zs) - 1)]
    return -float((low + high) / 2)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def _collectable(text_col: str, bits: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        board = new_board(bits)
        for b in batches:
            got = []
            for x in b.column(text_col):
                places = features(x.as_py(), board, bits=bits)
                if len(places) > most:
                    places = places[np.argsort(places.astype(np.uint32) * np.uint32(0x9E3779B1), kind="stable")[:most]]
                got.append(places.tobytes())
            yield pa.RecordBatch.from_arrays([b.column("y"), b.column("o"), pa.array(got, pa.binary())],
                                             names=["y", "o", "places"])
    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          per_class: int = PER_CLASS, bits: int = HASH_BITS) -> tuple[np.ndarray, float, bool]:
    """Weights and intercept from labelled rows outside the held-out fold; and were there rows of both classes?"""
    own = F.col(f"`{id_col}`")
    usable = (labels.select(own.alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
              .filter(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
              .groupBy("id").agg(F.max("y").alias("y")).withColumn("o", F.xxhash64("id")))
    picked = None
    for y in (0, 1):
        some = usable.filter(F.col("y") == y).orderBy("o", "id").limit(per_class)
        picked = some if picked is None else picked.union(some)
    texts = (docs.select(own.alias("id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(picked), "id")
             .groupBy("id", "y", "o").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
             .select("y", "o", F.col("t.text").alias("text")))
    got = texts.mapInArrow(_collectable("text", bits, PLACES), "y int, o long, places binary").toArrow()
    order = np.argsort(got["o"].to_numpy(), kind="stable")
    places = [np.frombuffer(x.as_buffer(), np.int32) for x in got["places"]]  # views: the driver holds what was sent once
    y = got["y"].to_numpy()
    return *fit([places[i] for i in order], y[order], bits), len(np.unique(y)) == 2


def _scores(shared, text_col: str, name: str, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        board, (weights, intercept) = new_board(bits), shared.value
        for b in batches:
            got = [score_of(features(x.as_py(), board, bits=bits), weights, intercept) for x in b.column(text_col)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.float64())], names=[*b.schema.names, name])
    return run


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           per_class: int = PER_CLASS, bits: int = HASH_BITS) -> tuple[DataFrame, str, bool]:
    """``docs`` with a score behind its columns, that column's name, and whether both classes were learnt."""
    name = fresh(docs, "score")
    *model, learnt = train(docs, labels, id_col, text_col, "toxic", per_class, bits)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    return docs.mapInArrow(_scores(shared, text_col, name, bits), schema_with(docs, f"{name} double")), name, learnt


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``."""
    own = F.col(f"`{id_col}`")
    got, score, _ = scored(docs.select(own, F.col(f"`{text_col}`")), labels, id_col, text_col, **kw)
    return got.select(own, held_out(own).alias("held_out"), F.col(score).alias("score"), (F.col(score) >= 0.5).cast("int").alias("predicted"))


def decent(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that aren't judged toxic, with the columns of ``docs``; all where nothing told the classes apart."""
    got, score, learnt = scored(docs, labels, id_col, text_col)
    return got.filter(F.col(score) < 0.5).drop(score) if learnt else docs


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    from .common import table
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
