"""Stages against brute force, end to end and on an empty table; queries against their SQL."""

from collections import Counter

import pytest

import corpus_pipeline
from punctuo.llm import packing, queries

from . import cases
from .test_text_ops import toxic_docs

KIND = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def folder(spark, tmp_path):
    docs, labels = toxic_docs()
    docs = [(d, "Clean start " + t + " é") for d, t in docs]
    rows = docs + [(d + 1000, t) for d, t in cases.documents()] + [(3000, docs[1][1]), (3001, cases.PASSAGE * 2), (None, None)]
    spark.createDataFrame([(d, t, "en", None, len(t or "")) for d, t in rows], KIND).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, cases.PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    toxic = {d for d, t in toxic_docs()[0] if "grumblefrotz" in t or "vilewort" in t or "scumbrel" in t}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, folder).cache()
        if name != "best_fit_packing":
            assert out.columns == docs.columns
            after = Counter((r.doc_id, r.text) for r in out.collect())
            assert not after - Counter(before)
            kept = {d for d, _ in after}
        if name == "toxicity":
            gone = {d for d, _ in before} - kept
            assert len(gone & toxic) > 0.9 * len(toxic) and len(gone - toxic) < 0.05 * len(before)
        elif name == "exact_dedup":
            keep = {}
            for d, t in before:
                k = (t or "").encode().lower()
                keep[k] = d if keep.get(k) is None else max(keep[k], -1 if d is None else d)
            assert kept == set(keep.values())
        elif name == "simhash_near_dedup":
            assert kept == {c[2] for c in cases.simhashes(before)}
        elif name == "benchmark_decontamination":
            assert kept == {h[0] for h in cases.hits(before, [(1, cases.PASSAGE)]) if not h[5]}
        else:
            assert {r.doc_id for r in out.collect()} == {d for d, _ in before}
            assert out.groupBy("sequence_id").sum("length").filter(f"`sum(length)` > {packing.CAPACITY}").count() == 0
        docs = spark.createDataFrame(out.collect(), out.schema) if name != "best_fit_packing" else docs


def test_run_and_empty(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_stages_with_columns_of_any_name(spark, folder):
    rows = cases.documents() + cases.TIES
    docs = cases.frame(spark, rows).withColumnsRenamed({"z": "spans", "n": "n_words"})
    plain = cases.frame(spark, rows, extra=False)
    for name, stage in corpus_pipeline.STAGES:
        got, want = stage(spark, docs, folder), stage(spark, plain, folder)
        if name == "best_fit_packing":
            pieces = lambda df: Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
            assert pieces(got) == pieces(want)
        else:
            assert got.columns == docs.columns
            assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter((r.doc_id, r.text) for r in want.collect())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    from oracle_check import compare
    assert compare(spark, "/root/testdata/sf0.001", [name], verbose=False) == {name: "OK"}


def test_all_are_registered():
    import __spark_entry__
    assert set(queries.QUERIES) <= set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES} - {"pipeline"}
