"""From raw documents to packed training sequences.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but
the last return the rows they keep with the columns of ``docs``, whatever further columns those have and whatever they are
called (``doc_id`` and ``text`` are used). An empty table stays empty. ``run`` writes each stage's rows as
Parquet to the shared folder the cluster names in ``spark.checkpoint.dir`` and reads them back, so a lost
executor costs at most the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from punctuo.llm import common, decontaminate, exact_dedup, packing, simhash, toxicity


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier trained on ``labels`` doesn't judge toxic; null and empty texts are judged by its intercept, and
    all rows stay where there are no labels of both classes."""
    return toxicity.decent(docs, common.table(spark, sf_dir, "labels"))


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of equal texts (A-Z lower-cased, null as empty): that with the greatest id; of rows repeated with id and text one."""
    return exact_dedup.survivors(docs)


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of texts with near fingerprints: that with the smallest id; texts without words are one component."""
    return simhash.near_survivors(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of which under a twentieth of the words, or none, lies in windows of ``benchmark``; null and empty texts stay."""
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of each row, with its place in a sequence; null and empty texts are a piece of one token."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxic_out),
    ("exact_dedup", copies_out),
    ("simhash_near_dedup", near_copies_out),
    ("benchmark_decontamination", benchmark_out),
    ("best_fit_packing", packed),
]

#: A trained classifier, fingerprints' components and a tokenizer aren't SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
