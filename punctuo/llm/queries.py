"""Queries and DuckDB SQL of this subpackage, read by ``__spark_entry__``."""

from __future__ import annotations

import corpus_pipeline

from . import decontaminate, exact_dedup, fill_in_middle, hard_negatives, line_dedup, one_bit_search, packing, simhash, suffix_dedup, token_counts, toxicity, url_filter, warc

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_warc": warc.op3_warc,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_packing": packing.op7_packing,
    "op8_simhash": simhash.op8_simhash,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_one_bit_search": one_bit_search.op12_one_bit_search,
    "op13_fill_in_middle": fill_in_middle.op13_fill_in_middle,
}

ORACLE_SQL = {
    "op2_url_filter": url_filter.SQL,
    "op3_warc": warc.SQL,
    "op5_decontaminate": decontaminate.SQL,
    "op6_exact_dedup": exact_dedup.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op13_fill_in_middle": fill_in_middle.SQL,
}
