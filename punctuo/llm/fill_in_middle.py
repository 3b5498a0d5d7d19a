"""Fill-in-middle transformation (13): cutting texts in three by one counted-quantifier match.

``regexp_count`` gives a text's units ``n`` (code points by default). Two cuts ``a <= b`` in 0..n are drawn from
the SHA-256 of seed and id. A pattern of the row's own, ``\\A(unit{a}+)(unit{b-a}+)(.*+)\\z``, captures
prefix, middle and suffix in one match: its quantifiers are counted and possessive, so nothing is tried twice
and a match takes time in proportion to the text. The same match's replacement string puts the parts in order
behind their marks, so no part is cut out on its own.

Everything is a row-wise DataFrame expression: no shuffle, no Python worker.

Forms: ``plain`` (the text as it is), ``psm`` (prefix, suffix, middle) and ``spm`` (suffix, prefix, middle).
``restored`` gives the text back from output and form; a text with a mark in it stays plain, and marks can't
overlap each other, so the first mark found is the one that was put there.

Defined cases: null and empty texts are plain with ``n`` 0; a null id draws as an empty one; repeated rows
draw alike; a part may be empty (ties of the cuts); very long texts are matched whole; an empty table gives an empty
result; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
SEED = "1"
CUT_RATE = 90  # of 100 texts are cut
SPM_RATE = 20  # of 100 cut texts put the suffix first
UNIT = "."     # one atom of a pattern; with (?s) a code point


def _checked(marks: Sequence[str]) -> None:
    """A mark may neither hold another nor begin with what any of them ends with."""
    clash = len(set(marks)) < 3 or not all(marks) or any(
        x != y and x in y or any(x[-k:] == y[:k] for k in range(1, min(len(x), len(y)))) for x in marks for y in marks)
    if clash:
        raise ValueError(f"marks overlap: {marks}")


def draws(id_col: str, seed: str = SEED) -> list[Column]:
    """The first four 8-digit groups of the SHA-256 of ``seed:id``, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _put(*parts: str) -> Column:
    """A replacement string; ``$1`` and so on stay, marks are quoted."""
    return F.lit("".join(p if re.fullmatch(r"\$\d", p) else re.sub(r"([\\$])", r"\\\1", p) for p in parts))


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text from which ``output`` of that ``form`` was made."""
    p, s, m = (re.sub(r"(\W)", r"\\\1", x) for x in marks)
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", marks: Sequence[str] = MARKS,
                   seed: str = SEED, cut_rate: int = CUT_RATE, spm_rate: int = SPM_RATE, unit: str = UNIT) -> DataFrame:
    """One row per row of ``docs``: its id, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars``, ``output``."""
    _checked(marks)
    h1, h2, h3, h4 = draws(id_col, seed)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
                       h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4"))
    rows = rows.select("*", F.regexp_count("text", F.lit(f"(?s){unit}")).cast("long").alias("n"))
    marked = F.lit(False)
    for mark in marks:
        marked = marked | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | marked | (F.col("h3") % 100 >= cut_rate)
    cut1, cut2 = F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)
    rows = rows.select("id", "text", "n", F.least(cut1, cut2).alias("a"), F.greatest(cut1, cut2).alias("b"),
                       F.when(plain, "plain").when(F.col("h4") % 100 < spm_rate, "spm").otherwise("psm").alias("form"))
    count = lambda c: c.cast("string")
    pattern = F.concat(F.lit(rf"(?s)\A({unit}{{"), count(F.col("a")), F.lit(f"}}+)({unit}{{"), count(F.col("b") - F.col("a")),
                       F.lit(r"}+)(.*+)\z"))
    p, s, m = marks
    order = F.when(F.col("form") == "spm", _put(s, "$3", p, "$1", m, "$2")).otherwise(_put(p, "$1", s, "$3", m, "$2"))
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    cut = F.col("form") != "plain"
    return rows.select(F.col("id").alias(id_col), "n", "form", F.when(cut, F.col("a")).alias("prefix_chars"),
                       F.when(cut, F.col("b") - F.col("a")).alias("middle_chars"), output.alias("output"))


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    from .common import table
    got = fill_in_middle(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = """
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
num AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM doc),
cut AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM num),
part AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM part
"""
