"""Fill-in-middle transformation."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from punctuo.llm import fill_in_middle as fim

from .cases import TIES, documents, frame


def brute(doc, text, marks=fim.MARKS, seed="1", units=list):
    text = text or ""
    u = units(text)
    n = len(u)
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in marks) or h3 % 100 >= 90:
        return doc, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc, n, "spm", a, b - a, marks[1] + s + marks[0] + p + marks[2] + m
    return doc, n, "psm", a, b - a, marks[0] + p + marks[1] + s + marks[2] + m


ODD = [(i, t) for i, t in enumerate(["<P>", "a<S>b", "<M", "S><P", "$1\\2$", "\r\n \x85\n", "🎉é\U0001F1E9\U0001F1EA" * 9, "<" * 40, "<S" * 9 + ">",
                                     "\x00a\x00", "\\E\\Q(", "日本語" * 50] * 12, 1000)]


@pytest.mark.parametrize("rows", [documents(), TIES, ODD, [(7, "xé🎉\n" * 300_000)]])
def test_against_brute_force(spark, rows):
    got = fim.fill_in_middle(frame(spark, rows))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert Counter(map(tuple, got.collect())) == Counter(brute(*r) for r in rows)
    back = got.select("doc_id", fim.restored(F.col("output"), F.col("form")))
    assert Counter(map(tuple, back.collect())) == Counter((d, t or "") for d, t in rows)


def test_every_form_and_the_empty_table(spark):
    rows = documents() + ODD
    assert {brute(*r)[2] for r in rows} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(frame(spark, rows).limit(0)).count() == 0


def test_other_marks_seed_and_unit(spark):
    rows, marks = documents(), ("$pre|", "\\suf|", "(mid)")
    got = fim.fill_in_middle(frame(spark, rows), marks=marks, seed="s")
    assert Counter(map(tuple, got.collect())) == Counter(brute(*r, marks=marks, seed="s") for r in rows)
    back = got.select("doc_id", fim.restored(F.col("output"), F.col("form"), marks))
    assert Counter(map(tuple, back.collect())) == Counter((d, t or "") for d, t in rows)
    pairs = [(i, "éa" * i) for i in range(40)]  # by grapheme: two code points are one unit
    got = fim.fill_in_middle(frame(spark, pairs), unit=r"\X")
    units = lambda t: ["é" if i % 2 == 0 else "a" for i in range(2 * t.count("a"))]
    assert Counter(map(tuple, got.collect())) == Counter(brute(*r, units=units) for r in pairs)
    for bad in (("<P>", "<P>", "<M>"), ("ab", "ba", "x"), ("a", "xa", "y"), ("", "a", "b")):
        with pytest.raises(ValueError):
            fim.fill_in_middle(frame(spark, rows), marks=bad)


def test_no_shuffle_and_no_python(spark):
    plan = fim.fill_in_middle(frame(spark, documents()).coalesce(1)).transform(
        lambda df: df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Aggregate" not in plan
