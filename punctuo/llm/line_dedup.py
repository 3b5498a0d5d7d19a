"""Line dedup (9): content-defined chunks of lines, with DataFrame functions only.

A text's lines are hashed (XXH64). A rolling window over the hashes of two neighbouring lines says whether a chunk ends
between them: a byte of each hash is taken, and the lines stay together where the upper one's is below ``open`` and the lower
one's at least ``close``. So boundaries depend on nearby lines only and shift with them. There are several independent
chunkings of the same text: coarse ones by a byte each, and fine ones, which find short repeats among other lines. A fine one
(``open`` = ``close`` = 128) goes by one bit, its chunks are the two lines where that bit goes from 0 to 1 (the other direction:
from 1 to 0), so all of them together have a chunk wherever two neighbours differ in one of their bits.
Equal lines, one under the other, look alike to any such rule; one more chunking keeps them together, cut to two lines at most.

1. One pass gives narrow rows (document, place, lines, MD5) of all multi-line chunks of all chunkings, once each, and of the
   few two-line runs that none of them has. Chunk digests that occur at two places or more, and their first place (grouped with
   partial sums and written; the join back splits where a digest is hot).
2. Matches grow line by line: of the runs that no chunking has, those that repeat go too, as far as they join on to a repeated
   chunk, by one line each. A repeat that no chunk touched isn't found; how many are is measured in the README.
3. Byte comparison: what repeats is taken from its texts and grouped by whole content, combined before the shuffle. A
   digest with two contents is no ground for removal.
4. Lines in a repeated chunk (or run) go, but for its first place (smallest id, then text digest, then place);
   texts are put together from the lines that stay.

A document is known by id and text digest, so two texts under one id stay apart.

Defined cases: null and empty texts have one empty line and lose nothing; rows repeated with id and text are
one document and share its result; null ids come first; a repeated line between others that don't repeat stays;
chunks may overlap in one text; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Bytes of the hash that a fine chunking each goes by, in both directions; (byte, open, close) of the coarse ones.
FINE = (0, 1, 2, 3)
COARSE = ((4, 224, 32), (5, 224, 32))
FAR = 1 << 32  # a chunk's number: its first line times this, plus its lines


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, mark`` (text digest), ``text`` and its ``lines``."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return rows.select("id", F.unhex(F.md5("text")).alias("mark"), "text", F.split("text", "\n", -1).alias("lines"))


def bounds(inside: Column, n: Column) -> Column:
    """``(start, end)`` of the chunks, from whether each line stays with the next."""
    ends = F.concat(F.filter(F.transform(inside, lambda x, i: F.when(~x, i + 1)), lambda x: x.isNotNull()), F.array(n))
    starts = F.concat(F.array(F.lit(0)), F.slice(ends, F.lit(1), F.size(ends) - 1))
    return F.filter(F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end"))), lambda c: c["end"] - c["start"] > 1)


def next_to(values: Column, rule) -> Column:
    """``rule`` of each value and the one behind it; one less than there are values."""
    return F.zip_with(F.slice(values, F.lit(1), F.size(values) - 1), F.slice(values, F.lit(2), F.size(values)), rule)


def coarse(hashes: Column, byte: int, open_: int, close: int) -> Column:
    """The numbers of the chunks with two lines or more."""
    part = F.transform(hashes, lambda h: F.shiftrightunsigned(h, 8 * byte).bitwiseAND(F.lit(255)))
    found = bounds(next_to(part, lambda a, b: (a < open_) & (b >= close)), F.size(hashes))
    return F.transform(found, lambda c: c["start"].cast("long") * FAR + (c["end"] - c["start"]))


def pairs_where(hashes: Column, fine: Sequence[int], differ: bool) -> Column:
    """The numbers of the two-line runs that a fine chunking has as a chunk (or none has)."""
    bits = F.lit(sum(128 << 8 * byte for byte in fine))
    other = next_to(hashes, lambda a, b: (a.bitwiseXOR(b).bitwiseAND(bits) != 0) == F.lit(differ))
    return F.filter(F.transform(other, lambda x, i: F.when(x, i.cast("long") * FAR + 2)), lambda x: x.isNotNull())


def same_lines(hashes: Column) -> Column:
    """The numbers of the chunks of equal lines one under the other, of two lines at most."""
    found = bounds(next_to(hashes, lambda a, b: a == b), F.size(hashes))
    return F.flatten(F.transform(found, lambda c: F.transform(
        F.sequence(c["start"], c["end"] - 2, F.lit(2)), lambda i: i.cast("long") * FAR + 2)))


def first_line(number: Column) -> Column:
    return F.shiftright(number, 32).cast("int")


def n_lines(number: Column) -> Column:
    return number.bitwiseAND(F.lit(FAR - 1)).cast("int")


def content(lines: Column, number: Column) -> Column:
    return F.array_join(F.slice(lines, first_line(number) + 1, n_lines(number)), "\n")


def digested(lines: Column, numbers: Column) -> Column:
    return F.transform(numbers, lambda x: F.struct(x.alias("number"), F.unhex(F.md5(content(lines, x))).alias("digest")))


def occurring_again(each: DataFrame) -> DataFrame:
    """The rows whose digest is at another place too, and whether theirs is the ``first``; repeated rows once."""
    at = F.struct("id", "mark", "number")
    first = written(each.groupBy("digest").agg(F.min(at).alias("at"), F.max(at).alias("last"))
                    .filter(~F.col("at").eqNullSafe(F.col("last"))).drop("last"), "line-first")
    found = each.join(first, "digest").select("id", "mark", "number", "digest", F.col("at").eqNullSafe(at).alias("first"))
    return found.dropDuplicates(["id", "mark", "number"])


def same(*cols: str):
    """Equal in ``id`` (nulls alike) and in ``cols``, against columns named with ``_`` behind."""
    on = F.col("id").eqNullSafe(F.col("id_"))
    for c in cols:
        on = on & (F.col(c) == F.col(f"{c}_"))
    return on


def underscored(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{c}_") for c in cols])


def grown(each: DataFrame, found: DataFrame) -> DataFrame:
    """Rows as ``found`` of the repeated runs that no fine chunking has, where an unbroken line of them meets a repeated chunk."""
    start, size = first_line(F.col("number")), n_lines(F.col("number"))
    runs = occurring_again(each.filter(~F.col("chunk")).drop("chunk")).withColumn("line", start)
    nth = F.row_number().over(Window.partitionBy("id", "mark").orderBy("line"))  # the runs of one text
    runs = written(runs.withColumn("island", F.col("line") - nth), "line-runs")
    beside = found.select("id", "mark", F.explode(F.array(start - 1, start + size - 1)).alias("line"))
    met = runs.join(underscored(beside, "id", "mark", "line"), same("mark", "line"), "left_semi").select("id", "mark", "island").distinct()
    return runs.join(underscored(met, "id", "mark", "island"), same("mark", "island"), "left_semi").drop("line", "island")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fine: Sequence[int] = FINE,
               coarser: Sequence[tuple] = COARSE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_lines, n_removed`` (lines), ``n_chunks, n_removed_chunks`` (multi-line), ``kept_text``."""
    texts = texts_of(docs, id_col, text_col)
    h, lines = F.col("h"), F.col("lines")
    hashed = texts.select("id", "mark", "text", "lines", F.transform("lines", lambda x: F.xxhash64(x)).alias("h"))
    numbers = F.array_distinct(F.concat(same_lines(h), pairs_where(h, fine, True), *[coarse(h, *c) for c in coarser]))
    counted = hashed.select("id", "mark", "text", F.size(numbers).cast("long").alias("n_chunks"))
    hashed = hashed.select("id", "mark", "lines", numbers.alias("numbers"), pairs_where(h, fine, False).alias("others"))
    rows = hashed.select("id", "mark", F.explode(F.concat(
        F.transform(digested(lines, F.col("numbers")), lambda x: x.withField("chunk", F.lit(True))),
        F.transform(digested(lines, F.col("others")), lambda x: x.withField("chunk", F.lit(False))))).alias("x"))
    each = written(rows.select("id", "mark", "x.*"), "line-chunks")
    found = written(occurring_again(each.filter("chunk").drop("chunk")), "line-repeats")
    looked = found.withColumn("chunk", F.lit(True)).unionByName(written(grown(each, found), "line-grown").withColumn("chunk", F.lit(False)))
    kind = "struct<number:bigint,digest:binary,first:boolean,chunk:boolean>"
    while True:
        # only repeats and texts (shorter than their lines) are dealt out; how many chunks a text has, its own row says
        of = looked.groupBy(F.col("id").alias("id_"), F.col("mark").alias("mark_")).agg(
            F.sort_array(F.collect_list(F.struct("number", "digest", "first", "chunk"))).alias("again"))
        whole = written(counted.join(of, same("mark"), "left").select(
            "id", F.split("text", "\n", -1).alias("lines"), "n_chunks", F.coalesce("again", F.array().cast(f"array<{kind}>")).alias("again")), "line-texts")
        seen = whole.filter(F.size("again") > 0).select(F.explode(F.transform("again", lambda a: F.struct(
            a["digest"].alias("digest"), content(lines, a["number"]).alias("text")))).alias("c")).select("c.*").distinct()
        mixed = written(seen.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest"), "line-mixed")
        if mixed.isEmpty():  # as good as always: MD5 of other contents
            break
        looked = looked.join(mixed, "digest", "left_anti")
    later = F.filter("again", lambda a: ~a["first"])
    gone = F.array_distinct(F.flatten(F.transform(later, lambda a: F.sequence(
        first_line(a["number"]), first_line(a["number"]) + n_lines(a["number"]) - 1))))
    n = F.size("lines")
    kept = whole.select("id", "lines", "n_chunks", F.size(F.filter(later, lambda a: a["chunk"])).cast("long").alias("n_removed_chunks"),
                        gone.alias("gone"))
    kept = kept.select("*", F.array_except(F.sequence(F.lit(0), n - 1), F.col("gone")).alias("left"))
    return kept.select(F.col("id").alias(id_col), n.cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_removed"),
                       "n_chunks", "n_removed_chunks", F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n").alias("kept_text"))


def op9_line_dedup(spark, sf_dir: str) -> DataFrame:
    from .common import table
    got = line_dedup(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_lines", "n_removed", "n_chunks", "n_removed_chunks", F.sha2("kept_text", 256).alias("kept_sha256"))
