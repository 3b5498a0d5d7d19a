"""Greedy batches, and where a run goes on."""

import datetime as dt
import os
import random

import pytest

from punctuo.operators import segments as S
from punctuo.sources import resume as RS

T0 = dt.datetime(2024, 1, 1)


def plain(rows, days=5):
    out, batch, first, ended = {}, 0, None, False
    for path, a, b in sorted(rows):
        if a is None or b is None:
            out[path] = batch
            continue
        if ended:
            batch, first, ended = batch + 1, None, False
        first = first or a
        out[path] = batch
        ended = b - first > dt.timedelta(days=days)
    return out


def cases():
    rng = random.Random(3)
    at = lambda h: T0 + dt.timedelta(hours=h)
    steady = [(f"f{i:04d}", at(7 * i), at(7 * i + 6)) for i in range(300)]
    mixed = [(f"f{i:04d}", at(5 * i + rng.randint(-90, 90)), at(5 * i + rng.randint(-90, 200))) for i in range(257)]
    gaps = [(p, None, None) if rng.random() < 0.3 else (p, a, b) for p, a, b in mixed]
    return [steady, mixed, gaps, [("a", at(0), at(999))] + steady, [(f"x{i}", at(0), at(0)) for i in range(40)],
            [("only", at(0), at(500))], [("none", None, None)], [(f"w{i:03d}", at(900 * i), at(900 * i + 800)) for i in range(70)]]


@pytest.mark.parametrize("i", range(8))
def test_greedy_batches(spark, i):
    rows = cases()[i]
    df = spark.createDataFrame(rows, "path string, first timestamp_ntz, last timestamp_ntz").repartition(3)
    got = S.greedy_batches(df).collect()
    # files without a time behind a batch's end may stand on either side of the cut in a plain loop; ours stay with the batch before
    assert {r.path: r.batch for r in got} == plain(rows) and len(got) == len(rows)


def test_no_files(spark):
    assert S.greedy_batches(spark.createDataFrame([], "path string, first timestamp_ntz, last timestamp_ntz")).count() == 0


LAST = [(None, None, False), ("d/f2.slot1.x", None, False), ("d/f9.slot0.x", None, False), ("d/gone", None, False), ("d/gone", None, True),
        (None, "d/f3.slot0.x", False), ("d/f1.slot0.x", "d/f3.slot0.x", False), ("d/f5.slot1.x", "d/f3.slot0.x", False),
        ("d/gone", "d/f3.slot0.x", True), ("d/f1.slot0.x", "d/not there", False)]


@pytest.mark.parametrize("last,up_to,restart", LAST)
def test_pending_files(spark, last, up_to, restart):
    paths = [f"d/f{i}.slot0.x" for i in range(10)]

    def loop():  # one file after the other, as a run does
        import re
        name, out = last, []
        while True:
            if not name:
                nxt = paths[0]
            else:
                at = [i for i, p in enumerate(paths) if re.sub(r"\.slot\d\.", "", p) == re.sub(r"\.slot\d\.", "", name)]
                nxt = (paths[at[0] + 1] if at[0] + 1 < len(paths) else None) if at else paths[0] if restart and not out else None
            if nxt is None or nxt == up_to:
                return out
            out.append(nxt)
            name = nxt
    listing = spark.createDataFrame([(p, i) for i, p in enumerate(paths)], "path string, n int").repartition(2)
    got = sorted(r.path for r in RS.pending(listing, last, up_to, restart).collect())
    assert got == loop() == RS.names_after(paths, last, up_to, restart)


def test_a_followed_folder(spark, tmp_path):
    folder, got = f"{tmp_path}/in", []
    os.makedirs(folder)
    put = lambda name, text: open(f"{folder}/{name}", "w").write(text)
    for i in range(5):
        put(f"f{i}.slot0.txt", f"line {i}\n")
    put("_hidden.txt", "no\n")

    def run(**kw):
        got.clear()
        names = RS.file_names(spark, f"{folder}/*.txt", **kw)
        RS.follow(spark, names, f"{tmp_path}/progress", lambda p: spark.read.text(p),
                  lambda df, i: got.extend(sorted(r.value for r in df.collect()))).awaitTermination()
        return got

    assert run(after=f"{folder}/f0.slot1.txt", up_to=f"{folder}/f3.slot0.txt") == ["line 1", "line 2"]
    assert run(after=f"{folder}/f0.slot1.txt", up_to=f"{folder}/f3.slot0.txt") == []
    assert run() == ["line 3", "line 4"]
    put("f7.txt", "line 7\n")
    assert run() == ["line 7"] and run() == []
    os.remove(f"{folder}/f7.txt")
    put("f8.txt", "line 8\n")
    assert run() == []  # the file that was read last is gone
    assert run(restart=True) == ["line 0", "line 1", "line 2", "line 3", "line 4", "line 8"]
