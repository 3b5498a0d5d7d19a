import gzip
import io
import os
import tarfile
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from punctuo import fixtures as fx
from punctuo import sinks
from punctuo.operators import facts as FA
from punctuo.operators import histograms as H
from punctuo.plans import refresh as R
from punctuo.sources import files as FS
from punctuo.streaming import stream as STR

D = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_stream_equals_batch_and_retry_is_idempotent(spark):
    work = tempfile.mkdtemp(prefix="punctuo-stream-")
    sample = fx.sample(spark, D)
    src = f"{work}/in"
    sample.repartition(3, "trip_id").write.parquet(src)
    state, ckpt = f"{work}/state", f"{work}/ckpt"
    q = STR.ingest_and_refresh(spark, STR.stream_files(spark, src, sample.schema), state, ckpt, fx.remarks(spark, D))
    q.awaitTermination()
    got = R.stored(spark, state, "by_day")
    want = H.histogram(FA.facts(sample, fx.remarks(spark, D)), "by_day")
    assert _rows(got) == _rows(want.select(*got.columns))
    # the same batch again (a retry) changes nothing
    before = sinks.manifest(spark, state)
    assert R.refresh(spark, R.stored(spark, state, "sample"), None, state, batch_id=0) == {}
    assert sinks.manifest(spark, state) == before


def _totals(spark, state):
    kinds = ("by_hour", "by_day", "by_station", "by_duration")
    return ([R.stored(spark, state, k).agg(F.sum("sample_count")).first()[0] for k in kinds]
            + [R.stored(spark, state, "sample").count()])


def test_stop_after_each_write_and_retry(spark, tmp_path, monkeypatch):
    sample, remarks = fx.sample(spark, D).where("trip_id < 'T3'").cache(), fx.remarks(spark, D)
    first, second = sample.where("id % 2 = 0"), sample.where("id % 2 = 1")
    R.refresh(spark, first, remarks, f"{tmp_path}/once", batch_id=0)
    both = STR.new_samples(second, R.stored(spark, f"{tmp_path}/once", "sample"))
    R.refresh(spark, both, remarks, f"{tmp_path}/once", batch_id=1)
    want = _totals(spark, f"{tmp_path}/once")
    state = f"{tmp_path}/stopped"
    R.refresh(spark, first, remarks, state, batch_id=0)
    before, real = _totals(spark, state), sinks.write_part
    for stop in (1, 3, 5, 6):  # after the first and third histogram, after the open samples, in the commit
        done = []

        def stopping(df, *a, **k):
            out = real(df, *a, **k)
            done.append(out)
            if len(done) == stop:
                raise KeyboardInterrupt
            return out

        def stopped(*a, **k):
            raise KeyboardInterrupt
        with monkeypatch.context() as m:
            m.setattr(sinks, "write_part", stopping)
            if stop == 6:
                m.setattr(sinks, "commit", stopped)
            with pytest.raises(KeyboardInterrupt):
                R.refresh(spark, STR.new_samples(second, R.stored(spark, state, "sample")), remarks, state, batch_id=1)
        assert _totals(spark, state) == before
    R.refresh(spark, STR.new_samples(second, R.stored(spark, state, "sample")), remarks, state, batch_id=1)
    assert _totals(spark, state) == want
    assert R.refresh(spark, second, remarks, state, batch_id=1) == {}
    R.refresh_aggregations(spark, state)
    assert R.stored(spark, state, "by_month").agg(F.sum("sample_count")).first()[0] == want[1]
    assert R.stored(spark, state, "without_time").agg(F.sum("sample_count")).first()[0] == want[0]


def test_commits_keep_history_and_clean_up(spark, tmp_path):
    state, df = str(tmp_path), spark.range(3).selectExpr("id AS k", "1L AS sample_count")
    for i in range(4):
        m = sinks.manifest(spark, state)
        sinks.commit(spark, state, m, {"t": [sinks.write_part(df.where(f"k <= {i}"), state, "t")]}, batch_id=i)
    m = sinks.manifest(spark, state)
    assert m["version"] == 4 and m["batches"] == [[0, 3]] and sinks.read_parts(spark, state, m["tables"]["t"]).count() == 3
    assert len(os.listdir(f"{state}/t")) == sinks.KEEP
    with pytest.raises(RuntimeError):  # a second writer from an older state
        sinks.commit(spark, state, m | {"version": 3}, {})
    assert sinks.manifest(spark, state) == m


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "b c", "x")], "i int, s string, t string")
    sinks.append(df, f"{tmp_path}/p", ["i"])
    sinks.append(df, f"{tmp_path}/p", ["i"])
    assert spark.read.parquet(f"{tmp_path}/p").count() == 4
    sinks.export_tsv(df.coalesce(1), f"{tmp_path}/t")
    assert [r.value for r in spark.read.text(f"{tmp_path}/t").collect()] == ["1\ta\t", "2\tb c\tx"]
    sinks.export_json(df, f"{tmp_path}/j")
    assert {r.s for r in spark.read.json(f"{tmp_path}/j").collect()} == {"a", "b c"}
    lines = FS.read_lines(spark, f"{tmp_path}/j").collect()
    assert len(lines) == 2 and all(r.path.startswith("file:") for r in lines)


def test_unpack_and_split_log(spark):
    work = tempfile.mkdtemp(prefix="punctuo-files-")
    with zipfile.ZipFile(f"{work}/gtfs.zip", "w") as z:
        z.writestr("agency.txt", "﻿agency_id,agency_name\n1,A\n")
        z.writestr("stops.txt", "stop_id,stop_name\n1,S\n")
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:bz2") as t:
        for name in ("b.pb", "a.pb"):
            data = name.encode()
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    open(f"{work}/feeds.tar.bz2", "wb").write(buf.getvalue())
    files = spark.read.format("binaryFile").load(f"{work}/*.*")
    members = FS.unpack(files).select(F.element_at(F.split("path", "/"), -1).alias("f"), "member").collect()
    assert sorted((r.f, r.member) for r in members) == [("feeds.tar.bz2", "a.pb"), ("feeds.tar.bz2", "b.pb"),
                                                        ("gtfs.zip", "agency.txt"), ("gtfs.zip", "stops.txt")]
    body = gzip.compress(b'{"departures": [{"delay": 60}]}\n{"x": 1}')
    log = (b'[01/Jan/2024:10:00:00 +0000] "GET /departures?x=1 HTTP/1.1" 200 12\n' + body + b"\n"
           + b'[01/Jan/2024:10:01:00 +0000] "GET /radar HTTP/1.1" 200 5\nnot-gzip\n')
    os.makedirs(f"{work}/logs")
    open(f"{work}/logs/access.log", "wb").write(log)
    out = FS.read_log(spark, f"{work}/logs/*").orderBy("ts").collect()
    assert [(r.type, r.err is None) for r in out] == [("departures", True), (None, False)]
    assert out[0].body.startswith('{"departures"')
    listed = FS.list_inputs(spark, f"{work}/*.*", up_to=f"file:{work}/gtfs.zip").collect()
    assert [os.path.basename(r.path) for r in listed] == ["feeds.tar.bz2"]


def test_log_entries_across_splits(spark, tmp_path):
    import datetime as dt
    import hashlib
    import random
    rng = random.Random(2)
    want, log = {}, b"junk \xff before\nthe first header\n"
    for i in range(200):
        body = "".join(rng.choices("abc\n{}é", k=rng.randint(0, 400)))
        ok = i % 9 != 4
        log += f'[02/Jan/2024:{i // 60:02d}:{i % 60:02d}:00 +0000] "GET /{["arrivals", "radar"][i % 2]}?x={i} HTTP/1.1" 200 7\n'.encode()
        log += (gzip.compress(body.encode()) if ok else b"\x1f\x8b broken \n\r\n") + b"\n"
        want[dt.datetime(2024, 1, 2, i // 60, i % 60)] = ("arrivals" if i % 2 == 0 else None, hashlib.md5(body.encode()).hexdigest() if ok else None, ok)
    os.makedirs(f"{tmp_path}/logs")
    for name in ("a.log", "b.log"):
        open(f"{tmp_path}/logs/{name}", "wb").write(log)
    open(f"{tmp_path}/logs/empty.log", "wb").close()
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("701", kept):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = FS.read_log(spark, f"{tmp_path}/logs/*").collect()
            for name in ("a.log", "b.log"):
                mine = [r for r in rows if r.path.endswith(name)]
                assert {r.ts: (r.type, r.hash, r.err is None) for r in mine if r.ts} == want and len(mine) == 201
                assert [(r.err, r.hash) for r in mine if r.ts is None] == [("NoHeader", None)]
            assert len(rows) == 402
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
