"""Ingest jobs: everything or nothing, responses once, dimensions and stations kept."""

import pytest
from pyspark.sql import functions as F

from punctuo import fixtures as fx
from punctuo import sinks
from punctuo.operators import facts as FA
from punctuo.operators import histograms as H
from punctuo.plans import fold as FO
from punctuo.plans import ingest as IN
from punctuo.plans import refresh as R
from punctuo.profiles import DE_GTFS

D = "/root/testdata/sf0.001"
TABLES = ("station", "remarks", "dimension", "response_log", "by_hour", "by_day")


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs")) + "/d"
    fx.fptf_responses(spark, D).where("pmod(xxhash64(response_id), 6) = 0").write.parquet(path)
    return spark.read.parquet(path)


def _state(spark, state):
    m = sinks.manifest(spark, state)
    if not m["version"]:
        return {}
    out = {t: sinks.read_parts(spark, state, m["tables"][t]) for t in TABLES}
    out |= {t: H.summed(out[t]).where("sample_count <> 0") for t in ("by_hour", "by_day")}
    return {t: sorted(map(repr, df.select(*sorted(df.columns)).collect())) for t, df in out.items()} | {
        "samples": FO.samples(spark, state, m).count()}


def test_a_job_that_stops_has_stored_nothing(spark, docs, tmp_path, monkeypatch):
    half = F.pmod(F.xxhash64("response_id", F.lit(1)), F.lit(2)) == 0
    first, second = docs.where(half), docs.where(~half)
    state, real = str(tmp_path), sinks.write_part
    IN.ingest_fptf(spark, first, state, batch_id=0)
    before = _state(spark, state)
    assert before["samples"] > 100 and all(before[t] for t in TABLES)
    for stop in (2, 4, 6, 8, 11):
        done = []

        def stopping(*a, **k):
            done.append(real(*a, **k))
            if len(done) == stop:
                raise KeyboardInterrupt
            return done[-1]
        with monkeypatch.context() as m:
            m.setattr(sinks, "write_part", stopping)
            with pytest.raises(KeyboardInterrupt):
                IN.ingest_fptf(spark, second, state, batch_id=1)
        assert _state(spark, state) == before
    IN.ingest_fptf(spark, second, state, batch_id=1)
    after = _state(spark, state)
    log = sinks.read_parts(spark, state, sinks.manifest(spark, state)["tables"]["response_log"])
    assert log.groupBy("hash").count().where("count > 1").isEmpty()
    # another run over the same responses: each is in the log
    IN.ingest_fptf(spark, docs.withColumn("source", F.lit("again")), state, batch_id=2)
    again = _state(spark, state)
    assert again == after
    # what is stored is what one pass over the stored samples gives
    s = FO.samples(spark, state).drop("day")
    want = H.histogram(FA.facts(s, sinks.read_parts(spark, state, sinks.manifest(spark, state)["tables"]["remarks"])), "by_day")
    assert sorted(map(repr, want.select(*sorted(want.columns)).collect())) == after["by_day"]
    dims = sinks.read_parts(spark, state, sinks.manifest(spark, state)["tables"]["dimension"])
    assert dims.groupBy("dim", "id").count().where("count > 1").isEmpty() and dims.groupBy("dim", "key").count().where("count > 1").isEmpty()


def test_invalid_documents_and_an_empty_batch(spark, tmp_path):
    kind = "response_id string, type string, doc string, response_ts timestamp_ntz, source string"
    bad = spark.createDataFrame([("a", "trip", None, None, "s"), ("b", "nonsense", "{}", None, "s"), ("c", None, "{}", None, "s"),
                                 ("d", "departures", "not json", None, "s"), ("e", "trip", "{}", None, "s")], kind)
    m = IN.ingest_fptf(spark, bad, str(tmp_path), batch_id=0)
    assert m["batches"] == [[0, 0]] and "samples" not in m["tables"]
    assert IN.ingest_fptf(spark, bad.limit(0), str(tmp_path), batch_id=1)["batches"] == [[0, 1]]


def test_feeds_behind_the_last_timetable(spark, tmp_path):
    fx.write_timetables(spark, D, f"{tmp_path}/tables")
    tables = {n: spark.read.parquet(f"{tmp_path}/tables/{n}") for n in ("trips", "routes", "agency", "stop_times")}
    tu = fx.trip_updates(spark, D).drop("run").where("CAST(trip_id AS BIGINT) % 8 = 0")
    stu = fx.stop_time_updates(spark, D).where("CAST(trip_id AS BIGINT) % 8 = 0")
    versions, stops, state = fx.timetable_versions(spark, D).drop("k"), fx.stops(spark, D), f"{tmp_path}/state"
    with pytest.raises(IN.TimetableUnavailable):
        IN.ingest_gtfs(spark, tu, stu, versions, tables, stops, state, batch_id=0, strict=True)
    assert sinks.manifest(spark, state)["version"] == 0
    m = IN.ingest_gtfs(spark, tu, stu, versions, tables, stops, state, batch_id=0, offline=True, bus_fraction=0.5)
    s = FO.samples(spark, state).drop("day")
    want = H.histogram(FA.facts(s, None, DE_GTFS), "by_day", DE_GTFS)
    got = R.stored(spark, state, "by_day")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))
    assert s.where("delay_minutes IS NULL").count() > 0 and "by_station" not in m["tables"]
    assert sinks.read_parts(spark, state, m["tables"]["station"]).count() == stops.count()
    assert sinks.read_parts(spark, state, m["tables"]["operator"]).where("name = 'Other'").count() == 1
    early = tu.where("feed_ts < '2024-01-15'")
    IN.ingest_gtfs(spark, early, stu, versions, tables, stops, state, batch_id=1, strict=True)  # nothing new in it
    assert sorted(map(repr, R.stored(spark, state, "by_day").collect())) != [] and FO.samples(spark, state).count() >= s.count()
