"""Matching along a trip, bad input, conflicts, numbering, readers."""

import datetime as dt

from pyspark.sql import functions as F

from punctuo import fixtures as fx
from punctuo.functions import buckets as B
from punctuo.operators import dims as D
from punctuo.operators import fptf as P
from punctuo.operators import gtfs as G
from punctuo.operators import normalise as N
from punctuo.operators import stations as ST
from punctuo.sources import envelopes as EN
from punctuo.sources import gtfs_static as GS
from punctuo.sources import official as OF

T = dt.datetime
FEED = T(2024, 1, 1, 6, 0)
INST = ("trip_id string, start_date string, start_time string, trip_schedule_relationship string, feed_ts timestamp_ntz, "
        "line_name string, line_fahrtnr string, product_name string, operator_id int, product_type_id int")
UPD = ("trip_id string, start_date string, feed_ts timestamp_ntz, position int, stop_sequence int, stop_id string, "
       "schedule_relationship string, arrival_delay long, arrival_time long, departure_delay long, departure_time long")


def events(spark, updates, dates=("20240101",), stops="abcd", rel="SCHEDULED", feed=FEED):
    inst = spark.createDataFrame([("t", d, None, rel, feed, "L", "N", "2", 1, 104) for d in dates], INST)
    st = spark.createDataFrame([("t", i, s, f"0{i}:00:00", f"0{i}:10:00") for i, s in enumerate(stops)],
                               "trip_id string, stop_sequence int, stop_id string, arrival_time string, departure_time string")
    up = spark.createDataFrame([("t", d, feed, *u) for d, *u in updates], UPD)
    ev = G.stop_events(inst, st, None, up).orderBy("start_date", "stop_number", "is_departure").collect()
    return {(r.start_date, r.stop_number, r.is_departure): r for r in ev}


def test_updates_stay_with_their_run_and_the_pointer_moves_forward(spark):
    day1, day2 = "20240101", "20240102"
    ev = events(spark, [(day1, 0, 1, None, "SCHEDULED", None, None, 120, None), (day2, 0, None, "c", "SCHEDULED", 60, None, None, None)],
                (day1, day2))
    assert len(ev) == 12
    assert [ev[day1, s, True].delay_minutes for s in (0, 1, 2)] == [None, 2, 2] and ev[day1, 3, False].delay_minutes == 2
    assert [ev[day2, s, True].delay_minutes for s in (0, 1, 2)] == [None, None, 1] and ev[day2, 2, False].delay_minutes == 1
    # an update that is for no stop stops the pointer; the ones behind it aren't reached
    ev = events(spark, [(day1, 0, 0, None, "SCHEDULED", None, None, 60, None), (day1, 1, 9, "x", "SKIPPED", None, None, None, None),
                        (day1, 2, 2, "c", "SCHEDULED", None, None, 600, None)])
    assert [ev[day1, s, True].has_update for s in (0, 1, 2)] == [True, False, False]
    assert ev[day1, 2, True].delay_minutes == 1 and not ev[day1, 2, True].cancelled


def test_absolute_times_cancelled_trips_and_far_feeds(spark):
    day = "20240101"
    at = int(dt.datetime(2024, 1, 1, 1, 15, tzinfo=dt.timezone.utc).timestamp())
    ev = events(spark, [(day, 0, 1, None, "SCHEDULED", None, at - 900, None, at)])
    assert ev[day, 1, False].delay_minutes == 0 and ev[day, 1, True].delay_minutes == 5 and ev[day, 3, False].delay_minutes == 5
    assert ev[day, 1, True].projected_duration_minutes == 50 and ev[day, 1, False].projected_duration_minutes == 15
    assert all(r.cancelled for r in events(spark, [], rel="CANCELED").values())
    far = events(spark, [], feed=T(2024, 3, 1))  # 60 days: over a smallint, no error, N5 drops it
    assert min(r.ttl_minutes for r in far.values()) < -80_000


def test_versions_keep_timetables_apart(spark):
    v = [spark.createDataFrame([(n, "t", 0, "a", "01:00:00", "01:00:00"), (n, "t", 1, "b", "02:00:00", "02:00:00")][: 2 if n == "v1" else 1],
                               "gtfs_version string, trip_id string, stop_sequence int, stop_id string, arrival_time string, "
                               "departure_time string") for n in ("v1", "v2")]
    inst = spark.createDataFrame([("t", "20240101", None, "SCHEDULED", FEED, "L", "N", "2", 1, 104, "v1")], INST + ", gtfs_version string")
    assert G.stop_events(inst, v[0].unionByName(v[1]), None, None).count() == 2


def test_feed_before_the_first_versions_last_day(spark):
    vs = spark.createDataFrame([("v1", T(2024, 1, 1)), ("v2", T(2024, 1, 10)), ("v3", T(2024, 1, 20))], "version string, mtime timestamp_ntz")
    feeds = spark.createDataFrame([(T(2023, 12, 1),), (T(2024, 1, 2),), (T(2024, 1, 10, 14),), (T(2024, 1, 10, 14, 0, 1),), (T(2024, 2, 1),)],
                                  "feed_ts timestamp_ntz")
    got = {r.feed_ts: r.version for r in G.attach_version(feeds, vs).collect()}
    assert list(got[t] for t in sorted(got)) == ["v1", "v1", "v1", "v2", None]


def test_bad_values_become_null(spark):
    bad = spark.createDataFrame([("99999999999",), ("60",)], "s string").select(B.minutes_from_seconds(F.col("s").cast("bigint")).alias("m"))
    assert [r.m for r in bad.collect()] == [1666666667, 1]
    log = spark.createDataFrame([('[99/Foo/2024:10:00:00 +0000] "GET /trips HTTP/1.1" 200 1',)], "v string")
    assert log.select(EN.log_meta(F.col("v")).alias("m")).first().m.asDict() == {"ts": None, "type": "trips"}
    raw = spark.createDataFrame([("1", "i", "n", "abc", "9,5")], "EVA_NR string, IFOPT string, NAME string, Laenge string, Breite string")
    assert tuple(ST.official_from_raw(raw).select("lon", "lat").first()) == (None, 9.5)
    doc = ('[{"tripId":"t","stop":{"type":"stop","id":"s","name":"S","extra":1,"location":{"longitude":1,"latitude":2}},'
           '"plannedWhen":"not a date","remarks":[{"type":"hint","text":"x","summary":"y"}]}]')
    docs = spark.createDataFrame([("k", "departures", doc), ("e", "departures", "no json"), ("r", "radar", "[]")], "k string, type string, doc string")
    r = P.fptf_samples(docs).collect()
    assert len(r) == 1 and r[0].scheduled_time is None and r[0].remarks == '[{"type":"hint","text":"x","summary":"y"}]'
    assert '"extra":1' in P.fptf_stations(docs).first().details


def test_remarks_key_covers_every_field(spark):
    df = spark.createDataFrame([('[{"type":"a","code":"c","text":"t"}]',), ('[{"type":"b","code":"c","text":"t"}]',),
                                ('[{"type":"a","code":"c","text":"t","summary":"s"}]',), ('[ {"type":"a", "code":"c","text":"t"} ]',)], "r string")
    keys = [r.k for r in df.select(N.remarks_key(F.col("r")).alias("k")).collect()]
    assert len(set(keys)) == 3 and keys[0] == keys[3]


def test_insert_ignore_and_numbering(spark):
    old = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (2, "b"), (2, "a")], "k int, v string")
    assert sorted(map(tuple, D.insert_ignore(old, new, "k").collect())) == [(1, "old"), (2, "a")]
    n = D.numbered(spark.range(1000).selectExpr("cast(999 - id AS int) AS k").repartition(7), "k").collect()
    assert sorted((r.k, r._nr) for r in n) == [(i, i + 1) for i in range(1000)]
    assert D.numbered(spark.range(0).withColumnRenamed("id", "k"), "k").count() == 0


def test_response_counts_are_driven_by_responses(spark):
    res = spark.createDataFrame([(1, "radar", 2), (2, "trip", 0)], "event_id int, type string, expected_rt_count int")
    norm = spark.createDataFrame([(1, 5), (1, None)], "response_id int, delay_minutes int")
    assert N.rt_count_check(res, norm).first().asDict() == {
        "incorrect_rt_count": 1, "missing_rts": 1, "excess_rts": 0, "empty_responses": 1, "samples_from_radar": 2, "rt_samples_from_radar": 1}


def test_static_and_official_readers(spark, tmp_path):
    (tmp_path / "stops.txt").write_bytes("﻿stop_id,stop_name,unused\n1,\"A, b\",x\n2,B,y\n1,C,z\n".encode())
    df = GS.read_static(spark, str(tmp_path / "stops.txt"), ["stop_id", "stop_name", "parent_station"], "stop_id", "v1")
    assert sorted(map(tuple, df.collect())) == [("v1", "1", "C", None), ("v1", "2", "B", None)]
    (tmp_path / "o.csv").write_text("EVA_NR;IFOPT;NAME;Laenge;Breite\n8000001;de:1;N;6,5;50,25\n")
    assert tuple(ST.read_official_stations(spark, str(tmp_path / "o.csv")).first()) == ("8000001", "de:1", "N", 6.5, 50.25)


def test_responses_spread_over_all_events(spark):
    d = "/root/testdata/sf0.001"
    n = fx.responses(spark, d).count()
    assert fx.raw_samples(spark, d).where("hash IS NULL").count() == 0
    assert fx.raw_samples(spark, d).select("response_id").distinct().count() > 0.9 * n or n > 5000
    assert OF.official_long(fx.official_punctuality_csv(spark, d)).count() > 0


def test_dimension_ids_given_by_the_job_stay(spark):
    from punctuo.operators import dims as D
    stored = spark.createDataFrame([("operator", 4, "O1", "one")], "dim string, id int, key string, name string")
    values = spark.createDataFrame([(1, "O1"), (2, "O9"), (3, None), (4, "")], "id int, operator string")
    assert D.assign_all(stored, values, {"operator": "operator"}, auto_ids=False) == (stored, values)
    every, out = D.assign_all(stored, values, {"operator": "operator"})
    assert {(r.key, r.id) for r in every.collect()} == {("O1", 4), ("", 5), ("O9", 6)}
    assert {(r.id, r.operator_id) for r in out.collect()} == {(1, 4), (2, 6), (3, None), (4, 5)}


def test_station_documents_keep_what_details_say(spark):
    from punctuo.operators import stations as T
    st = spark.createDataFrame([
        ("1", "A", 7.0, 50.0, None), ("2", "B", 7.0, 50.0, '{"id":"22","name":"bee","type":"stop","weight":3.5,"location":{"latitude":51.0,"longitude":8.0}}'),
        ("3", "C", 7.0, 50.0, '{"weight":0}'), ("4", "D", None, None, "no json")], "station_id string, name string, lon double, lat double, details string")
    of = spark.createDataFrame([("1", "de:1", "x", 7.0001, 50.0), ("22", "de:22", "x", 8.1, 51.0), ("4", "de:4", "x", 9.0, 52.0)],
                               "eva string, ifopt string, name string, lon double, lat double")
    got = {r.station_id: r for r in T.documents(st, of).collect()}
    one, two, three, four = (got[k].details for k in "1234")
    assert (one.id, one.name, one.type, one.location.longitude, one.ifoptId, one.weight, got["1"].repaired) == ("1", "A", "station", 7.0, "de:1", 1.0, False)
    assert (two.id, two.name, two.type, two.location.longitude, two.ifoptId, two.weight, got["2"].repaired) == ("22", "bee", "stop", 8.1, "de:22", 3.5, True)
    assert got["2"].position.longitude == 8.0 and three.weight == 1.0 and three.ifoptId is None
    assert four.ifoptId == "de:4" and not got["4"].repaired and four.location.longitude is None
