import datetime as dt

from pyspark.sql import functions as F

from punctuo.operators import facts as FA
from punctuo.operators import histograms as H
from punctuo.profiles import CH_SBB, DE_DB

SCHEMA = ("id long, scheduled_time timestamp_ntz, scheduled_duration_minutes smallint, "
          "projected_duration_minutes smallint, delay_minutes smallint, cancelled boolean, "
          "sample_time timestamp_ntz, ttl_minutes smallint, trip_id string, line_name string, "
          "product_type_id smallint, station_id string, operator_id smallint, is_departure boolean, "
          "remarks_hash string, load_factor_id smallint")
T = dt.datetime


def row(i, sched, delay, cancelled, st, ttl, trip="ICE100", station="B", dep=True, remarks=None, pdur=None):
    return (i, sched, 10, pdur, delay, cancelled, st, ttl, trip, "ICE 100", 1, station, 1, dep, remarks, None)


def facts_of(spark, rows, remarks=None, profile=DE_DB):
    s = spark.createDataFrame(rows + [row(999, T(2023, 1, 5), None, False, T(2023, 1, 5), 0, trip="X")], SCHEMA)
    f = FA.label_facts(FA.facts(s, remarks, profile), profile)
    return sorted([r.asDict() for r in f.collect()], key=lambda r: (r["prior_ttl_bucket"] or "", r["prior_delay_bucket"] or ""))


def test_golden_example(spark):
    s = T(2023, 1, 1, 17, 10)
    rows = [row(1, s, None, False, T(2023, 1, 1, 16, 0), 70), row(2, s, 1, False, T(2023, 1, 1, 17, 0), 11),
            row(3, s, 17, False, T(2023, 1, 1, 17, 25), 2), row(4, s, None, False, T(2023, 1, 1, 17, 40), -30)]
    f = facts_of(spark, rows)
    got = {(r["prior_ttl_bucket"], r["prior_delay_bucket"], r["latest_sample_ttl_bucket"],
            r["latest_sample_delay_bucket"]) for r in f}
    assert got == {("[60,75)", None, "[0,5)", "[16,21)"), ("[10,15)", "[1,2)", "[0,5)", "[16,21)"),
                   (None, None, "[0,5)", "[16,21)"), ("(,-20)", None, "[0,5)", "[16,21)")}
    assert len(f) == 4  # the unfrozen row X is not in the facts


def test_cancelled_latest_and_substitute(spark):
    s = T(2023, 1, 1, 10, 0)
    rows = [row(1, s, 5, False, T(2023, 1, 1, 9, 0), 60), row(2, s, None, True, T(2023, 1, 1, 9, 30), 30, remarks="h")]
    f = facts_of(spark, rows)
    assert {r["latest_sample_delay_bucket"] for r in f} == {None}
    rem = spark.createDataFrame([("h", '[{"code":"alternative-trip","text":"x"}]')], "remarks_hash string, remarks string")
    f2 = facts_of(spark, rows, rem)
    assert {r["latest_sample_delay_bucket"] for r in f2} == {"(,)"}
    f3 = facts_of(spark, rows, rem, CH_SBB)  # no substitute detection in this profile
    assert {r["latest_sample_delay_bucket"] for r in f3} == {None}


def test_cancelled_prior_dropped_and_no_realtime(spark):
    s = T(2023, 1, 1, 10, 0)
    rows = [row(1, s, None, True, T(2023, 1, 1, 9, 0), 60), row(2, s, 3, False, T(2023, 1, 1, 9, 30), 30),
            row(3, s, None, False, T(2023, 1, 1, 9, 0), 60, station="C")]
    f = facts_of(spark, rows)
    assert len(f) == 1 and f[0]["latest_sample_delay_bucket"] == "[3,4)"


def test_tie_lowest_id_wins(spark):
    s = T(2023, 1, 1, 10, 0)
    rows = [row(7, s, 4, False, T(2023, 1, 1, 9, 0), 60), row(5, s, 9, False, T(2023, 1, 1, 9, 0), 60)]
    f = facts_of(spark, rows)
    latest = [r for r in f if r["prior_ttl_bucket"] is None]
    assert len(latest) == 1 and latest[0]["latest_sample_delay_bucket"] == "[9,10)"


def test_frozen_edge_and_retention(spark):
    rows = [row(1, T(2023, 1, 2, 22, 0), 1, False, T(2023, 1, 2, 21, 0), 60),
            row(2, T(2023, 1, 4, 12, 0), 1, False, T(2023, 1, 4, 11, 0), 60, trip="Y")]
    s = spark.createDataFrame(rows, SCHEMA)
    thr = FA.freeze_threshold(s).first()[0]
    assert thr == T(2023, 1, 2, 12, 0)
    edge = spark.createDataFrame([row(3, thr, 1, False, thr, 0, trip="Z")], SCHEMA).unionByName(s)
    assert FA.facts(edge).where(F.col("scheduled_time") == thr).count() == 0
    assert FA.retain(edge).where(F.col("scheduled_time") == thr).count() == 1


def test_histogram_sums_conserved(spark):
    import os
    from punctuo import fixtures as fx
    d = "/root/testdata/sf0.001"
    f = FA.facts(fx.sample(spark, d), fx.remarks(spark, d))
    total = f.agg(F.sum("sample_count")).first()[0]
    for kind in ("by_hour", "by_day", "by_station", "by_duration"):
        assert H.histogram(f, kind).agg(F.sum("sample_count")).first()[0] == total
    parts = H.all_histograms(f)
    for kind in ("by_hour", "by_day", "by_station", "by_duration"):
        a = sorted(repr(tuple(r)) for r in parts[kind].collect())
        b = sorted(repr(tuple(r)) for r in H.histogram(f, kind).select(*parts[kind].columns).collect())
        assert a == b
    parts["_all"].unpersist()


def test_a_null_in_the_key_matches_nothing(spark):
    s = T(2023, 1, 1, 10, 0)
    rows = [row(1, s, 5, False, T(2023, 1, 1, 9, 0), 60, trip=None), row(2, s, 2, False, T(2023, 1, 1, 9, 30), 30, trip=None),
            row(3, s, 7, False, T(2023, 1, 1, 9, 0), 60, station=None), row(4, s, 3, False, T(2023, 1, 1, 9, 0), 60)]
    f = facts_of(spark, rows)
    assert [r["latest_sample_delay_bucket"] for r in f] == ["[3,4)"]
