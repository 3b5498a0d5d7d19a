import datetime as dt

from pyspark.sql import functions as F

from punctuo.operators import gtfs as G
from punctuo.operators import normalise as N

T = dt.datetime


def test_fallback_and_relevance(spark):
    df = spark.createDataFrame([
        (1, T(2024, 1, 1, 12, 0), None, None, None, T(2024, 1, 1, 11, 2)),
        (2, T(2024, 1, 2, 12, 0), None, None, T(2024, 1, 1, 12, 0), None),
        (3, T(2024, 1, 2, 12, 1), None, None, T(2024, 1, 1, 12, 0), None),
        (4, T(2023, 12, 31, 12, 0), None, None, T(2024, 1, 1, 12, 0), None)],
        "id int, scheduled_time timestamp_ntz, projected_time timestamp_ntz, delay_seconds int, "
        "sample_time timestamp_ntz, response_ts timestamp_ntz").withColumn("cancelled", F.lit(None).cast("boolean"))
    n = N.normalise(df)
    r = {x.id: x for x in n.collect()}
    assert r[1].sample_time == T(2024, 1, 1, 11, 0) and r[1].ttl_minutes == 60 and r[1].cancelled is False
    kept = {x.id for x in N.relevant(n).collect()}
    assert kept == {1, 2, 4}  # ttl 1440 and -1440 kept, 1441 dropped


def test_gtfs_time_and_product(spark):
    df = spark.createDataFrame([("25:10:00", "2", "ICE 5"), ("05:00:00", "2", "IC 1"), ("00:00:01", "715", "x"),
                                ("00:00:00", "abc", "S1"), ("00:00:00", "2", "S1"), ("00:00:00", "106", "RE")],
                               "t string, rt string, n string")
    got = df.select(G.gtfs_seconds(F.col("t")).alias("s"), G.product_type(F.col("rt"), F.col("n")).alias("p")).collect()
    assert [r.s for r in got][:3] == [90600, 18000, 1]
    assert [r.p for r in got] == [101, 102, 700, 1000, 109, 104]


def test_delay_and_cancel_fill(spark):
    inst = spark.createDataFrame([("t1", "20240101", None, "SCHEDULED", T(2024, 1, 1, 6, 0), "L", "N1", "2", 1, 104)],
                                 "trip_id string, start_date string, start_time string, trip_schedule_relationship string, "
                                 "feed_ts timestamp_ntz, line_name string, line_fahrtnr string, product_name string, "
                                 "operator_id int, product_type_id int")
    st = spark.createDataFrame([("t1", i, f"s{i}", f"0{i}:00:00", f"0{i}:01:00") for i in range(1, 6)],
                               "trip_id string, stop_sequence int, stop_id string, arrival_time string, "
                               "departure_time string")
    up = spark.createDataFrame([("t1", "20240101", T(2024, 1, 1, 6, 0), i, i, r, d) for i, r, d in
                                [(1, "SCHEDULED", 60), (2, "SKIPPED", None), (4, "SCHEDULED", 0)]],
                               "trip_id string, start_date string, feed_ts timestamp_ntz, position int, stop_sequence int, "
                               "schedule_relationship string, departure_delay int")
    ev = G.stop_events(inst, st, None, up).where("is_departure").orderBy("stop_number").collect()
    assert [r.delay_minutes for r in ev] == [1, 1, 1, 0]
    assert [r.cancelled for r in ev] == [False, True, True, False]
    assert ev[0].scheduled_time == T(2024, 1, 1, 1, 1)


def _line(spark, n, trips=1, copies=1):
    t = spark.range(trips).select(F.concat(F.lit("t"), "id").alias("trip_id"))
    day, at = F.lit("20240101").alias("start_date"), F.lit("2024-01-01 06:00:00").cast("timestamp_ntz").alias("feed_ts")
    inst = t.crossJoin(spark.range(copies)).select(
        "trip_id", day, F.lit(None).cast("string").alias("start_time"), F.lit("SCHEDULED").alias("trip_schedule_relationship"), at,
        F.lit("L").alias("line_name"), F.lit("N").alias("line_fahrtnr"), F.lit("2").alias("product_name"),
        F.lit(1).alias("operator_id"), F.lit(104).alias("product_type_id"))
    st = t.select("trip_id", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("stop_sequence")).select(
        "trip_id", "stop_sequence", F.concat(F.lit("s"), "stop_sequence").alias("stop_id"), F.lit("10:00:00").alias("arrival_time"),
        F.when(F.col("stop_sequence") != 5, "10:01:00").alias("departure_time"))
    up = st.where("stop_sequence % 3 = 0 OR stop_sequence = 5").select(
        "trip_id", day, at, F.col("stop_sequence").alias("position"), "stop_sequence",
        F.when(F.col("stop_sequence") == 5, "SKIPPED").otherwise("SCHEDULED").alias("schedule_relationship"),
        (F.col("stop_sequence") * 60).alias("departure_delay"))
    return G.stop_events(inst, st, None, up)


def test_long_trips_in_one_walk(spark):
    df = _line(spark, 900)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
    rows = df.where("is_departure").orderBy("stop_number").collect()
    assert len(rows) == 898 and rows[-1].delay_minutes == 897 and rows[-1].stop_number == 899
    # stop 5 has no departure time, yet its cancellation holds until the next update
    assert {r.stop_number for r in rows if r.cancelled} == set() and 5 not in {r.stop_number for r in rows}
    arrivals = df.where("NOT is_departure").orderBy("stop_number").collect()
    assert [r.stop_number for r in arrivals if r.cancelled] == [5]


def test_an_instance_given_twice_gives_its_events_twice(spark):
    one, two = _line(spark, 12, 2).collect(), _line(spark, 12, 2, copies=2).collect()
    assert sorted(map(repr, two)) == sorted([*map(repr, one), *map(repr, one)])


def test_a_timetable_is_pruned_to_the_versions_in_use(spark, tmp_path):
    from punctuo import fixtures as fx
    d = "/root/testdata/sf0.001"
    fx.write_timetables(spark, d, str(tmp_path))
    tables = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("trips", "routes", "agency", "stop_times")}
    versions = fx.timetable_versions(spark, d).drop("k")
    feeds = fx.trip_updates(spark, d).drop("run")
    used = G.versions_in_use(versions, feeds)
    assert sorted(r.gtfs_version for r in used.collect()) == ["gtfs-20240101.zip", "gtfs-20240110.zip"]
    early = feeds.where("feed_ts < '2024-01-05'")
    assert [r.gtfs_version for r in G.versions_in_use(versions, early).collect()] == ["gtfs-20240101.zip"]
    pruned = G.of_versions(tables["stop_times"], G.versions_in_use(versions, early))
    assert pruned.count() == tables["stop_times"].where("gtfs_version = 'gtfs-20240101.zip'").count()
    df = G.versioned_stop_events(early, fx.stop_time_updates(spark, d), versions, tables)
    assert df._jdf.queryExecution().executedPlan().toString().count("dynamicpruning") >= 2
    # with one version valid for all feeds it is the plain chain
    plain = {n: t.where("gtfs_version = 'gtfs-20240101.zip'").drop("gtfs_version") for n, t in tables.items()}
    want = G.stop_events(G.join_timetable(early, plain["trips"], plain["routes"], plain["agency"], plain["stop_times"]),
                         plain["stop_times"], None, fx.stop_time_updates(spark, d))
    assert sorted(map(repr, df.collect())) == sorted(map(repr, want.collect()))
