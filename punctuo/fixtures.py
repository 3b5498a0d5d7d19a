"""Adapter views: the driver's TPC-H-ish tables re-shaped into this engine's inputs.

Each view is deterministic integer arithmetic over the given tables, so it
grows with them (whole tables, no subsets) and an independent SQL engine can
rebuild it row for row (see ``oracle/views.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BASE_TS = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def add_minutes(ts: Column, n: Column) -> Column:
    return F.timestamp_add("MINUTE", n.cast("int"), ts)


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table ``sample`` (one row per observed arrival/departure status)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    base = (li.join(od, li.l_orderkey == od.o_orderkey)
            .groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey")
            .agg(F.min("l_quantity").cast("int").alias("qty")))
    ok, ln, pk, sk, ck = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey"))
    cancelled = (sk % 17 == 0)
    delay = (F.when(cancelled | (pk % 4 == 0), F.lit(None))
             .when(pk % 10 < 8, ((pk * 7 + sk) % 6 - 1))
             .otherwise((pk * 7 + sk) % 221 - 100)).cast("smallint")
    ttl = (F.col("qty") * 9 - 40 + ln).cast("smallint")
    sched = add_minutes(F.lit(BASE_TS).cast("timestamp_ntz"), (ok % 28) * 1440 + (ok * 37) % 1440)
    b2 = base.select("*", sched.alias("scheduled_time"), cancelled.alias("cancelled"),
                     delay.alias("delay_minutes"), ttl.alias("ttl_minutes"))
    return b2.select(
        (((ok * 8 + ln) * 20001 + pk) * 1001 + sk).alias("id"),
        "scheduled_time",
        (pk % 61).cast("smallint").alias("scheduled_duration_minutes"),
        F.when(pk % 4 != 0, pk % 61 + sk % 7 - 3).cast("smallint").alias("projected_duration_minutes"),
        "delay_minutes", "cancelled",
        add_minutes(F.col("scheduled_time"), F.coalesce(F.col("delay_minutes"), F.lit(0)) - F.col("ttl_minutes")).alias("sample_time"),
        "ttl_minutes",
        F.when((ok * 8 + ln) % 211 != 0, F.concat(F.lit("T"), _s(ok))).alias("trip_id"),  # a few rows belong to no stop event
        F.concat(F.lit("L"), _s(ck % 25)).alias("line_name"),
        (ok % 3).cast("smallint").alias("product_type_id"),
        F.concat(F.lit("S"), _s(ck % 40)).alias("station_id"),
        (ck % 4).cast("smallint").alias("operator_id"),
        (ln % 2 == 0).alias("is_departure"),
        F.when(ln >= 5, F.md5(F.concat(F.lit("r"), _s(sk)))).alias("remarks_hash"),
        F.when(sk % 3 != 0, sk % 4).cast("smallint").alias("load_factor_id"),
    )


def remarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remarks dimension, one array of one remark per supplier; 4 in 6 announce a substitute."""
    k = F.col("s_suppkey")
    text = (F.when(k % 6 == 1, "Ersatzfahrt fuer RE 5").when(k % 6 == 2, "ICE 2901 replaces").when(k % 6 == 3, "IC 2950")
            .when(k % 6 == 4, "a substitute runs").otherwise("WLAN"))
    return table(spark, sf_dir, "supplier").select(
        F.md5(F.concat(F.lit("r"), _s(k))).alias("remarks_hash"),
        F.concat(F.lit('[{"type":"'), F.when(k % 2 == 0, "hint").otherwise("status"), F.lit('","code":"'),
                 F.when(k % 6 == 0, "alternative-trip").otherwise("a"), F.lit('","text":"'), text,
                 F.lit('","summary":"'), F.col("s_name"), F.lit('"}]')).alias("remarks"))


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        _s(k).alias("stop_id"), F.col("s_name").alias("stop_name"),
        F.expr("CAST(6 + s_suppkey % 90 * 0.1 AS DOUBLE)").alias("stop_lon"),
        F.expr("CAST(47 + s_suppkey % 70 * 0.1 AS DOUBLE)").alias("stop_lat"),
        F.when(k % 5 != 0, _s(k - k % 5)).alias("parent_station"))


def agency(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    aid = (F.when(k % 6 == 0, F.concat(F.lit("x"), _s(k)))
           .when(k % 6 == 1, _s(k + 30000)).otherwise(_s(k)))
    return n.select(aid.alias("agency_id"), F.col("n_name").alias("agency_name"))


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    a = k % 25
    aid = F.when(a % 6 == 0, F.concat(F.lit("x"), _s(a))).when(a % 6 == 1, _s(a + 30000)).otherwise(_s(a))
    prefix = (F.when(k % 5 == 0, "ICE ").when(k % 5 == 1, "IC ").when(k % 5 == 2, "EC ")
              .when(k % 5 == 3, "S").otherwise("RE "))
    types = [0, 1, 2, 3, 2, 101, 102, 105, 106, 109, 200, 103, 715]
    rt = F.lit(1500)
    for i in reversed(range(len(types))):
        rt = F.when(k % 14 == i, F.lit(types[i])).otherwise(rt)
    return p.select(_s(k).alias("route_id"), aid.alias("agency_id"),
                    F.concat(prefix, _s(k % 90)).alias("route_short_name"), _s(rt).alias("route_type"))


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", _s(F.col("o_orderkey")).alias("trip_id"), _s(F.col("o_custkey")).alias("route_id"),
                    F.concat(F.lit("N"), _s(F.col("o_orderkey") % 997)).alias("trip_short_name"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trips(spark, sf_dir).drop("o_orderkey")


def _stop_times(li: DataFrame) -> DataFrame:
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    g = li.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("sk"), F.max("l_partkey").alias("upd"))
    base = F.lit(18000) + (ok % 20) * 3600 + ln * 600
    return g.select("l_orderkey", _s(ok).alias("trip_id"), ln.alias("stop_sequence"), _s(F.col("sk")).alias("stop_id"),
                    (base - 60).alias("arrival_s"), base.alias("departure_s"), "upd")


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stop_times(table(spark, sf_dir, "lineitem")).drop("l_orderkey")


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Departure delay per (trip, stop), one run per trip (for the documents)."""
    st = stop_times(spark, sf_dir)
    u = F.col("upd")
    return st.where(u % 3 != 0).select(
        "trip_id", "stop_sequence", "stop_id",
        F.when(u % 11 == 0, "SKIPPED").otherwise("SCHEDULED").alias("schedule_relationship"),
        F.when(u % 11 != 0, u % 1500 - 300).alias("departure_delay"))


def stop_time_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop-time updates of every trip instance: by stop id, sequence or both; delays or absolute times.

    Every 37th trip has an update in third place that is for no stop of it, so the pointer stays there.
    """
    runs = trip_updates(spark, sf_dir).select("trip_id", "start_date", "feed_ts", "run")
    j = stop_times(spark, sf_dir).join(runs, "trip_id").withColumn("u", F.col("upd") + F.col("run") * 7)
    u, bogus = F.col("u"), (F.col("trip_id").cast("bigint") % 37 == 0) & (F.col("stop_sequence") == 3)
    off = u % 11 == 0
    at = F.unix_seconds(F.col("feed_ts").cast("timestamp"))
    return j.where((u % 3 != 0) | bogus).select(
        "trip_id", "start_date", "feed_ts", F.col("stop_sequence").alias("position"),
        F.when(bogus, 99).when(u % 4 != 1, F.col("stop_sequence")).alias("stop_sequence"),
        F.when(bogus, "nowhere").when(u % 4 != 2, F.col("stop_id")).alias("stop_id"),
        F.when(off, "SKIPPED").otherwise("SCHEDULED").alias("schedule_relationship"),
        F.when(~off & (u % 6 == 2), u % 900 - 100).alias("arrival_delay"),
        F.when(~off & (u % 6 == 4), at + u % 7200).alias("arrival_time"),
        F.when(~off & (u % 5 != 1), u % 1500 - 300).alias("departure_delay"),
        F.when(~off & (u % 5 == 1), at + u % 7200).alias("departure_time"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    h = F.md5(F.concat(F.lit("e"), _s(F.when(i % 50 == 1, i - i % 3).otherwise(i))))
    t = F.col("event_type")
    typ = (F.when(t == "view", "departures").when(t == "click", "arrivals")
           .when(t == "signup", "trip")
           .when(t == "purchase", F.when(i % 4 == 3, "radar").otherwise("journeys")))
    raw = F.concat(F.lit('{"board":['), F.repeat(F.lit('{"dTimeR":"1"},'), (i % 7).cast("int")), F.lit("{}]}"))
    return e.select("event_id", h.alias("hash"), typ.alias("type"), raw.alias("raw"), "ts")


def raw_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-normalisation samples as extracted from responses (seconds, nullable flags).

    Every ``sample`` row is turned back into what a response carried: delay in
    seconds (with a sub-minute part so rounding matters), projected time,
    an often missing sample time and cancel flag, and the id of the response
    (an ``events`` row) it came in, for the fallback time.
    """
    s = sample(spark, sf_dir)
    events = table(spark, sf_dir, "events")
    i = F.col("id")
    delay_s = F.when(F.col("delay_minutes").isNotNull(), F.col("delay_minutes").cast("int") * 60 + i % 61 - 30)
    r = responses(spark, sf_dir).select(F.col("event_id").alias("response_id"), "hash",
                                        F.col("type").alias("response_type"), F.col("ts").alias("response_ts"))
    raw = s.select(
        i.alias("sample_id"), F.pmod(i, events.select(F.max("event_id") + 1).scalar()).alias("response_id"), "trip_id", "station_id", "is_departure",
        "scheduled_time",
        F.when(delay_s.isNotNull(), F.timestamp_add("SECOND", delay_s, F.col("scheduled_time"))).alias("projected_time"),
        delay_s.alias("delay_seconds"),
        F.when(i % 7 != 0, F.col("cancelled")).alias("cancelled"),
        F.when(i % 13 != 0, F.col("sample_time")).alias("sample_time"),
        "line_name", "product_type_id", "operator_id", "remarks_hash", "load_factor_id",
        "scheduled_duration_minutes", "projected_duration_minutes")
    return raw.join(r, "response_id", "left")


def dimension_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The natural keys of four dimensions as responses carry them, one row per ``sample`` row."""
    s = sample(spark, sf_dir)
    key = lambda p, c: F.concat(F.lit(p), _s(F.col(c)))
    return s.select("id", key("O", "operator_id").alias("operator"), key("Operator ", "operator_id").alias("operator_name"),
                    key("LF", "load_factor_id").alias("load_factor"), key("P", "product_type_id").alias("product_type"),
                    F.when(F.col("id") % 3 == 0, "calculated").when(F.col("id") % 3 == 1, "prognosed").alias("prognosis_type"))


def stored_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What earlier runs stored of them: the keys of samples with small ids in part; every region is an old operator."""
    r = table(spark, sf_dir, "region").select(
        F.lit("operator").alias("dim"), (F.col("r_regionkey") * 3 + 1).cast("int").alias("id"),
        F.concat(F.lit("O"), _s(F.col("r_regionkey") * 2)).alias("key"), F.col("r_name").alias("name"))
    v = dimension_values(spark, sf_dir)
    old = v.where("product_type = 'P1'").select(F.lit("product_type").alias("dim"), F.lit(5).cast("int").alias("id"),
                                               F.col("product_type").alias("key"), F.lit(None).cast("string").alias("name")).distinct()
    return r.unionByName(old)


def _hms(sec: Column) -> Column:
    """Seconds after service-day start as GTFS ``HH:MM:SS`` text (hour may exceed 23)."""
    return F.concat_ws(":", F.lpad(_s(F.floor(sec / 3600)), 2, "0"), F.lpad(_s(F.floor(sec % 3600 / 60)), 2, "0"),
                       F.lpad(_s(sec % 60), 2, "0"))


def gtfs_stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``stop_times`` as a GTFS file carries it: times as text."""
    st = stop_times(spark, sf_dir)
    return st.select("trip_id", "stop_sequence", "stop_id", _hms(F.col("arrival_s")).alias("arrival_time"),
                     _hms(F.col("departure_s")).alias("departure_time"))


def trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GTFS-RT TripUpdates of every order: optional start time, relationship, feed time.

    ``run`` 0 is the order's day; a third of the trips runs the next day too (1), and a fifth is in a
    second feed an hour later (2).
    """
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    runs = F.filter(F.array(F.lit(0), F.when(k % 3 == 0, 1), F.when(k % 5 == 0, 2)), lambda r: r.isNotNull())
    o = o.select("o_orderkey", F.explode(runs).alias("run"))
    day = F.timestamp_add("DAY", (k % 28 + (F.col("run") == 1).cast("int")).cast("int"), F.lit(BASE_TS).cast("timestamp_ntz"))
    rel = F.when(k % 23 == 0, "CANCELED").when(k % 29 == 0, "ADDED").otherwise("SCHEDULED")
    return o.select(
        _s(k).alias("trip_id"), F.date_format(day, "yyyyMMdd").alias("start_date"),
        F.when(k % 7 == 0, F.lit("06:00:00")).alias("start_time"), rel.alias("trip_schedule_relationship"),
        F.timestamp_add("SECOND", ((k % 20) * 3600 + 14400 + (F.col("run") == 2).cast("int") * 3600).cast("int"), day)
        .alias("feed_ts"), "run")


def feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed snapshot files: one per ``events`` row, named by time order."""
    e = table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("feeds/"), F.date_format("ts", "yyyyMMdd'T'HHmmss.SSSSSS"), F.lit("-"),
                             _s(F.col("event_id")), F.lit(".pb")).alias("path"),
                    F.col("ts").alias("mtime"), "event_id")


def gtfs_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timetable versions: one per calendar day seen in ``events``, published at a varying hour."""
    e = table(spark, sf_dir, "events")
    d = F.date_trunc("day", "ts").cast("timestamp_ntz")
    days = e.select(d.alias("d")).distinct()
    return days.select(F.concat(F.lit("gtfs-"), F.date_format("d", "yyyyMMdd"), F.lit(".zip")).alias("version"),
                       F.timestamp_add("HOUR", (F.dayofmonth("d") % 5 * 5).cast("int"), F.col("d")).alias("mtime"))


def timetable_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of the timetable versions: published on the 1st, 10th and 20th; ``k`` is their number."""
    v = gtfs_versions(spark, sf_dir).withColumn("k", F.element_at(F.create_map(
        F.lit("01"), F.lit(0), F.lit("10"), F.lit(1), F.lit("20"), F.lit(2)), F.substring("version", 12, 2)))
    return v.where(F.col("k").isNotNull())


def write_timetables(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The timetable in each of three versions, a folder for each version of a table.

    The second runs 5 minutes later than the first, skips fifth stops and names trips otherwise; the third 10 minutes later.
    """
    v = timetable_versions(spark, sf_dir).select(F.col("version").alias("gtfs_version"), "k")
    later = 300 * F.col("k")
    st = stop_times(spark, sf_dir).join(F.broadcast(v)).where("k <> 1 OR stop_sequence <> 5").select(
        "gtfs_version", "trip_id", "stop_sequence", "stop_id", _hms(F.col("arrival_s") + later).alias("arrival_time"),
        _hms(F.col("departure_s") + later).alias("departure_time"))
    tr = trips(spark, sf_dir).join(F.broadcast(v)).select("gtfs_version", "trip_id", "route_id", F.when(
        F.col("k") == 1, F.concat(F.lit("M"), F.col("trip_short_name"))).otherwise(F.col("trip_short_name")).alias("trip_short_name"))
    tables = {"stop_times": st, "trips": tr, "routes": routes(spark, sf_dir).join(F.broadcast(v.drop("k"))),
              "agency": agency(spark, sf_dir).join(F.broadcast(v.drop("k")))}
    for name, df in tables.items():  # each task writes a file for each version; dealt out by version, three tasks would write all
        df.write.partitionBy("gtfs_version").parquet(f"{path}/{name}")


def write_gtfs_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """GTFS text files: byte order marks, further columns, and for every 7th route an older row with the same id before it."""
    rt = routes(spark, sf_dir).withColumn("route_desc", F.lit('a "quoted", text'))
    old = rt.where("CAST(route_id AS INT) % 7 = 0").withColumn("route_short_name", F.concat(F.lit("old "), F.col("route_short_name")))
    tables = {"agency": agency(spark, sf_dir), "routes": old.coalesce(1).union(rt.coalesce(1)), "trips": trips(spark, sf_dir),
              "stops": stops(spark, sf_dir), "stop_times": gtfs_stop_times(spark, sf_dir)}
    for name, df in tables.items():
        marked = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
        marked.write.option("header", True).option("escape", '"').csv(f"{path}/{name}.txt")


def official_station_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official station list as read from its ``;`` CSV: text columns, decimal commas."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    lon = F.expr("CAST(6 + s_suppkey % 90 * 0.1 + (s_suppkey % 3) * 0.003 AS DOUBLE)")
    lat = F.expr("CAST(47 + s_suppkey % 70 * 0.1 AS DOUBLE)")
    return s.select(
        _s(F.when(k % 9 == 0, k + 100000).otherwise(k)).alias("EVA_NR"),
        F.concat(F.lit("de:"), _s(k)).alias("IFOPT"), F.concat(F.lit("Official "), F.col("s_name")).alias("NAME"),
        F.regexp_replace(_s(lon), r"\.", ",").alias("Laenge"),
        F.when(k % 11 != 0, F.regexp_replace(_s(lat), r"\.", ",")).alias("Breite"))


OFFICIAL_AREAS = ["db-total", "db-fernverkehr", "db-regio"]


def official_punctuality_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official punctuality figures in the published wide layout (year, area, threshold, 12 months, avg)."""
    o = table(spark, sf_dir, "orders")
    area = (F.when(F.col("o_custkey") % 3 == 0, OFFICIAL_AREAS[0]).when(F.col("o_custkey") % 3 == 1, OFFICIAL_AREAS[1])
            .otherwise(OFFICIAL_AREAS[2]))
    g = o.groupBy((F.year("o_orderdate") + 29).alias("JAHR"), area.alias("BEREICH"),
                  F.when(F.col("o_orderkey") % 2 == 0, 5).otherwise(15).alias("threshold"),
                  F.month("o_orderdate").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    g = g.withColumn("v", F.when((F.col("JAHR") + F.col("m")) % 7 != 0, (F.col("n") % 1000) / F.lit(10.0)))
    w = g.groupBy("JAHR", "BEREICH", "threshold").pivot("m", list(range(1, 13))).agg(F.first("v"))
    months = [F.col(str(m)) for m in range(1, 13)]
    avg = F.aggregate(F.array(*months), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    cnt = F.size(F.filter(F.array(*months), lambda x: x.isNotNull()))
    return w.select(F.col("JAHR"), F.col("BEREICH"), F.col("threshold").alias("< VERSPÄTUNG"),
                    *[F.col(str(m)).alias(str(m)) for m in range(1, 13)],
                    F.when(cnt > 0, avg / cnt).alias("AVG JAHR"))


def official_operator_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """category -> operator id text, over the operators present in ``sample``."""
    ops = sample(spark, sf_dir).select(_s(F.col("operator_id")).alias("operator")).distinct()
    cat = (F.when(F.col("operator").isin("0", "1"), OFFICIAL_AREAS[1]).otherwise(OFFICIAL_AREAS[2]))
    return ops.select(cat.alias("category"), "operator").unionByName(
        ops.select(F.lit(OFFICIAL_AREAS[0]).alias("category"), "operator"))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _fptf_stop(p: Column) -> Column:
    """The FPTF stop of a narrow one (``stop_id, stop_name, stop_lon, stop_lat, parent_station``)."""
    loc = F.struct(F.lit("location").alias("type"), p["stop_id"].alias("id"),
                   p["stop_lat"].alias("latitude"), p["stop_lon"].alias("longitude"))
    parent = F.when(p["parent_station"].isNotNull(), F.struct(
        F.lit("station").alias("type"), p["parent_station"].alias("id"),
        F.concat(F.lit("Station "), p["parent_station"]).alias("name"), loc.alias("location")))
    return F.struct(F.lit("stop").alias("type"), p["stop_id"].alias("id"), p["stop_name"].alias("name"),
                    loc.alias("location"), parent.alias("station"),
                    F.when(p["stop_id"].cast("int") % 4 == 0, F.lit("low-to-medium")).alias("loadFactor"))


def _fptf_line(n: Column) -> Column:
    return F.struct(F.lit("line").alias("type"), n["route_id"].alias("id"),
                    n["trip_short_name"].alias("fahrtNr"), n["route_short_name"].alias("name"),
                    F.lit("regional").alias("product"), n["route_type"].alias("productName"),
                    F.struct(F.lit("operator").alias("type"), n["agency_id"].alias("id"),
                             n["agency_name"].alias("name")).alias("operator"))


def _trip_day(k: Column) -> Column:
    return F.timestamp_add("DAY", (k % 28).cast("int"), F.lit(BASE_TS).cast("timestamp_ntz"))


def _fptf_stopover(c: Column, day: Column) -> Column:
    """The FPTF stopover of a narrow call (``stop_sequence, arrival_s, departure_s, delay, p``)."""
    pd = F.timestamp_add("SECOND", c["departure_s"].cast("int"), day)
    pa = F.timestamp_add("SECOND", c["arrival_s"].cast("int"), day)
    return F.struct(
        _fptf_stop(c["p"]).alias("stop"), _iso(pa).alias("plannedArrival"), F.lit(None).cast("string").alias("arrival"),
        F.lit(None).cast("int").alias("arrivalDelay"), _iso(pd).alias("plannedDeparture"),
        F.when(c["delay"].isNotNull(), _iso(F.timestamp_add("SECOND", c["delay"], pd))).alias("departure"),
        c["delay"].alias("departureDelay"), (c["stop_sequence"] == 7).alias("cancelled"),
        F.when(c["stop_sequence"] % 4 == 2, F.lit("low")).alias("loadFactor"))


def _trip_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each trip with a line: ``l_orderkey``, its line ``n`` and its calls ``c`` in order, both narrow.

    The line items are dealt out once, by order; all that follows for a trip is done where they lie.
    """
    st = _stop_times(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
                     .where(F.col("l_orderkey").isNotNull()).repartition("l_orderkey"))
    u = F.col("upd")
    delay = F.when((u % 3 != 0) & (u % 11 != 0) & F.col("stop_sequence").isNotNull(), u % 1500 - 300).cast("int")
    sp = stops(spark, sf_dir)
    ev = st.join(sp.select("stop_id", F.struct(*sp.columns).alias("p")), "stop_id")
    calls = ev.withColumn("delay", delay).groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("stop_sequence", "arrival_s", "departure_s", "delay", "p"))).alias("c"),
        F.min_by("departure_s", "stop_sequence").alias("first_s"))
    n = F.struct("route_id", "trip_short_name", "route_short_name", "route_type", "agency_id", "agency_name")
    lines = (_trips(spark, sf_dir).join(routes(spark, sf_dir), "route_id").join(agency(spark, sf_dir), "agency_id")
             .select("o_orderkey", n.alias("n")))
    return calls.join(lines, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def fptf_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FPTF response documents (one JSON text per row) built from the timetable tables.

    trip_id % 4 picks the document type of each trip (trip, journeys,
    refreshJourney, radar); departure/arrival boards are built per (stop, day,
    hour) so a board stays bounded; ``locations`` per parent station.

    Only narrow calls, stops and lines are dealt out, by trip and then by board; a document's nested objects are put
    together row by row behind the last shuffle.
    """
    sp = stops(spark, sf_dir)
    trip_calls = _trip_calls(spark, sf_dir)
    kk = F.col("l_orderkey")
    per_trip = trip_calls.select(
        "l_orderkey", _s(kk).alias("trip_id"), _fptf_line(F.col("n")).alias("line"), _trip_day(kk).alias("_day"),
        F.timestamp_add("SECOND", F.col("first_s").cast("int"), _trip_day(kk)).alias("_pd"),
        F.transform("c", lambda c: _fptf_stopover(c, _trip_day(kk))).alias("sos"))
    first, last = F.col("sos")[0], F.element_at(F.col("sos"), -1)
    remarks = F.when(kk % 5 == 0, F.array(F.struct(F.lit("hint").alias("type"), F.lit("bicycle").alias("code"),
                                                   F.lit("Bicycles allowed").alias("text"))))
    # every third trip has an alternative ten minutes later, half of them without a stop of their own
    after = lambda s: F.timestamp_add("SECOND", F.lit(s), F.col("_pd"))
    other = F.when(kk % 3 == 0, F.array(F.struct(
        F.concat(F.lit("alt"), F.col("trip_id")).alias("tripId"), F.when(kk % 2 == 1, first["stop"]).alias("stop"),
        first["stop"].alias("origin"), last["stop"].alias("destination"), F.col("line"),
        F.when(kk % 5 == 0, _iso(after(900))).alias("when"), _iso(after(600)).alias("plannedWhen"), F.when(kk % 5 == 0, 300).alias("delay"),
        (kk % 7 == 0).alias("cancelled"), F.lit("high").alias("loadFactor"), F.array(last).alias("nextStopovers"))))
    trip = F.struct(
        F.col("trip_id").alias("id"), first["stop"].alias("origin"), last["stop"].alias("destination"),
        F.col("line"), remarks.alias("remarks"), (kk % 23 == 0).alias("cancelled"),
        first["plannedDeparture"].alias("plannedDeparture"), first["departure"].alias("departure"),
        first["departureDelay"].alias("departureDelay"), last["plannedArrival"].alias("plannedArrival"),
        last["arrival"].alias("arrival"), last["arrivalDelay"].alias("arrivalDelay"),
        F.slice(F.col("sos"), F.lit(2), F.size("sos")).alias("stopovers"), other.alias("alternatives"))
    rt_s = F.unix_timestamp(F.timestamp_add("HOUR", F.lit(4), F.col("_day")).cast("timestamp"))
    walking = F.struct(F.lit(True).alias("walking"), last["stop"].alias("origin"), last["stop"].alias("destination"))
    leg = trip.withField("walking", F.lit(False))
    kind = kk % 4
    doc = (F.when(kind == 0, F.to_json(F.struct(trip.alias("trip"), rt_s.alias("realtimeDataUpdatedAt"))))
           .when(kind == 1, F.concat(F.lit('{"journeys":[{"legs":['), F.to_json(leg), F.lit(","),
                                     F.to_json(walking), F.lit(']}],"realtimeDataFrom":'), _s(rt_s), F.lit("}")))
           .when(kind == 2, F.to_json(F.struct(F.struct(F.array(leg).alias("legs")).alias("journey"),
                                               rt_s.alias("realtimeDataUpdatedAt"))))
           .otherwise(F.to_json(F.struct(F.array(F.struct(
               F.col("trip_id").alias("tripId"), F.col("line"), F.col("sos").alias("nextStopovers")))
               .alias("movements"), rt_s.alias("realtimeDataUpdatedAt")))))
    typ = (F.when(kind == 0, "trip").when(kind == 1, "journeys").when(kind == 2, "refreshJourney")
           .otherwise("radar"))
    trip_docs = per_trip.select(F.concat(F.lit("t"), F.col("trip_id")).alias("response_key"), typ.alias("type"),
                                doc.alias("doc"))
    # along a trip, a stop of every third number shows the call before it, another one the call behind it
    shown = F.transform("c", lambda c, i: F.struct(
        c.alias("x"), F.when(c["stop_sequence"] % 3 == 2, F.get(F.col("c"), i - 1)).alias("before"),
        F.when(c["stop_sequence"] % 3 == 1, F.get(F.col("c"), i + 1)).alias("behind")))
    ev = trip_calls.select("l_orderkey", "n", F.explode(shown).alias("e"))
    # a call is dealt out once for both boards of its stop and hour, twice only where it arrives and leaves in different hours
    forms = {"departures": ("departure_s", 1), "arrivals": ("arrival_s", 2)}
    at = lambda x, k, field: F.timestamp_add("SECOND", x[field].cast("int"), _trip_day(k))
    dep, arr = [F.date_trunc("hour", at(F.col("e.x"), kk, field)) for field, _ in forms.values()]
    hour = lambda h, of: F.struct(h.alias("_h"), F.lit(of).alias("of"))
    hours = F.when(dep.eqNullSafe(arr), F.array(hour(dep, 3))).otherwise(F.array(hour(dep, 1), hour(arr, 2)))
    b = ev.select("l_orderkey", "n", "e", F.explode_outer(hours).alias("w")).select(
        F.col("e.x.p.stop_id").alias("stop_id"), "w._h", F.struct(kk.alias("k"), "n", "w.of", "e").alias("b"))
    g = b.groupBy("stop_id", "_h").agg(F.collect_list("b").alias("l"), F.bit_or("b.of").alias("of"))
    boards = []
    for name, (field, bit) in forms.items():
        def alt(b: Column) -> Column:
            x, delay, day, t = b["e"]["x"], b["e"]["x"]["delay"], _trip_day(b["k"]), at(b["e"]["x"], b["k"], field)
            third = lambda r: x["stop_sequence"] % 3 == r
            over = lambda c: F.when(c.isNotNull(), F.array(_fptf_stopover(c, day)))
            return F.struct(
                _s(b["k"]).alias("tripId"), _fptf_stop(x["p"]).alias("stop"), _fptf_line(b["n"]).alias("line"),
                F.when(third(0), _iso(F.timestamp_add("SECOND", F.coalesce(delay, F.lit(0)), t))).alias("when"),
                _iso(t).alias("plannedWhen"), F.when(third(0), delay).alias("delay"),
                F.lit(False).alias("cancelled"), F.when(x["stop_sequence"] % 5 == 0, F.lit("full")).alias("loadFactor"),
                over(b["e"]["before"]).alias("previousStopovers"), over(b["e"]["behind"]).alias("nextStopovers"))

        own = F.filter("l", lambda b: b["of"].bitwiseAND(F.lit(bit)) != 0)
        d = g.where(F.col("of").bitwiseAND(F.lit(bit)) != 0).select("stop_id", "_h", F.array_sort(
            F.transform(own, lambda b: F.struct(_s(b["k"]).alias("trip_id"), alt(b).alias("a")))).alias("l"))
        alts = F.transform("l", lambda x: x["a"])
        obj_form = F.to_json(F.struct(alts.alias(name), F.unix_timestamp(F.col("_h").cast("timestamp"))
                                      .alias("realtimeDataUpdatedAt")))
        arr_form = F.to_json(alts)
        doc = F.when(F.col("stop_id").cast("int") % 2 == 0, obj_form).otherwise(arr_form)
        boards.append(d.select(F.concat(F.lit(name[0]), F.col("stop_id"), F.lit("@"),
                                        F.date_format("_h", "yyyyMMddHH")).alias("response_key"),
                               F.lit(name).alias("type"), doc.alias("doc")))
    stops_s = sp.select("stop_id", _fptf_stop(F.struct(*sp.columns)).alias("stop"))
    lg = sp.join(stops_s, "stop_id").groupBy(F.coalesce("parent_station", "stop_id").alias("p")).agg(
        F.array_sort(F.collect_list(F.struct("stop_id", "stop"))).alias("l"))
    locs = lg.select(F.concat(F.lit("l"), F.col("p")).alias("response_key"), F.lit("locations").alias("type"),
                     F.to_json(F.transform("l", lambda x: x["stop"])).alias("doc"))
    return trip_docs.unionByName(boards[0]).unionByName(boards[1]).unionByName(locs)


def fptf_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as responses: boards came half an hour after their hour began, of others the time isn't known."""
    d = fptf_documents(spark, sf_dir)
    hour = F.try_to_timestamp(F.split("response_key", "@").getItem(1), F.lit("yyyyMMddHH")).cast("timestamp_ntz")
    return d.select(F.col("response_key").alias("response_id"), "type", "doc", F.when(F.contains("response_key", F.lit("@")),
                    add_minutes(hour, F.lit(30))).alias("response_ts"), F.lit("fixture").alias("source"))


def _hafas_inner(e: Column, i: Column) -> Column:
    et = F.col("event_type")
    meth = (F.when(et.isin("view", "click"), "StationBoard").when(et == "signup", "JourneyDetails")
            .when(et == "purchase", "TripSearch").when(i % 3 == 0, "JourneyGeoPos").when(i % 3 == 1, "LocMatch")
            .otherwise("Unknown"))
    rtype = F.when(et == "click", "ARR").otherwise("DEP")
    jny = F.concat(F.repeat(F.lit('{"stbStop":{"dTimeR":"120000"}},'), (i % 4).cast("int")), F.lit("{}"))
    return F.concat(F.lit('{"svcResL":[{"meth":"'), meth, F.lit('","res":{"type":"'), rtype,
                    F.lit('","jnyL":['), jny, F.lit("]}}]}"))


def hafas_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HAFAS log lines (one per ``events`` row) in the three envelope forms plus junk."""
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    inner = _hafas_inner(e, i)
    esc = F.replace(inner, F.lit('"'), F.lit('\\"'))
    line = (F.when(i % 5 == 0, F.concat(F.lit('[0,"res","'), esc, F.lit('"]')))
            .when(i % 5 == 1, F.concat(F.lit('{"log":"'), esc, F.lit('"}')))
            .when(i % 5 == 2, inner).when(i % 5 == 3, F.lit('{"other":1}')).otherwise(F.lit("not json")))
    return e.select("event_id", line.alias("value"))


def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access-log header lines (one per ``events`` row)."""
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    path = (F.when(et == "view", "departures").when(et == "click", "arrivals").when(et == "signup", "trips")
            .when(et == "purchase", "journeys").otherwise("radar"))
    status = F.when(F.col("event_id") % 9 == 0, "404").otherwise("200")
    line = F.concat(F.lit("["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "GET /'), path,
                    F.lit('?id='), _s(F.col("user_id")), F.lit(' HTTP/1.1" '), status, F.lit(" 1234"))
    return e.select("event_id", line.alias("value"))


def _gzipped(batches):
    import gzip

    import pyarrow as pa
    for b in batches:
        out = [h.encode() + b"\n" + (b"not gzipped" if i % 50 == 7 else gzip.compress(t.encode(), mtime=0))
               for i, h, t in zip(*(b.column(c).to_pylist() for c in ("event_id", "header", "body")))]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["entry"])


def write_access_logs(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Access logs with gzipped JSON bodies (one entry per ``events`` row, every 50th body broken)."""
    e = access_log_lines(spark, sf_dir).join(table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id")
    header = F.regexp_replace("value", '" 404 ', '" 200 ')
    body = F.concat(F.lit('{"departures":[{"delay":'), _s(F.col("user_id")), F.lit("}],\n\"id\":"), _s(F.col("event_id")), F.lit("}"))
    logs = e.select("event_id", header.alias("header"), body.alias("body")).mapInArrow(_gzipped, "entry binary")
    logs.select(F.col("entry").cast("string").alias("value")).write.text(path)
