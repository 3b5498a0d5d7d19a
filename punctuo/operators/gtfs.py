"""GTFS timetable x GTFS-RT trip updates -> samples.

Plan shape (scale notes):

* Static GTFS dimensions (agency, routes, stops) are small per feed version;
  trips and stop_times are the large side. The trip-update snapshot joins
  trips -> routes -> agency on natural ids; stop_times join by trip_id (the
  one big shuffle). AQE turns the dimension joins into broadcasts from their
  runtime size; nothing is force-broadcast without a bound.
* Per trip instance (trip, start date, feed time) matching and fills (delay, cancel flag, durations) walk the
  ordered arrays of stops and updates; no window, and no key but the trip and the instance is shuffled.
* Random choices of the reference (offline sample time, bus thinning) are
  replaced by seeded MD5 fractions, so reruns and retries of a lost
  task give identical rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.buckets import js_round
from .dims import numbered

# --- fixed values --------------------------------------------------------------
OFFLINE_SAMPLES_PER_TRIP = 1
OFFLINE_MAX_HOURS = 10
BUS_SAMPLING_FRACTION = 0.1
FEED_FILE_SAMPLING = 3
VERSION_SWITCH_HOUR = 14          # a version is valid until 14:00 local on the next version's file date
OPERATOR_ID_LIMIT = 30000
OTHER_OPERATOR = (0, "0", "Other")
# ---------------------------------------------------------------------------------


def product_type(route_type: Column, short_name: Column) -> Column:
    """GTFS route type (+ short name prefix) -> product id; rule order matters."""
    i = _leading_int(route_type.cast("string"))
    name = F.coalesce(short_name, F.lit(""))

    def between(lo, hi):
        return (i >= lo) & (i < hi)

    return (F.when((i == 3) | between(700, 800), 700)
            .when(between(200, 300), 200)
            .when((i == 1) | between(400, 500), 400)
            .when((i == 0) | between(900, 1000), 900)
            .when(((i == 2) & name.startswith("ICE")) | (i == 101), 101)
            .when((i == 2) & (name.startswith("IC") | name.startswith("EC")), 102)
            .when((i == 102) | (i == 105), 102)
            .when(((i == 2) & name.startswith("S")) | between(109, 110), 109)
            .when(between(100, 104), 100)
            .when((i == 2) | between(104, 109), 104)
            .otherwise(1000)).cast("int")


def _leading_int(s: Column) -> Column:
    """JS parseInt: leading (signed) integer of a string, NULL if none."""
    digits = F.regexp_extract(s, r"^\s*([+-]?\d+)", 1)
    return F.when(digits != "", digits.cast("bigint"))


def gtfs_seconds(hms: Column) -> Column:
    """``HH:MM:SS`` (hours may exceed 23) -> seconds after service-day start."""
    p = F.split(hms, ":")
    return ((p.getItem(0).cast("int") * 60 + p.getItem(1).cast("int")) * 60 + p.getItem(2).cast("int"))


def service_start(start_date: Column, start_time: Column, first_departure_s: Column, tz: str = "UTC") -> Column:
    """Local noon of the start date (+ rounded hour shift of startTime) minus 12 h."""
    st = F.coalesce(gtfs_seconds(start_time), first_departure_s)
    shift_h = js_round((st - first_departure_s) / F.lit(3600.0)).cast("int")
    y = F.substring(start_date, 1, 4).cast("int")
    m = F.substring(start_date, 5, 2).cast("int")
    d = F.substring(start_date, 7, 2).cast("int")
    noon = F.timestamp_add("HOUR", shift_h, F.make_timestamp_ntz(y, m, d, F.lit(12), F.lit(0), F.lit(0)))
    if tz.upper() != "UTC":
        noon = F.to_utc_timestamp(noon.cast("timestamp"), tz).cast("timestamp_ntz")
    return F.timestamp_add("HOUR", F.lit(-12), noon)


def operators(agency: DataFrame) -> DataFrame:
    """Agencies -> operators (leading integer id, invalid or > 30000 -> 0) + 'Other'."""
    oid = _leading_int(F.col("agency_id"))
    oid = F.when(oid.isNull() | (oid > OPERATOR_ID_LIMIT), 0).otherwise(oid).cast("int")
    a = agency.select(oid.alias("operator_id"), F.col("agency_id").alias("id"), F.col("agency_name").alias("name"))
    other = agency.sparkSession.createDataFrame([OTHER_OPERATOR], "operator_id int, id string, name string")
    return a.where(F.col("operator_id") != 0).unionByName(other)


def agency_operator(agency: DataFrame) -> DataFrame:
    oid = _leading_int(F.col("agency_id"))
    oid = F.when(oid.isNull() | (oid > OPERATOR_ID_LIMIT), 0).otherwise(oid).cast("int")
    return agency.select(*_keys("agency_id", agency), oid.alias("operator_id"))


def stations(stops: DataFrame) -> DataFrame:
    """Stops -> stations, empty parent -> NULL."""
    parent = F.when(F.coalesce(F.col("parent_station"), F.lit("")) != "", F.col("parent_station"))
    return stops.select(F.col("stop_id").alias("station_id"), F.col("stop_name").alias("name"),
                        F.struct(F.col("stop_lon").cast("double").alias("lon"),
                                 F.col("stop_lat").cast("double").alias("lat")).alias("lonlat"),
                        parent.alias("parent"))


def _keys(name: str, *tables: DataFrame) -> list[str]:
    """Join key: ``name``, and the timetable version where all tables carry one."""
    return ([VERSION] if all(VERSION in t.columns for t in tables) else []) + [name]


def join_timetable(tu: DataFrame, trips: DataFrame, routes: DataFrame, agency: DataFrame,
                   stop_times: DataFrame) -> DataFrame:
    """G1 + G2: updates of known trips with stop times, relationship SCHEDULED or CANCELED.

    One row per trip instance with route, operator and product attributes. With ``gtfs_version`` columns
    every join stays inside the version that is valid at the feed's time.
    """
    ok = tu.where(F.col("trip_schedule_relationship").isin("SCHEDULED", "CANCELED"))
    has_stops = stop_times.select(*_keys("trip_id", stop_times, tu)).distinct()
    v = [VERSION] if VERSION in routes.columns else []
    ag = agency_operator(agency)
    r = routes.join(ag, _keys("agency_id", routes, ag), "inner").select(
        *v, "route_id", "operator_id", F.col("route_short_name").alias("line_name"),
        F.col("route_type").alias("product_name"),
        product_type(F.col("route_type"), F.col("route_short_name")).alias("product_type_id"))
    t = trips.select(*_keys("trip_id", trips), "route_id", F.col("trip_short_name").alias("line_fahrtnr"))
    return (ok.join(t, _keys("trip_id", ok, t)).join(r, _keys("route_id", t, r))
            .join(has_stops, _keys("trip_id", ok, has_stops), "left_semi"))


def bus_thinning(df: DataFrame, fraction: float = BUS_SAMPLING_FRACTION, seed: int = 42) -> DataFrame:
    """Keep a seeded ``fraction`` of bus (700) trip instances, all others."""
    return df.where((F.col("product_type_id") != 700) | (_fraction(seed, "trip_id", "start_date") < F.lit(fraction)))


def _fraction(seed: int, *cols: str) -> Column:
    """A number in [0, 1) from the MD5 of the columns' text, the same in every run and retry."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("double") / F.lit(float(16 ** 7))


INSTANCE = ["trip_id", "start_date", "feed_ts"]
VERSION = "gtfs_version"


def _walk(stops: Column, updates: Column) -> Column:
    """G7 along a trip: for each stop the place of its update, as text (empty: it has none).

    A forward pointer into the updates moves on when the next update is for the stop (by stop id or sequence);
    while it hasn't moved, the first update may match. The fold carries the pointer and one text, which grows by
    a few bytes a stop (an array would be copied object by object), so the work is linear in the stops.
    """
    def matches(u: Column, s: Column) -> Column:
        return F.coalesce(u["stop_id"] == s["stop_id"], F.lit(False)) | F.coalesce(u["seq"] == s["seq"], F.lit(False))

    def step(acc: Column, s: Column) -> Column:
        on = matches(F.get(updates, acc["at"] + 1), s)
        first = (acc["at"] == 0) & matches(F.get(updates, F.lit(0)), s)
        moved = F.when(on, acc["at"] + 1).otherwise(acc["at"])
        return F.struct(moved.alias("at"), F.concat(acc["out"], F.when(on | first, moved.cast("string")).otherwise(""),
                                                    F.lit(",")).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.split(F.aggregate(stops, start, step, lambda acc: acc["out"]), ",")


def stop_events(instances: DataFrame, stop_times: DataFrame, stops: DataFrame | None, updates: DataFrame | None,
                tz: str = "UTC", sample_time: Column | None = None) -> DataFrame:
    """One sample row per arrival (not at the first stop) and departure (not at the last stop).

    Stop times become one ordered array per (version,) trip, updates one per trip instance (trip, start date,
    feed time; order ``position``), each once; an instance meets both in one join each, where ``_walk`` matches them.
    Then each event is a row, and what is carried along a trip (cancel flag, delay) or looked up ahead (durations)
    are windows over the instance, which is how the rows are already dealt out. ``updates`` carries
    ``trip_id, start_date, feed_ts, position, stop_sequence, stop_id, schedule_relationship`` and any of
    ``arrival_delay, arrival_time, departure_delay, departure_time`` (times in epoch seconds, used where there
    is no delay). ``None`` = no realtime at all (offline samples). ``stops`` restricts to known stop ids.
    An instance that is in a feed twice gives its events twice.
    """
    st = stop_times.select(*_keys("trip_id", stop_times), F.struct(
        F.col("stop_sequence").cast("bigint").alias("seq"), "stop_id", gtfs_seconds(F.col("arrival_time")).alias("arr_s"),
        gtfs_seconds(F.col("departure_time")).alias("dep_s")).alias("s"))
    keys = _keys("trip_id", st, instances)
    j = instances.join(st.groupBy(*keys).agg(F.array_sort(F.collect_list("s")).alias("_stops")), keys)
    kind = "array<struct<position:bigint,stop_id:string,seq:bigint,rel:string,ad:bigint,at:bigint,dd:bigint,dt:bigint>>"
    if updates is not None:
        def own(c: str, kind_: str = "bigint") -> Column:
            return (F.col(c) if c in updates.columns else F.lit(None)).cast(kind_)
        u = updates.select(*INSTANCE, F.struct(
            own("position").alias("position"), own("stop_id", "string").alias("stop_id"), own("stop_sequence").alias("seq"),
            own("schedule_relationship", "string").alias("rel"), own("arrival_delay").alias("ad"), own("arrival_time").alias("at"),
            own("departure_delay").alias("dd"), own("departure_time").alias("dt")).alias("u"))
        j = j.join(u.groupBy(*INSTANCE).agg(F.array_sort(F.collect_list("u")).cast(kind).alias("_updates")), INSTANCE, "left")
    else:
        j = j.withColumn("_updates", F.lit(None).cast(kind))
    # the number only tells instances with equal keys apart, which share a task from the next shuffle on
    j = j.withColumns({"_copy": F.monotonically_increasing_id(), "_updates": F.coalesce("_updates", F.array().cast(kind))})
    first_dep = F.get("_stops", F.lit(0))["dep_s"]
    origin = F.unix_seconds(service_start(F.col("start_date"), F.col("start_time"), first_dep, tz).cast("timestamp"))

    def call(x: Column, i: Column) -> Column:
        place = x["_at"]
        return F.struct(i.alias("i"), x["_stops"].alias("s"), (place != "").alias("has"),
                        F.get(F.col("_updates"), F.when(place != "", place.cast("int"))).alias("u"))

    calls = F.transform(F.arrays_zip("_stops", _walk(F.col("_stops"), F.col("_updates")).alias("_at")), call)
    # outer: for an inner one Spark infers a filter on the array's size, and copies the walk into it
    e = j.select(*instances.columns, "_copy", origin.alias("_origin"), (F.size("_stops") - 1).alias("_last"), F.explode_outer(calls).alias("_c"))
    c = F.col("_c")
    arrives = (c["i"] > 0) & c["s"]["arr_s"].isNotNull()
    departs = (c["i"] < F.col("_last")) & c["s"]["dep_s"].isNotNull()
    # arrival and departure where they are; where neither is, one that only carries the cancel flag on
    both = F.array(*[F.struct(
        (2 * c["i"] + int(dep)).alias("k"), c["s"]["stop_id"].alias("stop_id"), c["s"]["seq"].alias("seq"), F.lit(dep).alias("dep"),
        F.when(c["has"], F.coalesce(c["u"]["rel"] == "SKIPPED", F.lit(False))).alias("off"), c["s"]["dep_s" if dep else "arr_s"].alias("sec"),
        c["u"]["dd" if dep else "ad"].alias("delay"), c["u"]["dt" if dep else "at"].alias("time"), there.alias("there"),
        (there | (~other & F.lit(dep))).alias("kept")) for dep, there, other in ((False, arrives, departs), (True, departs, arrives))])
    e = e.where(c["s"].isNotNull()).select(*instances.columns, "_copy", "_origin", F.explode(both).alias("_e")).where("_e.kept")
    e = e.withColumn("_k", F.col("_e.k"))  # a plain column: the windows below share one sort
    along = Window.partitionBy(*INSTANCE, "_copy").orderBy("_k")
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    off = F.coalesce(F.last("_e.off", ignorenulls=True).over(so_far), F.lit(False))  # G8: a stop without update inherits
    e = e.withColumn("_off", F.when(F.col("trip_schedule_relationship") == "CANCELED", F.lit(True)).otherwise(off))
    sched = F.col("_origin") + F.col("_e.sec")
    e = e.filter("_e.there").withColumn("_sched", sched)
    e = e.withColumn("_delay", F.last(F.coalesce("_e.delay", F.col("_e.time") - F.col("_sched")), ignorenulls=True).over(so_far))  # G6
    e = e.withColumns({"_sched_next": F.lead("_sched").over(along), "_delay_next": F.lead("_delay").over(along)})
    ev, delay = F.col("_e"), F.col("_delay")
    real, real_next = F.col("_sched") + delay, F.col("_sched_next") + F.col("_delay_next")
    stime = F.col("feed_ts") if sample_time is None else sample_time

    def mins(seconds: Column) -> Column:
        return js_round(seconds / F.lit(60.0)).try_cast("int")

    to_ts = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", stime, to_ts(F.coalesce(real, F.col("_sched"))))
    out = e.select(
        stime.alias("sample_time"), "trip_id", "start_date", "line_name", "line_fahrtnr", "product_type_id",
        "product_name", "operator_id", F.col("_off").alias("cancelled"), ev["stop_id"].alias("station_id"),
        ev["seq"].alias("stop_number"), to_ts(F.col("_sched")).alias("scheduled_time"), mins(delay).alias("delay_minutes"),
        js_round(micros / F.lit(60_000_000.0)).try_cast("int").alias("ttl_minutes"), ev["dep"].alias("is_departure"),
        mins(F.col("_sched_next") - F.col("_sched")).alias("scheduled_duration_minutes"),
        mins(real_next - real).alias("projected_duration_minutes"), ev["off"].isNotNull().alias("has_update"))
    if stops is None:
        return out
    known = stops.select(F.col("stop_id").alias("station_id")).distinct()
    return out.join(known, "station_id", "left_semi")


def offline_instances(instances: DataFrame, seed: int = 42) -> DataFrame:
    """First feed of each (trip, start date) gets an update-free copy at an earlier time.

    The reference draws the offset uniformly from [0, 10 h); here it is a seeded
    hash fraction of the trip instance, so retries are deterministic.
    """
    w = Window.partitionBy("trip_id", "start_date").orderBy("feed_ts")
    first = instances.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")
    frac = _fraction(seed, "trip_id", "start_date")
    off = js_round(frac * F.lit(OFFLINE_MAX_HOURS * 3600.0)).cast("int")
    return first.withColumn("offline_sample_time", F.timestamp_add("SECOND", -off, F.col("feed_ts")))


# --- feed files and versions (S12-S14) ----------------------------------------------

def every_nth(files: DataFrame, n: int = FEED_FILE_SAMPLING, order: str = "path") -> DataFrame:
    """The n-th, 2n-th, ... file in sorted order; a trailing incomplete group is dropped.

    Numbered in two passes (``dims.numbered``), so the listing never meets in one task.
    """
    return numbered(files, order).where(F.col("_nr") % n == 0).drop("_nr")


def feed_time(header_ts: Column, mtime: Column) -> Column:
    """Header timestamp, else file modification time."""
    return F.coalesce(header_ts, mtime)


def version_validity(versions: DataFrame, tz: str = "UTC") -> DataFrame:
    """Version v is valid for (valid_until(v-1), valid_until(v)]; newest has none.

    One window over all versions: a timetable is published at most a few times a day, so the
    table is bounded by about a thousand rows a year.
    """
    w = Window.orderBy("version")
    nxt = F.lead("mtime").over(w)
    until = F.timestamp_add("HOUR", F.lit(VERSION_SWITCH_HOUR), F.date_trunc("day", nxt).cast("timestamp_ntz"))
    if tz.upper() != "UTC":
        until = F.to_utc_timestamp(until.cast("timestamp"), tz).cast("timestamp_ntz")
    v = versions.withColumn("valid_until", until)
    return v.withColumn("valid_from", F.lag("valid_until").over(w))


def attach_version(feeds: DataFrame, versions: DataFrame, ts: str = "feed_ts", tz: str = "UTC") -> DataFrame:
    """As-of join of each feed to the version valid at its time; NULL = gtfsUnavailable.

    One plan for every size: versions are spread over the days they are valid for (the first one from the first
    feed on) and joined on the day; the exact bounds decide within it.
    """
    v = version_validity(versions, tz).where(F.col("valid_until").isNotNull())
    start = F.coalesce("valid_from", feeds.select(F.min(ts)).scalar(), "valid_until")
    v = v.select("version", "valid_from", "valid_until", F.least(start, F.col("valid_until")).alias("_start"))
    days = F.sequence(F.to_date("_start"), F.to_date("valid_until"))
    vb = v.select("version", "valid_from", "valid_until", F.explode(days).alias("_vday"))
    fb = feeds.withColumn("_day", F.to_date(F.col(ts)))
    cond = ((F.col("_day") == F.col("_vday")) & (F.col(ts) <= F.col("valid_until"))
            & (F.col("valid_from").isNull() | (F.col(ts) > F.col("valid_from"))))
    return fb.join(vb, cond, "left").drop("_day", "_vday")


def versions_in_use(versions: DataFrame, feeds: DataFrame, ts: str = "feed_ts", tz: str = "UTC") -> DataFrame:
    """``gtfs_version`` of the versions that are valid at some time between the first and the last feed."""
    seen = feeds.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))
    v = version_validity(versions, tz)
    first, last = seen.select("first").scalar(), seen.select("last").scalar()
    return v.where((F.col("valid_until") >= first) & (F.col("valid_from").isNull() | (F.col("valid_from") < last))).select(
        F.col("version").alias(VERSION))


def of_versions(timetable: DataFrame, used: DataFrame) -> DataFrame:
    """Rows of a timetable table stored by ``gtfs_version`` that belong to ``used`` versions.

    ``used`` has a row for each version (at most a few a day are published, see ``version_validity``), so it is broadcast, and its
    values prune the folders of other versions while the query runs.
    """
    return timetable.join(F.broadcast(used), VERSION, "left_semi")


def versioned_stop_events(updates: DataFrame, stop_time_updates: DataFrame, versions: DataFrame, tables: dict[str, DataFrame],
                          stops: DataFrame | None = None, tz: str = "UTC") -> DataFrame:
    """S14 + G1-G11: each feed's updates with the timetable version that is valid at its time; without one they are dropped.

    ``tables`` are ``trips``, ``routes``, ``agency`` and ``stop_times``, stored by ``gtfs_version``.
    """
    used = versions_in_use(versions, updates, tz=tz)
    tables = {name: of_versions(df, used) for name, df in tables.items()}
    tu = attach_version(updates, versions, tz=tz).where(F.col("version").isNotNull()).withColumnRenamed("version", VERSION)
    inst = join_timetable(tu.drop("valid_from", "valid_until"), tables["trips"], tables["routes"], tables["agency"], tables["stop_times"])
    return stop_events(inst, tables["stop_times"], stops, stop_time_updates, tz)
