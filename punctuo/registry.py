"""Named queries over a data folder: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry reads the driver tables through ``fixtures`` and runs one
operator (or a chain ending in it) over the whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from .operators import facts as FA
from .operators import histograms as H
from .operators import stats as ST
from .functions import buckets as B
from .plans import fold as FO
from .plans import ingest as IN
from .plans import refresh as R
from .profiles import CH_SBB, DE_DB, DE_GTFS
from .session import shared_path
from .sources import envelopes as EN
from .streaming import stream as STR

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _facts(spark: SparkSession, d: str, profile=DE_DB) -> DataFrame:
    return FA.facts(fx.sample(spark, d), fx.remarks(spark, d), profile)


def _hist(spark: SparkSession, d: str, kind: str, profile=DE_DB) -> DataFrame:
    return H.histogram(_facts(spark, d, profile), kind, profile)


# --- A: core statistics -------------------------------------------------------

@register("freeze_threshold")
def q_freeze_threshold(spark, d):
    return FA.freeze_threshold(fx.sample(spark, d))


@register("latest_sample")
def q_latest_sample(spark, d):
    s = fx.sample(spark, d)
    frozen = s.where(F.col("scheduled_time") < FA.freeze_threshold_col(s))
    return FA.latest_samples(frozen, fx.remarks(spark, d)).drop("latest_sample_time")


@register("substitute_running")
def q_substitute_running(spark, d):
    # the remarks dictionary restricted to hashes the samples actually carry
    s = fx.sample(spark, d).select("remarks_hash").where(F.col("remarks_hash").isNotNull()).distinct()
    subs = FA.substitute_hashes(fx.remarks(spark, d))
    return subs.join(s, "remarks_hash", "left_semi")


@register("delay_bucket")
def q_delay_bucket(spark, d):
    return fx.sample(spark, d).select("id", "delay_minutes", B.delay_bucket(F.col("delay_minutes")).alias("bucket"))


@register("ttl_bucket")
def q_ttl_bucket(spark, d):
    return fx.sample(spark, d).select("id", "ttl_minutes", B.ttl_bucket(F.col("ttl_minutes")).alias("bucket"))


@register("reduced_ttl_bucket")
def q_reduced_ttl_bucket(spark, d):
    s = fx.sample(spark, d).select("id", B.ttl_bucket(F.col("ttl_minutes")).alias("bucket"))
    return s.select("id", "bucket", B.reduced_ttl_bucket(F.col("bucket")).alias("reduced"))


@register("sample_facts")
def q_sample_facts(spark, d):
    return FA.label_facts(_facts(spark, d)).drop("latest_sample_ttl_bucket_h")


@register("sample_with_latest")
def q_sample_with_latest(spark, d):
    f = _facts(spark, d)
    return f.agg(F.count(F.lit(1)).alias("fact_rows"), F.sum("sample_count").cast("bigint").alias("samples"),
                 F.count_if(F.col("prior_ttl_bucket").isNull()).alias("latest_rows"))


@register("sample_retention")
def q_sample_retention(spark, d):
    return FA.retain(fx.sample(spark, d))


for _k in ("by_hour", "by_day", "by_station", "by_duration"):
    def _mk(kind):
        return lambda spark, d: _hist(spark, d, kind)
    register(f"histogram_{_k}")(_mk(_k))


@register("histogram_merge")
def q_histogram_merge(spark, d):
    # the facts (latest known) fall in halves by line and station, so most keys are in both
    f = _facts(spark, d)
    half = F.pmod(F.xxhash64("line_name", "station_id"), F.lit(2))
    return H.merge_histogram(H.histogram(f.where(half == 0), "by_day"), H.histogram(f.where(half == 1), "by_day"))


def _folded(spark, batches, remarks, kind):
    """A stored histogram after the batches were folded in, one after the other."""
    state = shared_path(spark, f"fold-{uuid.uuid4().hex}")
    for i, batch in enumerate(batches):
        FO.fold(spark, batch, remarks, state, batch_id=i)
    return R.stored(spark, state, kind)


@register("late_samples")
def q_late_samples(spark, d):
    # a fifth of the samples, of all stop events alike, comes when the others are frozen and counted
    s = fx.sample(spark, d)
    late = F.pmod(F.xxhash64("trip_id", "station_id", "scheduled_time", "sample_time"), F.lit(5)) == 0
    return _folded(spark, [s.where(~late), s.where(late)], fx.remarks(spark, d), "by_day")


@register("replayed_samples")
def q_replayed_samples(spark, d):
    # a third of the samples is reported again under other ids, long after
    s = fx.sample(spark, d)
    again = s.where("id % 3 = 0").withColumn("id", F.col("id") + 10 ** 15)
    return _folded(spark, [s, again], fx.remarks(spark, d), "by_hour")


@register("open_samples")
def q_open_samples(spark, d):
    state = shared_path(spark, f"fold-{uuid.uuid4().hex}")
    FO.fold(spark, fx.sample(spark, d), fx.remarks(spark, d), state)
    return FO.open_samples(spark, state)


@register("histogram_without_time")
def q_histogram_without_time(spark, d):
    return H.without_time(_hist(spark, d, "by_hour"))


@register("histogram_by_month")
def q_histogram_by_month(spark, d):
    return H.by_month(_hist(spark, d, "by_day"))


@register("histogram_gtfs_profile")
def q_histogram_gtfs(spark, d):
    return H.without_time(_hist(spark, d, "by_day", DE_GTFS))


@register("histogram_swiss_profile")
def q_histogram_swiss(spark, d):
    return _hist(spark, d, "by_hour", CH_SBB)


@register("sample_histogram")
def q_sample_histogram(spark, d):
    return H.full_histogram(_facts(spark, d))


@register("total_sample_count")
def q_total_sample_count(spark, d):
    return H.with_total(H.full_histogram(_facts(spark, d)))


# --- C: consumer queries ------------------------------------------------------

@register("conditional_delay")
def q_conditional_delay(spark, d):
    return ST.conditional_delay(_hist(spark, d, "by_hour"))


@register("final_delay")
def q_final_delay(spark, d):
    return ST.final_delay(_hist(spark, d, "by_hour"))


@register("accuracy_filter")
def q_accuracy_filter(spark, d):
    return ST.accuracy_filter(_hist(spark, d, "by_hour"), "(-10,10]")


@register("cancellation_rate")
def q_cancellation_rate(spark, d):
    return ST.cancellation_rate(_hist(spark, d, "by_day"))


@register("rt_availability")
def q_rt_availability(spark, d):
    return ST.rt_availability(fx.sample(spark, d))


# --- N: normalisation and counters --------------------------------------------

from .operators import normalise as N  # noqa: E402
from .operators import segments as SG  # noqa: E402
from .sources import files as FS  # noqa: E402
from .sources import resume as RS  # noqa: E402


def _norm(spark, d):
    return N.normalise(fx.raw_samples(spark, d))


@register("delay_minutes")
def q_delay_minutes(spark, d):
    return fx.raw_samples(spark, d).select(
        "sample_id", "delay_seconds", N.minutes_from_seconds(F.col("delay_seconds")).alias("delay_minutes"))


@register("ttl_minutes")
def q_ttl_minutes(spark, d):
    return _norm(spark, d).select("sample_id", "sample_time", "ttl_minutes")


@register("fallback_sample_time")
def q_fallback_sample_time(spark, d):
    return N.with_sample_time(_norm(spark, d)).select("sample_id", "sample_time", "sample_time_fallback",
                                                      "ttl_minutes", "cancelled")


@register("relevant_samples")
def q_relevant_samples(spark, d):
    return N.relevant(_norm(spark, d)).select("sample_id", "ttl_minutes", "delay_minutes", "cancelled")


@register("response_validation")
def q_response_validation(spark, d):
    st = N.response_status(fx.responses(spark, d), fx.raw_samples(spark, d))
    return st.groupBy("status").agg(F.count(F.lit(1)).alias("responses"))


STORED_BEFORE = "2024-01-15 00:00:00"


@register("response_dedup")
def q_response_dedup(spark, d):
    r = fx.responses(spark, d)
    cut = F.lit(STORED_BEFORE).cast("timestamp_ntz")
    r = r.drop("raw")
    return N.new_responses(r.where(F.col("ts") >= cut), r.where(F.col("ts") < cut))


@register("sample_dedup")
def q_sample_dedup(spark, d):
    # a third of the samples is reported again under another id
    s = fx.sample(spark, d)
    times = F.when(F.col("id") % 3 == 0, 2).otherwise(1)
    return N.dedup_samples(s.withColumn("_time", F.explode(F.sequence(F.lit(1), times))).drop("id", "_time"))


@register("response_type_name")
def q_response_type_name(spark, d):
    r = fx.responses(spark, d).select("event_id", N.response_type_id(F.col("type")).alias("type_id"))
    return r.select("event_id", "type_id", B.response_type_name(F.col("type_id")).alias("name"))


@register("stream_incremental_files")
def q_stream_incremental_files(spark, d):
    src = fx.table(spark, d, "events").select("event_id", "event_type")
    out = shared_path(spark, f"stream-{uuid.uuid4().hex}")
    rows = STR.stream_files(spark, f"{d.rstrip('/')}/events*.parquet", src.schema)
    (rows.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/progress")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(src.schema).parquet(f"{out}/rows")


@register("remarks_hash")
def q_remarks_hash(spark, d):
    s = fx.sample(spark, d).select("remarks_hash").where(F.col("remarks_hash").isNotNull())
    r = fx.remarks(spark, d)
    j = s.join(r, "remarks_hash")
    return j.groupBy(N.remarks_key(F.col("remarks")).alias("remarks_key")).agg(F.count(F.lit(1)).alias("samples"))


@register("response_log")
def q_response_log(spark, d):
    return N.response_log(_norm(spark, d))


@register("quality_counters")
def q_quality_counters(spark, d):
    return N.quality(_norm(spark, d))


SAMPLE_CONTENT = ["trip_id", "station_id", "is_departure", "scheduled_time", "projected_time", "delay_seconds", "cancelled", "sample_time",
                  "line_name", "product_type_id", "operator_id", "remarks_hash", "load_factor_id", "scheduled_duration_minutes",
                  "projected_duration_minutes"]


@register("load_counters")
def q_load_counters(spark, d):
    # a third of the samples is in its response twice; responses before the middle of the month are stored
    n = _norm(spark, d)
    more = F.when(F.col("sample_id") % 3 == 0, F.array(F.lit(0), F.lit(10 ** 15))).otherwise(F.array(F.lit(0).cast("bigint")))
    twice = n.withColumn("_more", F.explode(more)).withColumn("sample_id", F.col("sample_id") + F.col("_more")).drop("_more")
    stored = fx.responses(spark, d).where(F.col("ts") < F.lit(STORED_BEFORE).cast("timestamp_ntz"))
    return N.load_counters(twice, stored, SAMPLE_CONTENT)


@register("rt_count_check")
def q_rt_count_check(spark, d):
    r = fx.responses(spark, d).withColumn("expected_rt_count", EN.expected_rt(F.col("raw")))
    return N.rt_count_check(r, _norm(spark, d))


@register("rt_diff_avg")
def q_rt_diff_avg(spark, d):
    return N.rt_diff_avg(_norm(spark, d))


def _file_spans(spark, d):
    # ten responses to a file; a file's last sample may lie hours behind its first
    e = fx.table(spark, d, "events").withColumn("f", F.floor(F.col("event_id") / 10))
    spans = e.groupBy("f").agg(F.min_by("ts", "event_id").alias("first"), F.max_by("ts", "event_id").alias("last"))
    return spans.select(F.concat(F.lit("feeds/"), F.lpad(F.col("f").cast("string"), 9, "0")).alias("path"), "first",
                        F.timestamp_add("MINUTE", (F.col("f") * 7919 % 400).cast("int"), F.col("last")).alias("last"))


@register("batch_window")
def q_batch_window(spark, d):
    return SG.greedy_batches(_file_spans(spark, d))


@register("batch_grid")
def q_batch_grid(spark, d):
    n = N.relevant(_norm(spark, d))
    origin = n.select(F.min("sample_time")).scalar()
    b = n.withColumn("batch", N.batch_id(F.col("sample_time"), origin))
    return b.groupBy("batch").agg(F.count(F.lit(1)).alias("samples"), F.min("sample_time").alias("first_sample_time"),
                                  F.max("sample_time").alias("last_sample_time"))


@register("pending_files")
def q_pending_files(spark, d):
    files = fx.feed_files(spark, d)
    n = files.agg(F.max("event_id")).first()[0]
    at = {r["event_id"]: r["path"] for r in files.where(F.col("event_id").isin(n // 3, 2 * n // 3)).collect()}
    return RS.pending(files, at[n // 3], at[2 * n // 3])


@register("stream_resume_files")
def q_stream_resume_files(spark, d):
    # a file for each day; the run goes on behind the tenth and stops before the twentieth
    out = shared_path(spark, f"resume-{uuid.uuid4().hex}")
    e = fx.table(spark, d, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    e.repartition("day").write.partitionBy("day").parquet(f"{out}/in")
    files = [r["path"] for r in FS.list_inputs(spark, f"{out}/in/day=*/*.parquet").select("path").collect()]  # one a day
    prefix = f"{out}/in/"
    named = [prefix + f.split("/in/", 1)[1] for f in files]
    names = RS.file_names(spark, f"{out}/in/day=*/*.parquet", after=named[9], up_to=named[19])
    RS.follow(spark, names, f"{out}/progress", lambda paths: spark.read.parquet(*paths),
              lambda df, i: df.write.mode("overwrite").parquet(f"{out}/rows/batch={i}")).awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("event_id", "event_type")


# --- G: GTFS timetable x GTFS-RT ----------------------------------------------

from .operators import gtfs as G  # noqa: E402
from .sources import gtfs_static as GS  # noqa: E402


def _instances(spark, d):
    return G.join_timetable(fx.trip_updates(spark, d).drop("run"), fx.trips(spark, d), fx.routes(spark, d),
                            fx.agency(spark, d), fx.gtfs_stop_times(spark, d))


def _events(spark, d):
    return G.stop_events(_instances(spark, d), fx.gtfs_stop_times(spark, d), fx.stops(spark, d),
                         fx.stop_time_updates(spark, d))


EV_KEY = ["trip_id", "start_date", "sample_time", "stop_number", "is_departure"]


@register("gtfs_trip_join")
def q_gtfs_trip_join(spark, d):
    return _instances(spark, d).select("trip_id", "start_date", "route_id", "operator_id", "product_type_id",
                                       "line_name", "line_fahrtnr", "trip_schedule_relationship", "feed_ts")


@register("gtfs_product_type")
def q_gtfs_product_type(spark, d):
    r = fx.routes(spark, d)
    return r.select("route_id", "route_type", "route_short_name",
                    G.product_type(F.col("route_type"), F.col("route_short_name")).alias("product_type_id"))


@register("gtfs_time_seconds")
def q_gtfs_time_seconds(spark, d):
    st = fx.gtfs_stop_times(spark, d)
    return st.select("trip_id", "stop_sequence", "arrival_time", G.gtfs_seconds(F.col("arrival_time")).alias("arrival_s"),
                     "departure_time", G.gtfs_seconds(F.col("departure_time")).alias("departure_s"))


@register("service_day_start")
def q_service_day_start(spark, d):
    inst = _instances(spark, d)
    st = fx.gtfs_stop_times(spark, d).groupBy("trip_id").agg(
        F.min_by(G.gtfs_seconds(F.col("departure_time")), F.col("stop_sequence")).alias("first_departure_s"))
    j = inst.join(st, "trip_id")
    return j.select("trip_id", "start_date", "feed_ts", "start_time", "first_departure_s",
                    G.service_start(F.col("start_date"), F.col("start_time"), F.col("first_departure_s"))
                    .alias("service_start"))


@register("stop_events")
def q_stop_events(spark, d):
    return _events(spark, d).drop("has_update")


@register("delay_propagation")
def q_delay_propagation(spark, d):
    return _events(spark, d).select(*EV_KEY, "scheduled_time", "delay_minutes", "ttl_minutes")


@register("stop_update_match")
def q_stop_update_match(spark, d):
    return _events(spark, d).select(*EV_KEY, "has_update")


@register("cancel_propagation")
def q_cancel_propagation(spark, d):
    return _events(spark, d).select(*EV_KEY, "cancelled")


@register("event_durations")
def q_event_durations(spark, d):
    return _events(spark, d).select(*EV_KEY, "scheduled_duration_minutes", "projected_duration_minutes")


@register("offline_samples")
def q_offline_samples(spark, d):
    off = G.offline_instances(_instances(spark, d))
    return G.stop_events(off, fx.gtfs_stop_times(spark, d), fx.stops(spark, d), None,
                         sample_time=F.col("offline_sample_time")).drop("has_update")


@register("bus_sampling")
def q_bus_sampling(spark, d):
    return G.bus_thinning(_instances(spark, d))


@register("gtfs_operators")
def q_gtfs_operators(spark, d):
    return G.operators(fx.agency(spark, d))


@register("gtfs_stations")
def q_gtfs_stations(spark, d):
    return G.stations(fx.stops(spark, d)).select("station_id", "name", F.col("lonlat.lon").alias("lon"),
                                                 F.col("lonlat.lat").alias("lat"), "parent")


@register("feed_file_sampling")
def q_feed_file_sampling(spark, d):
    return G.every_nth(fx.feed_files(spark, d))


@register("gtfs_version_asof")
def q_gtfs_version_asof(spark, d):
    feeds = fx.feed_files(spark, d).select("path", G.feed_time(F.lit(None).cast("timestamp_ntz"),
                                                              F.col("mtime")).alias("feed_ts"))
    return G.attach_version(feeds, fx.gtfs_versions(spark, d)).select("path", "feed_ts", "version")


@register("stop_events_versioned")
def q_stop_events_versioned(spark, d):
    path = shared_path(spark, f"timetables-{uuid.uuid4().hex}")
    fx.write_timetables(spark, d, path)
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in ("trips", "routes", "agency", "stop_times")}
    return G.versioned_stop_events(fx.trip_updates(spark, d).drop("run"), fx.stop_time_updates(spark, d),
                                   fx.timetable_versions(spark, d).drop("k"), tables, fx.stops(spark, d)).drop("has_update")


@register("gtfs_static_join")
def q_gtfs_static_join(spark, d):
    path = shared_path(spark, f"gtfs-{uuid.uuid4().hex}")
    fx.write_gtfs_csv(spark, d, path)
    read = lambda name, cols, key=None: GS.read_static(spark, f"{path}/{name}.txt", cols, key)
    ag = read("agency", ["agency_id", "agency_name", "agency_lang"], "agency_id")
    rt = read("routes", ["route_id", "agency_id", "route_short_name", "route_type"], "route_id")
    tr = read("trips", ["trip_id", "route_id", "trip_short_name"], "trip_id")
    st = read("stop_times", ["trip_id", "stop_id", "stop_sequence", "departure_time"]).withColumn("n", F.col("stop_sequence").cast("int"))
    sp = read("stops", ["stop_id", "stop_name"], "stop_id")
    per = (st.join(sp, "stop_id").groupBy("trip_id")
           .agg(F.count(F.lit(1)).alias("stops"), F.min_by("stop_name", "n").alias("first_stop"), F.max("departure_time").alias("last_time")))
    return (tr.join(rt, "route_id").join(ag, "agency_id").join(per, "trip_id")
            .select("trip_id", "route_id", "route_short_name", "route_type", "agency_name", "agency_lang", "trip_short_name", "stops",
                    "first_stop", "last_time"))


# --- D: dimensions, T: stations, S16/C6: official figures ---------------------

from .operators import dims as D  # noqa: E402
from .operators import stations as T  # noqa: E402
from .sources import official as OF  # noqa: E402


@register("zip_unnest")
def q_zip_unnest(spark, d):
    li = fx.table(spark, d, "lineitem")
    per = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("s"))
    arrays = per.select("l_orderkey", F.transform("s", lambda x: x["l_linenumber"]).alias("l_linenumber"),
                        F.transform("s", lambda x: x["l_partkey"]).alias("l_partkey"))
    return D.zip_rows(arrays, ["l_linenumber", "l_partkey"])


def _line_dim(spark, d):
    s = fx.sample(spark, d).select("line_name").distinct()
    n = F.regexp_extract("line_name", r"^L(\d+)$", 1).cast("int")
    return s.where(n < 10).select((n + 1).cast("smallint").alias("line_id"), "line_name")


@register("surrogate_keys")
def q_surrogate_keys(spark, d):
    dim, _ = D.assign_ids(_line_dim(spark, d), fx.sample(spark, d).select("line_name"), "line_name", "line_id")
    return dim


@register("surrogate_key_lookup")
def q_surrogate_key_lookup(spark, d):
    _, mapped = D.assign_ids(_line_dim(spark, d), fx.sample(spark, d).select("id", "line_name"),
                             "line_name", "line_id")
    return mapped


def _dimensions(spark, d):
    return D.assign_all(fx.stored_dimensions(spark, d), fx.dimension_values(spark, d), {
        k: k for k in ("operator", "load_factor", "product_type", "prognosis_type")}, {"operator": "operator_name"})


@register("dimension_keys")
def q_dimension_keys(spark, d):
    return _dimensions(spark, d)[0]


@register("dimension_lookup")
def q_dimension_lookup(spark, d):
    return _dimensions(spark, d)[1]


def _station_dim(spark, d):
    st = fx.stops(spark, d)
    return st.select(F.col("stop_id").alias("station_id"), F.col("stop_name").alias("name"),
                     F.when(F.col("stop_id").cast("int") % 3 != 0, F.concat(F.lit("{\"id\":\""), F.col("stop_id"),
                                                                              F.lit("\"}"))).alias("details"))


def _station_new(spark, d):
    st = fx.stops(spark, d)
    return st.where(F.col("stop_id").cast("int") % 2 == 0).select(
        F.col("stop_id").alias("station_id"), F.concat(F.lit("new "), F.col("stop_name")).alias("name"),
        F.concat(F.lit("{\"new\":\""), F.col("stop_id"), F.lit("\"}")).alias("details"))


@register("station_upsert")
def q_station_upsert(spark, d):
    old = _station_dim(spark, d).where(F.col("station_id").cast("int") % 5 != 1)
    return D.upsert(old, _station_new(spark, d), "station_id", ["details"])


@register("station_upsert_if_null")
def q_station_upsert_if_null(spark, d):
    old = _station_dim(spark, d).where(F.col("station_id").cast("int") % 5 != 1)
    return D.upsert(old, _station_new(spark, d), "station_id", ["details"], only_if_null=True)


@register("insert_ignore")
def q_insert_ignore(spark, d):
    ops = G.operators(fx.agency(spark, d))
    old = ops.where(F.col("operator_id") % 2 == 0).withColumn("name", F.concat(F.lit("old "), F.col("name")))
    return D.insert_ignore(old, ops, "operator_id")


@register("first_per_key")
def q_first_per_key(spark, d):
    r = fx.raw_samples(spark, d).select("response_id", "station_id", "sample_id", "line_name")
    return D.first_per_key(r, ["response_id", "station_id"], F.col("sample_id"))


@register("last_response_time")
def q_last_response_time(spark, d):
    return D.last_response_time(N.response_log(_norm(spark, d)))


def _served_lines(spark, d):
    st = fx.gtfs_stop_times(spark, d).select("trip_id", F.col("stop_id").alias("station_id"))
    tr = fx.trips(spark, d).select("trip_id", "route_id")
    rt = fx.routes(spark, d).select("route_id", F.col("route_short_name").alias("line_name"))
    return st.join(tr, "trip_id").join(rt, "route_id").select("station_id", "line_name")


@register("station_lines")
def q_station_lines(spark, d):
    stn = G.stations(fx.stops(spark, d)).select("station_id", "name")
    return T.station_lines(stn, _served_lines(spark, d))


def _official_stations(spark, d):
    return T.official_from_raw(fx.official_station_list(spark, d))


def _our_stations(spark, d):
    return G.stations(fx.stops(spark, d)).select("station_id", "name", F.col("lonlat.lon").alias("lon"),
                                                 F.col("lonlat.lat").alias("lat"))


@register("official_stations")
def q_official_stations(spark, d):
    return _official_stations(spark, d)


@register("geo_distance")
def q_geo_distance(spark, d):
    o = _official_stations(spark, d)
    s = _our_stations(spark, d)
    j = s.join(o, s.station_id == o.eva)
    return j.select("station_id", F.round(T.geo_distance(s.lon, s.lat, o.lon, o.lat), 3).alias("distance_m"))


@register("station_repair")
def q_station_repair(spark, d):
    r = T.repair_positions(_our_stations(spark, d), _official_stations(spark, d))
    return r.withColumn("distance_m", F.round("distance_m", 3))


def _station_documents(spark, d):
    st = _our_stations(spark, d).join(_station_dim(spark, d).select("station_id", "details"), "station_id")
    lines = T.station_lines(st.select("station_id"), _served_lines(spark, d))
    return T.documents(st, _official_stations(spark, d), lines)


@register("station_documents")
def q_station_documents(spark, d):
    x = F.col("details")
    return _station_documents(spark, d).select(
        "station_id", x["id"].alias("id"), x["name"].alias("name"), x["type"].alias("type"), x["location"]["longitude"].alias("lon"),
        x["location"]["latitude"].alias("lat"), x["ifoptId"].alias("ifopt_id"), F.transform(x["lines"], lambda y: y["name"]).alias("lines"),
        x["weight"].alias("weight"))


@register("repaired_stations")
def q_repaired_stations(spark, d):
    return _station_documents(spark, d).where("repaired").select("station_id", F.col("position.longitude").alias("lon"),
                                                                 F.col("position.latitude").alias("lat"))


@register("missing_stations")
def q_missing_stations(spark, d):
    return T.missing_stations(_our_stations(spark, d), _official_stations(spark, d))


@register("official_stats_unpivot")
def q_official_stats_unpivot(spark, d):
    return OF.official_long(fx.official_punctuality_csv(spark, d))


@register("official_comparison")
def q_official_comparison(spark, d):
    stats = OF.official_delay_stats(OF.official_long(fx.official_punctuality_csv(spark, d)))
    bm = H.by_month(_hist(spark, d, "by_day"))
    return OF.official_comparison(bm, stats, fx.official_operator_mapping(spark, d))


# --- S5-S8: response readers; P: FPTF documents --------------------------------

from .operators import fptf as P  # noqa: E402


@register("hafas_envelope")
def q_hafas_envelope(spark, d):
    r = EN.hafas_responses(fx.hafas_log_lines(spark, d))
    return r.select("event_id", F.get_json_object("res", "$.svcResL[0].meth").alias("meth"), "hash")


@register("hafas_response_type")
def q_hafas_response_type(spark, d):
    return EN.hafas_responses(fx.hafas_log_lines(spark, d)).select("event_id", "type")


@register("expected_rt_count")
def q_expected_rt_count(spark, d):
    return EN.hafas_responses(fx.hafas_log_lines(spark, d)).select("event_id", "expected_rt_count")


@register("access_log_meta")
def q_access_log_meta(spark, d):
    m = fx.access_log_lines(spark, d).select("event_id", EN.log_meta(F.col("value")).alias("m"))
    return m.where(F.col("m").isNotNull()).select("event_id", "m.ts", "m.type")


@register("log_entries")
def q_log_entries(spark, d):
    path = shared_path(spark, f"logs-{uuid.uuid4().hex}")
    fx.write_access_logs(spark, d, path)
    return FS.read_log(spark, path).select("ts", "type", "hash", "err")


def _fptf(spark, d):
    return P.fptf_samples(fx.fptf_documents(spark, d)).drop("stations")


SAMPLE_OUT = ["response_key", "type", "trip_id", "station_id", "is_departure", "scheduled_time", "projected_time",
              "delay_seconds", "cancelled", "load_factor", "line_name", "operator_id", "sample_time"]


@register("fptf_samples")
def q_fptf_samples(spark, d):
    return _fptf(spark, d).select(*SAMPLE_OUT)


for _t in ("board", "trip", "journeys", "radar"):
    def _mkp(kind):
        types = {"board": ["departures", "arrivals"], "trip": ["trip"], "journeys": ["journeys", "refreshJourney"],
                 "radar": ["radar"]}[kind]
        return lambda spark, d: _fptf(spark, d).where(F.col("type").isin(types)).select(*SAMPLE_OUT)
    register(f"fptf_{_t}")(_mkp(_t))


@register("fptf_metadata")
def q_fptf_metadata(spark, d):
    return _fptf(spark, d).select("response_key", "trip_id", "station_id", "is_departure", "cancelled",
                                  "load_factor", "operator_id", "operator_name", "line_name", "line_fahrtnr",
                                  "line_id", "product_type", "product_name",
                                  "remarks")


@register("fptf_stopovers")
def q_fptf_stopovers(spark, d):
    return _fptf(spark, d).where(F.col("type") == "trip").groupBy("is_departure").agg(
        F.count(F.lit(1)).alias("rows"), F.count("delay_seconds").alias("with_delay"))


@register("fptf_stations")
def q_fptf_stations(spark, d):
    return P.fptf_stations(fx.fptf_documents(spark, d))


@register("fptf_normalised")
def q_fptf_normalised(spark, d):
    s = _fptf(spark, d).withColumn("response_ts", F.col("sample_time"))
    return N.relevant(N.normalise(s)).select("response_key", "trip_id", "station_id", "is_departure",
                                             "scheduled_time", "delay_minutes", "ttl_minutes", "cancelled")


def _ingested(spark, d):
    # all responses, and then all of them again under another batch
    state = shared_path(spark, f"ingest-{uuid.uuid4().hex}")
    for i in range(2):
        IN.ingest_fptf(spark, fx.fptf_responses(spark, d), state, batch_id=i)
    return state


@register("ingest_fptf")
def q_ingest_fptf(spark, d):
    return R.stored(spark, _ingested(spark, d), "by_hour")


@register("ingest_fptf_log")
def q_ingest_fptf_log(spark, d):
    return IN.table(spark, _ingested(spark, d), "response_log", IN.LOG).drop("hash")


@register("ingest_gtfs")
def q_ingest_gtfs(spark, d):
    # feeds of odd and even trips in two batches, each against the version valid at its time
    path = shared_path(spark, f"timetables-{uuid.uuid4().hex}")
    fx.write_timetables(spark, d, path)
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in ("trips", "routes", "agency", "stop_times")}
    tu, odd = fx.trip_updates(spark, d).drop("run"), F.col("trip_id").cast("bigint") % 2 == 1
    state = shared_path(spark, f"ingest-{uuid.uuid4().hex}")
    for i, part in enumerate((odd, ~odd)):
        IN.ingest_gtfs(spark, tu.where(part), fx.stop_time_updates(spark, d).where(part), fx.timetable_versions(spark, d).drop("k"), tables,
                       fx.stops(spark, d), state, batch_id=i)
    return R.stored(spark, state, "by_day")
