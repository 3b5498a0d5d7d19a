"""Responses to statistics in one job and one commit (D7): FPTF documents or GTFS-RT samples into a state.

Per batch of documents: valid responses (N6), the first of each hash, none that the log has (N7); samples and stations (P);
minutes, fallback time, relevance (N1-N5); remarks by hash (N9, D5); natural keys to ids (D3); stations upserted (D4); the
response log (N10); and the samples folded into the stored statistics (``fold``: repeats, late rows, histograms). Parts of
all tables are written first; one rename then publishes samples, histograms, stations, remarks, dimensions, log and the
batch id together, so a job that stops anywhere has stored nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..operators import dims as D
from ..operators import fptf as P
from ..operators import gtfs as G
from ..operators import normalise as N
from ..profiles import DE_DB, DE_GTFS, Profile
from . import fold as FO

DIMENSIONS = {"operator": "operator_key", "load_factor": "load_factor", "product_type": "product_type", "prognosis_type": "prognosis_type"}
SAMPLE = ["id", "response_id", "scheduled_time", "scheduled_duration_minutes", "projected_duration_minutes", "delay_minutes", "cancelled",
          "sample_time", "ttl_minutes", "trip_id", "line_name", "line_fahrtnr", "product_type_id", "product_name", "station_id", "operator_id",
          "is_departure", "remarks_hash", "load_factor_id", "prognosis_type_id"]


def table(spark: SparkSession, state: str, name: str, schema: str, m: dict | None = None) -> DataFrame:
    """A committed table, empty where nothing was stored."""
    parts = (m or sinks.manifest(spark, state))["tables"].get(name)
    return sinks.read_parts(spark, state, parts) if parts else spark.createDataFrame([], schema)


LOG = ("response_id string, hash string, type smallint, response_time timestamp_ntz, response_time_estimated boolean, "
       "sample_time_estimated boolean, sample_count bigint, source string")
STATIONS = "station_id string, name string, lon double, lat double, parent string, details string"
REMARKS = "remarks_hash string, remarks string"
DIMS = "dim string, id int, key string, name string"


def sample_id(*content: str) -> Column:
    """A number from the MD5 of a sample's content: the same in every run, so ties are settled alike."""
    text = F.concat_ws("|", *[F.unix_micros(F.col(c).cast("timestamp")).cast("string") if c.endswith("_time") else F.col(c).cast("string")
                              for c in content])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def new_responses(docs: DataFrame, log: DataFrame) -> DataFrame:
    """N6 + N7: valid documents, the first of each hash (by response id), without those that are stored."""
    valid = docs.where(F.col("doc").isNotNull() & F.col("type").isin(list(N.RESPONSE_TYPE_IDS)))
    return N.new_responses(valid.withColumn("hash", F.md5("doc")), log, "response_id")


def fptf_batch(docs: DataFrame) -> DataFrame:
    """Normalised relevant and other samples of documents (``response_id, type, hash, response_ts, source, doc``)."""
    raw = P.fptf_samples(docs).where(F.col("station_id").isNotNull()).drop("stations")
    raw = raw.withColumnRenamed("type", "response_type").withColumnsRenamed({"operator_id": "operator_key"})
    return N.normalise(raw).withColumn("remarks_hash", F.when(F.col("remarks").isNotNull(), N.remarks_key(F.col("remarks"))))


def ingest_fptf(spark: SparkSession, docs: DataFrame, state: str, profile: Profile = DE_DB, batch_id: int | None = None,
                stations_only_if_null: bool = False, keep_days: int | None = None) -> dict:
    """Ingest a batch of documents (``response_id, type, doc, response_ts, source``) and commit it; the manifest."""
    base = sinks.manifest(spark, state)
    if sinks.committed(base, batch_id):
        return base
    log = table(spark, state, "response_log", LOG, base)
    docs = sinks.read_parts(spark, state, [sinks.write_part(new_responses(docs, log), state, "_new_responses")])
    norm = sinks.read_parts(spark, state, [sinks.write_part(fptf_batch(docs), state, "_new_samples")])
    rel = N.relevant(norm)
    tables: dict[str, list[str]] = {}

    def add(name: str, rows: DataFrame) -> None:
        tables[name] = [*base["tables"].get(name, []), sinks.write_part(rows, state, name)]

    # each stop is parsed once; outer: for an inner one Spark infers a filter on the array's size, and copies the parsing into it
    stops = P.fptf_stops(docs.select("type", "doc")).select(F.explode_outer("stops").alias("stop")).where("stop IS NOT NULL").distinct()
    stations = stops.select(F.inline(P.stations_of(F.array("stop")))).select(*[c.split()[0] for c in STATIONS.split(", ")])
    first = D.first_per_key(stations, "station_id", [F.col("parent").isNull(), F.col("details")])
    tables["station"] = [sinks.write_part(D.upsert(table(spark, state, "station", STATIONS, base), first, "station_id", ["details"],
                                                   stations_only_if_null), state, "station")]
    known = table(spark, state, "remarks", REMARKS, base)
    fresh = rel.where(F.col("remarks_hash").isNotNull()).select("remarks_hash", "remarks").dropDuplicates(["remarks_hash"])
    add("remarks", fresh.join(known.select("remarks_hash"), "remarks_hash", "left_anti"))
    remarks = sinks.read_parts(spark, state, tables["remarks"])
    stored = table(spark, state, "dimension", DIMS, base)
    every, mapped = D.assign_all(stored, rel, DIMENSIONS, {"operator": "operator_name"})
    add("dimension", every.join(stored.select("dim", "key"), ["dim", "key"], "left_anti").select("dim", "id", "key", "name"))
    source = docs.select("response_id", "source")
    add("response_log", N.response_log(norm).join(source, "response_id").select(*[c.split()[0] for c in LOG.split(", ")]))
    null = F.lit(None).cast("smallint")
    rows = mapped.withColumns({"scheduled_duration_minutes": null, "projected_duration_minutes": null})
    rows = rows.withColumn("id", sample_id("trip_id", "station_id", "is_departure", "scheduled_time", "sample_time", "ttl_minutes",
                                           "delay_minutes", "cancelled", "line_name", "operator_id", "load_factor_id", "remarks_hash"))
    parts, more = FO.folded(spark, rows.select(*SAMPLE), remarks, state, base, profile, keep_days)
    return FO.committed(spark, state, base, tables | parts, batch_id, more)


class TimetableUnavailable(RuntimeError):
    """Feeds lie behind the end of the last known timetable version."""


def ingest_gtfs(spark: SparkSession, updates: DataFrame, stop_time_updates: DataFrame, versions: DataFrame, timetable: dict[str, DataFrame],
                stops: DataFrame, state: str, profile: Profile = DE_GTFS, batch_id: int | None = None, tz: str = "UTC", strict: bool = False,
                offline: bool = False, bus_fraction: float = 1.0, keep_days: int | None = None) -> dict:
    """Ingest trip updates with the timetable version valid at their time (S14, G1-G15) and commit; the manifest.

    Feeds without a valid version are left out; with ``strict`` they stop the job before anything is stored. ``offline`` adds a
    sample without realtime for the first feed of each trip and day (G12), ``bus_fraction`` thins buses (G13). Operators
    come with the agencies (G14), stations with the stops (G15).
    """
    base = sinks.manifest(spark, state)
    if sinks.committed(base, batch_id):
        return base
    used = G.versions_in_use(versions, updates, tz=tz)
    tables_ = {name: G.of_versions(df, used) for name, df in timetable.items()}
    tu = G.attach_version(updates, versions, tz=tz).withColumnRenamed("version", G.VERSION).drop("valid_from", "valid_until")
    if strict and not tu.where(F.col(G.VERSION).isNull()).isEmpty():
        raise TimetableUnavailable("feeds without a valid timetable version")
    tu = tu.where(F.col(G.VERSION).isNotNull())
    inst = G.join_timetable(tu, tables_["trips"], tables_["routes"], tables_["agency"], tables_["stop_times"])
    inst = inst if bus_fraction >= 1 else G.bus_thinning(inst, bus_fraction)
    events = G.stop_events(inst, tables_["stop_times"], stops, stop_time_updates, tz)
    if offline:
        off = G.stop_events(G.offline_instances(inst), tables_["stop_times"], stops, None, tz, F.col("offline_sample_time"))
        events = events.unionByName(off)
    small = lambda c: F.col(c).cast("smallint").alias(c)
    null = F.lit(None)
    rows = N.relevant(events).withColumns({
        "load_factor_id": null.cast("smallint"), "remarks_hash": null.cast("string"), "response_id": null.cast("string"),
        "prognosis_type_id": null.cast("smallint"),
        "id": sample_id("trip_id", "station_id", "is_departure", "scheduled_time", "sample_time", "ttl_minutes", "delay_minutes", "cancelled",
                        "stop_number")})
    short = {"scheduled_duration_minutes", "projected_duration_minutes", "delay_minutes", "ttl_minutes"}
    rows = rows.select(*[small(c) if c in short else F.col(c) for c in SAMPLE])
    agencies = timetable["agency"].drop(G.VERSION).distinct()
    operators = D.insert_ignore(table(spark, state, "operator", "operator_id int, id string, name string", base), G.operators(agencies), "id")
    lonlat = G.stations(stops).select("station_id", "name", F.col("lonlat.lon").alias("lon"), F.col("lonlat.lat").alias("lat"), "parent",
                                      F.lit(None).cast("string").alias("details"))
    stations = D.upsert(table(spark, state, "station", STATIONS, base), lonlat, "station_id", ["details"], only_if_null=True)
    tables = {"operator": [sinks.write_part(operators, state, "operator")], "station": [sinks.write_part(stations, state, "station")]}
    parts, more = FO.folded(spark, rows, None, state, base, profile, keep_days)
    return FO.committed(spark, state, base, tables | parts, batch_id, more)
