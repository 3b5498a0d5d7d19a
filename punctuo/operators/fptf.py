"""FPTF documents -> sample rows and stations.

A document is parsed once, by the schema of its envelope, into a column of its own; the realtime stamp is
another column. Its sample sources (trips and legs, board entries and alternatives, movements) are exploded,
each one's metadata becomes plain columns, then its own events and stopovers are exploded as items of one
shape and turned into sample fields in one place. Every step is linear in the entries and row-local.
Stops and remarks stay raw JSON text until an item needs a field of them, so ``details`` and remarks keep
every field. Envelope variants (bare array vs. object) are told apart by the first character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- document schema (subset of FPTF read by the reference) ---------------------
LOC = "struct<type:string,id:string,latitude:double,longitude:double>"
STATION = f"struct<type:string,id:string,name:string,location:{LOC}>"
STOP_FIELDS = f"struct<type:string,id:string,name:string,location:{LOC},station:{STATION},loadFactor:string>"
STOP = "string"     # raw text; STOP_FIELDS where a field is needed
OPER = "struct<type:string,id:string,name:string>"
LINE = f"struct<type:string,id:string,fahrtNr:string,name:string,product:string,productName:string,operator:{OPER}>"
REMARKS = "string"  # raw text
_DEP = ("plannedDeparture:string,departure:string,departureDelay:int,departurePrognosisType:string,"
        "plannedDeparturePlatform:string,departurePlatform:string")
_ARR = ("plannedArrival:string,arrival:string,arrivalDelay:int,arrivalPrognosisType:string,"
        "plannedArrivalPlatform:string,arrivalPlatform:string")
STOPOVER = f"struct<stop:{STOP},{_ARR},{_DEP},cancelled:boolean,remarks:{REMARKS},loadFactor:string>"
ALT = (f"struct<tripId:string,stop:{STOP},origin:{STOP},destination:{STOP},line:{LINE},remarks:{REMARKS},"
       f"when:string,plannedWhen:string,delay:int,cancelled:boolean,loadFactor:string,prognosisType:string,"
       f"platform:string,plannedPlatform:string,previousStopovers:array<{STOPOVER}>,nextStopovers:array<{STOPOVER}>>")
TRIP = (f"struct<id:string,tripId:string,origin:{STOP},destination:{STOP},line:{LINE},remarks:{REMARKS},"
        f"cancelled:boolean,loadFactor:string,walking:boolean,{_DEP},{_ARR},stopovers:array<{STOPOVER}>,"
        f"alternatives:array<{ALT}>>")
MOVEMENT = (f"struct<tripId:string,id:string,line:{LINE},remarks:{REMARKS},cancelled:boolean,loadFactor:string,"
            f"nextStopovers:array<{STOPOVER}>>")
RT = "realtimeDataUpdatedAt:long,realtimeDataFrom:long"
ENVELOPES = {
    "departures_obj": f"struct<departures:array<{ALT}>,{RT}>",
    "arrivals_obj": f"struct<arrivals:array<{ALT}>,{RT}>",
    "board_arr": f"array<{ALT}>",
    "trip": f"struct<trip:{TRIP},{RT}>",
    "journeys": f"struct<journeys:array<struct<legs:array<{TRIP}>>>,{RT}>",
    "refreshJourney": f"struct<journey:struct<legs:array<{TRIP}>>,{RT}>",
    "radar": f"struct<movements:array<{MOVEMENT}>,{RT}>",
    "locations": "array<string>",
}

META_FIELDS = ["trip_id", "remarks", "cancelled", "load_factor", "operator_id", "operator_name", "line_name",
               "line_fahrtnr", "line_id", "product_type", "product_name"]
SAMPLE_FIELDS = META_FIELDS + ["station_id", "scheduled_time", "projected_time", "prognosis_type", "is_departure",
                               "delay_seconds", "scheduled_platform", "projected_platform", "sample_time"]


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c.cast("string") != "")


def _ts(s: Column) -> Column:
    return F.try_to_timestamp(s).cast("timestamp_ntz")  # NULL where it is no date


def data_time(doc: Column) -> Column:
    """realtimeDataUpdatedAt, else realtimeDataFrom (epoch seconds)."""
    a, b = doc["realtimeDataUpdatedAt"], doc["realtimeDataFrom"]
    sec = F.when(a.isNotNull() & (a != 0), a).otherwise(F.when(b != 0, b))
    return F.timestamp_seconds(sec).cast("timestamp_ntz")


def _first_char(c: Column) -> Column:
    return F.substring(F.ltrim(c), 1, 1)


# --- sample sources of a document --------------------------------------------------

SOURCE = (f"struct<kind:string,id:string,tripId:string,line:{LINE},remarks:{REMARKS},cancelled:boolean,loadFactor:string,"
          f"t:{TRIP},a:{ALT},sos:array<{STOPOVER}>,prov:string,dest:string,fb:string,dep:boolean>")


def _source(kind: str, o: Column, sos: Column, **more: Column) -> Column:
    """A trip, board entry or movement in one shape; only trips and movements have an id of their own."""
    null = F.lit(None)
    return F.struct(
        F.lit(kind).alias("kind"), (null if kind == "alt" else o["id"]).alias("id"),
        (o["tripId"]).alias("tripId"), o["line"].alias("line"), o["remarks"].alias("remarks"),
        o["cancelled"].alias("cancelled"), o["loadFactor"].alias("loadFactor"),
        (o.dropFields("stopovers", "alternatives") if kind == "trip" else null).alias("t"),
        (o.dropFields("previousStopovers", "nextStopovers") if kind == "alt" else null).alias("a"),
        sos.alias("sos"), *[more.get(k, null).alias(k) for k in ("prov", "dest", "fb")],
        more.get("dep", null).alias("dep")).cast(_SHAPE)


def _without(kind: str, *names: str) -> str:
    """The struct type ``kind`` without some of its array fields."""
    for n in names:
        at = kind.index(f",{n}:array<")
        depth, i = 0, kind.index("<", at)
        while True:
            depth += {"<": 1, ">": -1}.get(kind[i], 0)
            i += 1
            if not depth:
                break
        kind = kind[:at] + kind[i:]
    return kind


TRIP_OWN = _without(TRIP, "stopovers", "alternatives")
ALT_OWN = _without(ALT, "previousStopovers", "nextStopovers")
_SHAPE = SOURCE.replace(f"t:{TRIP}", f"t:{TRIP_OWN}").replace(f"a:{ALT}", f"a:{ALT_OWN}")


def _alts(arr: Column, dep: Column, fb: Column | None = None) -> Column:
    none = F.array().cast(f"array<{STOPOVER}>")
    return F.transform(F.coalesce(arr, F.array().cast(f"array<{ALT}>")), lambda a: _source(
        "alt", a, F.concat(F.coalesce(a["previousStopovers"], none), F.coalesce(a["nextStopovers"], none)),
        prov=a["origin"], dest=a["destination"], dep=dep, **({} if fb is None else {"fb": fb})))


def _trip(t: Column, through: bool) -> Column:
    """A trip (or leg) and its alternatives; a leg's stopovers don't name its ends as stations."""
    ends = {"prov": t["origin"], "dest": t["destination"]} if through else {}
    return F.concat(F.array(_source("trip", t, t["stopovers"], **ends)), _alts(t["alternatives"], F.lit(True), t["origin"]))


def _legs(legs: Column) -> Column:
    live = F.filter(F.coalesce(legs, F.array().cast(f"array<{TRIP}>")), lambda x: ~F.coalesce(x["walking"], F.lit(False)))
    return F.flatten(F.transform(live, lambda x: _trip(x, False)))


def _parsed(docs: DataFrame, keep: list[str], t: Column, d: Column) -> DataFrame:
    """``keep`` plus one column per envelope, NULL for all but the document's own."""
    is_arr = _first_char(d) == "["
    wanted = {
        "_dep_arr": ("board_arr", (t == "departures") & is_arr), "_dep": ("departures_obj", (t == "departures") & ~is_arr),
        "_arr_arr": ("board_arr", (t == "arrivals") & is_arr), "_arr": ("arrivals_obj", (t == "arrivals") & ~is_arr),
        "_trip": ("trip", t == "trip"), "_jr": ("journeys", t == "journeys"), "_rj": ("refreshJourney", t == "refreshJourney"),
        "_rd": ("radar", (t == "radar") & ~is_arr)}
    return docs.select(*keep, *[F.when(c, F.from_json(d, ENVELOPES[e])).alias(n) for n, (e, c) in wanted.items()])


def _source_array() -> Column:
    """All sample sources of a parsed document."""
    yes, no = F.lit(True), F.lit(False)
    none = F.array().cast(f"array<{_SHAPE}>")
    mv = F.transform("_rd.movements", lambda m: _source("mv", m, m["nextStopovers"]))
    by = [("_dep_arr", _alts(F.col("_dep_arr"), yes)), ("_dep", _alts(F.col("_dep.departures"), yes)),
          ("_arr_arr", _alts(F.col("_arr_arr"), no)), ("_arr", _alts(F.col("_arr.arrivals"), no)),
          ("_trip", _trip(F.col("_trip.trip"), True)),
          ("_jr", F.flatten(F.transform("_jr.journeys", lambda j: _legs(j["legs"])))),
          ("_rj", _legs(F.col("_rj.journey.legs"))), ("_rd", mv)]
    out = none
    for name, value in reversed(by):
        out = F.when(F.col(name).isNotNull(), value).otherwise(out)
    return F.coalesce(out, none)


def _sources(x: DataFrame, keep: list[str]) -> DataFrame:
    """One row per sample source: ``keep``, ``_st`` (realtime stamp) and ``_o``.

    The stamp is exploded along with its source. As a column beside them, Spark would move a filter on it below the parsing
    and copy the parsing, and with it the making of the documents, into the filter for every field of a stamp that it reads.
    """
    st = F.coalesce(*[data_time(F.col(n)) for n in ("_dep", "_arr", "_trip", "_jr", "_rj", "_rd")])
    stamped = F.transform(_source_array(), lambda o: F.struct(st.alias("st"), o.alias("o")))
    return x.select(*keep, F.explode(stamped).alias("_s")).select(*keep, F.col("_s.st").alias("_st"), F.col("_s.o").alias("_o"))


# --- items: own events and stopovers in one shape --------------------------------------

def _item(stop: Column, o: Column, pre: str, dep: Column, cancelled: Column, remarks: Column, others: list[Column],
          fb: Column | None = None) -> Column:
    """The fields of an event, whatever it comes from (``pre``: arrival, departure or a board entry's bare names)."""
    cap = pre.capitalize()
    names = (("plannedWhen", "when", "prognosisType", "delay", "plannedPlatform", "platform") if not pre else
             (f"planned{cap}", pre, f"{pre}PrognosisType", f"{pre}Delay", f"planned{cap}Platform", f"{pre}Platform"))
    kinds = ("planned", "actual", "prognosis", "delay", "planned_platform", "platform")
    return F.struct(stop.alias("stop"), *[o[n].alias(k) for n, k in zip(names, kinds)], dep.alias("dep"),
                    F.coalesce(cancelled, F.lit(False)).alias("cancelled"), o["loadFactor"].alias("own_load"), remarks.alias("remarks"),
                    F.array(stop, *others, *([] if fb is None else [fb])).alias("stations"),
                    (F.lit(None).cast("string") if fb is None else fb).alias("fb"))


def _items(o: Column) -> Column:
    t, a = o["t"], o["a"]

    def stopover(so: Column) -> Column:
        rem = F.coalesce(so["remarks"], o["remarks"])
        return F.array(
            F.when(_truthy(so["plannedDeparture"]), _item(so["stop"], so, "departure", F.lit(True), so["cancelled"], rem, [o["prov"]])),
            F.when(_truthy(so["plannedArrival"]), _item(so["stop"], so, "arrival", F.lit(False), so["cancelled"], rem, [o["dest"]])))

    trip = F.array(_item(t["origin"], t, "departure", F.lit(True), t["cancelled"] & ~_truthy(t["departure"]), o["remarks"], []),
                   _item(t["destination"], t, "arrival", F.lit(False), t["cancelled"] & ~_truthy(t["arrival"]), o["remarks"], []))
    alt = F.array(_item(a["stop"], a, "", o["dep"], a["cancelled"], o["remarks"], [a["destination"], a["origin"]], o["fb"]))
    along = F.flatten(F.transform(F.coalesce(o["sos"], F.array().cast(f"array<{STOPOVER}>")), stopover))
    # one array of all, the parts that an object hasn't being NULL items
    return F.filter(F.concat(F.when(o["kind"] == "trip", trip).otherwise(F.slice(trip, 1, 0)),
                             F.when(o["kind"] == "alt", alt).otherwise(F.slice(alt, 1, 0)), along), lambda i: i.isNotNull())


def fptf_samples(docs: DataFrame, type_col: str = "type", doc_col: str = "doc") -> DataFrame:
    """Dispatch each response document by type, flatten to raw sample rows (one scan).

    Output: response columns + one row per sample (``SAMPLE_FIELDS`` and ``stations``, raw stops).
    """
    keep = [c for c in docs.columns if c != doc_col]
    x = _sources(_parsed(docs, keep, F.col(type_col), F.col(doc_col)), keep)
    o = F.col("_o")
    trip_id = F.when(_truthy(o["tripId"]), o["tripId"]).when(_truthy(o["id"]), o["id"])
    x = x.select(*keep, "_st", trip_id.alias("trip_id"), o["line"].alias("_line"), F.explode(_items(o)).alias("_i"))
    x = x.withColumn("_stop", F.from_json("_i.stop", "struct<id:string,loadFactor:string>"))
    i, stop, line = F.col("_i"), F.col("_stop"), F.col("_line")
    station = F.when(_truthy(stop["id"]), stop["id"]).otherwise(F.get_json_object(i["fb"], "$.id"))
    vals = {
        "trip_id": F.col("trip_id"), "remarks": i["remarks"], "cancelled": i["cancelled"],
        "load_factor": F.when(_truthy(stop["loadFactor"]), stop["loadFactor"]).otherwise(i["own_load"]),
        "operator_id": line["operator"]["id"], "operator_name": line["operator"]["name"], "line_name": line["name"],
        "line_fahrtnr": line["fahrtNr"], "line_id": line["id"], "product_type": line["product"],
        "product_name": line["productName"], "station_id": station, "scheduled_time": _ts(i["planned"]),
        "projected_time": _ts(i["actual"]), "prognosis_type": i["prognosis"], "is_departure": i["dep"],
        "delay_seconds": i["delay"], "scheduled_platform": i["planned_platform"], "projected_platform": i["platform"],
        "sample_time": F.col("_st")}
    return x.select(*keep, *[vals[n].alias(n) for n in SAMPLE_FIELDS], i["stations"].alias("stations"))


def stations_of(stops: Column) -> Column:
    """List of raw stops -> station rows; skip NULL and ``location``; parent before child; ``details`` in full."""
    def one(raw):
        s = F.from_json(raw, STOP_FIELDS)
        st = s["station"]
        parent = F.when(st.isNotNull(), F.struct(
            st["id"].alias("station_id"), st["name"].alias("name"), st["location"]["longitude"].alias("lon"),
            st["location"]["latitude"].alias("lat"), F.lit(None).cast("string").alias("parent"),
            F.get_json_object(raw, "$.station").alias("details")))
        child = F.struct(s["id"].alias("station_id"), s["name"].alias("name"),
                         s["location"]["longitude"].alias("lon"), s["location"]["latitude"].alias("lat"),
                         st["id"].alias("parent"), raw.alias("details"))
        return F.when(raw.isNull() | (F.coalesce(s["type"], F.lit("")) == "location"), F.array()).otherwise(
            F.filter(F.array(parent, child), lambda x: x.isNotNull()))
    return F.flatten(F.transform(F.coalesce(stops, F.array().cast("array<string>")), one))


def _source_stops(o: Column) -> Column:
    """The raw stops that the items of a sample source name (``stations`` of ``_items``)."""
    none = F.array().cast("array<string>")
    trip = F.when(o["kind"] == "trip", F.array(o["t"]["origin"], o["t"]["destination"])).otherwise(none)
    alt = F.when(o["kind"] == "alt", F.array(o["a"]["stop"], o["a"]["destination"], o["a"]["origin"], o["fb"])).otherwise(none)
    along = F.transform(F.coalesce(o["sos"], F.array().cast(f"array<{STOPOVER}>")), lambda so: F.concat(
        F.when(_truthy(so["plannedDeparture"]), F.array(so["stop"], o["prov"])).otherwise(none),
        F.when(_truthy(so["plannedArrival"]), F.array(so["stop"], o["dest"])).otherwise(none)))
    return F.concat(trip, alt, F.flatten(along))


def fptf_stops(docs: DataFrame, type_col: str = "type", doc_col: str = "doc") -> DataFrame:
    """P3 + P11: ``stops``, the different raw stops that a document names (its samples, or a ``locations`` document); row-local."""
    keep = [c for c in docs.columns if c != doc_col]
    t, d = F.col(type_col), F.col(doc_col)
    named = F.flatten(F.transform(_source_array(), _source_stops))
    samples = _parsed(docs, keep, t, d).select(*keep, F.array_distinct(named).alias("stops"))
    locs = docs.where(t == "locations").select(*keep, F.array_distinct(F.from_json(d, ENVELOPES["locations"])).alias("stops"))
    return samples.unionByName(locs)  # no filter on the array: Spark would copy all of its making, the parsing too, into it


def fptf_stations(docs: DataFrame, type_col: str = "type", doc_col: str = "doc") -> DataFrame:
    """P3 + P11: stations seen per response (from samples and ``locations`` documents), each once.

    What is dealt out by response are a document's different raw stops in one row; they become station rows behind that, where
    making them distinct needs no further shuffle.
    """
    keep = [c for c in docs.columns if c != doc_col]
    stops = fptf_stops(docs, type_col, doc_col).repartition(*keep)
    return stops.select(*keep, F.inline(F.array_distinct(stations_of(F.col("stops"))))).distinct()
