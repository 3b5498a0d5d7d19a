"""Station enrichment.

T1 collects the distinct lines per station with ``collect_set`` after a
``distinct`` on (station, line): the aggregate buffer per station is bounded
by the number of lines serving it, not by its sample count, and the partial
aggregation de-duplicates map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371 * 1000     # spherical law of cosines, metres
REPAIR_DISTANCE_M = 300          # positions further than this from the official list are repaired


def geo_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres (argument of acos clamped to [-1, 1])."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dl = F.radians(lon2 - lon1)
    x = F.sin(p1) * F.sin(p2) + F.cos(p1) * F.cos(p2) * F.cos(dl)
    x = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x))
    return F.acos(x) * F.lit(float(EARTH_RADIUS_M))


def station_lines(station: DataFrame, sample: DataFrame) -> DataFrame:
    """Every station with the sorted distinct set of lines seen there (NULL when none)."""
    lines = (sample.select("station_id", "line_name").where(F.col("line_name").isNotNull()).distinct()
             .groupBy("station_id").agg(F.array_sort(F.collect_set("line_name")).alias("lines")))
    return station.join(lines, "station_id", "left")


def read_official_stations(spark, path: str) -> DataFrame:
    """``;``-separated official list with decimal commas."""
    raw = spark.read.csv(path, sep=";", header=True)
    return official_from_raw(raw)


def official_from_raw(raw: DataFrame) -> DataFrame:
    def num(c):
        return F.regexp_replace(F.col(c), ",", ".").try_cast("double")  # NULL where it is no number
    return raw.select(F.col("EVA_NR").cast("string").alias("eva"), F.col("IFOPT").alias("ifopt"),
                      F.col("NAME").alias("name"), num("Laenge").alias("lon"), num("Breite").alias("lat"))


def repair_positions(stations: DataFrame, official: DataFrame, metres: float = REPAIR_DISTANCE_M) -> DataFrame:
    """Attach the official id, repair positions further than ``metres``, default weight 1."""
    o = official.select(F.col("eva").alias("station_id"), F.col("ifopt"), F.col("lon").alias("o_lon"),
                        F.col("lat").alias("o_lat"), F.col("name").alias("o_name"))
    j = stations.join(o, "station_id", "left")
    d = geo_distance(F.col("lon"), F.col("lat"), F.col("o_lon"), F.col("o_lat"))
    repaired = F.col("o_lon").isNotNull() & F.col("o_lat").isNotNull() & (d > F.lit(float(metres)))
    return j.select(
        "station_id", "name",
        F.when(repaired, F.col("o_lon")).otherwise(F.col("lon")).alias("lon"),
        F.when(repaired, F.col("o_lat")).otherwise(F.col("lat")).alias("lat"),
        F.col("ifopt").alias("official_id"),
        F.coalesce(F.col("weight"), F.lit(1.0)).alias("weight") if "weight" in stations.columns
        else F.lit(1.0).alias("weight"),
        F.coalesce(repaired, F.lit(False)).alias("repaired"),
        F.when(F.col("o_lon").isNotNull(), d).alias("distance_m"))


DETAILS = "struct<id:string,name:string,type:string,location:struct<latitude:double,longitude:double>,weight:double>"


def documents(stations: DataFrame, official: DataFrame, lines: DataFrame | None = None, metres: float = REPAIR_DISTANCE_M) -> DataFrame:
    """T1 + T3 as they are exported: a station's details, or a synthesised object where it has none, enriched.

    ``stations`` has ``station_id, name, lon, lat, details`` (JSON or NULL); ``lines`` has ``station_id, lines``. The official
    entry is found by the details' id. Fields that the details lack come from the station; ``repaired`` marks those whose
    position was replaced (``position`` holds the one before).
    """
    d = F.from_json("details", DETAILS)
    own = stations.select("station_id", F.coalesce(d["id"], F.col("station_id")).alias("id"), F.coalesce(d["name"], F.col("name")).alias("name"),
                          F.coalesce(d["type"], F.lit("station")).alias("type"),
                          F.coalesce(d["location"]["longitude"], F.col("lon")).alias("lon"),
                          F.coalesce(d["location"]["latitude"], F.col("lat")).alias("lat"), d["weight"].alias("weight"))
    o = official.select(F.col("eva").alias("id"), "ifopt", F.col("lon").alias("o_lon"), F.col("lat").alias("o_lat"))
    j = own.join(o, "id", "left")
    j = j.join(lines, "station_id", "left") if lines is not None else j.withColumn("lines", F.lit(None).cast("array<string>"))
    far = F.coalesce(geo_distance(F.col("lon"), F.col("lat"), F.col("o_lon"), F.col("o_lat")) > F.lit(float(metres)), F.lit(False))
    place = lambda lon, lat: F.struct(F.lit("location").alias("type"), F.col("id").alias("id"), lat.alias("latitude"), lon.alias("longitude"))
    return j.select(
        "station_id", F.struct(
            "id", "name", "type", place(F.when(far, F.col("o_lon")).otherwise(F.col("lon")),
                                        F.when(far, F.col("o_lat")).otherwise(F.col("lat"))).alias("location"),
            F.col("ifopt").alias("ifoptId"), F.transform("lines", lambda x: F.struct(x.alias("name"))).alias("lines"),
            F.when(F.coalesce("weight", F.lit(0.0)) != 0, F.col("weight")).otherwise(1.0).alias("weight")).alias("details"),
        far.alias("repaired"), place(F.col("lon"), F.col("lat")).alias("position"))


def missing_stations(stations: DataFrame, official: DataFrame) -> DataFrame:
    """T4: official stations (with a valid latitude) absent from ours."""
    o = official.where(F.col("lat").isNotNull() & ~F.isnan("lat"))
    return o.join(stations.select(F.col("station_id").alias("eva")), "eva", "left_anti")
