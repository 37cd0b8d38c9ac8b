"""Seed points: regular lattices and points along roads."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.functions import geo

# Classes of roads along which boards stand.
ROAD_CLASSES = ("motorway", "trunk", "primary", "secondary", "tertiary")


def lattice(spark: SparkSession, bbox: tuple[float, float, float, float], step_m: float = 150.0) -> DataFrame:
    """(lon, lat) of a lattice over the box, edges included, row by row from the south-west.

    Both axes come from one range of numbers, so the lattice is made in parallel.
    """
    west, south, east, north = bbox
    dlat = step_m / geo.METRES_PER_DEGREE
    dlon = step_m / (geo.METRES_PER_DEGREE * math.cos(math.radians((south + north) / 2)))
    rows, cols = math.floor((north - south) / dlat) + 1, math.floor((east - west) / dlon) + 1
    if rows <= 0 or cols <= 0:
        return spark.createDataFrame([], "lon double, lat double")
    i = spark.range(rows * cols)
    return i.select((F.lit(west) + (F.col("id") % cols) * dlon).alias("lon"), (F.lit(south) + F.floor(F.col("id") / cols) * dlat).alias("lat"))


def along_roads(roads: DataFrame, step_m: float = 40.0, classes: tuple[str, ...] | None = ROAD_CLASSES) -> DataFrame:
    """(lon, lat) about every `step_m` along polylines, both ends included, rounded places once.

    Columns: way_id, highway, pts array<struct<lon,lat>>. Lines without length give nothing;
    null lines are skipped. Points equal to five decimals are one, the first of the lowest
    way. Places along a line are shares of its length in degrees, as for planar lines.
    """
    lines = roads if classes is None else roads.filter(F.col("highway").isin(list(classes)))
    p = F.col("pts")
    n_legs = F.greatest(F.size(p) - 1, F.lit(0))
    legs = F.zip_with(
        F.slice(p, F.lit(1), n_legs), F.slice(p, F.lit(2), n_legs),
        lambda a, b: F.struct(a["lon"].alias("x0"), a["lat"].alias("y0"), b["lon"].alias("x1"), b["lat"].alias("y1"), F.sqrt(F.pow(b["lon"] - a["lon"], 2) + F.pow(b["lat"] - a["lat"], 2)).alias("deg")),
    )
    lines = lines.filter(F.size("pts") >= 2).withColumn("legs", legs).withColumn("metres", geo.polyline_metres(p))
    lines = lines.withColumn("total", F.aggregate("legs", F.lit(0.0), lambda s, x: s + x["deg"])).filter("total > 0")
    n = F.greatest(F.lit(1), F.floor(F.col("metres") / step_m).cast("int"))
    at = lines.withColumn("n", n).select("way_id", "legs", "total", "n", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("k"))
    goal = F.col("k") / F.col("n") * F.col("total")
    # Walk the legs until the goal lies within one.
    start = F.struct(F.lit(0.0).alias("run"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))

    def step(s, leg):
        t = F.least(F.greatest(F.try_divide(goal - s["run"], leg["deg"]), F.lit(0.0)), F.lit(1.0))
        here = s["x"].isNull() & (leg["deg"] > 0) & (goal <= s["run"] + leg["deg"] * (1 + 1e-12))
        return F.struct(
            (s["run"] + leg["deg"]).alias("run"),
            F.when(here, leg["x0"] + (leg["x1"] - leg["x0"]) * t).otherwise(s["x"]).alias("x"),
            F.when(here, leg["y0"] + (leg["y1"] - leg["y0"]) * t).otherwise(s["y"]).alias("y"),
        )

    end = F.element_at("legs", -1)
    found = at.withColumn("s", F.aggregate("legs", start, step))
    found = found.select("way_id", "k", F.coalesce("s.x", end["x1"]).alias("lon"), F.coalesce("s.y", end["y1"]).alias("lat"))
    first = found.groupBy(F.bround("lon", 5).alias("_x"), F.bround("lat", 5).alias("_y")).agg(F.min_by(F.struct("lon", "lat"), F.struct("way_id", "k")).alias("p"))
    return first.select("p.lon", "p.lat")
