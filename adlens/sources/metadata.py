"""Landed panorama metadata as flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.functions import geo
from adlens.functions.text import url_parameter

LINK = "array<struct<Connection: struct<href: string>>>"
SCHEMA = f"""status string, data struct<
  Data: struct<panoramaId: string, timestamp: bigint, Point: struct<coordinates: array<double>>,
    EquirectangularProjection: struct<Origin: array<double>>,
    Images: struct<imageId: string, Tiles: struct<width: int>, Zooms: array<struct<level: int, width: int, height: int>>>>,
  Annotation: struct<Thoroughfares: {LINK}, Connections: {LINK},
    Markers: array<struct<properties: struct<description: string>, geometry: struct<coordinates: array<double>>>>>>"""


def neighbour_oids(annotation: Column) -> Column:
    """Oids of thoroughfares, then connections; order and repeats stay, empty ones go."""
    none = F.array().cast(LINK)
    links = F.concat(F.coalesce(annotation["Thoroughfares"], none), F.coalesce(annotation["Connections"], none))
    return F.filter(F.transform(links, lambda x: url_parameter(x["Connection"]["href"], "oid")), lambda o: o.isNotNull())


def nearest_label(markers: Column, lon: Column, lat: Column) -> Column:
    """Description of the marker nearest in degrees; of equals the first."""
    usable = F.filter(markers, lambda m: (F.coalesce(m["properties"]["description"], F.lit("")) != "") & (F.size(m["geometry"]["coordinates"]) >= 2))

    def key(m: Column, i: Column) -> Column:
        c = m["geometry"]["coordinates"]
        return F.struct((F.pow(c[0] - lon, 2) + F.pow(c[1] - lat, 2)).alias("d"), i.alias("i"), m["properties"]["description"].alias("label"))

    return F.array_min(F.transform(usable, key))["label"]


def parsed(raw: DataFrame, column: str = "value", oid: Column | None = None) -> DataFrame:
    """One row per successful document: flat panorama columns with their defaults.

    Documents that are no JSON, or whose status isn't success, have no row.
    """
    doc = raw.select("*", F.from_json(column, SCHEMA, {"mode": "PERMISSIVE"}).alias("_d")).filter("_d.status = 'success' and _d.data is not null")
    data, note = F.col("_d.data.Data"), F.col("_d.data.Annotation")
    point, origin = data["Point"]["coordinates"], data["EquirectangularProjection"]["Origin"]
    lon, lat = F.get(point, F.lit(0)), F.get(point, F.lit(1))
    return doc.select(
        (oid if oid is not None else data["panoramaId"]).alias("oid"), data["panoramaId"].alias("panoid"), F.col("_d.status").alias("status"),
        lon.alias("lon"), lat.alias("lat"), F.coalesce(data["timestamp"], F.lit(0)).alias("timestamp"), data["Images"]["imageId"].alias("image_id"),
        data["Images"]["Tiles"]["width"].alias("tile_size"), data["Images"]["Zooms"].alias("zooms"),
        F.coalesce(F.get(origin, F.lit(0)), F.lit(0.0)).alias("azimuth_origin"), F.coalesce(F.get(origin, F.lit(1)), F.lit(0.0)).alias("pitch_origin"),
        neighbour_oids(note).alias("neighbor_oids"), nearest_label(note["Markers"], lon, lat).alias("address"),
    )


def landed(spark: SparkSession, path: str) -> DataFrame:
    """Metadata files, one JSON document each."""
    return parsed(spark.read.text(path, wholetext=True))


def page(rows: DataFrame, key: str, skip: int, size: int) -> DataFrame:
    """`size` distinct keys after the first `skip` of them, in order: a page of a fixed sample."""
    return rows.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(key).offset(skip).limit(size)


def rendered(panoramas: DataFrame, beside: str | None = None) -> DataFrame:
    """(oid, value): panoramas written back as metadata documents (for landing and tests).

    With `beside` there are three markers: one farther off before the panorama's own, and
    one at its very place after it, both with that description.
    """
    link = lambda o: F.struct(F.struct(F.concat(F.lit("https://maps.example.net/?oid="), o, F.lit("&z=1")).alias("href")).alias("Connection"))
    data = F.struct(
        F.col("panoid").alias("panoramaId"), "timestamp", F.struct(F.array("lon", "lat").alias("coordinates")).alias("Point"),
        F.struct(F.array("azimuth_origin", "pitch_origin").alias("Origin")).alias("EquirectangularProjection"),
        F.struct(F.col("image_id").alias("imageId"), F.struct(F.col("tile_size").alias("width")).alias("Tiles"), F.col("zooms").alias("Zooms")).alias("Images"),
    )
    mark = F.struct(F.struct(F.col("address").alias("description")).alias("properties"), F.struct(F.array("lon", "lat").alias("coordinates")).alias("geometry"))
    marks = [mark]
    if beside is not None:
        at = lambda lon: F.struct(F.struct(F.lit(beside).alias("description")).alias("properties"), F.struct(F.array(lon, F.col("lat")).alias("coordinates")).alias("geometry"))
        marks = [at(F.col("lon") + 0.001).alias("m"), mark.alias("m"), at(F.col("lon")).alias("m")]
    half = F.floor(F.size("neighbor_oids") / 2).cast("int")
    first = F.slice("neighbor_oids", F.lit(1), F.greatest(half, F.lit(0)))
    rest = F.slice("neighbor_oids", half + 1, F.greatest(F.size("neighbor_oids"), F.lit(0)))
    note = F.struct(F.transform(first, link).alias("Thoroughfares"), F.transform(rest, link).alias("Connections"), F.array(*marks).alias("Markers"))
    return panoramas.select("oid", F.to_json(F.struct("status", F.struct(data.alias("Data"), note.alias("Annotation")).alias("data"))).alias("value"))


def by_oid(frontier: DataFrame, panoramas: DataFrame) -> DataFrame:
    """Metadata of asked oids; unknown and failed ones have no row, of repeated rows the earliest counts."""
    return frontier.select("oid").distinct().join(earliest(panoramas.filter("status = 'success'"), "oid"), "oid")


def earliest(panoramas: DataFrame, key: str) -> DataFrame:
    """The row of the earliest timestamp (if there is one) of each key; of equally early ones the smallest by its values."""
    order = F.struct(*sorted((c for c in panoramas.columns if c != key), key=lambda c: c != "timestamp"))
    return panoramas.groupBy(key).agg(F.min(order).alias("_r")).select(*[F.col(c) if c == key else F.col(f"_r.`{c}`") for c in panoramas.columns])


def by_coordinates(points: DataFrame, panoramas: DataFrame, reach_m: float = 500.0) -> DataFrame:
    """(point columns, panoid, metres) of the panorama nearest to each point within `reach_m`.

    Grid cells of the reach pair candidates; of equals the smallest panoid. Points without
    a position or a panorama in reach have no row. Columns: point_id, lon, lat.
    """
    step = reach_m * 1.001 / geo.METRES_PER_DEGREE
    ok = panoramas.filter("status = 'success'").filter(geo.valid_position(F.col("lon"), F.col("lat")))
    pano = ok.select("panoid", F.col("lon").alias("p_lon"), F.col("lat").alias("p_lat")).distinct()
    # Cells are one step high, and as wide as a step on the row's most polar edge.
    shrink = lambda row: F.greatest(F.cos(F.radians(F.least((F.abs(row) + 2) * step, F.lit(89.9)))), F.lit(1e-3))
    row = F.floor(F.col("p_lat") / step)
    pano = pano.withColumn("row", row).withColumn("col", F.floor(F.col("p_lon") / (F.lit(step) / shrink(F.col("row")))))
    asked = points.filter(geo.valid_position(F.col("lon"), F.col("lat"))).select("point_id", "lon", "lat")
    asked = asked.withColumn("row", F.explode(F.sequence(F.floor(F.col("lat") / step) - 1, F.floor(F.col("lat") / step) + 1)))
    here = F.floor(F.col("lon") / (F.lit(step) / shrink(F.col("row"))))
    asked = asked.withColumn("col", F.explode(F.sequence(here - 1, here + 1)))
    d = geo.distance_m(F.col("lon"), F.col("lat"), F.col("p_lon"), F.col("p_lat"))
    pairs = asked.join(pano, ["row", "col"]).withColumn("metres", d).filter(F.col("metres") <= reach_m)
    return pairs.groupBy("point_id").agg(F.min(F.struct("metres", "panoid")).alias("b")).select("point_id", "b.panoid", "b.metres")
