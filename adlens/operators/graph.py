"""Walks over the panorama graph, level by level.

A first-in-first-out walk empties one level before the next, so a level is one join of the
frontier with the metadata, and the order (level, place of the parent, place among its
neighbours) reproduces the sequential order. Levels are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlens.functions import geo
from adlens.operators.ranking import first_of_key
from adlens.session import shared_dir

Box = tuple[float, float, float, float]


def usable(panoramas: DataFrame) -> DataFrame:
    """One successful row of each oid: the earliest, of equally early ones the first by its values."""
    ok = panoramas.filter("status = 'success' and oid is not null and panoid is not null")
    columns = ("panoid", "lon", "lat", "neighbor_oids")
    stamp = F.col("timestamp").cast("long") if "timestamp" in panoramas.columns else F.lit(0)
    first = F.min(F.struct(stamp.alias("at"), *columns)).alias("r")
    return ok.groupBy("oid").agg(first).select("oid", *[f"r.{c}" for c in columns])


def nearest(panoramas: DataFrame, lon: float, lat: float) -> DataFrame:
    """The one panorama nearest to a point; of equals the smallest panoid."""
    d = geo.distance_m(F.col("lon"), F.col("lat"), F.lit(lon), F.lit(lat))
    return panoramas.withColumn("metres", d).filter("metres is not null").orderBy("metres", "panoid").limit(1)


def walk(panoramas: DataFrame, lon: float, lat: float, bbox: Box | None = None, max_nodes: int | None = None, local_nodes: int = 200_000) -> DataFrame:
    """(panoid, level, place) of the panoramas reached from the one nearest to (lon, lat).

    Panoramas outside the box are reached but neither given nor expanded. `max_nodes` stops
    the walk once more than so many have been seen, checked before each is taken. Unknown
    oids and failed metadata are skipped; several oids of a panorama are one node, cycles
    end by themselves; an empty table gives no rows. Graphs of at most `local_nodes` rows
    are walked by one task, larger ones by a join per level, with equal results.
    """
    spark = panoramas.sparkSession
    shared_dir(spark)
    meta = usable(panoramas).checkpoint()
    if meta.count() <= local_nodes:
        return _walk_in_task(meta, lon, lat, bbox, max_nodes)
    links = meta.select(F.col("panoid").alias("parent"), F.posexplode("neighbor_oids").alias("pos", "oid")).checkpoint()
    inside = geo.in_bbox(F.col("lon"), F.col("lat"), bbox)
    front = nearest(meta, lon, lat).select("panoid", "lon", "lat").withColumn("place", F.lit(0).cast("long")).checkpoint()
    seen, total, done = front.select("panoid"), front.count(), []
    level = 0
    while total and (max_nodes is None or total <= max_nodes):
        steps = front.filter(inside).select(F.col("panoid").alias("parent"), F.col("place").alias("from")).join(links, "parent").join(meta, "oid")
        new = steps.select("panoid", "lon", "lat", F.struct("from", "pos").alias("order")).join(seen, "panoid", "left_anti")
        new = first_of_key(new, ["panoid"], "order").checkpoint()
        n = new.count()
        given = front.filter(inside)
        if max_nodes is not None and total + n > max_nodes:
            # The node whose neighbours exceed the limit is the last one taken.
            last = new.orderBy("order").limit(max_nodes - total + 1).agg(F.max("order.from")).first()[0]
            done.append(given.filter(F.col("place") <= last).select("panoid", F.lit(level).alias("level"), "place"))
            break
        done.append(given.select("panoid", F.lit(level).alias("level"), "place"))
        if not n:
            break
        front = numbered(new, ["panoid", "lon", "lat"], "order", rows_known=n)
        seen = seen.unionByName(front.select("panoid"))
        if level % 8 == 7:
            seen = seen.checkpoint()
        total += n
        level += 1
    if not done:
        return spark.createDataFrame([], "panoid string, level int, place long")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _walk_in_task(meta: DataFrame, lon: float, lat: float, bbox: Box | None, max_nodes: int | None) -> DataFrame:
    start = nearest(meta, lon, lat).select("panoid").first()
    if start is None:
        return meta.sparkSession.createDataFrame([], "panoid string, level int, place long")

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        panoid, nodes = {}, {}
        for df in batches:
            for r in df.sort_values("oid").itertuples():
                panoid[r.oid] = r.panoid
                at, links = nodes.get(r.panoid, ((r.lon, r.lat), []))
                nodes[r.panoid] = (at, links + ([] if r.neighbor_oids is None else list(r.neighbor_oids)))
        seen, out, level, front = {start.panoid}, [], 0, [start.panoid]
        while front:
            later: list[str] = []
            for place, p in enumerate(front):
                if max_nodes is not None and len(seen) > max_nodes:
                    later = []
                    break
                (x, y), links = nodes[p]
                if bbox and not (bbox[0] <= x <= bbox[2] and bbox[1] <= y <= bbox[3]):
                    continue
                out.append((p, level, place))
                for q in (panoid.get(o) for o in links):
                    if q is not None and q not in seen:
                        seen.add(q)
                        later.append(q)
            front, level = later, level + 1
        yield pd.DataFrame(out, columns=["panoid", "level", "place"])

    return meta.coalesce(1).mapInPandas(task, "panoid string, level int, place long")


#: Rows that one task may number.
SMALL = 50_000


def numbered(rows: DataFrame, columns: list[str], order: str, name: str = "place", start: int = 0, rows_known: int | None = None) -> DataFrame:
    """Rows with dense numbers in the order of a column, without sorting many in one task.

    Range partitions are sorted in parallel; only their sizes meet on the driver. Few rows
    (`rows_known`) are numbered by one task, which saves two jobs a level.
    """
    if rows_known is not None and rows_known <= SMALL:
        place = F.row_number().over(Window.orderBy(order)).cast("long") + (start - 1)
        return rows.select(*columns, place.alias(name))
    ordered = rows.repartitionByRange(F.col(order)).sortWithinPartitions(order)
    ordered = ordered.select(*columns, F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")).checkpoint()
    sizes = ordered.groupBy("_part").agg(F.count("*").alias("n"), F.min("_row").alias("base")).collect()
    if not sizes:
        return rows.select(*columns, F.lit(start).cast("long").alias(name))
    at, shift = start, {}
    for r in sorted(sizes, key=lambda r: r._part):
        shift[r._part] = at - r.base
        at += r.n
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in shift.items() for x in kv]), F.col("_part"))
    return ordered.select(*columns, (F.col("_row") + offset).cast("long").alias(name))
