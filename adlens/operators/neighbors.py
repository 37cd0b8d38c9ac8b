"""All pairs of points within a radius: overlapping latitude strips, local sort, swept window.

Plan, for points in n strips of latitude:

1. A point goes to every strip its square of side `radius` touches (one or two), and
   within a strip to every longitude tile the square touches (one or two). Strips are
   range-partitioned together with their tiles, so a strip through a city is itself cut.
2. Each task sorts its rows by longitude (Spark's spillable sort) and sweeps: the active
   set of a row is the run of rows that follow it within the radius, found by binary
   search over the sorted longitudes of whole batches of tiles.
3. A pair belongs to the one strip and tile that holds the lower corner of the squares'
   overlap. No pair is found twice, so nothing has to be made distinct afterwards.

A tile with more than `hot_rows` rows is cut at quantiles of its longitudes: a slice sweeps
from its own range and sees the rows up to one radius beyond it. Only rows of one and the
same longitude, which no cut can part, are shared out by their id among slices that all see
them. No rows are capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions import geo
from adlens.session import shared_dir

#: Candidates examined at once by a task, so that its memory stays bounded.
CHUNK = 1_000_000
#: Rows of tiles swept at once.
BLOCK = 100_000
#: Tiles to be cut that are broadcast; more are joined.
MAX_HOT = 20_000
#: Quantiles at which a tile may be cut.
GRID = 256


def _sweep(rows: dict[str, np.ndarray], radius: float, window: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs among rows sorted by (tile, longitude); `window` is each row's reach in degrees."""
    lon, lat = rows["lon"], rows["lat"]
    tile = np.cumsum(np.concatenate([[0], rows["edge"][1:].astype(np.int64)]))
    # One axis for all tiles: the gap between two tiles is wider than any window.
    axis = tile * 1000.0 + lon
    end = np.searchsorted(axis, np.minimum(axis + window, tile * 1000.0 + 500.0), side="right")
    count = np.where(rows["own"], np.maximum(end - np.arange(len(lon)) - 1, 0), 0)
    total = np.concatenate([[0], np.cumsum(count)])
    at = 0
    while at < len(lon):
        to = max(at + 1, int(np.searchsorted(total, total[at] + CHUNK, side="right")) - 1)
        low, high = at, to
        at = to
        parts = [(low, high, None)]
        if high - low == 1 and count[low] > CHUNK:  # one row with a very long window
            parts = [(low, high, s) for s in range(0, int(count[low]), CHUNK)]
        for a, b, start in parts:
            if start is None:
                left = np.repeat(np.arange(a, b), count[a:b])
                right = np.arange(len(left)) - np.repeat(total[a:b] - total[a], count[a:b]) + left + 1
            else:
                right = np.arange(a + 1 + start, a + 1 + min(start + CHUNK, int(count[a])))
                left = np.full(len(right), a)
            dlat = (lat[right] - lat[left]) * geo.METRES_PER_DEGREE
            near = np.abs(dlat) <= radius
            left, right, dlat = left[near], right[near], dlat[near]
            dlon = (lon[right] - lon[left]) * geo.METRES_PER_DEGREE * np.cos(np.radians((lat[left] + lat[right]) / 2))
            near = (dlon * dlon + dlat * dlat <= radius * radius) & (rows["group"][left] != rows["group"][right])
            near &= (rows["home_y"][left] | rows["home_y"][right]) & (rows["home_x"][left] | rows["home_x"][right])
            left, right = left[near], right[near]
            yield rows["id"][left], rows["id"][right]


def _sweeper(radius: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            get = {c: table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("id", "lon", "lat", "strip", "tile", "slice", "home_y", "home_x", "own", "reach")}
            get["group"] = table.column("group").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            edge = np.zeros(len(get["id"]), dtype=bool)
            for c in ("strip", "tile", "slice"):
                edge[1:] |= get[c][1:] != get[c][:-1]
            get["edge"] = edge
            for a, b in _sweep(get, radius, get["reach"]):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["id_a", "id_b"])

        def last_edge(batch: pa.RecordBatch) -> int:
            """Start of the tile that the batch ends in; 0 if it has but one."""
            keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("strip", "tile", "slice")]
            same = np.logical_and.reduce([k == k[-1] for k in keys])
            return int(len(same) - np.argmin(same[::-1])) if not same.all() else 0

        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            first = held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in ("strip", "tile", "slice"))
            if first and size >= BLOCK:
                yield from flush(pa.Table.from_batches(held))
                held, size = [], 0
            cut = last_edge(batch)
            if size + cut >= BLOCK and cut:
                yield from flush(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held, size, batch = [], 0, batch.slice(cut)
            held.append(batch)
            size += batch.num_rows
        if held:
            yield from flush(pa.Table.from_batches(held))

    return run


def pairs_within(
    points: DataFrame,
    id_col: str,
    lon: Column,
    lat: Column,
    group: Column,
    radius_m: float,
    strip_m: float = 200.0,
    hot_rows: int = 50_000,
) -> DataFrame:
    """Pairs (`id_a` < `id_b`) of points of different groups at most `radius_m` apart.

    The id must be a unique integer. A point whose id or position is null has no pairs;
    a null group counts as the empty string. Points at one place are a pair; a
    repeated row is a point of its own. An empty table gives no rows. Columns of `points`
    other than the id don't matter, whatever their names. `group` may be any string.
    """
    cell = max(strip_m, 4 * radius_m) / geo.METRES_PER_DEGREE
    half = (radius_m * (1 + 1e-9) + 1e-3) / 2 / geo.METRES_PER_DEGREE
    base = points.select(
        F.col(id_col).cast("long").alias("id"), lon.cast("double").alias("lon"), lat.cast("double").alias("lat"), F.coalesce(group.cast("string"), F.lit("")).alias("group")
    ).filter("id is not null and lon is not null and lat is not null and not isnan(lon) and not isnan(lat)")
    low = F.floor((F.col("lat") - half) / cell)
    strips = base.withColumn("low", low).withColumn("strip", F.explode(F.sequence(F.col("low"), F.floor((F.col("lat") + half) / cell))))
    # Narrowest parallel that the strip's points can lie on, one strip beyond it on either side.
    widest = F.greatest(F.abs(F.col("strip")), F.abs(F.col("strip") + 1)) * cell + 2 * half
    shrink = F.greatest(F.cos(F.radians(F.least(widest, F.lit(90.0)))), F.lit(1e-4))
    strips = strips.withColumn("half_x", F.lit(half) / shrink).withColumn("wide", F.col("half_x") * (cell / half))
    tiles = (
        strips.withColumn("low_x", F.floor((F.col("lon") - F.col("half_x")) / F.col("wide")))
        .withColumn("tile", F.explode(F.sequence(F.col("low_x"), F.floor((F.col("lon") + F.col("half_x")) / F.col("wide")))))
        .select(
            "id", "lon", "lat", "group", "strip", "tile",
            (F.col("low") == F.col("strip")).alias("home_y"), (F.col("low_x") == F.col("tile")).alias("home_x"), (F.col("half_x") * 2).alias("reach"),
        )
    )
    shared_dir(points.sparkSession)
    hot = tiles.groupBy("strip", "tile").agg(F.count("*").alias("n")).filter(F.col("n") > hot_rows).checkpoint()
    n_hot = hot.limit(MAX_HOT + 1).count()
    if n_hot:
        hot = F.broadcast(hot) if n_hot <= MAX_HOT else hot
        cuts = F.percentile_approx("lon", [i / GRID for i in range(1, GRID)], 10_000)
        grid = tiles.join(hot, ["strip", "tile"]).groupBy("strip", "tile").agg(cuts.alias("grid"), F.max("n").alias("n"))
        # As many of the grid's cuts as make slices of about hot_rows rows.
        step = F.greatest(F.lit(1), F.floor(F.lit(GRID) * hot_rows / F.col("n"))).cast("int")
        slices = grid.select("strip", "tile", F.transform(F.sequence(step, F.lit(GRID - 1), step), lambda i: F.element_at("grid", i)).alias("cuts")).checkpoint()
        tiles = tiles.join(F.broadcast(slices) if n_hot <= MAX_HOT else slices, ["strip", "tile"], "left")
        under = lambda x: F.size(F.filter("cuts", lambda c: c < x))
        upto = F.size(F.filter("cuts", lambda c: c <= F.col("lon")))
        tied = upto - under(F.col("lon"))
        mine = F.when(tied >= 2, upto - F.pmod(F.xxhash64("id"), tied.cast("long")).cast("int")).otherwise(upto)
        seen = F.sequence(under(F.col("lon") - F.col("reach") * (1 + 1e-9)), upto)
        cold = F.col("cuts").isNull()
        tiles = tiles.withColumn("mine", F.when(cold, 0).otherwise(mine)).withColumn("slice", F.explode(F.when(cold, F.array(F.lit(0))).otherwise(seen)))
        tiles = tiles.withColumn("own", F.col("mine") == F.col("slice")).drop("mine", "cuts")
    else:
        tiles = tiles.withColumn("slice", F.lit(0)).withColumn("own", F.lit(True))
    # The id makes the order the same in every slice, so that each pair is swept from one of its rows.
    swept = tiles.repartitionByRange("strip", "tile", "slice").sortWithinPartitions("strip", "tile", "slice", "lon", "id")
    return swept.mapInArrow(_sweeper(float(radius_m)), "id_a long, id_b long")


def board_pairs(banners: DataFrame, radius_m: float = 25.0, reach_m: float = 25.0) -> DataFrame:
    """Readings from different panoramas whose boards stand within `radius_m`.

    A board stands `reach_m` from its camera along the bearing. Positions that are null,
    (0, 0) or off the globe have none; a null bearing leaves the board at its camera.
    """
    # The plain ranges reach the scan, where files and row groups off the globe are skipped.
    placed = banners.filter("lon between -180 and 180 and lat between -90 and 90").filter(geo.valid_position(F.col("lon"), F.col("lat")))
    bearing = F.when(F.isnan("bearing_deg"), None).otherwise(F.col("bearing_deg"))
    return pairs_within(
        placed,
        "seq",
        geo.sign_lon(F.col("lon"), F.col("lat"), bearing, reach_m),
        geo.sign_lat(F.col("lat"), bearing, reach_m),
        F.col("panoid"),
        radius_m,
    ).select(F.col("id_a").alias("seq_a"), F.col("id_b").alias("seq_b"))
