import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from adlens.operators.neighbors import board_pairs, pairs_within


def metres(a, b):
    dx = (b[0] - a[0]) * 111320 * math.cos(math.radians((a[1] + b[1]) / 2))
    return math.hypot(dx, (b[1] - a[1]) * 111320)


def brute(rows, radius):
    out = set()
    for i, (ia, xa, ya, ga) in enumerate(rows):
        for ib, xb, yb, gb in rows[i + 1 :]:
            if ga != gb and metres((xa, ya), (xb, yb)) <= radius:
                out.add((min(ia, ib), max(ia, ib)))
    return out


def found(df, radius, **kw):
    p = pairs_within(df, "id", F.col("lon"), F.col("lat"), F.col("g"), radius, **kw)
    rows = [tuple(r) for r in p.collect()]
    assert len(rows) == len(set(rows)), "a pair has one owner"
    return set(rows)


def test_random_points_equal_brute_force(spark):
    r = random.Random(1)
    for lat0 in (0.0, 45.0, -72.0, 89.99):
        rows = [(i, 10 + r.uniform(0, 0.004), min(90.0, lat0 + r.uniform(0, 0.003)), str(r.randrange(40))) for i in range(400)]
        df = spark.createDataFrame(rows, "id long, lon double, lat double, g string").repartition(5)
        assert found(df, 25.0) == brute(rows, 25.0)


def test_hot_tile_is_sliced_without_loss(spark):
    r = random.Random(2)
    rows = [(i, 10 + r.uniform(0, 0.001), 45 + r.uniform(0, 0.001), str(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, lon double, lat double, g string")
    assert found(df, 25.0, hot_rows=20) == brute(rows, 25.0)


def test_ties_nulls_and_empty(spark):
    rows = [(1, 1.0, 1.0, "a"), (2, 1.0, 1.0, "b"), (3, 1.0, 1.0, "a"), (4, None, 1.0, "c"), (None, 1.0, 1.0, "d"), (5, float("nan"), 1.0, "e"), (6, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "id long, lon double, lat double, g string")
    assert found(df, 25.0) == {(1, 2), (2, 3), (1, 6), (2, 6), (3, 6)}
    assert found(df.limit(0), 25.0) == set()


def test_boards_stand_along_the_bearing(spark):
    rows = [
        (1, "a", 38.0, 45.0, 0.0), (2, "b", 38.0, 45.0 + 50 / 111320, 180.0), (3, "c", 38.0, 45.0, 180.0),
        (4, "d", 0.0, 0.0, None), (5, "e", 200.0, 45.0, None), (6, "f", 38.0, 45.0 + 25 / 111320, None),
    ]
    df = spark.createDataFrame(rows, "seq long, panoid string, lon double, lat double, bearing_deg double")
    df = df.withColumn("id", F.lit("clash")).withColumn("strip", F.lit(1)).withColumn("tile", F.lit(1))
    assert {tuple(r) for r in board_pairs(df).collect()} == {(1, 2), (1, 6), (2, 6)}


def test_crowds_of_one_longitude_are_shared_out(spark):
    r = random.Random(5)
    lons = [10.0, 10.0003, 10.0003, 10.0005]
    rows = [(i, r.choice(lons) if i % 4 else 10 + r.uniform(0, 0.001), 45 + r.uniform(0, 0.002), str(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, lon double, lat double, g string").repartition(6)
    for hot_rows in (10, 60):
        assert found(df, 25.0, hot_rows=hot_rows) == brute(rows, 25.0)


def test_half_a_million_points_in_one_tile(spark):
    """One tile, ten slices: the pairs are those of a grid in numpy."""
    n, radius = 500_000, 3.0
    rng = np.random.default_rng(3)
    lon, lat = 10 + rng.uniform(0, 0.9, n), 1.0 + rng.uniform(0, 0.9, n)
    x, y = lon * 111320, lat * 111320
    cell = {}
    for i, key in enumerate(zip((x // 4).astype(int).tolist(), (y // 4).astype(int).tolist())):
        cell.setdefault(key, []).append(i)
    want = set()
    for (a, b), own in cell.items():
        near = [j for da in (-1, 0, 1) for db in (-1, 0, 1) for j in cell.get((a + da, b + db), ())]
        want |= {(i, j) for i in own for j in near if i < j and metres((lon[i], lat[i]), (lon[j], lat[j])) <= radius}
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "lon": lon, "lat": lat})).withColumn("g", F.col("id"))
    assert found(df, radius, strip_m=250_000.0) == want and len(want) > 100
