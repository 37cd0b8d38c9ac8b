import math
import random

from pyspark.sql import functions as F

from adlens.operators.greedy import first_fit, first_fit_boards, spaced


def board(lon, lat, bearing):
    if bearing is None:
        return lon, lat
    a = math.radians(bearing)
    return lon + 25 * math.sin(a) / (111320 * max(0.1, math.cos(math.radians(lat)))), lat + 25 * math.cos(a) / 111320


def metres(x0, y0, x1, y1):
    return math.hypot((x1 - x0) * 111320 * math.cos(math.radians((y0 + y1) / 2)), (y1 - y0) * 111320)


def sequential(rows, groups=None, cap=None):
    kept, taken = [], {}
    for seq, lon, lat, bearing, phones in rows:
        if groups and taken.get(groups[seq], 0) >= cap:
            continue
        x, y = board(lon, lat, bearing)
        r, clash = 325 / 111320, False
        for _, klon, klat, kb, kp in kept:
            if not (abs(klat - lat) <= r and abs(klon - lon) <= r / max(0.1, math.cos(math.radians(lat)))):
                continue
            d = metres(*board(klon, klat, kb), x, y)
            if set(phones or ()) & set(kp or ()):
                clash |= d <= 300
            else:
                clash |= d <= 25
        if not clash:
            kept.append((seq, lon, lat, bearing, phones))
            if groups and groups[seq] is not None:
                taken[groups[seq]] = taken.get(groups[seq], 0) + 1
    return {k[0] for k in kept}


SCHEMA = "seq long, lon double, lat double, bearing_deg double, phones array<string>"


def random_rows(r, n):
    return [(i, 38 + r.uniform(0, 0.008), 45 + r.uniform(0, 0.006), r.choice([None, r.uniform(0, 360)]), r.choice([None, [], ["1"], ["2", "3"], ["3"], [str(r.randrange(30))]])) for i in range(n)]


def test_first_fit_equals_the_sequential_loop(spark):
    r = random.Random(7)
    rows = random_rows(r, 250)
    for parts in (1, 6):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        got = first_fit_boards(df)
        assert {x.seq for x in got.collect()} == sequential(rows)


def test_batches_against_a_store_equal_one_run_and_idempotent(spark):
    rows = random_rows(random.Random(8), 160)
    a, b = (spark.createDataFrame(x, SCHEMA) for x in (rows[:90], rows[90:]))
    first = first_fit_boards(a).checkpoint()
    second = first_fit_boards(b, first)
    assert {x.seq for x in first.unionByName(second).collect()} == sequential(rows)
    assert first_fit_boards(a, first).count() == 0


def test_copies_of_a_spot_make_no_edges(spark):
    rows = random_rows(random.Random(12), 60)
    rows += [(1000 + i, *rows[5][1:]) for i in range(400)] + [(2000, None, None, None, ["1"]), (2001, None, None, None, ["1"])]
    got = {x.seq for x in first_fit_boards(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == sequential(rows[:-2]) | {2000, 2001}


def test_a_row_over_the_cap_rejects_nothing(spark):
    """Two boards of one panorama, a third beside the second: the loop keeps 1 and 3 at cap 1."""
    rows = [(1, 38.0, 45.0, None, None), (2, 38.01, 45.0, None, None), (3, 38.01, 45.0001, None, None)]
    df = spark.createDataFrame([(*x, p) for x, p in zip(rows, "aab")], SCHEMA + ", panoid string")
    assert {x.seq for x in first_fit_boards(df, group="panoid", cap=1).collect()} == {1, 3}


def test_cap_within_the_rounds_equals_the_sequential_loop(spark):
    r = random.Random(21)
    rows = random_rows(r, 220)
    groups = {x[0]: r.choice([None, *"abcdefgh"]) for x in rows}
    df = spark.createDataFrame([(*x, groups[x[0]]) for x in rows], SCHEMA + ", panoid string")
    for cap in (1, 4):
        got = {x.seq for x in first_fit_boards(df, group="panoid", cap=cap).collect()}
        assert got == sequential(rows, groups, cap)
    lost = spark.createDataFrame([(i, None, None, None, None, "a") for i in range(5)], SCHEMA + ", panoid string")
    assert {x.seq for x in first_fit_boards(lost, group="panoid", cap=2).collect()} == {0, 1}


def test_rounds_equal_the_task_that_decides_the_rest(spark):
    for seed in range(3):
        r = random.Random(seed)
        n = 70
        of = {i: r.choice([None, "a", "b", "c", "d"]) for i in range(n)}
        edges = sorted({tuple(sorted(r.sample(range(n), 2))) for _ in range(120)})
        nodes, e = spark.createDataFrame(list(of.items()), "seq long, of string"), spark.createDataFrame(edges, "earlier long, later long")
        for cap in (None, 3):
            kept, taken = set(), {}
            for i in range(n):
                if not any(a in kept for a, b in edges if b == i) and not (cap and of[i] and taken.get(of[i], 0) >= cap):
                    kept.add(i)
                    taken[of[i]] = taken.get(of[i], 0) + 1
            for tail in (0, 1000):
                assert {x.seq for x in first_fit(nodes, e, "of", cap, tail=tail).collect()} == kept, (seed, cap, tail)


def test_chain_keeps_both_ends_and_empty(spark):
    nodes = spark.createDataFrame([(1,), (2,), (3,), (None,)], "seq long")
    edges = spark.createDataFrame([(1, 2), (2, 3)], "earlier long, later long")
    assert sorted(r.seq for r in first_fit(nodes, edges).collect()) == [1, 3]
    assert first_fit(nodes.limit(0), edges.limit(0)).count() == 0


def spacing(points, d):
    cell = lambda lon, lat: (round(lat / (d / 111320)), round(lon / (d / (111320 * max(0.1, math.cos(math.radians(lat)))))))
    guard, kept = {}, {}
    for seq, lon, lat in points:
        r, c = cell(lon, lat)
        near = [guard.get((r + i, c + j)) for i in (-1, 0, 1) for j in (-1, 0, 1)]
        if any(g and metres(*g, lon, lat) < d for g in near):
            continue
        kept[seq] = (r, c) not in guard
        guard.setdefault((r, c), (lon, lat))
    return kept


def test_spacing_equals_the_sequential_loop(spark):
    r = random.Random(9)
    points = [(i, 38 + r.uniform(0, 0.006), 45 + r.uniform(0, 0.004)) for i in range(150)]
    df = spark.createDataFrame(points, "seq long, lon double, lat double")
    assert {x.seq: x.recorded for x in spaced(df, 75.0).collect()} == spacing(points, 75.0)
    guards = spark.createDataFrame([(-1, points[3][1], points[3][2])], "seq long, lon double, lat double")
    assert {x.seq for x in spaced(df, 75.0, guards).collect()} == spacing([(-1, *points[3][1:]), *points], 75.0).keys() - {-1}
    assert spaced(df.limit(0), 75.0).count() == 0
    assert df.filter(F.lit(True)).count() == 150


def kept(spark, rows, **radii):
    return {x.seq for x in first_fit_boards(spark.createDataFrame(rows, SCHEMA), **radii).collect()}


def east(metres, lat=45.0):
    return 38.0 + metres / (111320 * math.cos(math.radians(lat)))


def test_boundaries_of_the_duplicate_rule(spark):
    one = (1, 38.0, 45.0, 0.0, None)
    assert kept(spark, [one, (2, 38.0, 45.0, 59.0, None)]) == {1}  # one camera, boards 24.6 m apart
    assert kept(spark, [one, (2, 38.0, 45.0, 61.0, None)]) == {1, 2}
    call = (1, 38.0, 45.0, None, ["5"])
    assert kept(spark, [call, (2, east(299), 45.0, None, ["5", "6"])]) == {1}
    assert kept(spark, [call, (2, east(301), 45.0, None, ["5"])]) == {1, 2}
    assert kept(spark, [call, (2, east(20), 45.0, None, ["7"])]) == {1}
    assert kept(spark, [call, (2, east(20), 45.0, None, ["5"])], phone_radius_m=10.0) == {1, 2}  # same phone, but too far for it
    # Boards 290 m apart, but the cameras that face each other are 340 m apart: outside the search box.
    assert kept(spark, [(1, 38.0, 45.0, 90.0, ["5"]), (2, east(340), 45.0, 270.0, ["5"])]) == {1, 2}
    # A and B, B and C are duplicates, A and C are not: A and C stay.
    assert kept(spark, [(1, 38.0, 45.0, None, None), (2, east(20), 45.0, None, None), (3, east(40), 45.0, None, None)]) == {1, 3}
