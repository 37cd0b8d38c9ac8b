import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.operators import images, ranking, recognition, state
from adlens.operators.dictionary import Directory

BRANDS = [
    {"canonical": "Пик", "role": "застройщик", "aliases": ["пик групп", "ГК ПИК"], "complexes": ["Бунинские луга", "Ключ"], "site": "pik.example", "phone": None, "category": None},
    {"canonical": "Самолёт", "role": "застройщик", "aliases": ["самолета"], "complexes": ["Квартал Домашний"], "site": None, "phone": "1", "category": "авто"},
    {"canonical": "Ё", "role": None, "aliases": None, "complexes": None, "site": None, "phone": None, "category": None},
]


def test_directory_cascade(spark):
    d = Directory(BRANDS)
    cases = [
        (None, "ЖК Бунинские луга", "Пик", True, "Бунинские луга", "недвижимость"),
        ("Квартал Домашний от Самолёта", None, "Самолёт", True, "Квартал Домашний", "авто"),
        ("офис пик групп рядом", None, "Пик", True, None, "недвижимость"),
        ("пикник", None, "пикник", False, None, None),
        ("Неизвестный ", None, "Неизвестный", False, None, None),
        (None, None, None, False, None, None),
        ("!!!", None, None, False, None, None),
        ("старый ключ", None, "старый ключ", False, None, None),  # four letters are no substring
        ("Ключ", None, "Пик", True, "Ключ", "недвижимость"),
        ("гк пик", "Квартал домашний", "Самолёт", True, "Квартал Домашний", "авто"),
    ]
    df = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(cases)], "i int, raw string, hint string")
    for r in df.select("i", d.lookup(F.col("raw"), F.col("hint")).alias("b")).collect():
        assert (r.b.canonical, r.b.matched, r.b.complex_name, r.b.category) == cases[r.i][2:], cases[r.i]
    empty = Directory([])
    assert df.limit(1).select(empty.lookup(F.lit("a")).alias("b")).first().b.canonical == "a"


def test_ranking(spark):
    rows = [("a", 1, 5.0, True), ("a", 2, 9.0, False), ("a", 3, 7.0, True), ("a", 4, 1.0, True), (None, 5, 1.0, True), (None, 6, 2.0, None)]
    df = spark.createDataFrame(rows, "g string, id int, s double, ok boolean")
    order = [F.desc("s"), F.asc("id")]
    assert sorted(r.id for r in ranking.top_per_group(df, ["g"], order, 2).collect()) == [2, 3, 5, 6]
    assert sorted(r.id for r in ranking.within_budget(df, ["g"], order, ["id"], F.col("ok"), 2).filter("granted").collect()) == [1, 3, 5]
    assert sorted(r.id for r in ranking.first_of_key(df, ["g"], "id").collect()) == [1, 5]
    assert sorted(r.id for r in ranking.latest_of_key(df, ["g"], "id").collect()) == [4, 6]
    assert ranking.within_budget(df.limit(0), ["g"], order, ["id"], F.col("ok"), 2).count() == 0


def test_state(spark):
    known = spark.createDataFrame([("a",)], "oid string")
    batch = spark.createDataFrame([("a", 1), ("b", 3), ("b", 2), (None, 4), ("c", 5)], "oid string, seq int")
    assert sorted(tuple(r) for r in state.insert_new(known, batch, "oid", "seq").collect()) == [("b", 2), ("c", 5)]
    old, new = spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([(2, "x", 1)], "id int, n string, gone int")
    out = state.evolved([old, new], T.StructType.fromDDL("id long, n string, later boolean"))
    assert sorted((r.id, r.n, r.later) for r in out.collect()) == [(1, None, None), (2, "x", None)]


def picture(rgb):
    h, w = rgb.shape[:2]
    return (w, h, bytearray(np.ascontiguousarray(rgb[..., ::-1]).tobytes()))


def test_visual_stats(spark):
    flat = np.full((20, 20, 3), 128, np.uint8)
    board = (np.indices((20, 20)).sum(axis=0) % 2 * 255).astype(np.uint8)
    checks = np.stack([board, 255 - board, np.zeros_like(board)], axis=-1)
    df = spark.createDataFrame([(1, *picture(flat)), (2, *picture(checks)), (3, 5, 5, bytearray(b"x")), (4, 1, 4, bytearray(b"\0" * 12))], "id int, width int, height int, data binary")
    r = {x.id: x for x in images.with_visual_stats(df).collect()}
    assert r[1].colorfulness == 0 and r[1].edge_density == 0 and r[1].gray_std == 0
    assert r[2].saturation > 0.9 and r[2].colorfulness > 100
    assert r[3].gray_std is None and r[4].edge_density is None and r[4].dark_ratio == 1.0


def test_visual_stats_follow_their_definition():
    rgb = np.random.default_rng(4).integers(0, 256, (30, 41, 3)).astype(np.uint8)
    red, green, blue = (rgb[..., i].astype(float) for i in range(3))
    gray, got = rgb.mean(axis=2), images.visual_stats(rgb)
    a, b = red - green, (red + green) / 2 - blue
    assert abs(got["colorfulness"] - (np.hypot(a.std(), b.std()) + 0.3 * np.hypot(a.mean(), b.mean()))) < 1e-9
    assert abs(got["gray_std"] - gray.std()) < 1e-9 and got["bright_ratio"] == (gray >= 185).mean() and got["dark_ratio"] == (gray <= 100).mean()
    assert abs(got["edge_density"] - ((np.abs(np.diff(gray, axis=0)) > 24).mean() + (np.abs(np.diff(gray, axis=1)) > 24).mean()) / 2) < 1e-9
    big = np.repeat(np.repeat(rgb, 40, axis=0), 40, axis=1)[: 30 * 40, : 41 * 40]
    small = images.shrunk(big, 41)
    assert (small == rgb).all() and images.shrunk(rgb, 512) is rgb
    assert images.shrunk(np.full((1000, 3, 3), 7, np.uint8), 100).shape == (100, 1, 3)


def test_crops_verify_and_routes(spark):
    from adlens.operators import crops
    from adlens.plans import pipeline

    rng = np.random.default_rng(7)
    pano = rng.integers(0, 256, (16, 32, 3)).astype(np.uint8)
    pano[:, 16:] = 90
    tiles = [("p", 0, x, y, *picture(pano[y * 8 : y * 8 + 8, x * 8 : x * 8 + 8])) for x in range(4) for y in range(2)]
    tiles = spark.createDataFrame(tiles + tiles[:1], "panoid string, zoom int, x int, y int, width int, height int, data binary")
    rows = [("p", 0, 0.1, 0.1, 0.4, 0.8, 0.9), ("p", 1, 0.6, 0.1, 0.95, 0.9, 0.8), ("p", 2, 0.3, 0.3, 0.3, 0.5, 0.7), ("q", 0, 0.1, 0.1, 0.3, 0.3, 0.9)]
    df = spark.createDataFrame(rows, "panoid string, idx int, fx0 double, fy0 double, fx1 double, fy1 double, score double")
    df = df.selectExpr("*", "array(named_struct('level', 0, 'width', 32, 'height', 16)) as zooms", "8 as tile_size", "300 as crop_w", "300 as crop_h")
    cut = {(r.panoid, r.idx): images.pixels(r.data, r.height, r.width) for r in crops.cropped(df, tiles, 0, straighten=False).collect()}
    assert cut.keys() == {("p", 0), ("p", 1), ("q", 0)} and (cut["p", 0] == pano[1:12, 3:12]).all() and not cut["q", 0].any()
    seen = pipeline.verified_boxes(df, tiles)
    assert {(r.panoid, r.idx) for r in seen.filter("is_ad").collect()} == {("p", 0)}
    files = {r.idx: r for r in crops.encoded(crops.cropped(df.filter("panoid = 'p'"), tiles, 0, straighten=False)).collect()}
    assert files[0].name == "p_0.png" and files[0].data[:4] == b"\x89PNG" and files[0].body.startswith("iVBOR")
    many = spark.createDataFrame([("p", i, 0.1, 0.1, 0.4, 0.8, i / 10, 300 if i % 2 else 100, True) for i in range(12)], "panoid string, idx int, fx0 double, fy0 double, fx1 double, fy1 double, score double, crop_w int, is_ad boolean")
    many = many.withColumn("crop_h", F.lit(400)).unionByName(many.withColumn("crop_h", F.lit(400)).limit(1).withColumn("is_ad", F.lit(False)).withColumn("idx", F.lit(99)))
    routes = {r.idx: r.route for r in pipeline.routed(many).collect()}
    assert routes == {**{i: "skipped-lowres" for i in range(0, 12, 2)}, **{i: "cloud" for i in (11, 9, 7, 5)}, **{i: "skipped-budget" for i in (1, 3)}}
    assert {r.route for r in pipeline.routed(many, fallback=True).collect()} == {"cloud", "fallback"}
    assert {r.route for r in pipeline.routed(many, cloud=False).collect()} == {"fallback"}


def test_crops_never_broadcast_tiles_and_read_only_those_touched(spark, tmp_path):
    from adlens.operators import crops

    rng = np.random.default_rng(3)
    tiles = {(p, x, y): picture(rng.integers(0, 256, (8, 8, 3)).astype(np.uint8)) for p in ("p", "q") for x in range(8) for y in range(4) if (x, y) != (1, 1)}
    made = spark.createDataFrame([(p, 0, x, y, *t) for (p, x, y), t in tiles.items()], "panoid string, zoom int, x int, y int, width int, height int, data binary")
    ends = np.sort(rng.random((40, 2, 2)) * 0.5, axis=1) + [[0, 0], [0.1, 0.1]]
    rows = [("pq"[i % 2], i, *map(float, e.ravel())) for i, e in enumerate(ends)] + [("p", 90, 0.0, 0.0, 1 / 8, 1 / 4), (None, 91, 0.1, 0.1, 0.3, 0.3), ("r", 92, 0.1, 0.1, 0.3, 0.3), ("p", 93, 0.2, 0.2, 0.2, 0.3)]
    df = spark.createDataFrame(rows + rows[:2], "panoid string, idx int, fx0 double, fy0 double, fx1 double, fy1 double")
    df = df.selectExpr("*", "array(named_struct('level', 0, 'width', 64, 'height', 32)) as zooms", "8 as tile_size")
    log = str(tmp_path / "read")

    def fetch(panoid, x, y):
        with open(log, "a") as f:
            f.write(f"{panoid} {x} {y}\n")
        return tiles.get((panoid, x, y))

    for straighten in (False, True):
        joined, looked = (crops.cropped(df, t, 0, pad=0.1, straighten=straighten) for t in (made, fetch))
        assert not any("Broadcast" in x._jdf.queryExecution().executedPlan().toString() for x in (joined, looked))
        got = [sorted(((r.panoid or "", r.idx, r.width, r.height, bytes(r.data)) for r in x.collect())) for x in (joined, looked)]
        assert got[0] == got[1] and len(got[0]) == 43
        if not straighten:
            read = open(log).read().splitlines()
    want = set()
    for p, _, x0, y0, x1, y1 in rows:
        dx, dy = (x1 - x0) * 0.1, (y1 - y0) * 0.1
        if p and dx > 0:
            (ax, bx), (ay, by) = ((int(max(0.0, lo) * n), int(hi * n) - 1) for lo, hi, n in ((x0 - dx, x1 + dx, 64), (y0 - dy, y1 + dy, 32)))
            want |= {f"{p} {x} {y}" for x in range(ax // 8, bx // 8 + 1) for y in range(ay // 8, by // 8 + 1)}
    assert sorted(read) == sorted(want)  # each once


def test_crop_pixels_of_large_and_unnamed_boxes(spark, tmp_path):
    import duckdb

    from adlens.plans.walks import QUERIES, SQL

    rows = [("p", 0, 0.0, 0.0, 1.0, 1.0), ("p", 1, 0.3, 0.2, 0.6, 0.55), ("p", 1, 0.31, 0.2, 0.6, 0.55), (None, 2, 0.1, 0.1, 0.9, 0.9), ("q", None, 0.1, 0.1, 0.9, 0.9), ("q", 4, 0.5, 0.5, 0.5, 0.9)]
    rows += [(f"n{i // 3}", i, i % 7 / 10, i % 5 / 10, 0.9, 0.8) for i in range(60)]
    spark.createDataFrame(rows, "panoid string, idx int, fx0 double, fy0 double, fx1 double, fy1 double").coalesce(1).write.parquet(f"{tmp_path}/detections.parquet")
    df = QUERIES["q_crop_pixels"](spark, str(tmp_path))
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    db = duckdb.connect()
    db.execute(f"create view detections as select * from read_parquet('{tmp_path}/detections.parquet/*.parquet')")
    assert sorted(map(tuple, df.collect())) == sorted(db.execute(SQL["q_crop_pixels"]).fetchall())


def test_gray_stats_in_the_jvm_equal_numpy(spark):
    g = np.random.default_rng(1).integers(0, 256, (8, 8)).astype(float)
    want = images.visual_stats(np.repeat(g[..., None], 3, axis=-1).astype(np.uint8))
    got = spark.createDataFrame([(g.ravel().tolist(),)], "g array<double>").select(*[c.alias(k) for k, c in images.gray_stats(F.col("g"), 8).items()]).first()
    for k in ("edge_density", "gray_std", "bright_ratio", "dark_ratio"):
        assert abs(got[k] - want[k]) < 1e-9


def test_views_and_boxes():
    pano = np.zeros((100, 200, 3), np.uint8)
    pano[40:60, 95:105] = 255
    seen, uv = images.view(pano, 180.0, out=64)
    assert seen[32, 32].tolist() == [255, 255, 255] and abs(uv[32, 32, 0] - 0.5) < 0.01
    assert images.box_in_panorama(uv, 10, 10, 9, 20) is None
    box = images.box_in_panorama(uv, 28, 28, 36, 36)
    assert box[0] < 0.5 < box[2] and box[1] < 0.5 < box[3]
    _, seam = images.view(pano, 0.0, out=64)
    assert images.box_in_panorama(seam, 0, 0, 63, 63) is None
    assert images.yaws(4) == [0, 90, 180, 270]


def test_rectified():
    crop = np.random.default_rng(2).integers(0, 255, (120, 200, 3)).astype(np.uint8)
    assert images.rectified(crop[:5], (0.4, 0.4, 0.6, 0.6), (0.45, 0.45, 0.55, 0.55), 1000, 500).shape[0] == 5
    assert images.rectified(crop, (0.4, 0.4, 0.6, 0.6), (0.5, 0.5, 0.5, 0.6), 1000, 500) is crop
    assert images.rectified(crop, (0.45, 0.45, 0.55, 0.55), (0.3, 0.3, 0.7, 0.7), 1000, 500) is crop
    out = images.rectified(crop, (0.40, 0.40, 0.60, 0.60), (0.45, 0.45, 0.55, 0.55), 1000, 500)
    assert out.shape[1] == 200 and out is not crop
    # The centre of the box is seen in the middle of the picture.
    assert abs(int(out[out.shape[0] // 2, 100].astype(int).sum()) - int(crop[60, 100].astype(int).sum())) < 765


def test_stitch_leaves_holes_black(spark):
    tile = np.full((4, 4, 3), 9, np.uint8)
    tiles = spark.createDataFrame([("p", 0, 0, 0, *picture(tile)), ("p", 0, 1, 1, *picture(tile)), ("q", 1, 0, 0, *picture(tile))], "panoid string, zoom int, x int, y int, width int, height int, data binary")
    panos = spark.createDataFrame([("p", 4, [(0, 7, 6)]), ("q", 4, [(1, 4, 4)])], "panoid string, tile_size int, zooms array<struct<level: int, width: int, height: int>>")
    r = images.stitched(tiles, panos, 0).collect()
    assert len(r) == 1 and (r[0].width, r[0].height) == (7, 6)
    a = images.pixels(r[0].data, 6, 7)
    assert a[0, 0, 0] == 9 and a[5, 6, 0] == 9 and a[0, 5, 0] == 0
    assert images.outlined(a, [(0.1, 0.1, 0.9, 0.9)]).sum() != a.sum()


def test_image_files(spark, tmp_path):
    import struct
    import zlib

    def png(rgb):
        h, w = rgb.shape[:2]
        chunk = lambda t, d: struct.pack(">I", len(d)) + t + d + struct.pack(">I", zlib.crc32(t + d))
        raw = b"".join(b"\0" + rgb[i].tobytes() for i in range(h))
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")

    folder = tmp_path / "pn1"
    folder.mkdir()
    rgb = np.zeros((4, 4, 3), np.uint8)
    rgb[..., 0] = 200
    (folder / "2.0.1.png").write_bytes(png(rgb))
    (folder / "2.1.1.png").write_bytes(b"broken")
    r = images.read_tiles(spark, str(folder)).collect()
    assert [(x.panoid, x.zoom, x.x, x.y) for x in r] == [("pn1", 2, 0, 1)]
    assert images.pixels(r[0].data, 4, 4)[0, 0].tolist() == [200, 0, 0]


def test_recognition_cache_fallback_and_failures(spark):
    import pandas as pd

    rows = spark.createDataFrame([("e:1", "f:1", "x"), ("e:2", "f:2", "bad"), ("e:3", "f:3", "z"), ("e:4", "f:4", "bad")], "key string, fallback_key string, body string")
    blank = [None] * 8
    cache = spark.createDataFrame([("e:1", 1.0, "old", *blank), ("e:1", 2.0, "old", *blank), ("f:4", 1.0, "kept", *blank)], "key string, created double, " + ", ".join(f"{c} string" for c in recognition.RESULT))

    def primary():
        def read(df):
            if (df.body == "bad").any():
                raise ValueError
            return pd.DataFrame({"text": "new " + df.body})

        return read

    def fallback():
        return lambda df: pd.DataFrame({"text": ["plan b"] * len(df)})

    got = {r.key: (r.text, r.failed, r.hit) for r in recognition.recognise(rows, cache, primary, fallback).collect()}
    assert got == {"e:1": ("old", False, True), "e:2": ("plan b", False, False), "e:3": ("new z", False, False), "e:4": ("kept", False, True)}
    alone = {r.key: (r.text, r.failed) for r in recognition.recognise(rows, cache.limit(0), primary).collect()}
    assert alone["e:2"] == (None, True) and alone["e:1"] == ("new x", False)


def test_detector_slot_and_regions(spark):
    df = spark.createDataFrame([("a",), ("b",)], "panoid string")

    def make():
        return lambda row: [(0.1, 0.1, 0.2, 0.2, 0.9, "banner", 0.9, 0.1)] if row.panoid == "a" else []

    r = recognition.detected(df, make, ["panoid"]).collect()
    assert [(x.panoid, x.idx, x.label) for x in r] == [("a", 0, "banner")]
    assert recognition.fixed_regions(df, [(0, 0, 1, 1), (0, 0, 0.5, 0.5)]).count() == 4
    assert recognition.fixed_regions(df, []).count() == 0


@pytest.mark.parametrize("w,h,want", [(880, 100, 0.5), (100, 800, 0.25), (10, 10, 1.0)])
def test_fit_scale(spark, w, h, want):
    assert spark.range(1).select(images.fit_scale(F.lit(w), F.lit(h)).alias("s")).first().s == want


def test_retries_and_observation(spark):
    calls = []

    def call(x):
        calls.append(x)
        if len(calls) < 3:
            raise ValueError
        return x

    assert recognition.retrying(call, delay=0.0)(7) == 7 and len(calls) == 3
    bad = recognition.retrying(lambda: 1 / 0, delay=0.0, fatal=lambda e: isinstance(e, ZeroDivisionError))
    for _ in range(2):
        with pytest.raises(ZeroDivisionError):
            bad()
    df, seen = recognition.observed(spark.range(10), "passing", even=F.col("id") % 2 == 0)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "even": 5}


def test_schema_evolution_takes_all_rows(spark, tmp_path):
    from adlens.plans.relational import q_schema_evolution

    rows = [(1, "a", True), (1000001, "b", False), (1500000, "c", True)]
    spark.createDataFrame(rows, "seq long, banner_id string, brand_matched boolean").write.parquet(f"{tmp_path}/banners.parquet")
    got = [(r.seq, r.banner_id, r.note) for r in q_schema_evolution(spark, str(tmp_path)).orderBy("seq").collect()]
    assert got == [(1, "a", None), (1000001, "b", None), (1500000, "c", None), (1500001, None, "new"), (3000000, None, "new")]


def test_zero_shot_refuses_labels_beyond_the_bound(spark, tmp_path):
    from adlens.plans.scalars import q_zero_shot, q_zero_shot_gate

    spark.range(1001).selectExpr("id as vec_id", "cast(id as int) as label", "array(1.0f, cast(id as float)) as embedding").write.parquet(f"{tmp_path}/embeddings.parquet")
    for query in (q_zero_shot, q_zero_shot_gate):
        with pytest.raises(ValueError, match="1000 labels"):
            query(spark, str(tmp_path))
