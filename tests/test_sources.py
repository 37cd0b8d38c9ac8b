import json
import os
import zipfile
from xml.etree import ElementTree

from pyspark.sql import functions as F

from adlens import cli, schemas
from adlens.plans import export, pipeline
from adlens.sources import config, directory, metadata, seeds, sinks


def doc(**data):
    return json.dumps({"status": "success", "data": data})


def test_metadata_documents(spark):
    link = lambda h: {"Connection": {"href": h}}
    base = {"panoramaId": "p", "Point": {"coordinates": [1.0, 2.0]}, "Images": {"imageId": "i", "Tiles": {"width": 256}, "Zooms": [{"level": 0, "width": 8, "height": 4}]}}
    mark = lambda d, c: {"properties": {"description": d}, "geometry": {"coordinates": c}}
    note = {
        "Thoroughfares": [link("x?oid=a&z=1"), link("x?z=1"), link("x?oid=")], "Connections": [link("x?oid=b"), link("x?oid=a")],
        "Markers": [{"properties": {}, "geometry": {"coordinates": [1.0, 2.0]}}, mark("far", [9.0, 9.0]), mark("first", [1.0, 2.1]), mark("second", [1.0, 1.9])],
    }
    docs = [doc(Data=base, Annotation=note), json.dumps({"status": "error"}), "no json", doc(Data=base | {"panoramaId": "q"}), None]
    df = spark.createDataFrame([(d,) for d in docs], "value string")
    rows = {r.panoid: r for r in metadata.parsed(df).collect()}
    assert set(rows) == {"p", "q"}
    assert rows["p"].neighbor_oids == ["a", "b", "a"] and rows["p"].address == "first"
    assert (rows["p"].timestamp, rows["p"].azimuth_origin, rows["p"].pitch_origin) == (0, 0.0, 0.0)
    assert rows["q"].neighbor_oids == [] and rows["q"].address is None


def test_nearest_and_by_oid(spark):
    p = spark.createDataFrame([("o1", "b", "success", 38.0, 45.0), ("o2", "a", "success", 38.0, 45.0), ("o3", "c", "error", 38.0, 45.0)], "oid string, panoid string, status string, lon double, lat double")
    q = spark.createDataFrame([(1, 38.0001, 45.0), (2, 50.0, 45.0), (3, None, 1.0)], "point_id int, lon double, lat double")
    assert [(r.point_id, r.panoid) for r in metadata.by_coordinates(q, p).collect()] == [(1, "a")]
    asked = spark.createDataFrame([("o1",), ("o3",), ("o9",), ("o1",)], "oid string")
    assert [r.panoid for r in metadata.by_oid(asked, p).collect()] == ["b"]


def test_seeds(spark):
    s = seeds.lattice(spark, (38.0, 45.0, 38.01, 45.01), 500.0).collect()
    assert len(s) == 6 and min(r.lon for r in s) == 38.0 and max(r.lat for r in s) <= 45.01
    assert seeds.lattice(spark, (1.0, 1.0, 0.0, 0.0)).count() == 0
    line = lambda *p: [{"lon": x, "lat": y} for x, y in p]
    roads = spark.createDataFrame(
        [(1, "primary", line((38.0, 45.0), (38.0, 45.001), (38.0, 45.003))), (2, "service", line((0.0, 0.0), (1.0, 1.0))), (3, "trunk", line((38.0, 45.0), (38.0, 45.0))),
         (4, "tertiary", line((38.0, 45.0), (38.00001, 45.0))), (5, "primary", None), (6, "primary", [])],
        "way_id int, highway string, pts array<struct<lon: double, lat: double>>",
    )
    got = sorted((round(r.lat, 6), round(r.lon, 6)) for r in seeds.along_roads(roads, 111.32).collect())
    assert got == [(45.0, 38.0), (45.0, 38.00001), (45.001, 38.0), (45.002, 38.0), (45.003, 38.0)]


def test_settings(tmp_path, monkeypatch):
    s = config.Settings()
    assert s.get("crop.pad") == 0.10 and s.get("no.such", 5) == 5
    for text, want in (("true", True), ("7", 7), ("0.5", 0.5), ("abc", "abc"), ("off", False)):
        monkeypatch.setenv("ADLENS_CROP_PAD", text)
        assert s.get("crop.pad") == want
    (tmp_path / "c.yaml").write_text("crop: {pad: 3}\n")
    monkeypatch.delenv("ADLENS_CROP_PAD")
    assert config.Settings.load(tmp_path / "c.yaml").get("crop.pad") == 3


def test_directory_file(spark, tmp_path):
    (tmp_path / "b.yaml").write_text("brands:\n  Раз: {role: банк, aliases: [р1]}\n  Два:\n")
    rows = directory.read_yaml(spark, str(tmp_path / "b.yaml")).collect()
    assert [(r.brand_id, r.canonical, r.aliases) for r in rows] == [(1, "Раз", ["р1"]), (2, "Два", [])]
    assert directory.read_yaml(spark, str(tmp_path / "none.yaml")).count() == 0


def banners(spark):
    base = dict.fromkeys(schemas.BANNERS.names)
    rows = [
        base | {"seq": 1, "banner_id": "a", "category": "недвижимость", "is_realty": "Да", "developer": "Пик", "phones": ["1", "2"], "timestamp": 0, "source_url": "https://x?a=1&b=2", "text": "<b>\x01"},
        base | {"seq": 2, "banner_id": "b", "category": "авто", "is_realty": "не уверен", "advertiser": "Я", "personal_ad": True, "timestamp": 1609498587, "lat": 45.5},
        base | {"seq": 3, "banner_id": "c", "is_realty": "нет"},
        base | {"seq": 4, "banner_id": "d", "is_realty": "не уверен", "brand_matched": True, "developer": "Пик"},
    ]
    return spark.createDataFrame([tuple(r[n] for n in schemas.BANNERS.names) for r in rows], schemas.BANNERS)


def sheet(path, n):
    with zipfile.ZipFile(path) as z:
        ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
        root = ElementTree.fromstring(z.read(f"xl/worksheets/sheet{n}.xml"))
        return [["".join(t.text or "" for t in c.iter(f"{ns}t")) or (c.findtext(f"{ns}v") or "") for c in row] for row in root.iter(f"{ns}row")], z.namelist()


def test_export(spark, tmp_path):
    b, path = banners(spark), f"{tmp_path}/out.xlsx"
    assert export.export_workbook(b, path, realty_only=True) == 2
    rows, names = sheet(path, 1)
    head = rows[0]
    at = {t: i for i, t in enumerate(head)}
    assert len(head) == 18 and len(rows) == 3 and "xl/worksheets/_rels/sheet1.xml.rels" in names
    by = {r[at["ID"]]: r for r in rows[1:]}
    assert by["a"][at["Застройщик"]] == "Пик (не опознан)" and by["d"][at["Застройщик"]] == "Пик"
    assert by["a"][at["Дата съёмки"]] == "" and by["a"][at["Текст со щита"]] == "<b>"
    private, _ = sheet(path, 2)
    assert [r[at["ID"]] for r in private[1:]] == ["b"] and private[1][at["Дата съёмки"]] == "2021-01-01"
    assert export.realty(b, strict_case=True).count() == 2 and export.realty(b, include_unsure=False).count() == 1
    assert export.by_category(b, category="авто").count() == 1 and export.by_category(b, True, "авто").count() == 4
    assert export.export_workbook(b.limit(0), path) == 0


def test_files_sink(spark, tmp_path):
    df = spark.createDataFrame([("a.jpg", bytearray(b"12")), ("b.jpg", bytearray(b""))], "name string, data binary")
    got = {r.name: r.bytes for r in sinks.write_files(df, f"{tmp_path}/crops").collect()}
    assert got == {"a.jpg": 2, "b.jpg": 0} and sorted(os.listdir(tmp_path / "crops")) == ["a.jpg", "b.jpg"]


def test_pipeline_of_one_panorama(spark):
    zoom = [(2, 4000, 3000)]
    p = spark.createDataFrame([("o", "p", "success", 38.0, 45.0, 5, "i", 256, zoom, 90.0, 0.0, [], "адрес")], schemas.PANORAMAS)
    box = lambda i, x, s, pos=0.9: ("p", i, x, 0.4, x + 0.1, 0.5, s, "banner", pos, 0.0)
    d = spark.createDataFrame([box(0, 0.1, 0.9), box(1, 0.11, 0.8), box(2, 0.5, 0.7), box(3, 0.8, 0.6, 0.01), ("p", 4, 0.1, 0.1, 0.1001, 0.1001, 0.9, "banner", 0.9, 0.0)], schemas.DETECTIONS)
    c = pipeline.candidates(d, p)
    assert sorted(r.idx for r in c.collect()) == [0, 2]
    reading = ("p", 0, "ЖК тест 8 (985) 277-78-79", "Пик", None, None, None, None, None, None, "Частное лицо", "vlm-a")
    r = spark.createDataFrame([reading], "panoid string, idx int, text string, advertiser string, category string, construction string, is_realty string, developer string, complex_name string, offer_type string, advertiser_type string, engine string")
    rows = pipeline.assembled(c.withColumn("seq", F.col("idx").cast("long")), r)
    got = {x.seq: x for x in rows.collect()}
    assert rows.schema.names == schemas.BANNERS.names and len(got) == 2
    assert got[0].phones == ["+79852777879"] and got[0].personal_ad and got[0].category == "недвижимость" and abs(got[0].bearing_deg - 144.0) < 1e-6
    assert got[2].text == "" and got[2].category == "не определено"
    assert {x.seq for x in pipeline.accepted(rows).collect()} == {0, 2}


def test_pipeline_query_takes_every_reading(spark, tmp_path):
    from adlens.plans.walks import q_pipeline

    spark.createDataFrame([("o", "p", "success", 38.0, 45.0, 5, "i", 256, [(2, 4000, 3000)], 90.0, 0.0, [], "адрес")], schemas.PANORAMAS).write.parquet(f"{tmp_path}/panoramas.parquet")
    boxes = [("p", i, x, 0.4, x + 0.1, 0.5, 0.9, "banner", 0.9, 0.0) for i, x in enumerate((0.1, 0.5, 0.8))]
    spark.createDataFrame(boxes[:2], schemas.DETECTIONS).write.parquet(f"{tmp_path}/detections.parquet")
    brands = "brand_id long, canonical string, role string, aliases array<string>, complexes array<string>, site string, phone string, category string"
    spark.createDataFrame([(1, "Пик", "застройщик", [], [], None, None, None)], brands).write.parquet(f"{tmp_path}/brands.parquet")
    names = schemas.BANNERS.names
    row = lambda **x: tuple({"lon": 38.0, "lat": 45.0, "ocr_engine": "vlm-a", "panoid": "p", **x}.get(k) for k in names)
    readings = [
        row(seq=9, banner_id="A", text="8 (985) 277-78-71"), row(seq=2, banner_id="B", text="8 (985) 277-78-72"), row(seq=4, banner_id="B", text="8 (985) 277-78-72"),
        row(seq=12, banner_id="C", bearing_deg=40.0, text="8 (985) 277-78-73"), row(seq=7, banner_id="D", panoid="q", lon=39.0, text="8 (985) 277-78-74"),
    ]
    spark.createDataFrame(readings, schemas.BANNERS).write.parquet(f"{tmp_path}/banners.parquet")
    rows = {r.phones: r for r in q_pipeline(spark, str(tmp_path)).collect()}
    assert sorted(rows) == [f"+7985277787{i}" for i in (1, 2, 3, 4)]
    # The board read first has the first box; boards beyond the boxes keep their own id.
    assert rows["+79852777872"].bearing_deg == 144.0 and rows["+79852777871"].bearing_deg == 288.0
    assert rows["+79852777873"].banner_id == "C" and rows["+79852777874"].panoid == "q"
    both = pipeline.paired(pipeline.candidates(spark.createDataFrame(boxes, schemas.DETECTIONS), spark.read.parquet(f"{tmp_path}/panoramas.parquet")), spark.createDataFrame(readings[:3], schemas.BANNERS))
    assert [(r.seq, r.idx, r.own_banner_id) for r in both.orderBy("seq").collect()] == [(0, 0, "B"), (1, 2, None), (2, 0, "B"), (3, 1, "A")]


def test_command_line(spark, tmp_path):
    b = f"{tmp_path}/banners"
    banners(spark).write.parquet(b)
    assert "авто" in cli.main(["stats", b], spark)
    assert cli.main(["export", b, f"{tmp_path}/o.xlsx", "--category", "авто"], spark) == "1 rows"
    assert cli.main(["grid", "38.0,45.0,38.01,45.01", f"{tmp_path}/grid", "--step", "500"], spark) == "6 points"
    p = spark.createDataFrame([("o", "p", "success", 38.0, 45.0, 5, "i", 256, [], 90.0, 0.0, [], "")], schemas.PANORAMAS)
    p.write.parquet(f"{tmp_path}/p")
    assert cli.main(["crawl", f"{tmp_path}/p", f"{tmp_path}/state", "38.0,45.0"], spark) == "1 panoramas, frontier empty"


def test_pictures_and_long_tables_in_the_workbook(spark, tmp_path, monkeypatch):
    import zipfile
    from xml.etree import ElementTree

    import numpy as np

    from adlens.operators.crops import png
    from adlens.sources import sinks

    data = png(np.full((400, 220, 3), 9, np.uint8))
    df = spark.createDataFrame([(1, data), (2, None), (3, data), (4, None), (5, None)], "id int, pic binary").orderBy("id")
    monkeypatch.setattr(sinks, "ROWS", 2)
    path = f"{tmp_path}/b.xlsx"
    assert sinks.write_sheets(path, [("t", df), ("empty", df.limit(0))], picture="pic") == [5, 0]
    with zipfile.ZipFile(path) as z:
        names = z.namelist()
        assert len([n for n in names if n.startswith("xl/worksheets/sheet")]) == 4 and z.read("xl/media/p1_1.png") == data and "xl/media/p2_1.png" in names
        for n in names:
            if n.endswith((".xml", ".rels")):
                ElementTree.fromstring(z.read(n))
        drawing = z.read("xl/drawings/drawing1.xml").decode()
        assert f'cx="{110 * 9525}" cy="{200 * 9525}"' in drawing and "<xdr:row>1</xdr:row>" in drawing
        assert z.read("xl/workbook.xml").decode().count("<sheet ") == 4
