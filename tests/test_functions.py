import random

from pyspark.sql import functions as F

from adlens.functions import boxes, contacts, geo, scoring, text


def value(spark, column, schema="x string", row=(None,)):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first().v


def test_contacts_examples(spark):
    cases = [
        ("8 (985) 277-78-79", ["+79852777879"], [], [], []),
        ("+7 495 126 76 76", ["+74951267676"], [], [], []),
        ("+77260051860", [], ["+77260051860"], [], []),
        ("8-700-123-45-67", ["+77001234567"], [], [], []),
        ("7260051860", [], [], [], []),
        ("test.РФ WWW.Kinomax.RU, spasstower.ru.", [], [], ["test.рф", "kinomax.ru", "spasstower.ru"], []),
        ("https://t.me/Foo_bar1 a@mail.ru", [], [], ["mail.ru"], ["@foo_bar1", "@mail"]),
        ("kinomax.com.ru", [], [], ["kinomax.com"], []),
        ("dom.рфы", [], [], [], []),
        ("8 985 277 78 79 8-985-277-78-79", ["+79852777879"], [], [], []),
        (None, [], [], [], []),
        ("", [], [], [], []),
    ]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, t string")
    for r in df.select("i", contacts.contacts(F.col("t")).alias("c")).collect():
        assert (r.c.phones, r.c.phones_unreliable, r.c.sites, r.c.telegram) == tuple(cases[r.i][1:]), cases[r.i][0]


def test_phone_prefix_is_a_parameter(spark):
    c = contacts.numbers(F.lit("+1 (743) 555-38-24"), prefix=r"\+1", country="+1")
    assert value(spark, c) == ["+17435553824"]


def test_fixed_rounds_the_binary_value(spark):
    r = random.Random(3)
    xs = [0.00025, 0.12345, 0.5, 1.0, 0.99995, 231.75, 0.35, 2.675] + [r.randrange(10**5) / 10**5 for _ in range(500)]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", text.fixed(F.col("x"), 4).alias("a"), text.fixed(F.col("x"), 1).alias("b")).collect()
    assert all(q.a == f"{q.x:.4f}" and q.b == f"{q.x:.1f}" for q in rows)


def test_answers(spark):
    cases = {
        '{"text": "A", "phone": "null", "advertiser": "B"}': ("A", "B", False),
        '```json\n{"text": "A", "phone": "8 900", "site": null}\n```': ("A\n8 900", None, False),
        '```\n{"text": "A", "phone": 5}\n```': ("A\n5", None, False),
        "plain words": ("plain words", None, False),
        "[1, 2]": (None, None, True),
        '{"other": 1}': ("", None, False),
    }
    df = spark.createDataFrame([(k,) for k in cases], "raw string")
    for r in df.select("raw", text.parse_answer(F.col("raw")).alias("a")).collect():
        assert (r.a.text, r.a.advertiser, r.a.failed) == cases[r.raw], r.raw


def test_category_rules(spark):
    cases = {None: "не определено", "abc": "не определено", "зззз": "другое", "пикник": "недвижимость", "банк": "финансы", "концерт и кредит": "финансы", "ozon": "ретейл"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    for r in df.select("t", scoring.keyword_category(F.col("t")).alias("c")).collect():
        assert r.c == cases[r.t], r.t


def test_boxes(spark):
    z = F.expr("array(named_struct('level', 1, 'width', 800, 'height', 400), named_struct('level', 0, 'width', 1600, 'height', 800))")
    assert value(spark, boxes.max_zoom(z)) == 0
    assert value(spark, boxes.zoom_level(z, 1)["width"]) == 800
    assert value(spark, boxes.zoom_level(z, 7)) is None
    nan = F.lit(float("nan"))
    rule = lambda p, n: value(spark, boxes.margin_rule(p, n))
    assert rule(F.lit(0.25), F.lit(9.0)) and rule(F.lit(0.10), F.lit(0.20)) and not rule(F.lit(0.10), F.lit(0.21)) and not rule(F.lit(0.09), F.lit(0.0))
    assert rule(F.lit(0.1), nan) and not rule(nan, nan) and not rule(F.lit(None).cast("double"), F.lit(0.0))
    gate = lambda w, h: value(spark, boxes.size_gate(F.lit(w), F.lit(h)))
    assert gate(30, 40) and not gate(29, 400) and not gate(30, 39) and gate(1000, 800) and not gate(1001, 800)


def test_suppression_keeps_a_conflict_free_set(spark):
    r = random.Random(5)
    element = "struct<fx0: double, fy0: double, fx1: double, fy1: double>"
    for _ in range(5):
        bs = [(x, y, x + 0.2, y + 0.2) for x, y in ((r.uniform(0, 0.6), r.uniform(0, 0.6)) for _ in range(25))]
        kept = value(spark, boxes.suppressed(F.col("b"), element, 0.4), f"b array<{element}>", (bs,))
        want = []
        for b in bs:
            if all(overlap(b, k) < 0.4 for k in want):
                want.append(b)
        assert [tuple(k) for k in kept] == want


def overlap(a, b):
    w, h = max(0, min(a[2], b[2]) - max(a[0], b[0])), max(0, min(a[3], b[3]) - max(a[1], b[1]))
    i = w * h
    return i / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - i) if i else 0.0


def test_geo(spark):
    az = geo.azimuth(F.lit(0.9), F.lit(100.0))
    assert abs(value(spark, az) - 64.0) < 1e-9
    assert abs(value(spark, geo.fraction_of_azimuth(az, F.lit(100.0))) - 0.9) < 1e-12
    assert value(spark, geo.azimuth(F.lit(0.0), F.lit(-30.0))) == 330.0
    assert value(spark, geo.neighbour_keys(F.lit(1), F.lit(5)))[0] == "0:4"
    assert value(spark, geo.in_bbox(F.lit(1.0), F.lit(2.0), (1.0, 1.0, 2.0, 2.0)))
    assert value(spark, geo.polyline_metres(F.expr("array(named_struct('lon', 0D, 'lat', 0D), named_struct('lon', 0D, 'lat', 1D))"))) == 111320.0
    assert value(spark, geo.polyline_metres(F.expr("array(named_struct('lon', 0D, 'lat', 0D))"))) == 0.0


def test_softmax_and_recall(spark):
    p = value(spark, scoring.softmax(F.array(F.lit(1000.0), F.lit(1000.0)), 100.0))
    assert p == [0.5, 0.5]
    assert value(spark, scoring.word_recall(F.lit("Скидка 50% на шубы"), F.lit("скидка на шубы"))) == 1.0 * 2 / 3
    assert value(spark, scoring.word_recall(F.lit("да"), F.lit("да"))) is None
    assert value(spark, scoring.cosine(F.expr("array(0D)"), F.expr("array(1D)"))) is None
