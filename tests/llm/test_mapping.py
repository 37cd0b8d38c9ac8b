from adlens.llm.mapping import Matcher, directory, edits, normal
from adlens.llm.p3 import mapped

BRANDS = [
    {"brand_id": 1, "canonical": "Бангесфей", "aliases": ["bangesfey", "гк бангесфей"], "complexes": ["Изумрудные террасы", "Изумрудные мельницы"], "site": "bangesfey.example.com"},
    {"brand_id": 2, "canonical": "Балдейпе Групп", "aliases": ["балдейпе", "Baldeype Grupp"], "complexes": ["Расдиндум", "Полынный маяк"], "site": None},
    {"brand_id": 3, "canonical": "Шутрыр Групп", "aliases": None, "complexes": None, "site": None},
    {"brand_id": 4, "canonical": "Лулданфи Групп", "aliases": ["лулданфи"], "complexes": ["Вересковый маяк", "Полынный причал"], "site": None},
    {"brand_id": 5, "canonical": "Пойвян", "aliases": ["пойвян"], "complexes": ["Янтарный маяк"], "site": None},
]


def test_names():
    names, complexes = directory(BRANDS)
    for value, want in {
        "ООО «БАНГЕСФЕЙ»": "Бангесфей", "Бнгефей": "Бангесфей", "bаngesfey": "Бангесфей", "от Пойвяном": "Пойвян", "скидки-Балдейпе-Групп-до-мая": "Балдейпе Групп",
        "ЖК Изумрудные террасы": "Бангесфей", "Балдейпе": "Балдейпе Групп", "bangesfey.example.com": "Бангесфей", "000 «Шутрыр Групп»": "Шутрыр Групп", "Вектор Групп Фарфенчут": "",
        "частное лицо": "", "—": "", "Групп": "", "Оптика «Фавейбон»": "",
    }.items():
        assert names.match(value).target == want, value
    for value, want in {
        "ЖК «Изумрдные  терасы»": "Изумрудные террасы", "izumrudnye melnitsy": "Изумрудные мельницы", "Полынный амяк": "Полынный маяк", "ПОЛЫННЫЙ ПРИЧАЛ (2 очередь)": "Полынный причал",
        "Старая пристань плюс": "", "Южный ковчег-2": "", "П0лынный причал": "Полынный причал",
    }.items():
        assert complexes.match(value).target == want, value


def test_every_candidate_is_checked():
    street = "изумрудные террасы вересковый причал северное сияние полынный хутор янтарный"
    others = [f"{street} {w}" for w in ("баржа", "грушевый", "дюжина", "жёлудь", "кубок", "щегол", "эхо")]
    assert Matcher([*((s, s) for s in others), ("тополь", "П")]).match(f"{street} тополь").target == "П"  # many targets
    assert Matcher([*((s, "П") for s in others), ("тополь", "П")]).match(f"{street} тополь").target == "П"  # many entries of one


def test_pieces():
    assert normal("  «П0лынный» маяк ё ") == "полынный маяк е"
    assert [edits(a, b, 2) for a, b in (("ab", "ba"), ("ab", "ab"), ("abc", "a"), ("abcd", "a"), ("abc", "xyz"))] == [1, 0, 2, 3, 3]


def test_table(spark):
    brands = spark.createDataFrame([(b["canonical"], b["aliases"], b["complexes"], b["site"]) for b in BRANDS], "canonical string, aliases array<string>, complexes array<string>, site string")
    rows = [(1, "Бангесфей", "бангесфей", None), (2, None, "", "  "), (3, "гк Бангесфей", None, "ЖК Расдиндум"), (3, "гк Бангесфей", None, "Расдиндум"), (4, "x" * 20000, None, None)]
    df = spark.createDataFrame(rows, "seq long, advertiser string, brand string, complex_name string").selectExpr("*", "1 as value", "2 as canon")
    got = sorted((r.seq, r.field_name, r.canon) for r in mapped(df, brands).collect())
    assert got == [(1, "brand", "Бангесфей"), (3, "advertiser", "Бангесфей"), (3, "advertiser", "Бангесфей"), (3, "complex_name", "Расдиндум"), (4, "advertiser", "")]
    assert mapped(df.limit(0), brands).count() == 0
    assert {r.canon for r in mapped(df, brands.limit(0)).collect()} == {""}
