import sys
import tempfile
from collections import Counter
from pathlib import Path

from adlens.llm import pii, pii_table
from adlens.llm.crf import Chain
from adlens.llm.p2 import tagged
from adlens.llm.pii import fitted, read, redact, spans, tagger

sys.path.insert(0, str(Path(__file__).parent))
import held_out  # noqa: E402


# Written by hand; no name, street or firm of them is in the labelled table.
ADS = [
    ("Продам пианино «Красный Октябрь», самовывоз. Звонить Ярославу, 8 913 555-12-34", {"name", "phone"}),
    ("Мастер Зоя, проспект Победы 7 кв 3, т. 8(383)2123456", {"address", "name", "phone"}),
    ("Хозяйка Эльвира, сдаю комнату студентам, +7 905 123 45 67", {"name", "phone"}),
    ("Спросить Лизу после шести, 89051234567", {"name", "phone"}),
    ("Виталий, ремонт холодильников, 8-952-111-22-33", {"name", "phone"}),
    ("Сдам домик у моря на июль. Пишите: lena.more@inbox.ru", {"email"}),
    ("Отдам щенка хаски. Богдан, 8 (812) 555-77-99", {"name", "phone"}),
    ("Требуется уборщица в кафе «Людмила», ул. Чкалова, 14", {"address"}),
    ("Рядом остановка Площадь Маркса, торг", set()),
    ("Продам участок, кадастровый номер 54:35:0123456:78, собственник Харитонова А. П.", {"name"}),
    ("Нашёл паспорт 50 04 123456 на имя Тарас Шевцов", {"id_number", "name"}),
    ("ИНН 540123456789, перечислю задаток", {"id_number"}),
    ("СНИЛС 112-233-445 95 утерян, вернуть за вознаграждение: Аглая, 8 999 888-77-66", {"id_number", "name", "phone"}),
    ("Продаю велосипед Стелс, почти новый, цена 12 500 руб.", set()),
    ("Услуги юриста. Константин Эдуардович Вяземский. 8 495 700 11 22", {"name", "phone"}),
    ("ЖК «Аврора-парк», 3 минуты до метро Беговая, без комиссии", set()),
    ("Куплю гараж в районе улицы Титова, дорого", set()),
    ("Репетитор английского, Мира Львовна, Красный проспект, 99, офис 5", {"address", "name"}),
    ("Массаж. Эдита. Звоните 8 800 555 35 35 бесплатно", {"name", "phone"}),
    ("Сдаю гараж, переулок Тихий 8, Вахтанг Георгиевич", {"address", "name"}),
    ("Ищу няню для двойни, Октябрьский район, график 5/2", set()),
    ("Котята мейн-кун, заводчик Пелагея Дронова, почта pelageya_d собака mail.ru", {"email", "name"}),
    ("Бетон М300 с доставкой, артикул 4012-77", set()),
    ("Печник Ермолай Кузьмич, Тверская ул., д. 5, кв. 10", {"address", "name"}),
    ("Ремонт телефонов Samsung и Xiaomi, ТЦ «Ройял», 2 этаж", set()),
    ("Эмилия (собственник), студия у метро, 8 901 000-11-22", {"name", "phone"}),
    ("ПРОДАМ ДРОВА. ЗВОНИТЬ ПРОХОРУ 8 923 100 20 30", {"name", "phone"}),
    ("Обращаться к Изольде, кабинет 12", {"name"}),
]


def counted(texts, golds, kinds=None):
    right = total = given = 0
    for gold, found in zip(golds, spans(tagger(), texts)):
        got = Counter((k, v) for _, _, k, v in found if kinds is None or k in kinds)
        gold = Counter({g: n for g, n in gold.items() if kinds is None or g[0] in kinds})
        right, total, given = right + sum((gold & got).values()), total + sum(gold.values()), given + sum(got.values())
    return right / total, right / given


def test_names_streets_and_phrases_of_neither_list():
    """Texts of another generator: its names, streets and phrases are not in the labelled table."""
    held = held_out.labelled(600, seed=5)
    texts = ["".join(t for t, _ in p) for p in held]
    golds = [Counter((k, read(k, t)) for t, k in p if k != "O") for p in held]
    recall, precision = counted(texts, golds)
    assert recall > 0.97 and precision > 0.99, (recall, precision)
    recall, precision = counted(texts, golds, ("name",))
    assert recall > 0.94 and precision > 0.99, (recall, precision)


def test_lists_are_disjoint():
    forms = {f.lower() for name in held_out.FIRST for f in name.split(" ")}
    assert not forms & {n.lower() for n in (*pii_table.WOMEN, *pii_table.MEN)}
    # Formats of numbers (article, lot, contract) are what they are in both.
    phrases = {p.lower() for p in (*held_out.OPENINGS, *held_out.REMARKS) if "{" not in p}
    assert not phrases & {p.lower() for p in (*pii_table.WORKS, *pii_table.ASIDES, *pii_table.PLACES, *pii_table.THINGS)}


def test_advertisements_written_by_hand():
    right = wrong = missed = 0
    for text, want in ADS:
        got = {k for _, _, k, _ in spans(tagger(), [text])[0]}
        right, wrong, missed = right + len(got & want), wrong + len(got - want), missed + len(want - got)
    assert wrong <= 2 and missed <= 3 and right >= 36, (right, wrong, missed)


def test_stored_weights_are_those_of_a_fit():
    """A small fit, stored and read again, tags alike."""
    small = fitted(rows=150, epochs=3)
    with tempfile.TemporaryDirectory() as d:
        small.save(f"{d}/w.npz")
        again = Chain.load(f"{d}/w.npz", pii.atoms, pii.shape)
    texts = ["".join(t for t, _ in p) for p in held_out.labelled(60, seed=2)]
    a, b = spans(small, texts), spans(again, texts)
    assert sum(x == y for x, y in zip(a, b)) >= 57


def test_examples():
    text = "Куплю дачу недорого\nзвоните: 7 912 962-8609\nт.8 (972) 76З-50-2О\nулица Мельничная, дом 62\nспросить Анну\nкадастровый № 77:01:21625912:34"
    found = spans(tagger(), [text])[0]
    assert [(k, v) for _, _, k, v in found] == [("phone", "9129628609"), ("phone", "9727635020"), ("address", ""), ("name", "")]
    out = redact(text, found)
    assert out == "Куплю дачу недорого\nзвоните: [PHONE]\nт.[PHONE]\n[ADDRESS]\nспросить [NAME]\nкадастровый № 77:01:21625912:34"
    disguised = "Продам коляску, почти новая, e-mail: Nash.Dom12 (at) box . example . net, тел. +7 （９９２） 194-66-65"
    assert [(k, v) for _, _, k, v in spans(tagger(), [disguised])[0]] == [("email", "nash.dom12@box.example.net"), ("phone", "9921946665")]


def test_no_cases():
    for t in ("рядом ЖК «Анна-парк», ост. Кленовая роща", "арт. 45 08 882213", "дом 2019 г., цена 78 900 руб., торг", "салон «Виктория» напротив", ""):
        assert spans(tagger(), [t]) == [[]], t


def test_read():
    assert read("phone", "8 (912) З45-67-8О") == "9123456780" and read("phone", "12 34") is None
    assert read("id_number", "45 08 882213") == "4508882213" and read("id_number", "123") is None
    assert read("email", "A @ B . C") == "a@b.c" and read("email", "a@b") is None
    assert read("address", "улица") is None and read("name", "А") is None


def test_table(spark):
    rows = [(1, "т.89123456789, спросить Анну"), (2, None), (3, ""), (4, "газель " * 4000 + "звоните: 89123456789"), (1, "т.89123456789, спросить Анну"), (5, "​\n ")]
    df = spark.createDataFrame(rows, "seq long, text string").selectExpr("*", "1 as found", "2 as redacted")
    got = {r.seq: sorted((f.kind, f.value) for f in r.found) for r in tagged(df).collect()}
    assert got == {1: [("name", ""), ("phone", "9123456789")], 3: [], 4: [("phone", "9123456789")], 5: []}
    assert tagged(df).count() == 5 and tagged(df.limit(0)).count() == 0
