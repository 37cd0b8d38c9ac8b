import random
from itertools import product
from pathlib import Path

import numpy as np
import pytest

from adlens.llm.p8 import fitted, subjects
from adlens.llm.subjects import SubjectModel, pieces

DATA = Path("/root/testdata/sf0.01")
ADS = {
    "авто": ["Шиномонтаж круглосуточно", "Тест-драйв нового кроссовера", "Запчасти для иномарок", "Замена масла без записи"],
    "финансы": ["Вклад под высокий процент", "Ипотека без взноса", "Кредит наличными за час", "Карта с кешбэком"],
    "медицина": ["Брекеты в рассрочку", "Приём невролога без очереди", "Анализы крови утром", "Ночная аптека рядом"],
    "другое": ["Проход закрыт до июня", "Не кормите голубей", "Собрание жильцов в четверг", "Перепись населения идёт"],
}
NOTES = ["Кадр слегка смазан.", "Столб закрывает строку.", "Проверяющий поставил вопрос."]


def made(seed, n):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        main = r.choice(list(ADS))
        kinds = [main] if main == "другое" or r.random() < 0.7 else sorted({main, r.choice(["авто", "финансы", "медицина"])})
        parts = [r.choice(ADS[k]) + r.choice(".!") for k in kinds for _ in range(r.randrange(1, 4))]
        parts += r.sample(NOTES, r.randrange(0, 3))
        r.shuffle(parts)
        n_of = {k: sum(any(p.startswith(a) for a in ADS[k]) for p in parts) for k in kinds}
        out.append((r.choice([" ", "\n"]).join(parts), [k for k in kinds if n_of[k] * 5 >= sum(n_of.values())]))
    return out


def test_made_documents():
    model = SubjectModel().fit(made(1, 400))
    held = made(2, 200)
    got = model.classify([t for t, _ in held])
    assert sum(sorted(g) == sorted(s) for g, (_, s) in zip(got, held)) > 190
    assert model.classify([None, "", " \n"]) == [[], [], []]
    assert len(model.classify(["Кадр слегка смазан."])[0]) == 1


def test_pieces():
    stems, gaps = pieces("Растяжка. Вторая!\n- третья, ЗАГЛАВНЫЕ СЛОВА тут")
    assert stems == ["растяж", "вторая", "третья", "заглав", "слова", "тут"] and gaps == ["stop", "line", "inner", "title", "space"]


def test_empty_model():
    assert SubjectModel().fit([]).classify(["слово"]) in ([[]], [["недвижимость"]])


def test_table(spark):
    docs = [(i, t) for i, (t, _) in enumerate(made(3, 150))] + [(900, None), (901, ""), (902, " \n\t"), (903, "Шиномонтаж круглосуточно. " * 3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as subjects", "2 as subject")
    labels = spark.createDataFrame([(i, s) for i, (_, ss) in enumerate(made(3, 150)) for s in ss] + [(None, "авто"), (5, None), (77777, "авто")], "doc_id long, subject string")
    items = spark.createDataFrame([(1, "Складной стела позади погоста."), (2, None)], "item_id long, text string")
    got = {r.doc_id: r.subjects for r in subjects(df, fitted(df, labels, items)).collect()}
    assert not {900, 901, 902} & got.keys() and got[903] == ["авто"] and len(got) == 151
    assert subjects(df.limit(0), fitted(df, labels.limit(0), items.limit(0))).count() == 0


def test_every_labelled_text_and_item_teaches(spark):
    """However many there are, and however long."""
    words = ["".join(w) for w in product("бвгдж", repeat=6)][:9_000]
    docs = [(i, f"{w} {w}") for i, w in enumerate(words[:6_500])] + [(6_500, "Шиномонтаж круглосуточно. " * 3000 + "Вулканизация, вулканизация.")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "авто") for i, _ in docs], "doc_id long, subject string")
    items = spark.createDataFrame([(i, f"{w} {w}") for i, w in enumerate(words[6_500:])], "item_id long, text string")
    model = fitted(df, labels, items)
    assert {*words, "шиномо", "вулкан"} <= model.word.keys()


def test_one_process_and_passes_over_a_table_give_equal_models(spark):
    """Beside a fit in memory, and at other orders and splits of the rows."""
    data, notes = made(5, 120), ["Складной стела позади погоста.", "Складной зонт."]
    labels = spark.createDataFrame([(i, s) for i, (_, ss) in enumerate(data) for s in ss], "doc_id long, subject string")
    rows = [(i, t) for i, (t, _) in enumerate(data)]
    items = spark.createDataFrame(list(enumerate(notes)), "item_id long, text string")
    want = SubjectModel().fit(data, notes)
    for order, parts, local_words in ((1, 1, 10**6), (-1, 3, 0)):
        got = fitted(spark.createDataFrame(rows[::order], "doc_id long, text string").repartition(parts), labels, items, local_words)
        assert got.word == want.word and np.array_equal(got.pair, want.pair) and got.boundaries.two == want.boundaries.two
        assert (got.weights, got.margin, got.threshold) == (want.weights, want.margin, want.threshold)
        assert np.array_equal(got.p1, want.p1) and np.array_equal(got.p2, want.p2)


def test_a_long_batch_scores_its_last_text_like_its_first():
    model = SubjectModel().fit(made(1, 100))
    numbers = model._numbers([["шиномо", "кругло"]] * 100_000)
    score = model._likelihood(numbers)
    assert np.abs(score - score[0]).max() < 1e-9


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_held_out_labels(spark):
    """Labels that the models weren't fitted on; a few of them are wrong."""
    t = {n: spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "doc_labels", "eval_items")}
    train, test = t["doc_labels"].filter("doc_id % 3 > 0"), t["doc_labels"].filter("doc_id % 3 = 0")
    gold = {}
    for r in test.collect():
        gold.setdefault(r.doc_id, set()).add(r.subject)
    got = {r.doc_id: set(r.subjects) for r in subjects(t["documents"], fitted(t["documents"], train, t["eval_items"])).collect()}
    right = sum(len(got[d] & g) for d, g in gold.items() if d in got)
    assert right / sum(map(len, gold.values())) > 0.8 and right / sum(len(got[d]) for d in gold if d in got) > 0.8
