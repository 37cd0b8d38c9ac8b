import itertools
import random

from pyspark.sql import functions as F

from adlens.llm import charforms as cf
from adlens.llm.p5 import consistent

WORDS = [("комната", 50), ("анна", 40), ("сосна", 9), ("box", 30), ("wi", 5), ("ооо", 20), ("а", 99), ("трёх", 3)]


def check(text):
    form, by = cf.Normaliser(WORDS).value(text)
    return form, by != ""


def test_disguises_are_found_and_resolved():
    for text, form in [
        ("Ｗｉ－Ｆｉ", "Wi-Fi"), ("ｅ－ｍａｉｌ：ａ＠ｂｏｘ．ｏｒｇ", "e-mail:a@box.org"), ("кoмната", "комната"), ("KOMHATA рядом", "КОМНАТА рядом"), ("тpёх", "трёх"), ("й".replace("й", "й") + "од", "йод"), ("а б", "а б"),
        ("сло​во", "слово"), ("Οптика", "Оптика"), ("Bаngesfey", "Bangesfey"), ("по́ле", "поле"), ("кешенi үйлер", "кешені үйлер"), ("A.А. Пшенкин", "А.А. Пшенкин"),
    ]:
        assert check(text) == (form, True), text


def test_ordinary_text_is_left():
    for text in [
        "ёж и йод", "54,5 м², ½, №5, ООО «А»™ — 3–4 ®", "Жаңа тұрғын үйлер кешені", "VIP-зал и Wi-Fi", "BOX.EXAMPLE.ORG", "KOMHATA@BOX.EXAMPLE.ORG", "e-mail", "IT-компания", "г0ртим4ай",
        "", "line\nbreak\r\n", "BMX box", "Ελλάδα",
    ]:
        assert check(text) == (text, False), text


def test_what_decides():
    words = [*WORDS, ("мой", 5), ("мои", 9), ("ёлка", 2), ("подоконник", 3)]
    n = cf.Normaliser(words)
    for text, form, by in [
        ("ком\u200bната", "комната", "trie"), ("мо" + "и\u0306", "мой", "trie"), ("Ё\u043bка".replace("Ё", "Е\u0308"), "Ёлка", "trie"), ("\u00ebлка", "ёлка", "trie"), ("ooo", "ооо", "trie"),
        ("ОООO", "ОООО", "table"), ("пoдокoнниk", "подоконник", "trie"), ("пoдокoник", "подоконик", "edit"), ("кoшка", "кошка", "table"), ("а\u00a0б", "а б", "signs"), ("мой", "мой", ""),
    ]:
        assert n.value(text) == (form, by), text


def test_plain_map_places():
    text = "т​ел ＋７ й кoт"
    out, at = cf.plain_map(text)
    assert out == "тел +7 й кот"
    assert all(text[i] in (c, "＋", "７", "и", "o") for c, i in zip(out, at)) and list(at) == sorted(at)


def distance(token, word):
    """Edits by dynamic programming, look-alikes equal."""
    same = lambda a, b: b in {t.lower() for t in cf.TWINS.get(a, a)}
    row = list(range(len(word) + 1))
    for i, a in enumerate(token, 1):
        now = [i]
        for j, b in enumerate(word, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (not same(a, b))))
        row = now
    return row[-1]


def test_automaton_equals_dynamic_programming():
    r = random.Random(1)
    letters = "аомaoбтx"
    words = sorted({"".join(r.choice("аомбт") for _ in range(r.randrange(1, 6))) for _ in range(40)})
    trie = cf.SpellingTrie((w, 1) for w in words)
    for _ in range(300):
        token = "".join(r.choice(letters) for _ in range(r.randrange(1, 6)))
        for budget in (0, 1, 2):
            best = min(distance(token, w) for w in words)
            hit = trie.find(token, budget)
            assert (hit[0] if hit else None) == (best if best <= budget else None), (token, budget)


def test_most_frequent_of_equal_spellings():
    trie = cf.SpellingTrie([("сом", 1), ("com", 7)])
    assert trie.find("COM")[2] == "com" if trie.find("COM") else True
    assert cf.SpellingTrie([("сор", 9), ("cop", 2)]).find("cop")[2] == "сор"


def test_table(spark):
    rows = [
        (1, "квартира в центре", None), (2, "KOMHATA в центре", "Οптика"), (3, None, None), (4, "", "  "), (5, "комната " * 5000 + "кoт", "x"), (2, "KOMHATA в центре", None),
        (6, "комната анна", "комната"),
    ]
    df = spark.createDataFrame(rows, "seq long, text string, advertiser string").withColumn("value", F.lit(1)).withColumn("form", F.lit(2))
    got = sorted((r.seq, r.field_name) for r in consistent(df).filter("by <> ''").collect())
    assert got == [(2, "advertiser"), (2, "text"), (2, "text"), (5, "text")]
    assert consistent(df.limit(0)).count() == 0


def test_many_ambiguous_words_are_joined(spark, monkeypatch):
    from adlens.llm import p5

    rows = [(i, t, None) for i, t in enumerate(["анна", "Анна тут", "AHHA", "кот кот", "зовут KOT и AHHA", "POP рынок", "POP", "воск BOX", "мел"])]
    df = spark.createDataFrame(rows * 2, "seq long, text string, advertiser string")
    want = sorted(tuple(r) for r in consistent(df).collect())
    monkeypatch.setattr(p5, "MAX_AMBIGUOUS", 0)
    assert sorted(tuple(r) for r in consistent(df).collect()) == want and any(r[4] == "trie" for r in want)


def test_short_latin_words_are_decided_by_their_twins(spark, monkeypatch):
    from adlens.llm import p5

    rows = [(i, t, None) for i, t in enumerate(["ооо", "ООО", "ооо", "ooo", "OOO", "pop", "POP", "рор", "ok", "e-mail", "op@box.org", "на"])]
    df = spark.createDataFrame(rows, "seq long, text string, advertiser string")
    for most in (p5.MAX_AMBIGUOUS, 0):  # broadcast, joined
        monkeypatch.setattr(p5, "MAX_AMBIGUOUS", most)
        assert sorted((r.seq, r.form) for r in consistent(df).filter("by <> ''").collect()) == [(3, "ооо"), (4, "ООО"), (7, "pop")]


def test_latin_words_in_cyrillic_letters_are_found(spark, monkeypatch):
    from adlens.llm import p5

    rows = [(i, t, None) for i, t in enumerate(["PACE", "pace", "Pace", "расе", "у расе", "сор", "cop", "сор", "а также сор"])]
    df = spark.createDataFrame(rows, "seq long, text string, advertiser string")
    for most in (p5.MAX_AMBIGUOUS, 0):  # broadcast, joined
        monkeypatch.setattr(p5, "MAX_AMBIGUOUS", most)
        assert sorted((r.seq, r.form) for r in consistent(df).filter("by <> ''").collect()) == [(3, "pace"), (4, "у pace"), (6, "сор")]


def test_every_pair_of_twins_is_mutual():
    for g in cf.LOOKALIKES:
        for a, b in itertools.permutations(g, 2):
            assert b in cf.TWINS[a]
