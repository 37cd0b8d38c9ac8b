"""Keyword, zero-shot and visual scores as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens.functions.binding import let
from adlens.functions.text import name_key, strip

OTHER, UNKNOWN = "другое", "не определено"
MIN_TEXT = 4

# Words that point to a category, matched as substrings of lower-case text.
KEYWORDS: dict[str, tuple[str, ...]] = {
    "недвижимость": (
        "жк ", "жилой комплекс", "квартир", "новостро", "застройщик", "ипотек", "апартамент", "недвижим", "м²", "кв.м", "от застройщика",
        "продажа квартир", "таунхаус", "коттедж", "риэлт", "квартал", "аренда", "аренду", "снять", "сдам", "сдаёт", "сдает", "сдаётся",
        "сдается", "продажа", "продаётся", "продается", "продам", "куплю", "студи", "комнат", "участок", "заселение", "сдача", "монолит",
        "офис продаж", "дом от", "квартиры от", "заезжай",
    ),
    "авто": ("автосалон", "автосервис", "шиномонтаж", "запчаст", "кредит на авто", "лада", "toyota", "kia", "автомобил", "шины", "автомойка"),
    "финансы": ("банк", "кредит", "займ", "вклад", "страхов", "микрозайм", "рассрочк", "инвест", "ипотека под"),
    "медицина": ("клиник", "стоматолог", "медицин", "аптек", "здоровь", "лечени", "диагностик", "анализы"),
    "ретейл": ("магазин", "скидк", "распродаж", "супермаркет", "sale", "акция", "торговый центр", "тц "),
    "развлечения": ("концерт", "театр", "кино", "фестивал", "парк", "шоу", "билеты"),
    "услуги": (
        "ремонт", "услуги", "юрист", "образован", "курсы", "салон красоты", "клининг", "доставка", "набор на службу", "ваканс", "работа в",
        "мастер", "химчистка", "ателье",
    ),
}
# Names that count double, scanned before the keywords.
NAMES: dict[str, tuple[str, ...]] = {
    "ретейл": (
        "wildberries", "wb.ru", "ozon", "магнит", "пятёрочка", "пятерочка", "перекрёсток", "перекресток", "дикси", "лента", "ашан", "метро",
        "kfc", "rostic", "ростикс", "макдоналдс", "вкусно и точка", "бургер", "л'этуаль", "летуаль", "sunlight", "санлайт", "улыбка радуги",
        "miele", "bosch", "самокат", "вкусвилл", "фикс прайс", "fix price", "спортмастер", "детский мир", "эльдорадо", "днс", "dns", "мвидео",
        "золото", "ювелир", "шаурма", "пекарня", "кофе", "пассаж", "молл",
    ),
    "авто": ("лукойл", "газпромнефть", "роснефть", "татнефть", "shell", "азс", "дизельных", "двигател", "автозапчаст", "колёса", "колеса"),
    "финансы": (
        "сбер", "втб", "тинькофф", "т-банк", "альфа-банк", "газпромбанк", "открытие", "совкомбанк", "кэшбэк", "кешбэк", "выплата",
        "погашение ипотеки", "вклад под",
    ),
    "развлечения": (
        "киномакс", "кинопоказ", "формула кино", "каро", "спасская башня", "выставка", "фестивал", "день индии", "лето в москве", "музей",
        "цирк", "аквапарк", "мультимедийная",
    ),
    "медицина": ("инвитро", "гемотест", "медси", "он клиник", "стоматологи", "оптика", "зрение", "линзы"),
    "недвижимость": ("самолет", "самолёт", "пик", "а101", "донстрой", "эталон", "гранель", "мр групп", "офис продаж", "квартал", "жк "),
}


def hits(low: Column, words: Sequence[str], weight: int = 1) -> Column:
    return reduce(lambda total, w: total + F.contains(low, F.lit(w)).cast("int"), words, F.lit(0)) * weight


def keyword_category(text: Column, names: Mapping[str, Sequence[str]] = NAMES, keywords: Mapping[str, Sequence[str]] = KEYWORDS) -> Column:
    """Category of most hits; of equals the one scanned first, names before keywords.

    Text under four characters tells nothing; text without hits is something else.
    """
    scan = [(cat, words, 2) for cat, words in names.items()] + [(cat, words, 1) for cat, words in keywords.items()]

    def best_of(low: Column) -> Column:
        scored = [F.struct(hits(low, words, w).alias("hits"), F.lit(-i).alias("order"), F.lit(cat).alias("category")) for i, (cat, words, w) in enumerate(scan)]
        best = let(F.array_max(F.array(*scored)), lambda b: F.when(b["hits"] == 0, OTHER).otherwise(b["category"]))
        return F.when(F.length(low) < MIN_TEXT, UNKNOWN).otherwise(best)

    return let(F.lower(strip(F.coalesce(text, F.lit("")))), best_of)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Null for a zero vector."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def softmax(scores: Column, scale: float = 1.0) -> Column:
    """Probabilities of an array of scores, safe against overflow."""
    spread = lambda s: let(F.array_max(s), lambda top: F.transform(s, lambda x: F.exp((x - top) * scale)))
    total = lambda e: F.aggregate(e, F.lit(0.0), lambda s, y: s + y)
    return let(let(scores, spread), lambda e: let(total(e), lambda t: F.transform(e, lambda x: x / t)))


def zero_shot(vector: Column, prompts: Sequence[tuple[str, Sequence[float]]], scale: float = 1.0) -> Column:
    """array<struct<p, name>> of softmax(scale * cosine) over the prompts."""
    names = F.array(*[F.lit(n) for n, _ in prompts])
    cosines = F.array(*[cosine(vector, F.lit([float(x) for x in v])) for _, v in prompts])
    return F.zip_with(softmax(cosines, scale), names, lambda p, n: F.struct(p.alias("p"), n.alias("name")))


def classified(text: Column, vector: Column | None = None, prompts: Sequence[tuple[str, Sequence[float]]] = ()) -> Column:
    """Category of a reading: the likeliest prompt where there is a picture's vector, else by the words of its text."""
    if vector is None or not prompts:
        return keyword_category(text)
    best = F.array_max(F.filter(zero_shot(vector, prompts), lambda s: s["p"].isNotNull()))
    return F.coalesce(F.when(F.size(vector) > 0, best["name"]), keyword_category(text))


# Thresholds of the visual gate.
def visual_gate(
    edges: Column, colour: Column, saturation: Column, bright: Column, dark: Column, contrast: Column, has_text: Column | None = None,
    min_edges: float = 0.025, min_colour: float = 18.0, min_saturation: float = 0.12, min_bright: float = 0.45, min_dark: float = 0.01, min_contrast: float = 18.0,
) -> Column:
    """struct<is_ad, score>: textured and colourful, or paper-like, or textured with text."""
    textured = edges >= min_edges
    colourful = (colour >= min_colour) | (saturation >= min_saturation)
    paper = textured & (bright >= min_bright) & (dark >= min_dark) & (contrast >= min_contrast)
    worded = (has_text if has_text is not None else F.lit(False)) & textured
    score = F.least(F.lit(1.0), 0.5 * edges / min_edges + 0.5 * colour / min_colour)
    return F.struct(F.coalesce((textured & colourful) | paper | worded, F.lit(False)).alias("is_ad"), F.bround(score, 3).alias("score"))


def word_recall(truth: Column, got: Column) -> Column:
    """Share of the truth's words of three letters or more found in the reading; null if it has none."""
    words = F.filter(F.split(name_key(truth, "%"), " "), lambda w: F.length(w) >= 3)
    found = lambda ws, hay: F.try_divide(F.size(F.filter(ws, lambda w: F.contains(hay, w))), F.size(ws))
    return let(name_key(got, "%"), lambda hay: let(words, lambda ws: found(ws, hay)))


def answer_matches(expected: Column, got: Column) -> Column:
    """Nothing expected: nothing got. Otherwise the normal form is contained."""
    none = F.coalesce(expected, F.lit("")) == ""
    empty = F.coalesce(got, F.lit("")) == ""
    return F.when(none, empty).otherwise(~empty & F.contains(name_key(got, "%"), name_key(expected, "%")))
