"""The labelled table of private advertisements that the tagger is trained on.

Texts are put together by a seeded generator from what is said in such advertisements and
from value patterns; every piece carries its label, so the table is exact. Most names,
streets and firms are made of syllables by rule, so that the model has to learn their
shape and surroundings: a list of names would not hold the next one.
"""

from __future__ import annotations

import random

Piece = tuple[str, str]

# What private advertisements say.
DEALS = ("Продам", "Продаю", "Куплю", "Отдам", "Обменяю", "Приму в дар", "Возьму", "Срочно продам", "Продаётся", "Продаются", "Недорого", "Ищу", "Купим", "Отдаю даром")
THINGS = (
    "шкаф-купе", "угловой диван", "холодильник Бирюса", "зимнюю резину R{d}", "ноутбук", "пианино Красный Октябрь", "аккордеон", "щенков таксы", "рассаду", "мёд с пасеки",
    "участок {d} соток", "детскую кроватку", "швейную машинку", "мотоблок", "дрова колотые", "саженцы яблони", "прицеп", "лодку", "рыболовные снасти", "книги", "монеты СССР", "козье молоко",
    "палас 3х{d}", "кирпич б/у", "машиноместо", "аквариум", "попугая с клеткой", "коньки, размер {t}", "свадебное платье", "телевизор", "баян", "стройматериалы", "картофель мешками",
    "автомобиль Волга", "мопед", "гантели", "старые открытки", "тыквы", "компьютерный стол", "теплицу", "кота", "корову", "мебель для кухни",
)
LETS = ("Сниму", "Снимем", "Сдам", "Сдаю", "Сдаём", "Сдаётся", "Пущу на квартиру", "Посуточно", "Аренда:")
HOMES = (
    "однушку", "двушку", "комнату в общежитии", "домик у озера", "коттедж", "гараж", "помещение {t} м²", "дачу на лето", "{d}-комнатную квартиру", "полдома", "студию {t} кв. м",
    "койко-место", "склад", "квартиру студентам", "место под киоск", "баню", "времянку",
)
WORKS = (
    "Уборка квартир", "Кладка плитки", "Вывоз мусора", "Ремонт крыш", "Прокат лыж", "Фотосъёмка праздников", "Няня на выходные", "Сиделка с опытом {d} лет", "Мастер на час", "Электрик, недорого",
    "Вспашка огородов", "Пошив и ремонт одежды", "Перетяжка мебели", "Стрижка собак", "Английский для детей", "Математика, подготовка к ЕГЭ", "Массаж на дому", "Печь-камин под ключ", "Копаю колодцы",
    "Настройка компьютеров", "Маникюр", "Торты на заказ", "Переезды, грузчики", "Спил деревьев", "Уроки гитары", "Бурение скважин", "Помогу с рефератом", "Заточка ножей", "Химчистка ковров",
    "Поклейка обоев", "Замена замков", "Ремонт холодильников на дому", "Вяжу носки", "Переезды, фургон", "Квартирные переезды, тент", "Доставка, бортовой", "Логопед, {d}–{t} лет", "Химия, {d}-{t} класс", "Ищу подработку", "Требуется помощник", "Нужна повариха", "Набираю учеников", "Сборка мебели",
    "Потерян кот, серый", "Найдены ключи", "Утеряны документы", "Ищу попутчика", "Найден щенок", "Нашедшего прошу вернуть",
)
ASIDES = (
    "торг уместен", "без посредников", "состояние хорошее", "возможна доставка", "только наличные", "цена договорная", "от {t} руб.", "{three} рублей", "{d} {three} руб. за всё", "цена {d} млн",
    "{d} {three} {three} р.", "в любое время", "после {t}:00", "строго до 2{d}:00", "по будням", "круглосуточно", "звонить вечером", "рядом школа и сад", "{d} минут до метро", "этаж {d} из 1{d}",
    "площадь {t},{d} кв. м", "площадь {t} м²", "площадь {t},{d} м², {d} этаж", "общая площадь {t},{d} м², жилая {t}", "площадь дома {three} м²", "площадь {t} кв.м, этаж {d}/{t}", "этаж {d}/{t}", "{d}/{t} этаж", "этаж {t}/{t}, лифт", "дом 19{t} года", "постройка 20{t} г.", "с мебелью", "без животных", "опыт {t} лет", "договор, чек", "гарантия {t} мес.", "предоплата {t}%", "новый, в упаковке",
    "самовывоз", "вид на реку", "солнечная сторона", "пенсионерам скидка {t}%", "не агентство", "агентам не беспокоить", "можно в рассрочку", "рост {three} см", "размер {t}-{t}", "пробег {t} {three} км",
    "{three}х{three}х{t} мм", "{four} штук", "кадастровый номер {t}:{t}:0{six}:{three}", "кадастровый № {t}:{t}:{six}:{d}", "кад. № {t}:0{d}:{six}{d}:{t}", "лот {six}", "лот № {four}", "лот №{six}", "артикул {six}",
    "арт. {four}", "арт. {t} {t} {six}", "арт. {t} 0{d} {six}", "артикул {t} {t} {six}", "арт {t}{t} {six}", "артикул {four}-{t}", "заказ {six}", "заказ № {six}", "договор №{four}", "договор № {six}", "код {four}", "серия {t}-{three}", "объявление № {six}{three}", "номер лота {six}{d}",
    "номер {six}{four}", "id {six}", "торг", "срочно", "недорого", "обмен", "тент", "межгород", "город, область", "парковка", "Wi-Fi", "wi-fi, кондиционер", "{t} м², Wi-Fi", "интернет Wi-Fi, балкон", "1–{t} класс", "с {d} до 2{d}",
    "Hi-Tech", "PlayStation {d}", "размер XL", "iPhone {t}", "Bosch, б/у", "{d}–{t} лет", "с нуля", "гибкий график", "пропуск в центр", "кузов {d} м", "{t} м³", "до {d} т", "№{d}", "20{t}", "{t} кг", "2 этаж", "вход со двора",
)
#: Places and firms named after people or streets, which are nobody's personal data.
PLACES = (
    "рядом кафе «{who}»", "магазин «{who}» внизу", "за магазином «{who}»", "салон «{who}»", "аптека «{who}» напротив", "в доме студия красоты «{who}»", "напротив ЖК «{who}-сити»", "ЖК «{who}-парк»",
    "жилой комплекс «{place}»", "ЖК «{place}» сдан", "ЖК {place}, новостройка", "остановка {place}", "ост. {place}", "остановка «{place} роща»", "ост. {place} роща", "станция {place}", "метро {place}", "м. {place}",
    "у парка {place}", "рядом улица {street}", "улица {street} в двух шагах", "недалеко от улицы {street}", "район {place}", "пересечение с улицей {street}", "ТЦ «{place}»", "рынок {place}", "СНТ «{place}»",
    "ул. {street} рядом", "выход на проспект {place}", "кинотеатр «{place}»", "школа «{who}»", "посёлок {place}", "ателье «{who}»", "магазин «{who}» рядом", "турбаза «{place}»", "бренд {place}",
)
# Given names, of which forms are made by rule.
WOMEN = (
    "Зоя", "Лариса", "Галина", "Валентина", "Оксана", "Кристина", "Диана", "Ксения", "Полина", "Дарья", "Виктория", "Вероника", "Маргарита", "Жанна", "Регина", "Инна", "Алла", "Снежана", "Ульяна",
    "Лилия", "Роза", "Вера", "Надежда", "Антонина", "Клавдия", "Евгения", "Александра", "Эльвира", "Варвара", "София", "Милана", "Яна", "Лидия", "Зинаида", "Асель", "Динара", "Камилла", "Лиза", "Катя", "Маша", "Лена",
)
MEN = (
    "Александр", "Владимир", "Виктор", "Юрий", "Олег", "Роман", "Максим", "Артём", "Никита", "Денис", "Кирилл", "Илья", "Егор", "Степан", "Георгий", "Григорий", "Леонид", "Валерий", "Геннадий", "Вячеслав",
    "Станислав", "Владислав", "Ярослав", "Эдуард", "Марат", "Ренат", "Рустам", "Азат", "Камиль", "Артур", "Давид", "Филипп", "Матвей", "Тимофей", "Захар", "Макар", "Яков", "Родион", "Виталий", "Евгений", "Саша", "Миша",
)
BEFORE_ACC = ("спросить ", "спрашивать ", "спросите ", "Спросить ", "зовите ", "пригласить ", "искать ")
BEFORE_DAT = ("звонить ", "звоните ", "позвонить ", "писать ", "Звонить ", "обращаться к ", "пишите ", "написать ")
BEFORE_NOM = (
    "мастер ", "хозяйка ", "хозяин ", "Хозяйка ", "меня зовут ", "зовут ", "контактное лицо: ", "собственник ", "владелец ", "риелтор ", "агент ", "бригадир ", "няня ", "репетитор ", "контакт: ", "имя: ", "ваш сантехник ",
    "с уважением, ", "администратор ", "ведущая ", "",
)
AFTER = (" (хозяин)", " (хозяйка)", " (собственник)", " (владелец)", " (мастер)", ", хозяйка", " — мастер", " (без посредников)", "")
LETTERS = "бвгдзклмнпрстфхчш"


def _stem(r: random.Random, syllables: int) -> str:
    """A made word: consonant, vowel, now and then a closing consonant."""
    out = ""
    for i in range(syllables):
        out += r.choice(LETTERS) + r.choice("аеиоуя" if i else "аеиоуы") + (r.choice("рлнмстйв") if r.random() < 0.35 else "")
    return out


def given(r: random.Random) -> tuple[str, bool]:
    """(nominative, woman); six in ten are made."""
    woman = r.random() < 0.5
    if r.random() < 0.4:
        return r.choice(WOMEN if woman else MEN), woman
    ends = ("ина", "ана", "ета", "ия", "ья", "ара", "ила", "ола", "уша", "ита", "ея", "да", "са") if woman else ("ан", "им", "ей", "ий", "ур", "ат", "ор", "ен", "ил", "он", "ель", "слав", "дар", "ис", "ар", "ым")
    return (_stem(r, r.randrange(1, 3)) + r.choice(ends)).capitalize(), woman


def declined(name: str, dative: bool) -> str:
    """Accusative or dative of a given name."""
    if name.endswith("ия"):
        return name[:-1] + ("и" if dative else "ю")
    if name[-1] in "ая":
        return name[:-1] + ("е" if dative else "у" if name[-1] == "а" else "ю")
    if name[-1] in "йь":
        return name[:-1] + ("ю" if dative else "я")
    return name + ("у" if dative else "а")


def patronymic(r: random.Random, woman: bool) -> str:
    base = given(r)[0]
    while base[-1] in "аяь":
        base = given(r)[0]
    if base.endswith("ий"):
        return base[:-2] + ("ьевна" if woman else "ьевич")
    if base[-1] == "й":
        return base[:-1] + ("евна" if woman else "евич")
    return base + ("овна" if woman else "ович")


def surname(r: random.Random, woman: bool) -> str:
    end = r.choice(("ов", "ов", "ев", "ин", "ин", "цев", "ёв", "ский", "енко", "ук", "ович", "ых", "ян", "ко", "ец"))
    word = (_stem(r, r.randrange(1, 3)) + r.choice(("н", "р", "к", "л", "т", "")) + end).capitalize()
    if woman:
        word = word[:-2] + "ая" if end == "ский" else word + "а" if end in ("ов", "ев", "ин", "цев", "ёв") else word
    return word


def place(r: random.Random) -> str:
    """Name of a place: an adjective or a noun, sometimes two words."""
    word = (_stem(r, r.randrange(1, 3)) + r.choice(("ский", "ная", "ово", "инка", "ка", "ье", "град", "вка", "ный", "чье", "ск"))).capitalize()
    return word + r.choice(("", "", "", " луга", " роща", " ключ", " квартал", "-парк", " пристань"))


def street(r: random.Random) -> str:
    """A street's name that agrees with a feminine kind."""
    word = (_stem(r, r.randrange(1, 3)) + r.choice(("ная", "ская", "овая", "чная", "ая", "инская", "няя"))).capitalize()
    return r.choice(("Новая", "Северная", "Победы", "Мира", "Ленина", "Гагарина", "Садовая", "9 Мая", word, word, word, word, word, word, word, word))


def _digits(r: random.Random, n: int) -> str:
    return "".join(r.choice("0123456789") for _ in range(n))


def _phone(r: random.Random) -> list[Piece]:
    a, b, c, d = r.choice("3489") + _digits(r, 2), _digits(r, 3), _digits(r, 2), _digits(r, 2)
    p = r.choice(("8", "+7", "7", "8", "+7"))
    joint = r.choice((" ", "-", " ", ".", "", " – ", " - "))
    text = r.choice((
        f"{p} ({a}) {b}-{c}-{d}", f"{p}({a}){b}{c}{d}", f"{p}{a}{b}{c}{d}", f"{p}({a}) {b} {c} {d}", f"{p} {a} {b}-{c}-{d}", f"{p}{joint}{a}{joint}{b}{joint}{c}{joint}{d}", f"({a}) {b}-{c}-{d}",
        f"{p} {a} {b}{c}{d}", f"{p} {a} {b}-{c}{d}", f"{a}{b}{c}{d}", f"{p}-{a}-{b}{c}{d}", f"{p} {a}-{b}-{c}-{d}", f"({a}) {b} {c}{d}",
    ))
    kind = r.random()
    if kind < 0.2:  # misread digits
        pairs = (("3", "З"), ("0", "О"), ("0", "O"), ("0", "о"), ("3", "з"))
        for old, new in r.sample(pairs, 2):
            text = text.replace(old, new, r.randrange(1, 3))
    elif kind < 0.3 and " " in text:  # broken over lines
        at = r.choice([i for i, c in enumerate(text) if c == " "])
        text = text[:at] + "\n" + text[at + 1 :]
    lead = r.choice(("тел. ", "т. ", "т.", "тел: ", "телефон ", "Телефон: ", "звоните: ", "звонить ", "моб. ", "WhatsApp ", "Viber ", "вотсап ", "сот. ", "", "", "", "по тел. "))
    return [(lead, "O"), (text, "phone")]


def _email(r: random.Random) -> list[Piece]:
    roman = lambda n: "".join(r.choice("bdgklmnprstvz") + r.choice("aeiou") for _ in range(n))
    user = r.choice((roman(3), roman(2) + "." + r.choice("abcdeks"), roman(2) + "_" + roman(1), roman(4), roman(2) + "-" + roman(2), r.choice("abcds") + "." + roman(3), roman(2) + "_" + r.choice("aims")))
    user += r.choice(("", "", str(r.randrange(1, 99)), str(r.randrange(100, 9999)), "." + str(r.randrange(10, 99)), "_" + str(r.randrange(10, 99))))
    host = [r.choice((roman(2), roman(3), roman(2) + r.choice("nsx"))), *(["example"] if r.random() < 0.5 else []), r.choice(("com", "org", "net", "ru", "info"))]
    at = r.choice(("@", "@", "@", "@", " @ ", "(at)", " (at) ", " собака ", "[at]"))
    text = user + at + r.choice((".", ".", ".", " . ")).join(host)
    if r.random() < 0.15:
        text = text.upper() if r.random() < 0.6 else text.title()
    return [(r.choice(("", "", "e-mail: ", "e-mail:", "почта ", "почта: ", "email ", "мейл ", "пишите на ")), "O"), (text, "email")]


def _id(r: random.Random) -> list[Piece]:
    n = lambda k: _digits(r, k)
    lead, text, tail = r.choice((
        ("паспорт ", f"{n(2)} {n(2)} {n(6)}", ""), ("пасп. ", f"{n(4)} {n(6)}", ""), ("паспорт серия ", f"{n(4)} № {n(6)}", ""), ("паспорт: ", f"{n(4)} {n(6)}", ""), ("паспорт № ", f"{n(4)} {n(6)}", ""),
        ("паспорт гражданина ", f"{n(10)}", ""), ("документ ", f"{n(4)}-{n(6)}", ", паспорт РФ"), ("паспортные данные ", f"{n(2)} {n(2)} {n(6)}", ""), ("СНИЛС ", f"{n(3)}-{n(3)}-{n(3)} {n(2)}", ""), ("СНИЛС ", n(11), ""),
        ("снилс: ", f"{n(3)}-{n(3)}-{n(3)}-{n(2)}", ""), ("снилс ", f"{n(3)}-{n(3)}-{n(3)}-{n(2)}", ""), ("", f"{n(3)}-{n(3)}-{n(3)}-{n(2)}", ""), ("СНИЛС № ", f"{n(3)} {n(3)} {n(3)} {n(2)}", ""), ("ИНН ", n(12), ""), ("инн физлица ", n(12), ""), ("ИНН: ", n(12), ""), ("мой ИНН ", n(12), ""),
        ("паспорт РФ ", f"{n(4)} {n(6)}", ""), ("", f"{n(3)}-{n(3)}-{n(3)} {n(2)}", ""), ("", f"{n(3)}-{n(3)}-{n(3)} {n(2)}", ""), ("паспорт ", f"{n(2)} {n(2)} {n(6)}", ""), ("страховое св-во ", f"{n(3)}-{n(3)}-{n(3)} {n(2)}", ""),
    ))
    return [(lead, "O"), (text, "id_number"), (tail, "O")]


def _address(r: random.Random) -> list[Piece]:
    s = street(r)
    man = (_stem(r, r.randrange(1, 3)) + r.choice(("ный", "ский", "овый", "ний", "ой"))).capitalize()
    people = r.choice((surname(r, False) + "а", (_stem(r, 2) + r.choice(("ов", "ей", "иц", "арей", "щиков"))).capitalize(), "Победы", "Мира", "Маршала " + surname(r, False) + "а"))
    h = str(r.randrange(1, 199)) + r.choice(("", "", "", "", "а", "Б", "/" + str(r.randrange(1, 20)), "к" + str(r.randrange(1, 6)), "к" + str(r.randrange(1, 6)), " к" + str(r.randrange(1, 6)), " корпус " + str(r.randrange(1, 6)), " корп. 2", " стр. 1", "-" + str(r.randrange(1, 200))))
    flat = r.choice(("", "", "", f", кв. {r.randrange(1, 300)}", f" кв {r.randrange(1, 300)}", f", квартира {r.randrange(1, 300)}", f", подъезд {r.randrange(1, 9)}", f", этаж {r.randrange(1, 20)}", f"-{r.randrange(1, 300)}", f", офис {r.randrange(1, 90)}"))
    house = r.choice((f", дом {h}", f", д. {h}", f", д.{h}", f" {h}", f", {h}", f" дом {h}", f" д {h}"))
    name = r.choice((
        f"улица {s}", f"ул. {s}", f"ул {s}", f"{s} ул.", f"{s} улица", f"ул.{s}", f"{man} пр-т", f"{man} проспект", f"проспект {people}", f"пр. {people}", f"пр-т {people}", f"{man} б-р", f"{man} б-р", f"б-р {people}", f"бульвар {people}", f"{man} бульвар",
        f"{man} переулок", f"пер. {people}", f"пер. {man}", f"переулок {people}", f"проезд {people}", f"{man} проезд", f"шоссе {people}", f"{man} шоссе", f"ш. {people}", f"{s} набережная", f"наб. {people}", f"площадь {people}", f"пл. {people}",
        f"{man} тупик", f"{s} аллея", f"{s} линия",
    ))
    text = name + house + flat
    if r.random() < 0.08:
        text = text.upper()
    elif r.random() < 0.08:
        text = text.lower()
    return [(r.choice(("", "", "", "адрес: ", "адрес ", "находимся: ", "по адресу ", "приходите: ")), "O"), (text, "address")]


def _name(r: random.Random) -> list[Piece]:
    base, woman = given(r)
    sur, pat = surname(r, woman), patronymic(r, woman)
    i, j = base[0], pat[0]
    kind = r.randrange(12)
    if kind < 2:
        return [(r.choice(BEFORE_ACC), "O"), (declined(base, False), "name")]
    if kind < 4:
        return [(r.choice(BEFORE_DAT), "O"), (declined(base, True), "name")]
    if kind == 4:
        return [(base, "name"), (r.choice(AFTER), "O")]
    text = r.choice((base, base, base, f"{base} {pat}", f"{base} {pat}", f"{sur} {base} {pat}", f"{base} {pat} {sur}", f"{i}.{j}. {sur}", f"{i}. {j}. {sur}", f"{sur} {i}. {j}.", f"{sur} {i}.{j}.", f"{base} {sur}", f"{sur} {base}"))
    if r.random() < 0.3:
        text = text.upper()
    return [(r.choice(BEFORE_NOM) if r.random() < 0.4 else "", "O"), (text, "name")]


MAKERS = {"phone": _phone, "email": _email, "id_number": _id, "address": _address, "name": _name}


def _said(r: random.Random, phrase: str) -> str:
    """A phrase with its numbers and names filled in; each blank anew."""
    fill = {
        "{d}": lambda: str(r.randrange(1, 10)), "{t}": lambda: str(r.randrange(10, 99)), "{three}": lambda: _digits(r, 3), "{four}": lambda: str(r.randrange(1000, 9999)), "{six}": lambda: _digits(r, 6),
        "{who}": lambda: given(r)[0], "{place}": lambda: place(r), "{street}": lambda: street(r),
    }
    for blank, make in fill.items():
        while blank in phrase:
            phrase = phrase.replace(blank, make(), 1)
    return phrase


def _opening(r: random.Random) -> str:
    kind = r.random()
    if kind < 0.4:
        text = f"{r.choice(DEALS)} {r.choice(THINGS)}"
    elif kind < 0.65:
        text = f"{r.choice(LETS)} {r.choice(HOMES)}"
    else:
        text = r.choice(WORKS)
    if r.random() < 0.3:
        text += ", " + r.choice(ASIDES)
    return _said(r, text)


def labelled(rows: int = 12000, seed: int = 11) -> list[list[Piece]]:
    """`rows` texts as pieces (text, label); the label O is for what isn't personal."""
    r = random.Random(seed)
    out = []
    for _ in range(rows):
        parts: list[list[Piece]] = []
        if r.random() < 0.9:
            opening = _opening(r)
            parts.append([(opening.upper() if r.random() < 0.12 else opening, "O")])
        body = [MAKERS[k](r) for k in r.choices(tuple(MAKERS), (5, 2, 2, 3, 5), k=r.choice((0, 1, 1, 2, 2, 3, 4, 5)))]
        body += [[(_said(r, r.choice(ASIDES if r.random() < 0.6 else PLACES)), "O")] for _ in range(r.randrange(0, 5))]
        r.shuffle(body)
        if r.random() < 0.15:  # signed right after what is offered
            body.insert(0, _name(r))
        parts += body
        gap = r.choice(("\n", "\n", ", ", ", ", ". ", ". ", " ", " ", " ", " ", "; ", "\n\n"))
        pieces: list[Piece] = []
        for i, p in enumerate(parts):
            pieces += ([(gap if r.random() < 0.9 else ", ", "O")] if i else []) + p
        if r.random() < 0.2:
            pieces.append((r.choice((".", "!", " ", "...")), "O"))
        if r.random() < 0.07:
            pieces = [(t.upper(), k) for t, k in pieces]
        elif r.random() < 0.03:
            pieces = [(t.lower(), k) for t, k in pieces]
        out.append([p for p in pieces if p[0]])
    return out
