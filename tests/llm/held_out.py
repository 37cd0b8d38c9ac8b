"""Made private advertisements whose names, streets and phrases the model was not trained on.

Only tests use them: the labelled table of the package has other lists (checked by a test).
"""

from __future__ import annotations

import random

# Phrases of private advertisements that hold nothing personal.
OPENINGS = (
    "Куплю дачу недорого", "Сдаётся студия, {n} м², Wi-Fi", "Грузоперевозки, газель", "Продаю гараж и погреб", "Шью шторы на заказ",
    "Ремонт стиральных машин, стаж {n} лет", "Ищу помощницу по дому", "Сниму комнату, семья без животных", "Продам коляску, почти новая",
    "Репетитор по физике, 8–11 класс", "Сдам {d}-комн. квартиру на длительный срок", "Отдам котят в добрые руки", "Меняю квартиру на дом",
    "Продам велосипед", "Установка дверей и окон", "Набор детей в секцию", "Пропала собака, рыжая", "Услуги сантехника",
)
REMARKS = (
    "смотреть после 1{d}:00", "метро Ольховая {d} мин пешком", "залог {t}%", "с 9 до 21, без выходных", "дом 20{t} г.", "от собственника, без комиссии",
    "площадь {t},{d} м², этаж {d}/{t}", "ост. Кленовая роща", "арт. {t} 0{d} {six}", "лот № {six}", "кадастровый № 77:0{d}:{six}{t}:{t}",
    "рядом ЖК «Анна-парк»", "салон «Виктория» напротив", "цена {t} {three} руб., торг", "цена {d} млн руб., торг", "цена {four} руб., торг",
    "остановка Садовая", "рядом улица Заречная", "магазин «Светлана» во дворе", "договор № {six}", "заказ № {four}", "номер {d}{six}{three}",
    "улица Полынная рядом", "ЖК «Дубровка», сдан в 20{t}", "студия «Марина» на первом этаже", "артикул {four} {six}", "до парка {d} минут",
)
FIRST = (
    "Анна Анну Анне", "Ольга Ольгу Ольге", "Нина Нину Нине", "Дина Дину Дине", "Тамара Тамару Тамаре", "Ирина Ирину Ирине", "Раиса Раису Раисе",
    "Марина Марину Марине", "Светлана Светлану Светлане", "Гульнара Гульнару Гульнаре", "Алина Алину Алине", "Елена Елену Елене", "Наталья Наталью Наталье",
    "Мария Марию Марии", "Людмила Людмилу Людмиле", "Татьяна Татьяну Татьяне", "Юлия Юлию Юлии", "Екатерина Екатерину Екатерине",
    "Сергей Сергея Сергею", "Борис Бориса Борису", "Антон Антона Антону", "Аркадий Аркадия Аркадию", "Павел Павла Павлу", "Руслан Руслана Руслану",
    "Ильдар Ильдара Ильдару", "Тимур Тимура Тимуру", "Игорь Игоря Игорю", "Глеб Глеба Глебу", "Фёдор Фёдора Фёдору", "Иван Ивана Ивану",
    "Пётр Петра Петру", "Николай Николая Николаю", "Алексей Алексея Алексею", "Дмитрий Дмитрия Дмитрию", "Михаил Михаила Михаилу", "Андрей Андрея Андрею",
)
#: All forms of the given names, in lower case.
GIVEN = frozenset(form.lower() for name in FIRST for form in name.split(" "))
PATRONYMIC = ("Борисович", "Аркадьевич", "Игоревич", "Антонович", "Тимурович", "Глебович", "Павлович", "Русланович", "Сергеевич", "Фёдорович", "Иванович", "Петрович")
SURNAME = (
    "Осоргунов", "Дерюжин", "Копыловец", "Тырсанов", "Зимогоров", "Журбаков", "Пшенкин", "Кувшинцев", "Хворостов", "Лядовцев", "Вощанов",
    "Бражелуков", "Подберёзов", "Чернопяткин", "Гуслянов", "Мелехонин", "Иванов", "Соколин", "Ряполов", "Туманцев", "Сухорук", "Бондаренко",
)
STREET = ("Рябинов", "Ольхов", "Льнян", "Кленов", "Заречн", "Сосн", "Мельничн", "Лодочн", "Валунн", "Ткацк", "Паромн", "Ярмарочн", "Смолян", "Перепелин", "Кузнечн", "Камышов", "Гончарн", "Дымков", "Ветрен", "Полынн")
AVENUE = ("Осенний", "Кедровый", "Дальний", "Яблоневый", "Полевой", "Угольный", "Янтарный", "Солодовый", "Лесной", "Южный")
PEOPLE = ("Стекольщиков", "Садоводов", "Кровельщиков", "Печатников", "Пасечников", "Звонарей", "Кружевниц", "Лоцманов", "Ткачей", "Бондарей")

Piece = tuple[str, str]


def _phone(r: random.Random) -> list[Piece]:
    a, b, c, d = f"{r.choice('39448')}{r.randrange(100):02d}", f"{r.randrange(1000):03d}", f"{r.randrange(100):02d}", f"{r.randrange(100):02d}"
    p = r.choice(("8", "7", "+7", "8", "+7"))
    text = r.choice((
        f"{p} ({a}) {b}-{c}-{d}", f"{p}({a}){b}{c}{d}", f"{p}{a}{b}{c}{d}", f"{p}-{a}-{b}-{c}-{d}", f"{p} {a} {b} {c} {d}", f"{p} {a} {b}-{c}{d}",
        f"({a}) {b}-{c}-{d}", f"+7.{a}.{b}.{c}.{d}", f"+7 {a} – {b} – {c} – {d}", f"{p} {a} {b}-{c}-{d}",
    ))
    if r.random() < 0.25:
        text = text.replace("3", "З", 1) if r.random() < 0.5 else text.replace("0", "О")
    if r.random() < 0.15:
        text = text.replace(" ", "\n", 1)
    lead = r.choice(("тел. ", "т.", "звоните: ", "WhatsApp ", "", "", "моб. ", "Viber "))
    return [(lead, "O"), (text, "phone")]


def _email(r: random.Random) -> list[Piece]:
    name = r.choice(("kvartira", "domik", "uyut", "zvonok", "sdam", "hozyain", "mail_box", "nash.dom", "ydacha", "petrov.i", "sokolin_a", "ivanova", "zimogorov.dom", "tyrsanov"))
    user = name + r.choice(("", str(r.randrange(10, 99)), str(r.randrange(100, 9999)), "." + str(r.randrange(10, 99)), "_" + str(r.randrange(10, 99))))
    host = (r.choice(("pochta", "yashik", "box", "pismo", "post", "inbox")), "example", r.choice(("com", "org", "net")))
    at = r.choice(("@", "@", "@", " @ ", "(at)", " собака "))
    text = user + at + r.choice((".", ".", " . ")).join(host)
    if r.random() < 0.15:
        text = text.upper()
    return [(r.choice(("", "", "e-mail:", "почта ")), "O"), (text, "email")]


def _id(r: random.Random) -> list[Piece]:
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    lead, text, tail = r.choice((
        ("паспорт ", f"{n(2)} {n(2)} {n(6)}", ""), ("пасп. ", f"{n(4)} {n(6)}", ""), ("паспорт серия ", f"{n(4)} № {n(6)}", ""),
        ("документ ", f"{n(4)}-{n(6)}", ", паспорт РФ"), ("СНИЛС ", f"{n(3)}-{n(3)}-{n(3)} {n(2)}", ""), ("СНИЛС ", n(11), ""),
        ("снилс: ", f"{n(3)}-{n(3)}-{n(3)}-{n(2)}", ""), ("ИНН ", n(12), ""), ("инн физлица ", n(12), ""), ("паспорт РФ ", f"{n(4)} {n(6)}", ""), ("", f"{n(3)}-{n(3)}-{n(3)} {n(2)}", ""),
    ))
    return [(lead, "O"), (text, "id_number"), (tail, "O")]


def _address(r: random.Random) -> list[Piece]:
    s, a, p = r.choice(STREET) + "ая", r.choice(AVENUE), r.choice(PEOPLE)
    h, k, q = r.randrange(1, 150), r.randrange(1, 6), r.randrange(1, 300)
    text = r.choice((
        f"улица {s}, дом {h}", f"ул. {s}, д. {h}, кв. {q}", f"ул {s} {h}-{q}", f"{s} ул., {h}к{k}", f"{a} пр-т, д.{h}, подъезд {k}",
        f"{a} б-р, {h}, этаж {k}", f"{a.upper()} ПРОСПЕКТ {h} КВ {q}", f"пер. {p} дом {h} корпус {k}", f"проезд {p}, {h}", f"ул. {s}, {h}",
        f"{a} проспект, дом {h}", f"шоссе {p}, {h}", f"{s} набережная, {h}",
    ))
    return [(text, "address")]


def _name(r: random.Random) -> list[Piece]:
    base, acc, dat = r.choice(FIRST).split(" ")
    woman = base[-1] in "ая"
    sur = r.choice(SURNAME)
    sur += "а" if woman and sur[-2:] in ("ов", "ин", "ев", "ёв") else ""
    pat = r.choice(PATRONYMIC)
    pat = pat[:-2] + "на" if woman else pat
    i, j = base[0], pat[0]
    kind = min(9, r.randrange(12))
    if kind == 0:
        return [("спросить ", "O"), (acc, "name")]
    if kind == 1:
        return [("звонить ", "O"), (dat, "name")]
    if kind == 2:
        return [(base, "name"), (" (" + r.choice(("хозяин", "хозяйка", "собственник")) + ")", "O")]
    text = (base, f"{base} {pat}", f"{sur} {base} {pat}", f"{i}.{j}. {sur}", f"{sur} {i}. {j}.", f"{base} {sur}", f"{base.upper()} {sur.upper()}")[kind - 3]
    return [(text, "name")]


MAKERS = {"phone": _phone, "email": _email, "id_number": _id, "address": _address, "name": _name}


def labelled(rows: int = 700, seed: int = 11) -> list[list[Piece]]:
    """`rows` texts as pieces (text, label); the label O is for what isn't personal."""
    r = random.Random(seed)
    out = []
    for _ in range(rows):
        fill = lambda s: s.format(n=r.randrange(8, 60), d=r.randrange(1, 10), t=r.randrange(10, 99), three=f"{r.randrange(1000):03d}", four=r.randrange(1000, 9999), six=f"{r.randrange(10**6):06d}")
        parts: list[list[Piece]] = []
        if r.random() < 0.9:
            opening = fill(r.choice(OPENINGS))
            parts.append([(opening.upper() if r.random() < 0.1 else opening, "O")])
        body = [MAKERS[k](r) for k in r.choices(("phone", "email", "id_number", "address", "name"), (5, 2, 2, 3, 5), k=r.randrange(0, 6))]
        body += [[(fill(r.choice(REMARKS)), "O")] for _ in range(r.randrange(0, 5))]
        r.shuffle(body)
        parts += body
        gap = r.choice(("\n", ", ", ". ", " "))
        pieces: list[Piece] = []
        for i, p in enumerate(parts):
            pieces += ([(gap, "O")] if i else []) + p
        if r.random() < 0.06:
            pieces = [(t.upper(), k) for t, k in pieces]
        out.append([p for p in pieces if p[0]])
    return out
