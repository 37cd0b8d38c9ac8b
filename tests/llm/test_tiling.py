import random

import numpy as np

from adlens.llm.p7 import leaked
from adlens.llm.tiling import SEED, SeedFilter, leaks, numbers, seeds, shared_runs, tile, words


def covered(a, b):
    """Words of a in runs of five or more that stand in b, by looking at every window."""
    grams = {tuple(b[i : i + SEED]) for i in range(len(b) - SEED + 1)}
    cells = set()
    for i in range(len(a) - SEED + 1):
        if tuple(a[i : i + SEED]) in grams and 0 not in a[i : i + SEED]:
            cells |= set(range(i, i + SEED))
    return len(cells)


def test_tiles_are_maximal_and_disjoint():
    r = random.Random(3)
    for _ in range(300):
        a = [r.randrange(1, 60) for _ in range(r.randrange(5, 40))]
        b = [r.randrange(0, 60) for _ in range(30)]
        for _ in range(r.randrange(0, 4)):
            i = r.randrange(len(a))
            b += a[i : i + r.randrange(3, 20)] + [r.randrange(0, 60)]
        t = tile(a, b)
        in_a, in_b = set(), set()
        for i, j, n in t:
            assert n >= SEED and a[i : i + n] == b[j : j + n]
            assert not in_a & set(range(i, i + n)) and not in_b & set(range(j, j + n))
            in_a |= set(range(i, i + n))
            in_b |= set(range(j, j + n))
        assert len(in_a) <= covered(a, b)
        if not t:
            assert covered(a, b) == 0


def test_tiles_of_unrepeated_words_cover_all():
    r = random.Random(4)
    for _ in range(200):
        a = r.sample(range(1, 500), 40)
        b = []
        for _ in range(5):
            i = r.randrange(40)
            b += a[i : i + r.randrange(2, 18)] + [0]
        if len({x for x in b if x}) < len([x for x in b if x]):
            continue  # a word quoted twice
        assert sum(n for _, _, n in tile(a, b)) == covered(a, b)


ITEM = "Складной стела позади погоста вечером перекрывает синеватый столбик про концерты строка тридцать четыре и ещё двадцать один"


def found(items, texts):
    """Leaks by tiling every pair of a passage and the runs that the filter of all seeds leaves."""
    every = [(i, numbers(t)) for i, t in items]
    every = [(i, w) for i, w in every if len(w) >= SEED]
    keys = np.unique(np.concatenate([seeds(np.array(w)) for _, w in every])) if every else np.zeros(0, np.int64)
    known = SeedFilter(len(keys))
    known.add(keys)
    out = [[] for _ in texts]
    for d, runs, _ in shared_runs(texts, known):
        out[d] = [i for i, w in every if leaks(w, runs, 0.5)]
    return out


def test_leaks():
    items = [(1, ITEM), (2, "слишком мало слов тут"), (3, "How often unevenly hides the rusty screen below the quarry when movers cost 8885")]
    w = ITEM.split()
    cases = {
        ITEM: [1], ITEM.upper().replace(" ", ",\n"): [1], " ".join(w[9:]) + " и потом " + " ".join(w[:9]): [1], " ".join(w[:8]): [], " ".join(w[:9]): [1],
        " ".join(w[:4] + ["и"] + w[4:8] + ["и"] + w[8:12]): [], ITEM.replace("о", "o"): [1], ITEM.replace("а", "а\u200b"): [1], "<b>" + "<br>".join(w) + "</b>": [1],
        "how OFTEN unevenly hides the rusty screen below": [3], "": [], "слишком мало слов тут": [],
    }
    texts = list(cases)
    assert dict(zip(texts, found(items, texts))) == cases
    assert found(items, [None]) == [[]] and found([], [ITEM]) == [[]]


def test_runs_are_all_that_can_be_shared():
    r = random.Random(6)
    for _ in range(60):
        items = [" ".join(f"w{r.randrange(40)}" for _ in range(r.randrange(5, 30))) for _ in range(4)]
        text = " ".join(f"w{r.randrange(45)}" for _ in range(30)) + " " + " ".join(items[0].split()[:12]) + " x " + items[1]
        keys = np.unique(np.concatenate([seeds(np.array(numbers(t))) for t in items]))
        known = SeedFilter(len(keys))
        known.add(keys)
        assert known.has(keys).all()
        runs = next((x[1] for x in shared_runs(["", text], known)), [])
        for t in items:
            assert sum(n for _, _, n in tile(numbers(t), runs)) == sum(n for _, _, n in tile(numbers(t), numbers(text)))


def test_words():
    assert words("THE Сосна, COCHA") == words("the сосна сосна")


def test_table(spark):
    docs = [(1, "начало " + ITEM), (2, None), (3, ""), (4, "слово " * 30000 + ITEM), (1, "начало " + ITEM), (5, "ничего")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id")
    items = spark.createDataFrame([(1, ITEM), (7, ITEM.lower()), (8, None), (None, ITEM), (9, "")], "item_id long, text string").selectExpr("*", "'x' as doc_id")
    want = sorted((d, i) for d in (1, 1, 4) for i in (1, 7))
    assert sorted((r.doc_id, r.item_id) for r in leaked(df, items).collect()) == want
    assert leaked(df.limit(0), items).count() == 0 and leaked(df, items.limit(0)).count() == 0


def test_many_items_with_a_common_phrase(spark):
    """50,000 items that all share a phrase, and repeated windows: one pass, as tiling every pair that may leak."""
    r = random.Random(8)
    phrase = "все права защищены и принадлежат их владельцам"
    items = [(i, f"{phrase} {' '.join(f'c{r.randrange(10**6)}' for _ in range(12))} {phrase}") for i in range(50_000)]
    items += [(60_000, "раз два три четыре пять " * 6), (60_001, phrase)]
    docs = [(i, f"{phrase} текст {i}") for i in range(40)]
    docs += [(100 + k, "до " + " ".join(items[k * 7][1].split()[3:18]) + " после " + phrase) for k in range(30)]
    docs += [(200, " x ".join(["раз два три четыре пять"] * 4))]
    got = {tuple(x) for x in leaked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string").repartition(8)).collect()}
    want = {(100 + k, k * 7) for k in range(30)} | {(d, 60_001) for d in [*range(40), *range(100, 130)]} | {(200, 60_000)}
    assert got == want
