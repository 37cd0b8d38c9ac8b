"""Freely typed values mapped to the entries of a reference list.

A value is normalised (characters, case, misread digits, frames like legal forms) and cut
into words; the words' character n-grams look up entry words in an inverted index, which
gives the weighted cosine of each pair of words met. An entry's score is the smaller of its
words' weighted mean and its least telling word's cosine; the best entry is accepted above
a threshold if it leads the next one by a margin. An exact check, the count of edits, follows
where the score is near the threshold or the margin is missing.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from math import log, sqrt

from adlens.llm.charforms import plain

# Cyrillic letters as the reference list transliterates them.
TRANSLIT = dict(zip(
    "абвгдеёжзийклмнопрстуфхцчшщъыьэюя",
    "a b v g d e e zh z i y k l m n o p r s t u f kh ts ch sh sch  y  e yu ya".split(" "),
))
# Digits as letters they are misread for.
MISREAD = str.maketrans("03468", "озчбв")
# Words that frame a name without being part of it.
FRAME = frozenset(
    "ооо оао зао ао пао сз гк ип группа компаний компания от застройщика застройщик и партнеры партнер официальный "
    "офис продаж жк жилой комплекс клубный дом мкр микрорайон корпус очередь "
    "ooo gk zhk oao pao example com net org ru www http https".split()
)
NAME_END = re.compile(r"(?:ом|ем|а|у|е|ы|и|ой|ов)$")
SPLIT = re.compile(r"[^0-9a-zа-яіғңүұәөқһ]+")


def normal(value: str) -> str:
    """Plain characters, lower case, misread digits as letters, single spaces."""
    words = []
    for w in SPLIT.split(plain(value).lower().replace("ё", "е")):
        if not w:
            continue
        if not w.isdigit() and not w.isalpha() or w == "000":
            w = w.translate(MISREAD)
        words.append(w)
    return " ".join(words)


def transliterated(text: str) -> str:
    return "".join(TRANSLIT.get(c, c) for c in text)


def grams(word: str) -> dict[str, int]:
    """Counts of a word's letters, and of its neighbouring letters in their order and in none.

    Ends are marked. Pairs in no order let two swapped letters keep what they share.
    """
    out: dict[str, int] = defaultdict(int)
    marked = f"<{word}>"
    for c in word:
        out[c] += 1
    for a, b in zip(marked, marked[1:]):
        out[a + b] += 1
        out["~" + min(a, b) + max(a, b)] += 1
    return out


def edits(a: str, b: str, most: int) -> int:
    """Edits (swaps of neighbours count one) from a to b; most + 1 if there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                d = min(d, before[j - 2] + 1)
            now.append(d)
        if min(now) > most:
            return most + 1
        before, row = row, now
    return min(row[-1], most + 1)


@dataclass(frozen=True)
class Entry:
    words: tuple[str, ...]  # what tells it from other entries
    target: str


@dataclass(frozen=True)
class Match:
    target: str  # empty: none
    score: float
    by: str  # cosine, or check where that decided otherwise; empty without a target


class Matcher:
    #: Cosines of words below this are not looked at: twice as much is needed for any decision.
    LEAST = 0.2

    def __init__(self, entries: Iterable[tuple[str, str]], threshold: float = 0.6, margin: float = 0.02, near: float = 0.2):
        """entries: (spelling, target) pairs; one target may have many spellings.

        Scores within `near` of the threshold are checked for edits.
        """
        self.threshold, self.margin, self.low, self.sure = threshold, margin, threshold - near, threshold + near
        pairs = [(tuple(w for w in normal(s).split() if w not in FRAME), t) for s, t in entries]
        of: dict[str, set[str]] = defaultdict(set)
        for words, t in pairs:
            for w in words:
                of[w].add(t)
        #: Words that many targets end in tell nothing when another word is there.
        self.generic = {w for w, t in of.items() if len(t) >= 3 and any(len(p) > 1 and p[-1] == w for p, _ in pairs)}
        self.entries = [Entry(words, t) for words, t in dict.fromkeys(pairs) if words]
        self.words = sorted({w for e in self.entries for w in e.words})
        place = {w: i for i, w in enumerate(self.words)}
        targets = len({e.target for e in self.entries})
        self.weight = [log(1 + targets / len(of[w])) * len(w) for w in self.words]
        self.parts: list[tuple[list[int], list[int]]] = []  # words of each entry: all, telling
        self.holding: list[list[int]] = [[] for _ in self.words]
        for j, e in enumerate(self.entries):
            at = [place[w] for w in e.words]
            self.parts.append((at, [i for i in at if self.words[i] not in self.generic] or at))
            for i in set(at):
                self.holding[i].append(j)
        vectors = [grams(w) for w in self.words]
        df: dict[str, int] = defaultdict(int)
        for v in vectors:
            for g in v:
                df[g] += 1
        n = max(1, len(self.words))
        self.idf = {g: log(1 + n / d) for g, d in df.items()}
        self.unseen = log(1 + n)
        self.index: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for i, v in enumerate(vectors):
            norm = sqrt(sum((c * self.idf[g]) ** 2 for g, c in v.items()))
            for g, c in v.items():
                self.index[g].append((i, c * self.idf[g] / norm))
        self.known: dict[str, dict[int, float]] = {}

    def cosines(self, word: str) -> dict[int, float]:
        """Entry words by cosine to a value's word, from the inverted index."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > 200_000:
                self.known.clear()
            dot: dict[int, float] = defaultdict(float)
            square = 0.0
            for g, c in grams(word).items():
                w = c * self.idf.get(g, self.unseen)
                square += w * w
                for i, x in self.index.get(g, ()):
                    dot[i] += w * x
            norm = sqrt(square) or 1.0
            found = self.known[word] = {i: d / norm for i, d in dot.items() if d >= self.LEAST * norm}
        return found

    def candidates(self, words: list[str]) -> list[tuple[float, float, str, list[int]]]:
        """(rank, score, target, its entries, best first) of every target met, best first."""
        best: dict[int, float] = {}
        for v in words:
            stems = [v]
            if len(v) >= 6 and (m := NAME_END.search(v)):
                stems.append(v[: m.start()])
            for s in stems:
                for i, c in self.cosines(s).items():
                    if c > best.get(i, 0.0):
                        best[i] = c
        targets: dict[str, list[tuple[float, float, int]]] = defaultdict(list)
        for j in {j for i in best for j in self.holding[i]}:
            every, telling = self.parts[j]
            whole = sum(self.weight[i] * best.get(i, 0.0) for i in every) / sum(self.weight[i] for i in every)
            least = min(best.get(i, 0.0) for i in telling)
            targets[self.entries[j].target].append(((whole + least) / 2, min(whole, least), j))
        out = []
        for t, found in targets.items():
            found.sort(reverse=True)
            out.append((found[0][0], found[0][1], t, [j for _, _, j in found]))
        return sorted(out, key=lambda x: (-x[0], -x[1], x[2]))

    def distance(self, entry: Entry, words: list[str]) -> float | None:
        """Edits per letter of the entry's words in the value; None if a telling word isn't there.

        A missing generic word costs its letters, so it orders entries without ruling them out.
        """
        telling = any(w not in self.generic for w in entry.words)
        total = letters = 0
        for w in entry.words:
            most = 1 if len(w) <= 4 else 2 if len(w) <= 8 else 3
            low = min((self._word(w, v, most) for v in words), default=most + 1)
            if low > most:
                if not telling or w not in self.generic:
                    return None
                low = len(w)
            total += low
            letters += len(w)
        return total / letters

    @staticmethod
    def _word(w: str, v: str, most: int) -> int:
        d = edits(w, v, most)
        if d and len(v) > len(w) and (m := NAME_END.search(v)) and len(w) >= 5:
            d = min(d, edits(w, v[: m.start()], most))
        return d

    def match(self, value: str) -> Match:
        return self.match_normal(normal(value))

    def match_normal(self, form: str) -> Match:
        words = form.split()
        core = [w for w in words if w not in FRAME] or words
        found = self.candidates(core)
        if not found:
            return Match("", 0.0, "")
        rank, score, target, _ = found[0]
        clear = len(found) < 2 or rank - found[1][0] >= self.margin
        taken = target if clear and score >= self.threshold else ""
        if clear and not self.low <= score < self.sure:
            return Match(taken, score, "cosine" if taken else "")
        near = []
        for r, s, t, entries in found:
            if s >= self.low and (d := [x for j in entries if (x := self.distance(self.entries[j], core)) is not None]):
                near.append((r - min(d), s, t))
        near.sort(key=lambda x: (-x[0], x[2]))
        if near and (len(near) < 2 or near[0][0] - near[1][0] >= self.margin):
            return Match(near[0][2], near[0][1], "cosine" if near[0][2] == taken else "check")
        return Match("", score, "check" if taken else "")


def directory(brands: Iterable[dict]) -> tuple[Matcher, Matcher]:
    """Matchers of the advertiser directory: names to canonicals, complexes to complexes."""
    names: list[tuple[str, str]] = []
    complexes: list[tuple[str, str]] = []
    for b in brands:
        spellings = [b["canonical"], *(b["aliases"] or ())]
        if b.get("site"):
            spellings.append(b["site"])
        names += [(s, b["canonical"]) for s in spellings if s]
        for c in b["complexes"] or ():
            for s in (c, transliterated(c.lower())):
                complexes.append((s, c))
                names.append((s, b["canonical"]))
    return Matcher(names), Matcher(complexes)
