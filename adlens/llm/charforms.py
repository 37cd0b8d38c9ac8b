"""One consistent form for text that looks the same but is stored in other characters.

Tokens run, as they are stored, through a trie of canonical spellings by a weighted edit
automaton. A look-alike of another alphabet, a full-width form, a separate mark and an
ignorable character cost nothing; any other edit costs one. Among the words reached at no
cost the most frequent is the canonical spelling. A disguised token that reaches none may
take one edit, and the word then reached tells its alphabet. Tokens that reach no word are
normalised by the table: the alphabet is the one that the token's unmistakable letters
belong to. What stands between tokens (spaces, digits, signs) has a table of its own.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable

# Letters drawn alike, Latin first, Cyrillic second, Greek after them.
LOOKALIKES = (
    "AАΑ", "BВΒ", "CСϹ", "EЕΕ", "HНΗ", "IІΙ", "JЈ", "KКΚ", "MМΜ", "OОΟ", "PРΡ", "SЅ", "TТΤ", "XХΧ", "YУΥ", "NΝ", "ZΖ",
    "aаα", "cсϲ", "eе", "iіι", "jј", "oоο", "pрρ", "sѕ", "xхχ", "yуυ", "vν", "kкκ",
)
#: Characters that leave no mark (code point ranges).
IGNORABLE = "­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ"
#: Spaces other than the ordinary one.
SPACES = "   -   　"
#: Full-width forms of the printable ASCII characters, and of a few signs.
FULL_WIDTH = "！-～￠-￦"
MARKS = "̀-ͯ҃-҇᪰-᫿᷀-᷿⃐-⃿︠-︯"
GREEK = "Ͱ-Ͽ"
CYRILLIC = "Ѐ-҂Ҋ-ԯ"

EXOTIC = re.compile(f"[{IGNORABLE}{SPACES}{FULL_WIDTH}{MARKS}]")
#: What needs a closer look: anything exotic, or alphabets that meet within a word.
SUSPECT = re.compile(f"[{IGNORABLE}{SPACES}{FULL_WIDTH}{MARKS}{GREEK}]|[A-Za-z][{CYRILLIC}]|[{CYRILLIC}][A-Za-z]")
#: The same for Spark's regular expressions, with whole words in Latin letters besides.
LOOK = f"[A-Za-z{IGNORABLE}{SPACES}{FULL_WIDTH}{MARKS}{GREEK}]"
TOKEN = re.compile(rf"(?:[^\W\d_]|[{IGNORABLE}{MARKS}])+")
#: Host names, mail addresses, handles and paths, where Latin letters are at home.
HOST = re.compile(rf"[\w{IGNORABLE}.+-]*@[\w{IGNORABLE}.-]+|[\w{IGNORABLE}-]+(?:\.[\w{IGNORABLE}-]+)+(?:/[\w./-]*)?|\w+://\S*|@\w+|\w+_\w+|\w+\(at\)\S+", re.I)

_IGNORE = re.compile(f"[{IGNORABLE}]")
_MARK = re.compile(f"[{MARKS}]")
_SPACE = re.compile(f"[{SPACES}]")
_WIDE = re.compile(f"[{FULL_WIDTH}]")
TO: dict[str, dict[str, str]] = {"latin": {}, "cyrillic": {}}
for _group in LOOKALIKES:
    for _c in _group:
        for _d in _group:
            _name = "latin" if "A" <= _d <= "z" else "cyrillic" if "Ѐ" <= _d <= "ԯ" else ""
            if _name and _c != _d:
                TO[_name].setdefault(_c, _d)
#: All letters that a letter may stand for, itself first.
TWINS: dict[str, str] = {}
for _group in LOOKALIKES:
    for _c in _group:
        TWINS[_c] = "".join(dict.fromkeys(TWINS.get(_c, _c) + _group))


def script(c: str) -> str:
    if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ɏ":
        return "latin"
    if "Ѐ" <= c <= "ԯ":
        return "cyrillic"
    return "greek" if "Ͱ" <= c <= "Ͽ" else "other"


def ambiguous(word: str) -> bool:
    """Every letter has a twin in the other of Latin and Cyrillic."""
    other = TO["cyrillic"] if script(word[:1]) == "latin" else TO["latin"]
    return bool(word) and all(c in other for c in word)


#: Letters of whole words that may be disguised entirely, for Spark's regular expressions.
AMBIGUOUS_CYRILLIC = "".join(sorted(c for c in TO["latin"] if script(c) == "cyrillic"))
AMBIGUOUS_LATIN = "".join(sorted(c for c in TO["cyrillic"] if script(c) == "latin"))


def by_table(token: str) -> str:
    """Token of composed letters with all its look-alikes put into one alphabet."""
    kinds = [script(c) for c in token]
    used = set(kinds) - {"other"}
    if len(used) < 2 and "greek" not in used:
        return token
    sure = {"latin": 0, "cyrillic": 0}
    all_ = {"latin": 0, "cyrillic": 0}
    for c, k in zip(token, kinds):
        if k in all_:
            all_[k] += 1
            sure[k] += c not in TO["latin" if k == "cyrillic" else "cyrillic"]
    if "greek" in used and len(used) == 1 and not all(c in TO["cyrillic"] or c in TO["latin"] for c in token):
        return token  # a Greek word
    if sure["latin"] and sure["cyrillic"]:
        to = ""  # both alphabets are certain: only foreign twins of neighbours could be meant
    elif sure["cyrillic"] or sure["latin"]:
        to = "cyrillic" if sure["cyrillic"] else "latin"
    else:
        to = "latin" if all_["latin"] > all_["cyrillic"] else "cyrillic"
    table = TO.get(to, {})
    return "".join(table.get(c, c) if k != to else c for c, k in zip(token, kinds))


_READ: dict[tuple[str, str], frozenset[str]] = {}


def _read(c: str, marks: str) -> frozenset[str]:
    """Lower-case letters that a stored letter with separate marks reads as at no cost."""
    known = _READ.get((c, marks))
    if known is None:
        if "！" <= c <= "～":
            c = chr(ord(c) - 0xFEE0)
        base, *own = unicodedata.normalize("NFD", c) if c not in TWINS else c
        ways = set()
        for t in TWINS.get(base, base):
            one = unicodedata.normalize("NFC", t + "".join(own) + marks)
            # A mark that makes no letter (a stress, a cedilla) is read over.
            ways.add((one if len(one) == 1 else unicodedata.normalize("NFC", t + "".join(own))[:1]).lower())
        if len(_READ) > 10_000:
            _READ.clear()
        known = _READ[c, marks] = frozenset(ways)
    return known


def places(token: str) -> list[frozenset[str]]:
    """The letters of a stored token, each as what it reads as; ignorable characters are skipped."""
    out: list[frozenset[str]] = []
    i, n = 0, len(token)
    while i < n:
        c, i = token[i], i + 1
        if _IGNORE.match(c):
            continue
        marks = ""
        while i < n and (_MARK.match(token[i]) or _IGNORE.match(token[i])):
            marks += token[i] if _MARK.match(token[i]) else ""
            i += 1
        if not _MARK.match(c):
            out.append(_read(c, marks))
    return out


class SpellingTrie:
    """Trie of lower-case canonical words with their frequencies."""

    def __init__(self, words: Iterable[tuple[str, int]]):
        self.root: dict = {}
        self.known: dict[tuple[str, int], tuple[float, int, str] | None] = {}
        for word, n in words:
            self.add(word, n)

    def add(self, word: str, n: int) -> None:
        node = self.root
        for c in word:
            node = node.setdefault(c, {})
        node[""] = (max(n, node.get("", (0, ""))[0]), word)

    def find(self, token: str, budget: int = 0) -> tuple[float, int, str] | None:
        """(cost, frequency, word) of the best word within the budget, for a token as it is stored."""
        key = (token, budget)
        if key not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[key] = self._find(places(token), budget)
        return self.known[key]

    def _find(self, token: list[frozenset[str]], budget: int) -> tuple[float, int, str] | None:
        live: list[tuple[dict, int]] = [(self.root, 0)]
        for ways in token:
            after: dict[int, tuple[dict, int]] = {}

            def reach(node: dict, cost: int, after: dict = after) -> None:
                if cost <= budget and (id(node) not in after or after[id(node)][1] > cost):
                    after[id(node)] = (node, cost)

            for node, cost in self._skips(live, budget):
                for w in ways:
                    if w in node:
                        reach(node[w], cost)
                if cost < budget:
                    reach(node, cost + 1)
                    for w, child in node.items():
                        if w and w not in ways:
                            reach(child, cost + 1)
            live = list(after.values())
            if not live:
                return None
        ends = [(cost, -node[""][0], node[""][1]) for node, cost in self._skips(live, budget) if "" in node]
        if not ends:
            return None
        cost, n, word = min(ends)
        return cost, -n, word

    @staticmethod
    def _skips(live: list[tuple[dict, int]], budget: int) -> list[tuple[dict, int]]:
        if not budget:
            return live
        out, edge = list(live), live
        while edge:
            edge = [(child, cost + 1) for node, cost in edge if cost < budget for w, child in node.items() if w]
            out += edge
        return out


def compose(text: str) -> tuple[str, list[int]]:
    """Full-width forms, spaces, marks and ignorables resolved; place of each character left."""
    out: list[str] = []
    at: list[int] = []
    for i, c in enumerate(text):
        if "！" <= c <= "～":
            c = chr(ord(c) - 0xFEE0)
        elif _SPACE.match(c):
            c = " "
        elif _IGNORE.match(c):
            continue
        elif _MARK.match(c):
            if out and len(one := unicodedata.normalize("NFC", out[-1] + c)) == 1:
                out[-1] = one
            continue
        elif "￠" <= c <= "￦":
            c = unicodedata.normalize("NFKC", c)[:1]
        out.append(c)
        at.append(i)
    return "".join(out), at


_WORD = re.compile(r"[^\W\d_]+")
_LABEL = re.compile(r"[A-Za-z0-9_-]{2,}")
_FIXED: dict[str, str] = {}


def _fix(m: re.Match) -> str:
    w = m.group()
    fixed = _FIXED.get(w)
    if fixed is None:
        if len(_FIXED) > 200_000:
            _FIXED.clear()
        fixed = _FIXED[w] = by_table(w)
    return fixed


def plain_map(text: str) -> tuple[str, list[int] | range]:
    """Text in plain form by the table alone, with the place of each of its characters."""
    if not SUSPECT.search(text):
        return text, range(len(text))
    out, at = compose(text)
    return _WORD.sub(_fix, out), at


def plain(text: str) -> str:
    return plain_map(text)[0]


#: Letters from which a token may take one edit to the word that tells its alphabet.
EDITED = 6


class Normaliser:
    """Whole values: is one disguised, and what is its consistent form.

    `words` are the canonical spellings with their frequencies; of two whole-word twins the
    more frequent decides, so an ordinary Latin word stays and one made of Latin letters
    that is common in Cyrillic doesn't.
    """

    def __init__(self, words: Iterable[tuple[str, int]]):
        self.trie = SpellingTrie(words)
        self.tokens: dict[str, tuple[str, str]] = {}
        self.learnt: set[str] = set()

    def learn(self, words: Iterable[tuple[str, int]]) -> None:
        """Adds canonical words that a value's tokens may stand for."""
        for word, n in words:
            if word in self.learnt:
                continue
            self.learnt.add(word)
            self.trie.add(word, n)
            self.trie.known.clear()
            self.tokens.clear()

    def token(self, token: str) -> tuple[str, str]:
        """(consistent spelling of a stored token in its own case, what decided: trie, edit, table)."""
        known = self.tokens.get(token)
        if known is None:
            if len(self.tokens) > 200_000:
                self.tokens.clear()
            known = self.tokens[token] = self._spelling(token)
        return known

    def _spelling(self, token: str) -> tuple[str, str]:
        hit = self.trie.find(token)
        letters = compose(token)[0] if EXOTIC.search(token) else token
        if hit and len(hit[2]) == len(letters):
            return "".join(w.upper() if c.isupper() else w for c, w in zip(letters, hit[2])), "trie"
        plain_ = by_table(letters)
        if plain_ != token and len(letters) >= EDITED and (hit := self.trie.find(token, 1)):
            kind = "cyrillic" if script(hit[2][0]) == "cyrillic" else "latin"
            to = "".join(c if script(c) == kind else TO[kind].get(c, c) for c in letters)
            if len({script(c) for c in to} - {"other"}) == 1:
                return to, "edit"
        return plain_, "table"

    def value(self, text: str) -> tuple[str, str]:
        """(consistent form, what found a disguise: trie, edit, table or signs; empty if none is there)."""
        latin: Latin | None = None
        parts: list[str] = []
        by: set[str] = set()
        done = 0
        for m in TOKEN.finditer(text):
            w = m.group()
            letters = compose(w)[0] if _WIDE.search(w) else w
            if letters.isascii() and (not ambiguous(letters) or (latin := latin or Latin(text)).owns(*m.span())):
                if letters != w:
                    by.add("signs")
                    parts += (self._between(text[done : m.start()], by), letters)
                    done = m.end()
                continue  # no letter has a twin, or Latin letters are at home here
            fixed, how = self.token(w)
            if fixed != w:
                by.add(how)
                parts += (self._between(text[done : m.start()], by), fixed)
                done = m.end()
        rest = self._between(text[done:], by)
        found = next((k for k in ("trie", "edit", "table", "signs") if k in by), "")
        return ("".join(parts) + rest if parts else rest), found

    @staticmethod
    def _between(text: str, by: set[str]) -> str:
        """Spaces, full-width signs and stray marks of a stretch whose tokens are in order."""
        if not EXOTIC.search(text):
            return text
        by.add("signs")
        return compose(text)[0]


class Latin:
    """Where a text's Latin letters are at home: host and mail names, hyphenated Latin words (e-mail).

    Initials with dots are no host, nor is anything with a Cyrillic letter.
    """

    def __init__(self, text: str):
        self.text, self.at = compose(text) if EXOTIC.search(text) else (text, range(len(text)))
        self.hosts = [h.span() for h in HOST.finditer(self.text) if h.group().isascii() and _LABEL.search(h.group())]

    def owns(self, start: int, end: int) -> bool:
        """Of a place in the stored text."""
        a, b = bisect_left(self.at, start), bisect_left(self.at, end)
        return any(x <= a and b <= y for x, y in self.hosts) or self._hyphened(a, b)

    def _hyphened(self, start: int, end: int) -> bool:
        text, a, b = self.text, start, end
        while a and (text[a - 1] == "-" or text[a - 1].isalpha()):
            a -= 1
        while b < len(text) and (text[b] == "-" or text[b].isalpha()):
            b += 1
        return b - a > end - start and any("A" <= c <= "z" and c.isalpha() and c not in TO["cyrillic"] for c in text[a:b])
