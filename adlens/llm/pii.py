"""Personal values in free text: tagging by the chain model, then exact reading of each span."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache
from pathlib import Path

from adlens.llm.charforms import TO, ambiguous, plain_map
from adlens.llm.crf import Chain
from adlens.llm.pii_table import labelled

KINDS = ("phone", "email", "id_number", "address", "name")
PLACEHOLDER = {"phone": "[PHONE]", "email": "[EMAIL]", "id_number": "[ID]", "address": "[ADDRESS]", "name": "[NAME]"}
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
TOKEN = re.compile(r"[^\W_]+|[^\s]")
# Letters read in place of digits.
DIGITS = str.maketrans("ОоOoЗзlI|бВ", "00003311168")
#: Numbers within a span that holds more than one.
PHONE = re.compile(r"(?<!\d)(?:\+?[78][\s.\-()–]*)?\(?\d{3}\)?[\s.\-()–]*\d{3}[\s.\-–]*\d{2}[\s.\-–]*\d{2}(?!\d)")
MISREAD = re.compile(r"[\dОоOoЗз]+")


def tokens(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Tokens of a plain text, marked by the gap before them, and their places."""
    out, places = [], []
    end = 0
    for m in TOKEN.finditer(text):
        a, b = m.span()
        gap = "\n" if "\n" in text[end:a] else " " if a > end else ""
        out.append(gap + m.group())
        places.append((a, b))
        end = b
    return out, places


def _meant(w: str) -> str:
    """Digits where letters were misread in a run of digits; a capitalised word all in look-alike letters."""
    if MISREAD.fullmatch(w) and any(c.isdigit() for c in w):
        return w.translate(DIGITS)
    if len(w) > 2 and w[0].isupper() and w.isascii() and ambiguous(w):
        return "".join(TO["cyrillic"][c] for c in w)
    return w


def shape(token: str) -> str:
    gap = token[: len(token) - len(token.lstrip())]
    w = _meant(token[len(gap) :])
    if w.isdigit():
        return f"{gap and '_'}9{min(len(w), 13)}"
    if w.isalpha():
        kind = "A" if w.isupper() else "Aa" if w[0].isupper() else "a"
        return f"{gap and '_'}{kind if len(w) > 1 else kind[0] + '1'}{'' if 'а' <= w[0].lower() <= 'ё' else 'L'}"
    if any(c.isdigit() for c in w):
        return f"{gap and '_'}m{'L' if any('a' <= c.lower() <= 'z' for c in w) else ''}{min(sum(c.isdigit() for c in w), 12) if sum(c.isdigit() for c in w) > 2 else 's'}"
    return f"{gap and '_'}{w}"


def atoms(token: str) -> list[str]:
    w = _meant(token.lstrip())
    low = w.lower()
    out = ["s:" + shape(token), "g:" + token[: len(token) - len(w)]]  # the length stays
    if w.isalpha():
        out += ["w:" + low, "e3:" + low[-3:], "e2:" + low[-2:], "b4:" + low[:4], "c:" + ("A" if w.isupper() else "Aa" if w[0].isupper() else "a")]
    elif any(c.isdigit() for c in w):
        out += ["n:" + str(min(13, sum(c.isdigit() for c in w))), "f:" + (w[0] if w[0].isdigit() else "x"), "x:" + re.sub(r"\d+", "9", low)[:8]]
    else:
        out.append("w:" + low)
    return out


#: The fitted weights; `python -m adlens.llm.pii` fits them anew.
WEIGHTS = Path(__file__).with_name("pii_weights.npz")


@lru_cache(maxsize=1)
def tagger() -> Chain:
    """The fitted model, as stored with the package."""
    return Chain.load(WEIGHTS, atoms, shape)


def fitted(rows: int = 12000, seed: int = 11, epochs: int = 12) -> Chain:
    """A model trained from the labelled table of `rows` texts."""
    texts, tags = [], []
    for pieces in labelled(rows, seed):
        text = "".join(t for t, _ in pieces)
        words, places = tokens(text)
        edges, at = [], 0
        for t, k in pieces:
            edges.append((at, at + len(t), k))
            at += len(t)
        row, i, before = [], 0, None
        for a, _ in places:
            while edges[i][1] <= a:
                i += 1
            kind = edges[i][2]
            row.append("O" if kind == "O" else ("I-" if before == i else "B-") + kind)
            before = i
        texts.append(words)
        tags.append(row)
    return Chain(LABELS, atoms, shape).fit(texts, tags, epochs=epochs)


def _digits(text: str) -> str:
    return "".join(c for c in text.translate(DIGITS) if c.isdigit())


def read(kind: str, text: str) -> str | None:
    """Normal value of a tagged span; None if it can't be one."""
    if kind == "phone":
        d = _digits(text)
        return d[1:] if len(d) == 11 and d[0] in "78" else d if len(d) == 10 else None
    if kind == "id_number":
        d = _digits(text)
        return d if len(d) in (10, 11, 12) else None
    if kind == "email":
        s = re.sub(r"\s*(?:\(at\)|\[at\]|\bсобака\b|@)\s*", "@", text.strip().lower())
        s = re.sub(r"\s*\.\s*", ".", s).strip(" .,:;")
        return s if re.fullmatch(r"[^@\s]+@[^@\s]+\.[^@\s.]+", s) else None
    if kind == "address":
        return "" if any(c.isdigit() for c in text) and any(c.isalpha() for c in text) else None
    return "" if sum(c.isalpha() for c in text) >= 2 else None


Span = tuple[int, int, str, str]


def spans(model: Chain, texts: Sequence[str]) -> list[list[Span]]:
    """(start, end, kind, value) of each personal value, in places of the given texts."""
    plains = [plain_map(t) for t in texts]
    cut = [tokens(p) for p, _ in plains]
    out: list[list[Span]] = []
    for (text, at), (words, places), tags in zip(plains, cut, model.decode([w for w, _ in cut])):
        found: list[Span] = []
        i = 0
        while i < len(tags):
            if tags[i] == "O":
                i += 1
                continue
            kind, j = tags[i][2:], i + 1
            while j < len(tags) and tags[j] == "I-" + kind:
                j += 1
            a, b = places[i][0], places[j - 1][1]
            value = read(kind, text[a:b])
            if value is not None:
                found.append((at[a], at[b - 1] + 1, kind, value))
            elif kind == "phone":
                for m in PHONE.finditer(text[a:b].translate(DIGITS)):
                    found.append((at[a + m.start()], at[a + m.end() - 1] + 1, kind, _digits(m.group())[-10:]))
            i = j
        out.append(found)
    return out


def redact(text: str, found: Sequence[Span]) -> str:
    done, parts = 0, []
    for a, b, kind, _ in found:
        parts += (text[done:a], PLACEHOLDER[kind])
        done = b
    return "".join(parts) + text[done:]


if __name__ == "__main__":
    fitted().save(WEIGHTS)
