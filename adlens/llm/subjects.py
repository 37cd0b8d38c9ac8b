"""Subjects of documents by interpolated n-gram language models of their statements.

A document is cut into statements; every statement is scored by one interpolated bigram
model per subject and by a background model (notes about the shot, addresses, phones,
held-out passages). A statement goes to the subject of lowest cross-entropy per token if
that is below the background's by a calibrated margin; a document has the subjects whose
share of its advertising statements passes a calibrated threshold.

Labels are per document and some are wrong, so the models are fitted by expectation
maximisation: a statement belongs to one of its document's subjects, to the background, or
rarely to anything else. Words that all subjects' documents hold alike sink into the
background model. Every fifth labelled document is kept out of the fit: the weights of the
interpolation, the margin and the threshold are estimated on these.

A fit asks its texts for sums only (`Texts`: in memory; `p8.TextTable`: over a table of any
size), and takes all of them. Equal statements under equal labels are one row with their
number. Shares are kept in steps of 2^-20, so sums are the same at any order of rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import islice
from dataclasses import dataclass, field
from math import log
from zlib import crc32

import numpy as np

from adlens.llm.charforms import plain

# The subjects.
SUBJECTS = ("недвижимость", "авто", "финансы", "медицина", "ретейл", "развлечения", "услуги", "другое")
OTHER, BACKGROUND = SUBJECTS.index("другое"), len(SUBJECTS)
MARKUP = re.compile(r"<[^<>]{0,200}>|&#?\w{1,10};")
TOKEN = re.compile(r"[^\W_]+")
STOP = re.compile(r"[.!?…]+[»\")]*\s+[«\"(+\-–—]*\s*$")
BULLET = re.compile(r"\s[-–—]\s+$")
BOS, EOS = "<s>", "</s>"
#: Prior log-odds of a boundary for each kind of gap between words.
_SURE = {"dot": "?", "low": "?", "stop": "cut", "line": "cut", "bullet": "cut", "case": "?", "title": "?"}
GAP = {"dot": 1.5, "low": -1.0, "stop": 3.0, "line": 2.0, "bullet": 2.5, "case": 2.0, "title": -1.0, "space": -3.0, "inner": -6.0}


#: Letters of a stem: inflected forms, and words misread late, are one class. No text is shortened by it.
STEM = 6


def stem(word: str) -> str:
    return "0" if word[0].isdigit() else word[:STEM].lower()


#: Stems of a text's words, and the kind of gap after each but the last.
Cut = tuple[list[str], list[str]]
#: A cut text with the bits of its subjects, or NOTE.
Labelled = tuple[list[str], list[str], int]
#: Labels of a text known to be about no subject, and of one whose labels no longer bind it.
NOTE, FREE = -1, 1 << len(SUBJECTS)


def bits_of(subjects: Iterable[str]) -> int:
    return sum(1 << SUBJECTS.index(s) for s in set(subjects) if s in SUBJECTS)


def kept_out(text: str) -> bool:
    return crc32(text.encode("utf-8", "replace")) % 5 == 0


def pieces(text: str) -> Cut:
    """Stems of a text's words, and the kind of gap after each but the last."""
    text = plain(MARKUP.sub("\n", text))
    one_case = text.islower()  # then capitals can't tell where a statement begins
    stems: list[str] = []
    gaps: list[str] = []
    end, before = 0, ""
    for m in TOKEN.finditer(text):
        w = m.group()
        if stems:
            gap = text[end : m.start()]
            upper = w[0].isupper()
            if gap == " ":
                shift = upper and len(w) > 1 and len(before) > 1 and w.isalpha() and before.isalpha() and w.isupper() != before.isupper()
                kind = "case" if shift else "title" if upper or one_case else "space"
            elif STOP.search(gap) and (upper or not w[0].isalpha()):
                kind = "stop"
            elif "\n" in gap:
                kind = "line"
            elif upper and BULLET.search(gap) and not gap.strip()[:-1]:
                kind = "bullet" if gap.strip() == "-" else "inner"
            elif gap.strip(" \t"):
                kind = "inner" if not STOP.search(gap) else "dot" if one_case else "low"
            elif len(w) > 1 and len(before) > 1 and w.isalpha() and before.isalpha() and w.isupper() != before.isupper() and upper:
                kind = "case"
            else:
                kind = "title" if upper or one_case else "space"
            gaps.append(kind)
        stems.append(stem(w))
        end, before = m.end(), w
    return stems, gaps


@dataclass
class Boundaries:
    """Bigram model of statements that tells where one ends and the next begins."""

    one: Counter = field(default_factory=Counter)
    two: Counter = field(default_factory=Counter)
    total: int = 1
    #: Decisions taken before, by the words on either side and the kind of gap.
    known: dict[tuple[str, str, str], bool] = field(default_factory=dict)

    def fit(self, triples: Counter, passes: int = 2) -> Boundaries:
        """Sure gaps teach the model first; what it cuts then teaches it again.

        Before a capitalised word a gap may be either, so the first pass counts neither.
        `triples` counts the gaps by the words on either side and their kind (see `triples_of`).
        """
        for again in range(passes):
            one, two = Counter(), Counter()
            for (x, y, kind), n in triples.items():
                if not kind:
                    mark = "in"
                elif again:
                    mark = "cut" if self.cuts([x, y], [kind])[0] else "in"
                else:
                    mark = _SURE.get(kind, "in")
                for pair in ((x, EOS), (BOS, y)) if mark == "cut" else ((x, y),) if mark == "in" else ():
                    one[pair[0]] += n
                    two[pair] += n
            self.one, self.two, self.total, self.known = one, two, sum(one.values()) or 1, {}
        return self

    def p(self, a: str, b: str) -> float:
        low = (self.one[b if b != EOS else BOS] + 0.1) / self.total
        return 0.8 * self.two[a, b] / (self.one[a] or 1) + 0.2 * low

    def cuts(self, stems: list[str], gaps: list[str]) -> list[bool]:
        """Whether each gap is cut: its kind and the model speak for it together."""
        known = self.known
        if len(known) > 500_000:
            known.clear()
        out = []
        for key in zip(stems, stems[1:], gaps):
            cut = known.get(key)
            if cut is None:
                a, b, kind = key
                cut = known[key] = GAP[kind] > -6 and GAP[kind] + log(self.p(a, EOS) * self.p(BOS, b) / self.p(a, b)) > 0
            out.append(cut)
        return out

    def cut(self, stems: list[str], gaps: list[str]) -> list[list[str]]:
        """Statements of a document."""
        out, start = [], 0
        for i, c in enumerate(self.cuts(stems, gaps), 1):
            if c:
                out.append(stems[start:i])
                start = i
        if start < len(stems):
            out.append(stems[start:])
        return out


def triples_of(texts: Iterable[Labelled]) -> Counter:
    """Gaps by the words on either side and their kind; the ends of a text have the kind ""."""
    out: Counter = Counter()
    for stems, gaps, bits in texts:
        if stems and bits != NOTE:
            out.update(zip(stems, stems[1:], gaps))
            out.update(((BOS, stems[0], ""), (stems[-1], EOS, "")))
    return out


def _blocks(rows: Iterable, size: int) -> Iterator[list]:
    rows = iter(rows)
    while block := list(islice(rows, size)):
        yield block


def statements_of(texts: Iterable[Labelled], boundaries: Boundaries, model: SubjectModel | None = None) -> Counter:
    """How often each (statement, bits) occurs; labels that `model` distrusts become FREE."""
    out: Counter = Counter()
    for block in _blocks(texts, 1000):
        cut = [boundaries.cut(stems, gaps) for stems, gaps, _ in block]
        bits = [b for _, _, b in block] if model is None else model.trusted(cut, [b for _, _, b in block])
        for statements, b in zip(cut, bits):
            out.update((" ".join(s), b) for s in statements)
    return out


#: Steps of a share: sums of them are exact up to 2^33 tokens.
STEP = 2.0**20
#: Statements of a block of numbers (bound of what is held at once).
BLOCK = 20_000
#: Statements' tokens, the words before them and the ends; their labels, numbers and whether they stand under unlike labels.
Numbers = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class Statements:
    """Distinct (statement, bits) with their numbers, in memory."""

    def __init__(self, rows: Iterable[tuple[str, int, int]]):
        self.rows = list(rows)

    def vocabulary(self) -> tuple[list[str], list[tuple[str, str]]]:
        """Words and pairs of words that occur twice or more, in order."""
        by_n: defaultdict[int, tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
        for text, _, n in self.rows:
            s = text.split(" ")
            of_words, of_pairs = by_n[n]
            of_words.update(s)
            of_pairs.update(zip([BOS, *s], s))
        words: Counter = Counter()
        pairs: Counter = Counter()
        for n, both in by_n.items():
            for total, counts in zip((words, pairs), both):
                for key, k in counts.items():
                    total[key] += n * k
        return sorted(w for w, n in words.items() if n >= 2), sorted(p for p, n in pairs.items() if n >= 2)

    def numbered(self, model: SubjectModel) -> Numbered:
        """The statements as numbers; a statement met under three unlike labels or more is marked."""
        under: Counter = Counter()
        times: Counter = Counter()
        for text, bits, n in self.rows:
            if 0 < bits < FREE and bits.bit_count() == 1:
                under[text] += 1
                times[text] += n
        spread = {t for t, k in under.items() if k >= 6 or k >= 3 and k >= 0.25 * times[t]}
        return Numbered([model.block([(t, b, n, t in spread) for t, b, n in rows]) for rows in _blocks(self.rows, BLOCK)])


class Numbered:
    """Blocks of numbers, in memory."""

    def __init__(self, blocks: list[Numbers]):
        self.blocks = blocks

    def sums(self, model: SubjectModel, start: bool = False) -> np.ndarray:
        return model.sums(self.blocks, start)


class Texts:
    """Cut texts in memory, and the sums that a fit takes over them."""

    def __init__(self, fit: list[Labelled], kept: list[Labelled]):
        self.fit, self.kept = fit, kept

    def count(self) -> int:
        return sum(bits != NOTE for part in (self.fit, self.kept) for _, _, bits in part)

    def part(self, kept: bool) -> Texts:
        return Texts([], self.kept) if kept else Texts(self.fit, [])

    def triples(self) -> Counter:
        return triples_of([*self.fit, *self.kept])

    def statements(self, boundaries: Boundaries, model: SubjectModel | None = None) -> Statements:
        return Statements((t, b, n) for (t, b), n in statements_of([*self.fit, *self.kept], boundaries, model).items())

    def judged(self, model: SubjectModel) -> np.ndarray:
        return model.judged([*self.fit, *self.kept])


#: Tokens that the first weights of the interpolation count for in their estimate.
PRIOR = 50_000
#: Gain in F1 on kept-out documents for which the calibration moves on.
GAIN = 0.003
#: Margins and thresholds that the calibration compares, what is stated first.
MARGINS, THRESHOLDS = (0.0, 0.1, -0.1, 0.2, -0.2, 0.4, -0.4), (0.2, 0.19, 0.21, 0.17, 0.23)
#: Movement of the sums, by token and class, at which a fit rests.
REST = 1e-4


class SubjectModel:
    """Interpolated bigram models of the subjects and the background."""

    def __init__(self) -> None:
        #: Weights of bigram, unigram and uniform; where the estimate on kept-out documents begins.
        self.weights = (0.55, 0.42, 0.03)
        self.boundaries = Boundaries()
        self.word: dict[str, int] = {}
        #: Known pairs of words, in order: the first times the number of words and unknown, plus the second.
        self.pair = np.zeros(0, dtype=np.int64)
        #: Least share of a subject's statements, and least gain per token over the background.
        self.threshold = 0.2 - 1e-6
        self.margin = 0.0
        #: Logarithms of the tokens' probabilities, once they are asked for.
        self.logs: np.ndarray | None = None

    def _numbers(self, statements: Sequence[Sequence[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, the words before them, and the ends of a list of statements.

        A token is the number of its pair of words; where that is unknown, the number of its
        word (0: unknown), counted on after the pairs.
        """
        get, after = self.word.get, len(self.pair) + 1
        words = np.array([get(w, 0) for s in statements for w in s], dtype=np.int64)
        ends = np.cumsum([len(s) for s in statements], dtype=np.int64)
        prevs = np.ones_like(words)
        prevs[1:] = words[:-1]
        prevs[ends[:-1]] = 1
        pairs = prevs * (len(self.word) + 1) + words
        at = np.searchsorted(self.pair, pairs)
        return np.where(np.append(self.pair, -1)[at] == pairs, at + 1, after + words), prevs, ends

    def _parts(self) -> np.ndarray:
        """Bigram, unigram and uniform probabilities of each token by class."""
        two = np.concatenate([self.p2, np.zeros_like(self.p1)])
        one = np.concatenate([self.p1[self.second], self.p1])
        return np.stack([two, one, np.full_like(one, 1 / max(2, len(self.word)))]).astype(np.float64)

    def _likelihood(self, numbers: tuple[np.ndarray, ...]) -> np.ndarray:
        """Log-likelihood of each statement by class."""
        if self.logs is None:
            self.logs = np.log(sum(w * p for w, p in zip(self.weights, self._parts())))
        # Each statement is summed by itself: a running sum over all loses digits as it grows.
        return np.add.reduceat(self.logs[numbers[0]], np.concatenate([[0], numbers[2][:-1]]), axis=0)

    def block(self, rows: Sequence[tuple[str, int, int, bool]]) -> Numbers:
        """Numbers of (statement, bits, number, under unlike labels)."""
        return *self._numbers([r[0].split(" ") for r in rows]), *(np.array([r[i] for r in rows]) for i in (1, 2, 3))

    def _share(self, block: Numbers, start: bool) -> np.ndarray:
        """Class shares of a block's statements: at the start by their labels, then by the models too."""
        allowed = self._allowed(block[3])
        if start:
            allowed[:, BACKGROUND] *= np.where(block[5], 20.0, 0.4)
            return allowed / allowed.sum(axis=1, keepdims=True)
        score = self._likelihood(block[:3]) + np.log(np.maximum(allowed, 1e-12))
        share = np.exp(score - score.max(axis=1, keepdims=True))
        return share / share.sum(axis=1, keepdims=True)

    def sums(self, blocks: Iterable[Numbers], start: bool = False) -> np.ndarray:
        """Sums of the statements' shares by token, then by the word before tokens of unknown pairs."""
        n_words, after = len(self.word) + 1, len(self.pair) + 1
        out = np.zeros((after + 2 * n_words, len(SUBJECTS) + 1))
        told, back = out[: after + n_words], out[after + n_words :]
        for tokens, prevs, ends, bits, n, spread in blocks:
            share = np.rint(self._share((tokens, prevs, ends, bits, n, spread), start) * STEP) / STEP * n[:, None]
            each = np.repeat(share.T, np.diff(np.concatenate([[0], ends])), axis=1)
            loose = tokens >= after
            for c, x in enumerate(each):
                told[:, c] += np.bincount(tokens, x, len(told))
                back[:, c] += np.bincount(prevs[loose], x[loose], n_words)
        return out

    def _estimate(self, told: np.ndarray) -> None:
        """Models from the sums of statements' class shares."""
        n_words, after = len(self.word) + 1, len(self.pair) + 1
        two, one, past = told[:after], told[after : after + n_words].copy(), told[after + n_words :].copy()
        np.add.at(one, self.second, two)
        np.add.at(past, self.first, two)
        one[0] = 0
        # An unknown word is as likely in every class.
        self.p1 = (one / np.maximum(one.sum(axis=0), 1)).astype(np.float32)
        self.p2 = (two / (past[self.first] + 10.0)).astype(np.float32)
        self.logs = None

    def fit(self, docs: Sequence[tuple[str, Sequence[str]]], background: Sequence[str] = (), rounds: int = 14) -> SubjectModel:
        """docs: (text, subjects); background: texts known to be about no subject."""
        parts: tuple[list[Labelled], list[Labelled]] = ([], [])
        for text, subjects in docs:
            parts[kept_out(text)].append((*pieces(text), bits_of(subjects)))
        parts[0].extend((*pieces(t), NOTE) for t in background)
        return self.learn(Texts(*parts), rounds)

    def learn(self, texts: Texts, rounds: int = 14) -> SubjectModel:
        """Fit on all texts.

        A fit without every fifth document estimates the weights, the margin and the
        threshold on these; the fit that stays is one of all documents. Under 50 documents
        none is kept out: the first weights, margin and threshold stay.
        """
        rest, kept = texts.part(False), texts.part(True)
        of_rest, of_kept = rest.triples(), kept.triples()
        if texts.count() >= 50:
            self._train(rest, of_rest, rounds // 2)
            if of_kept:
                self._weigh(kept.statements(self.boundaries).numbered(self))
                self._calibrate(kept)
        return self._train(texts, of_rest + of_kept, rounds)

    def _train(self, texts: Texts, triples: Counter, rounds: int) -> SubjectModel:
        """Models of the subjects and the background by expectation maximisation, to rest or `rounds` times."""
        self.boundaries = Boundaries().fit(triples)
        statements = texts.statements(self.boundaries)
        words, pairs = statements.vocabulary()
        self.word = {BOS: 1} | {w: i + 2 for i, w in enumerate(words)}
        self.pair = np.sort(np.array([self.word[a] * (len(self.word) + 1) + self.word[b] for a, b in pairs], dtype=np.int64))
        self.first, self.second = np.divmod(np.append(0, self.pair), len(self.word) + 1)
        numbered = statements.numbered(self)
        told = numbered.sums(self, start=True)
        self._estimate(told)
        for again in range(2):
            for _ in range(rounds):
                last, told = told, numbered.sums(self)
                self._estimate(told)
                if np.abs(told - last).sum() < REST * told.sum() * told.shape[1]:
                    break
            if not again:
                numbered = texts.statements(self.boundaries, self).numbered(self)
        return self

    def _statements(self, cut: Sequence[Cut | None]) -> tuple[list[list[str]], np.ndarray]:
        """Statements of all cut texts, and the text of each."""
        statements: list[list[str]] = []
        owner: list[int] = []
        for d, c in enumerate(cut):
            if c is not None:
                for s in self.boundaries.cut(*c):
                    statements.append(s)
                    owner.append(d)
        return statements, np.array(owner, dtype=np.int64)

    @staticmethod
    def _allowed(bits: np.ndarray) -> np.ndarray:
        """Prior odds of each statement's classes by its document's labels."""
        out = np.full((len(bits), len(SUBJECTS) + 1), 0.01)
        out[:, BACKGROUND] = 0.5
        for c in range(BACKGROUND):
            out[(bits >> c & 1 > 0) | (bits == FREE), c] = 1.0
        out[bits == NOTE] = 0.0
        out[bits == NOTE, BACKGROUND] = 1.0
        return out

    def _weigh(self, numbered: Numbered, rounds: int = 12) -> None:
        """Weights of the interpolation that make kept-out statements likeliest, beside PRIOR tokens of the first weights."""
        first, parts = np.array(self.weights), self._parts()
        for _ in range(rounds):
            mixed = np.array(self.weights)[:, None, None] * parts
            told = (mixed / mixed.sum(axis=0) * numbered.sums(self)[: parts.shape[1]]).sum(axis=(1, 2)) + PRIOR * first
            self.weights, self.logs = tuple((told / told.sum()).tolist()), None

    def trusted(self, cut: Sequence[list[list[str]]], bits: Sequence[int]) -> list[int]:
        """The bits of each cut text; labels that hardly any statement of their document bears out no longer bind it."""
        own = np.repeat(np.arange(len(cut)), [len(c) for c in cut])
        if not len(own):
            return list(bits)
        kinds = self._likelihood(self._numbers([s for c in cut for s in c])).argmax(axis=1)
        table = np.zeros((len(cut), len(SUBJECTS) + 1))
        np.add.at(table, (own, kinds), 1)
        ads = table[:, :BACKGROUND].sum(axis=1)
        borne = [sum(table[d, c] for c in range(BACKGROUND) if b >> c & 1) for d, b in enumerate(bits)]
        return [FREE if b != NOTE and ads[d] > 0 and borne[d] < 0.15 * ads[d] else b for d, b in enumerate(bits)]

    def _kinds(self, score: np.ndarray, ends: np.ndarray, margin: float) -> np.ndarray:
        """Class of each statement: the subject of least entropy per token, if it gains `margin` over the background."""
        tokens = np.maximum(np.diff(np.concatenate([[0], ends])), 1)
        best = score[:, :BACKGROUND].argmax(axis=1)
        gain = (score[np.arange(len(score)), best] - score[:, BACKGROUND]) / tokens
        return np.where(gain > margin, best, BACKGROUND)

    def judged(self, texts: Iterable[Labelled]) -> np.ndarray:
        """Right, wrong and missed subjects of labelled texts by margin and threshold."""
        out = np.zeros((len(MARGINS), len(THRESHOLDS), 3), dtype=np.int64)
        for block in _blocks((t for t in texts if t[0]), 1000):
            statements, own = self._statements([c[:2] for c in block])
            numbers = self._numbers(statements)
            score = self._likelihood(numbers)
            gold = [{c for c in range(BACKGROUND) if b >> c & 1} for _, _, b in block]
            for i, margin in enumerate(MARGINS):
                table = np.zeros((len(block), len(SUBJECTS) + 1))
                np.add.at(table, (own, self._kinds(score, numbers[2], margin)), 1)
                for j, threshold in enumerate(THRESHOLDS):
                    for d, g in enumerate(gold):
                        found = self._subjects(table[d], threshold - 1e-6)
                        out[i, j] += len(found & g), len(found - g), len(g - found)
        return out

    def _calibrate(self, texts: Texts) -> None:
        """Margin and threshold of best agreement with the labels of kept-out documents.

        What is stated (no margin, a fifth) comes first and gives way to a clear gain only.
        """
        best = -1.0
        table = texts.judged(self)
        for i, margin in enumerate(MARGINS):
            for j, threshold in enumerate(THRESHOLDS):
                right, wrong, missed = table[i, j].tolist()
                f1 = 2 * right / max(1, 2 * right + wrong + missed)
                if f1 > best + GAIN:
                    best, self.margin, self.threshold = f1, margin, threshold - 1e-6
        self.agreement = best

    @staticmethod
    def _subjects(counts: np.ndarray, threshold: float) -> set[int]:
        ads = counts[:BACKGROUND].sum()
        if not ads:
            return set()
        found = {c for c in range(BACKGROUND) if c != OTHER and counts[c] >= threshold * ads}
        return found or {OTHER}

    def classify(self, texts: Sequence[str | None]) -> list[list[str]]:
        """Subjects of each text; a text without words has none, one of notes alone its likeliest."""
        statements, own = self._statements([pieces(t) if t else None for t in texts])
        table = np.zeros((len(texts), len(SUBJECTS) + 1))
        if not statements:
            return [[] for _ in texts]
        numbers = self._numbers(statements)
        score = self._likelihood(numbers)
        total = np.zeros_like(table)
        np.add.at(total, own, score)
        np.add.at(table, (own, self._kinds(score, numbers[2], self.margin)), 1)
        out = []
        for d in range(len(texts)):
            found = self._subjects(table[d], self.threshold)
            if not found and table[d].any():
                found = {int(total[d, :BACKGROUND].argmax())}
            out.append([SUBJECTS[c] for c in sorted(found)])
        return out
