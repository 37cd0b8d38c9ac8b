"""Byte-pair encoding as a lazily determinised finite-state transducer.

Merging is never simulated on a text. A token sequence is the encoding of its bytes exactly
if every two neighbours are (merging their joint bytes gives the two back), so the encoding
of a prefix is a chain of last tokens, and reading one more byte adds one link. The
transducer's state is what later bytes can still change:

* the bytes since the latest boundary that every continuation keeps, and
* the token before that boundary.

A start of a possible later token is alive while the bytes from it on are a proper prefix
of some token; the chains of all alive starts meet in the boundary. Whatever lies before it
is emitted, so lookahead is bounded by the longest token. States and transitions are made
when a text first needs them and kept.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

#: States kept before the automaton is built anew (memory bound; results don't depend on it).
MAX_STATES = 400_000
#: Words kept whole.
MAX_WORDS = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary file of lines `base64-token rank`."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.prefixes = {t[:k] for t in ranks for k in range(1, len(t))}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.words: dict[bytes, tuple[int, ...]] = {}
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple[bytes, bytes], int] = {(b"", b""): 0}
        self.states: list[tuple[bytes, bytes]] = [(b"", b"")]
        #: Tokens of each state's pending bytes, should the word end here.
        self.final: list[tuple[int, ...]] = [()]
        #: Length of the last token at each position of the pending bytes (0: no chain).
        self.links: list[tuple[int, ...]] = [(0,)]
        self.arcs: dict[int, tuple[int, tuple[int, ...]]] = {}

    def merge(self, word: bytes) -> list[bytes]:
        """Reference semantics: apply the merge of lowest rank until none applies."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: bytes, right: bytes) -> bool:
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            known = self.pairs[key] = self.merge(left + right) == [left, right]
        return known

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        before, pending = self.states[state]
        text = pending + bytes((byte,))
        n = len(text)
        links = [*self.links[state], 0]
        alive = [n]
        for start in range(n):
            if start and not links[start]:
                continue
            piece = text[start:]
            if not links[n] and piece in self.ranks:
                left = text[start - links[start] : start] if start else before
                if not left or self.fits(left, piece):
                    links[n] = n - start
            if piece in self.prefixes:
                alive.append(start)
        if not links[n]:
            raise ValueError("the vocabulary lacks a single byte")
        # The boundary: the last point that the chains of all alive starts share.
        shared: set[int] | None = None
        for start in alive:
            chain = {start}
            while start:
                start -= links[start]
                chain.add(start)
            shared = chain if shared is None else shared & chain
        cut = max(shared)
        out: list[int] = []
        at, kept = cut, before
        while at:
            token = text[at - links[at] : at]
            if not out:
                kept = token
            out.append(self.ranks[token])
            at -= links[at]
        key = (kept, text[cut:])
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            rest = [0]
            for i in range(cut + 1, n + 1):
                rest.append(links[i] if links[i] <= i - cut else 0)
            self.links.append(tuple(rest))
            tail: list[int] = []
            at = n
            while at > cut:
                tail.append(self.ranks[text[at - links[at] : at]])
                at -= links[at]
            self.final.append(tuple(reversed(tail)))
        arc = (to, tuple(reversed(out)))
        self.arcs[state << 8 | byte] = arc
        return arc

    def stream(self, data: Iterable[int]) -> Iterator[int]:
        """Token ids of one word's bytes, each as soon as no later byte can change it."""
        state = 0
        for byte in data:
            state, out = self.arcs.get(state << 8 | byte) or self._step(state, byte)
            yield from out
        yield from self.final[state]

    def encode(self, word: bytes) -> tuple[int, ...]:
        known = self.words.get(word)
        if known is None:
            if len(self.states) > MAX_STATES:
                self._reset()
            if len(self.pairs) > 4 * MAX_STATES:
                self.pairs.clear()
            known = tuple(self.stream(word))
            if len(word) <= 64:
                if len(self.words) > MAX_WORDS:
                    self.words.clear()
                self.words[word] = known
        return known


class Utf8:
    """Incremental UTF-8: feeds of bytes in, text out; a bad sequence gives U+FFFD."""

    def __init__(self) -> None:
        self.need = 0
        self.value = 0
        self.low, self.high = 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        out = []
        for byte in data:
            if self.need:
                if self.low <= byte <= self.high:
                    self.value = self.value << 6 | byte & 0x3F
                    self.need -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.need:
                        out.append(chr(self.value))
                    continue
                out.append("�")
                self.need, self.low, self.high = 0, 0x80, 0xBF
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xDF:
                self.need, self.value = 1, byte & 0x1F
            elif 0xE0 <= byte <= 0xEF:
                self.need, self.value = 2, byte & 0x0F
                self.low, self.high = (0xA0 if byte == 0xE0 else 0x80), (0x9F if byte == 0xED else 0xBF)
            elif 0xF0 <= byte <= 0xF4:
                self.need, self.value = 3, byte & 0x07
                self.low, self.high = (0x90 if byte == 0xF0 else 0x80), (0x8F if byte == 0xF4 else 0xBF)
            else:
                out.append("�")
        return "".join(out)

    def state(self) -> tuple[int, int, int, int]:
        return self.need, self.value, self.low, self.high

    def close(self) -> str:
        bad, self.need = self.need > 0, 0
        return "�" if bad else ""


class Decoder:
    """Streaming decode of ids; the UTF-8 machine's moves over whole tokens are kept."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {i: t for t, i in ranks.items()}
        self.moves: dict[tuple, tuple[tuple, str]] = {}

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        machine = Utf8()
        state = machine.state()
        for i in ids:
            move = self.moves.get((state, i))
            if move is None:
                machine.need, machine.value, machine.low, machine.high = state
                text = machine.feed(self.tokens[i])
                move = (machine.state(), text)
                if len(self.moves) > MAX_STATES:
                    self.moves.clear()
                self.moves[state, i] = move
            state, text = move
            if text:
                yield text
        machine.need = state[0]
        if tail := machine.close():
            yield tail
