"""Greedy string tiling with running Karp-Rabin over word sequences.

Words become numbers of 64 bits by a hash. Seeds are hashes of five words in a row. What a
document shares with any held-out passage lies in its windows whose seed a passage has, so
only these runs of words are kept of it. Passages and documents meet by their seeds; each
pair is tiled: longest matches of unmarked words are marked first, so moved, interrupted
and interleaved quotations are all covered.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from hashlib import blake2b

import numpy as np

from adlens.llm.charforms import plain

SEED = 5
MARKUP = re.compile(r"<[^<>]{0,200}>|&#?\w{1,10};")
WORD = re.compile(r"[^\W_]+")
#: Look-alikes of lower-case words, all brought to one alphabet on both sides.
FOLD = str.maketrans("abcehikmoptxyё", "авсенікмортхуе")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    """Words without regard to case, punctuation, spacing, mark-up and disguises."""
    return [w.translate(FOLD) for w in WORD.findall(plain(MARKUP.sub(" ", text)).lower())]


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes (mod 2^64) of all windows of n numbers."""
    if len(ids) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(ids) - n + 1, dtype=np.uint64)
    for k in range(n):
        out = out * _BASE + ids[k : k + len(out)].astype(np.uint64)
    return out


def tile(a: Sequence[int], b: Sequence[int], least: int = SEED, start: int = 16) -> list[tuple[int, int, int]]:
    """Tiles (place in a, place in b, length), longest first; 0 matches nothing."""
    free_a, free_b = [x != 0 for x in a], [x != 0 for x in b]
    tiles: list[tuple[int, int, int]] = []
    size = max(least, min(start, len(a), len(b)))

    def windows(s: Sequence[int], free: list[bool], n: int) -> Iterable[tuple[int, int]]:
        """(hash, place) of windows of n unmarked numbers, the hash running along."""
        mask, base = (1 << 61) - 1, 1_000_003
        top = pow(base, n, mask)
        h = run = 0
        for i, x in enumerate(s):
            if not free[i]:
                h = run = 0
                continue
            h = (h * base + x) % mask
            run += 1
            if run > n:
                h = (h - s[i - n] * top) % mask
            if run >= n:
                yield h, i - n + 1

    while True:
        by_hash: dict[int, list[int]] = defaultdict(list)
        for h, i in windows(a, free_a, size):
            by_hash[h].append(i)
        found: list[tuple[int, int, int]] = []
        longest = 0
        if by_hash:
            for h, j in windows(b, free_b, size):
                for i in by_hash.get(h, ()):
                    if i and j and free_a[i - 1] and free_b[j - 1] and a[i - 1] == b[j - 1]:
                        continue  # inside a match that began earlier
                    n = 0
                    while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                        n += 1
                    if n >= size:
                        found.append((n, i, j))
                        longest = max(longest, n)
        if longest > 2 * size:
            size = longest
            continue
        cut = False
        for n, i, j in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
            if all(free_a[i : i + n]) and all(free_b[j : j + n]):
                tiles.append((i, j, n))
                free_a[i : i + n] = free_b[j : j + n] = [False] * n
            else:
                cut = True  # what is left of it may be long enough still
        if cut:
            continue
        if size == least:
            return tiles
        size = max(least, size // 2)


_NUMBERS: dict[str, int] = {}


def numbers(text: str) -> list[int]:
    """The text's words as numbers of 64 bits, never 0."""
    known, out = _NUMBERS, []
    for w in words(text):
        n = known.get(w)
        if n is None:
            if len(known) > 500_000:
                known.clear()
            n = known[w] = int.from_bytes(blake2b(w.encode(), digest_size=8).digest(), "little", signed=True) or 1
        out.append(n)
    return out


def seeds(ids: np.ndarray) -> np.ndarray:
    """Seed of each window of five numbers, as signed 64-bit."""
    return rolling(ids, SEED).view(np.int64)


class SeedFilter:
    """Bloom filter of seeds: lets every seed of the passages through, and few others.

    Its size follows the number of seeds, up to 2^28 bits (32 MB) for any number.
    """

    MOST_BITS, PROBES = 1 << 28, 4

    def __init__(self, expected: int, bits: bytes | None = None):
        size = 1 << 13
        while size < min(self.MOST_BITS, 24 * expected):
            size *= 2
        self.size = np.uint64(size - 1)
        self.bits = np.zeros(size // 8, np.uint8) if bits is None else np.frombuffer(bits, np.uint8)

    def _places(self, keys: np.ndarray) -> list[np.ndarray]:
        k = keys.view(np.uint64)
        step = (k * _BASE) >> np.uint64(31) | np.uint64(1)
        return [((k ^ (k >> np.uint64(29))) + np.uint64(i) * step) & self.size for i in range(self.PROBES)]

    def add(self, keys: np.ndarray) -> None:
        for p in self._places(keys):
            np.bitwise_or.at(self.bits, (p >> np.uint64(3)).astype(np.int64), (1 << (p & np.uint64(7))).astype(np.uint8))

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), dtype=bool)
        for p in self._places(keys):
            out &= (self.bits[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def shared_runs(texts: Sequence[str | None], known: SeedFilter) -> Iterator[tuple[int, list[int], list[int]]]:
    """(place of the text, its runs of words in windows that pass the filter with 0 between runs, their seeds)."""
    rows = [numbers(t) if t else [] for t in texts]
    lengths = np.array([len(r) for r in rows], dtype=np.int64)
    flat = np.fromiter((x for r in rows for x in r), dtype=np.int64, count=int(lengths.sum()))
    if len(flat) < SEED:
        return
    start = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    owner = np.repeat(np.arange(len(rows)), lengths)
    whole = owner[: len(flat) - SEED + 1] == owner[SEED - 1 :]  # windows within one text
    keys = seeds(flat)
    hit = whole.copy()
    hit[whole] = known.has(keys[whole])
    at = np.flatnonzero(hit)
    covered = np.zeros(len(flat) + 1, dtype=np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + SEED, -1)
    covered = np.cumsum(covered[:-1]) > 0
    for d in np.unique(owner[at]).tolist():
        a, b = int(start[d]), int(start[d] + lengths[d])
        on = covered[a:b]
        runs: list[int] = []
        for x, keep, before in zip(flat[a:b].tolist(), on.tolist(), [False, *on[:-1].tolist()]):
            if keep:
                runs.append(x)
            elif before:
                runs.append(0)
        own = at[(at >= a) & (at < b)]
        yield d, runs, np.unique(keys[own]).tolist()


def leaks(item: Sequence[int], runs: Sequence[int], share: float) -> bool:
    """Whether tiles of five words or more cover at least `share` of the item's words."""
    return sum(n for _, _, n in tile(item, runs)) >= share * len(item)
