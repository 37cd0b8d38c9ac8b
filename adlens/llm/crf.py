"""Linear-chain conditional random field with factored features, in numpy.

A token is a bag of atoms (word, shape, ending, ...). The score of a label at a position
sums the weights of the atoms of the tokens around it and of the shapes of neighbouring
tokens. Weights of a token type are added up once and kept, so scoring a text is a few
table look-ups, and whole batches of texts are decoded together.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Sequence
from pathlib import Path

import numpy as np

OFFSETS = (-2, -1, 0, 1, 2)


class Chain:
    """Weights: atoms by offset, shape pairs left and right of the position, transitions."""

    def __init__(self, labels: Sequence[str], atoms_of: Callable[[str], list[str]], shape_of: Callable[[str], str]):
        self.labels = list(labels)
        self.atoms_of, self.shape_of = atoms_of, shape_of
        self.atom: dict[str, int] = {}
        self.shape: dict[str, int] = {"": 0, "?": 1}
        self.weights: dict[str, np.ndarray] = {}
        self._reset()

    def _reset(self) -> None:
        self.type: dict[str, int] = {"": 0}
        self.type_shape = [0]
        self.type_atoms: list[list[int]] = [[]]
        self.rows: list[np.ndarray] = []

    def __getstate__(self) -> dict:
        keep = dict(self.__dict__)
        for k in ("type", "type_shape", "type_atoms", "rows"):
            keep.pop(k)
        return keep

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._reset()

    def _type(self, token: str, grow: bool) -> int:
        known = self.type.get(token)
        if known is None:
            known = self.type[token] = len(self.type)
            atoms = self.atoms_of(token)
            ids = [self.atom[a] for a in atoms if a in self.atom]
            s = self.shape.setdefault(self.shape_of(token), len(self.shape)) if grow else self.shape.get(self.shape_of(token), 1)
            self.type_atoms.append(ids)
            self.type_shape.append(s)
        return known

    def _grid(self, texts: Sequence[Sequence[str]], grow: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Token types by text and position (0: none), with two blank places at either end."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        grid = np.zeros((len(texts), (int(lengths.max()) if len(texts) else 0) + 4), dtype=np.int64)
        for i, t in enumerate(texts):
            if t:
                grid[i, 2 : 2 + len(t)] = [self._type(w, grow) for w in t]
        return grid, lengths

    def _emission(self, grid: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        width = grid.shape[1] - 4
        out = np.zeros((grid.shape[0], width, len(self.labels)), dtype=np.float32)
        for k, o in enumerate(OFFSETS):
            out += tables[k][grid[:, 2 + o : 2 + o + width]]
        shapes = np.asarray(self.type_shape)[grid]
        out += self.weights["left"][shapes[:, 1 : 1 + width], shapes[:, 2 : 2 + width]]
        out += self.weights["right"][shapes[:, 2 : 2 + width], shapes[:, 3 : 3 + width]]
        return out

    def fit(self, texts: Sequence[Sequence[str]], tags: Sequence[Sequence[str]], epochs: int = 14, batch: int = 64, rate: float = 0.08, decay: float = 2e-4, seed: int = 7, least: int = 4) -> Chain:
        """Maximum likelihood by Adam over shuffled batches, its rate falling to zero; deterministic for a seed.

        Atoms of fewer than `least` tokens get no weight: a rare word is known by its shape
        and surroundings only.
        """
        rng = np.random.default_rng(seed)
        times = Counter(w for t in texts for w in t)
        counted: Counter = Counter()
        for w, n in times.items():
            for a in self.atoms_of(w):
                counted[a] += n
        self.atom = {a: i for i, a in enumerate(sorted(a for a, n in counted.items() if n >= least))}
        grid, lengths = self._grid(texts, grow=True)
        n_labels, n_types, n_atoms, n_shapes = len(self.labels), len(self.type), len(self.atom), len(self.shape)
        # Atoms of all types in one row; every type but the blank has some.
        # Every type has its shape's and gap's atom, but a rare type's may be too rare: the last row takes these.
        self.atom["?"] = len(self.atom)
        self.type_atoms[1:] = [a or [self.atom["?"]] for a in self.type_atoms[1:]]
        n_atoms = len(self.atom)
        flat = np.array([a for atoms in self.type_atoms for a in atoms], dtype=np.int64)
        counts = np.array([len(a) for a in self.type_atoms])
        owner, starts = np.repeat(np.arange(n_types), counts), np.concatenate([[0], np.cumsum(counts[1:])[:-1]])
        shapes = np.asarray(self.type_shape)
        at = {label: i for i, label in enumerate(self.labels)}
        gold = np.zeros((len(texts), grid.shape[1] - 4), dtype=np.int64)
        for i, t in enumerate(tags):
            gold[i, : len(t)] = [at[x] for x in t]
        w = {f"atoms{k}": np.zeros((n_atoms, n_labels), dtype=np.float32) for k in range(len(OFFSETS))}
        w |= {k: np.zeros((n_shapes, n_shapes, n_labels), dtype=np.float32) for k in ("left", "right")}
        w |= {"move": np.zeros((n_labels, n_labels), dtype=np.float32), "start": np.zeros(n_labels, dtype=np.float32)}
        self.weights = w
        first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
        for _ in range(epochs):
            # Batches of like lengths, in a new order and mix each time.
            order = np.argsort(lengths + rng.uniform(0, 12, len(texts)), kind="stable")
            parts = [order[a : a + batch] for a in range(0, len(order), batch)]
            for i in rng.permutation(len(parts)):
                pick = parts[i]
                width = int(lengths[pick].max())
                g, y = grid[pick][:, : width + 4], gold[pick][:, :width]
                tables = [np.concatenate([np.zeros((1, n_labels), np.float32), np.add.reduceat(w[f"atoms{k}"][flat], starts)]) for k in range(len(OFFSETS))]
                delta, move, start = self._gradient(self._emission(g, tables), lengths[pick], y)
                grad = {"move": move, "start": start}
                for k, o in enumerate(OFFSETS):
                    by_type = np.zeros((n_types, n_labels), dtype=np.float32)
                    np.add.at(by_type, g[:, 2 + o : 2 + o + width], delta)
                    spread = by_type[owner]
                    grad[f"atoms{k}"] = np.stack([np.bincount(flat, spread[:, c], n_atoms) for c in range(n_labels)], axis=1).astype(np.float32)
                s = shapes[g]
                for k, o in (("left", 1), ("right", 2)):
                    grad[k] = np.zeros_like(w[k])
                    np.add.at(grad[k], (s[:, o : o + width], s[:, o + 1 : o + 1 + width]), delta)
                step += 1
                now = rate * (1 - (step - 1) / (epochs * len(parts)))
                for k, v in w.items():
                    d = grad[k] / len(pick) - decay * v
                    first[k] = 0.9 * first[k] + 0.1 * d
                    second[k] = 0.99 * second[k] + 0.01 * d * d
                    v += now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
        self._reset()
        return self

    def save(self, path: str | Path) -> None:
        """Weights in half precision; atoms that weigh next to nothing are left out."""
        names = list(self.atom)
        keep = [i for i, a in enumerate(names) if max(np.abs(self.weights[f"atoms{k}"][i]).max() for k in range(len(OFFSETS))) >= 0.02]
        head = {"labels": self.labels, "atoms": [names[i] for i in keep], "shapes": list(self.shape)}
        arrays = {k: (w[keep] if k.startswith("atoms") else w).astype(np.float16) for k, w in self.weights.items()}
        np.savez_compressed(path, head=np.frombuffer(json.dumps(head, ensure_ascii=False).encode(), np.uint8), **arrays)

    @classmethod
    def load(cls, path: str | Path, atoms_of: Callable[[str], list[str]], shape_of: Callable[[str], str]) -> Chain:
        with np.load(path) as z:
            head = json.loads(z["head"].tobytes().decode())
            made = cls(head["labels"], atoms_of, shape_of)
            made.atom = {a: i for i, a in enumerate(head["atoms"])}
            made.shape = {s: i for i, s in enumerate(head["shapes"])}
            made.weights = {k: z[k].astype(np.float32) for k in z.files if k != "head"}
        return made

    def _gradient(self, e: np.ndarray, lengths: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Observed minus expected label counts by position, transition and start."""
        n, width, n_labels = e.shape
        move, start = self.weights["move"], self.weights["start"]

        def soft(x: np.ndarray, axis: int) -> np.ndarray:
            top = x.max(axis=axis, keepdims=True)
            return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

        live = np.arange(width)[None, :] < lengths[:, None]
        forward = np.zeros_like(e)
        backward = np.zeros_like(e)
        forward[:, 0] = start + e[:, 0]
        for t in range(1, width):
            new = soft(forward[:, t - 1, :, None] + move, 1) + e[:, t]
            forward[:, t] = np.where(live[:, t, None], new, forward[:, t - 1])
        for t in range(width - 2, -1, -1):
            new = soft(move + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(live[:, t + 1, None], new, backward[:, t + 1])
        total = soft(forward[:, -1], 1)
        marginal = np.exp(forward + backward - total[:, None, None]) * live[..., None]
        one = np.eye(n_labels, dtype=np.float32)
        delta = one[gold] * live[..., None] - marginal
        moves = np.zeros_like(move)
        for t in range(1, width):
            on = live[:, t]
            if on.any():
                joint = forward[on, t - 1, :, None] + move + (e[on, t] + backward[on, t])[:, None, :] - total[on, None, None]
                moves -= np.exp(joint).sum(axis=0)
                np.add.at(moves, (gold[on, t - 1], gold[on, t]), 1)
        return delta.astype(np.float32), moves, delta[:, 0].sum(axis=0)

    def _tables(self) -> list[np.ndarray]:
        """Summed weights of all token types met so far."""
        done = len(self.rows[0]) if self.rows else 0
        if done < len(self.type_atoms):
            fresh = self.type_atoms[done:]
            new = [np.stack([self.weights[f"atoms{k}"][a].sum(axis=0) if a else np.zeros(len(self.labels), np.float32) for a in fresh]) for k in range(len(OFFSETS))]
            self.rows = [np.concatenate([r, x]) for r, x in zip(self.rows, new)] if self.rows else new
        return self.rows

    def decode(self, texts: Sequence[Sequence[str]], cells: int = 40_000) -> list[list[str]]:
        """Best label sequence of each text (Viterbi over batches of texts of like length)."""
        out: list[list[str]] = [[] for _ in texts]
        order = sorted((i for i, t in enumerate(texts) if t), key=lambda i: len(texts[i]))
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and (to - at + 1) * len(texts[order[to]]) <= cells:
                to += 1
            if len(self.type) > 200_000:
                self._reset()
            part = [texts[i] for i in order[at:to]]
            grid, lengths = self._grid(part)
            for i, path in zip(order[at:to], self._viterbi(self._emission(grid, self._tables()), lengths)):
                out[i] = path
            at = to
        return out

    def _viterbi(self, e: np.ndarray, lengths: np.ndarray) -> list[list[str]]:
        n, width, n_labels = e.shape
        move = self.weights["move"]
        score = self.weights["start"] + e[:, 0]
        back = np.zeros((n, width, n_labels), dtype=np.int8)
        stay = np.arange(n_labels, dtype=np.int8)
        for t in range(1, width):
            ways = score[:, :, None] + move
            best = ways.argmax(axis=1)
            new = np.take_along_axis(ways, best[:, None, :], axis=1)[:, 0] + e[:, t]
            live = (t < lengths)[:, None]
            back[:, t] = np.where(live, best, stay)
            score = np.where(live, new, score)
        last = score.argmax(axis=1)
        path = np.zeros((n, width), dtype=np.int64)
        path[:, -1] = last
        for t in range(width - 1, 0, -1):
            path[:, t - 1] = back[np.arange(n), t, path[:, t]]
        return [[self.labels[j] for j in path[i, : lengths[i]]] for i in range(n)]
