"""Weighted acyclic automata over words: transducers from phrases to counts.

All paths have the same number of words, shorter ones end in END. States with the same arcs are one
state; the arcs of the last layer carry weights. So equal endings of phrases with equal counts are
stored once, and equal beginnings too.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np
import zstandard

END = 0


def distinct_rows(paths: np.ndarray, weights: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """The different rows in order, codes below ``base``, with the sums of their weights."""
    if not len(paths):
        return paths, weights
    if base ** paths.shape[1] < 1 << 63:
        packed = np.zeros(len(paths), np.int64)
        for i in range(paths.shape[1]):
            packed = packed * base + paths[:, i]
        order = np.argsort(packed, kind="stable")
        packed = packed[order]
        starts = np.flatnonzero(np.concatenate(([True], packed[1:] != packed[:-1])))
    else:
        order = np.lexsort(paths.T[::-1])
        own = paths[order]
        starts = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]).any(1))))
    return paths[order[starts]], np.add.reduceat(weights[order], starts)


def prefix_starts(paths: np.ndarray, n: int) -> np.ndarray:
    """Where each run of rows with the same first ``n`` codes begins, in sorted rows."""
    return np.flatnonzero(np.concatenate(([True], (paths[1:, :n] != paths[:-1, :n]).any(1)))) if len(paths) else np.zeros(0, np.int64)


class Automaton:
    """``words`` in the order of their bytes have the codes 1, 2, ...; layers are (starts of the states' arcs, codes, targets)."""

    def __init__(self, words: list[bytes], layers: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.words, self.layers = words, layers

    @property
    def arcs(self) -> int:
        return sum(len(codes) for _, codes, _ in self.layers)

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All phrases in order, a row of codes each, and their weights."""
        state, columns = np.zeros(1, np.int64), []
        for starts, codes, targets in self.layers:
            n = starts[state + 1] - starts[state]
            at = np.repeat(starts[state] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            columns = [np.repeat(c, n) for c in columns] + [codes[at]]
            state = targets[at]
        return np.stack(columns, 1), state

    def weights(self, paths: np.ndarray) -> np.ndarray:
        """Composition with the acceptor of some phrases: the weight of each row of codes, 0 where there is none. The code after the last word's is of no word."""
        state, there = np.zeros(len(paths), np.int64), np.ones(len(paths), bool)
        base = len(self.words) + 2
        for i, (starts, codes, targets) in enumerate(self.layers):
            keys = np.repeat(np.arange(len(starts) - 1), np.diff(starts)) * base + codes
            want = state * base + paths[:, i]
            at = np.minimum(np.searchsorted(keys, want), max(len(keys) - 1, 0))
            there &= (keys[at] == want) if len(keys) else False
            state = np.where(there, targets[at], 0) if len(keys) else state
        return np.where(there, state, 0)

    def encoded(self) -> bytes:
        arrays = [np.array(list(map(len, self.words)), np.int64)]
        for starts, codes, targets in self.layers:
            arrays += [np.diff(starts), codes, targets]
        out = [struct.pack("<I", len(self.layers))]
        for x in arrays:
            wide = next(w for w in (1, 2, 4, 8) if not len(x) or int(x.max()) < 1 << 8 * w)
            out += [struct.pack("<BQ", wide, len(x)), x.astype(f"<u{wide}").tobytes()]
        return zstandard.ZstdCompressor(level=1).compress(b"".join(out) + b"".join(self.words))

    @classmethod
    def decoded(cls, raw: bytes) -> Automaton:
        raw = zstandard.ZstdDecompressor().decompress(raw)
        (depth,), at, arrays = struct.unpack_from("<I", raw), 4, []
        for _ in range(1 + 3 * depth):
            wide, n = struct.unpack_from("<BQ", raw, at)
            arrays.append(np.frombuffer(raw, f"<u{wide}", n, at + 9).astype(np.int64))
            at += 9 + wide * n
        ends = (at + np.cumsum(arrays[0])).tolist()
        words = [raw[a:b] for a, b in zip([at, *ends[:-1]], ends, strict=True)]
        return cls(words, [(np.concatenate(([0], np.cumsum(arrays[1 + 3 * i]))), arrays[2 + 3 * i], arrays[3 + 3 * i]) for i in range(depth)])


class Builder:
    """Builds the minimal automaton from sorted phrases, a block at a time.

    What begins with the last word so far may go on in the next block and waits; the states of all
    that comes before are final: each is looked up in the register of its layer by its arcs, and only
    new ones are kept.
    """

    def __init__(self, words: list[bytes], depth: int):
        self.words, self.depth = words, depth
        self._register: list[dict[bytes, int]] = [{} for _ in range(depth)]
        self._root: list[np.ndarray] = []
        self._waiting: tuple[np.ndarray, np.ndarray] | None = None

    def add(self, paths: np.ndarray, weights: np.ndarray) -> None:
        if self._waiting is not None:
            paths, weights = np.concatenate((self._waiting[0], paths)), np.concatenate((self._waiting[1], weights))
        if len(paths):
            last = int(np.searchsorted(paths[:, 0], paths[-1, 0]))
            self._freeze(paths[:last], weights[:last])
            self._waiting = paths[last:], weights[last:]

    def _freeze(self, paths: np.ndarray, targets: np.ndarray) -> None:
        for layer in range(self.depth - 1, 0, -1):
            starts = prefix_starts(paths, layer)
            targets = self._states(layer, starts, paths[:, layer], targets)
            paths = paths[starts]
        self._root.append(np.stack((paths[:, 0], targets), 1))

    def _states(self, layer: int, starts: np.ndarray, codes: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """The number of each state, a run of arcs; states of one arc are told apart by numpy first."""
        own, arcs = self._register[layer], np.stack((codes, targets), 1).astype("<i8")
        n, out = np.diff(np.concatenate((starts, [len(codes)]))), np.zeros(len(starts), np.int64)
        one = np.flatnonzero(n == 1)
        if len(one):
            single = arcs[starts[one]]
            order = np.lexsort(single.T)
            new = np.concatenate(([True], (single[order][1:] != single[order][:-1]).any(1)))
            raw = single[order][new].tobytes()
            ids = np.array([own.setdefault(raw[i : i + 16], len(own)) for i in range(0, len(raw), 16)])
            out[one[order]] = ids[np.cumsum(new) - 1]
        raw, ends = arcs.tobytes(), starts + n
        several = np.flatnonzero(n > 1)
        out[several] = [own.setdefault(raw[16 * a : 16 * b], len(own)) for a, b in zip(starts[several].tolist(), ends[several].tolist(), strict=True)]
        return out

    def finish(self) -> Automaton:
        if self._waiting is not None:
            self._freeze(*self._waiting)
            self._waiting = None
        root = np.concatenate(self._root) if self._root else np.zeros((0, 2), np.int64)
        layers = [(np.array([0, len(root)]), root[:, 0], root[:, 1])]
        for own in self._register[1:]:
            arcs = np.frombuffer(b"".join(own), "<i8").reshape(-1, 2)
            layers.append((np.concatenate(([0], np.cumsum([len(x) // 16 for x in own], dtype=np.int64))).astype(np.int64), arcs[:, 0], arcs[:, 1]))
        return Automaton(self.words, layers)


def built(words: list[bytes], paths: np.ndarray, weights: np.ndarray) -> Automaton:
    """Of sorted different rows; words that no row has are left out."""
    used = np.unique(paths)
    used = used[used != END]
    code = np.zeros(len(words) + 1, np.int64)
    code[used] = np.arange(1, len(used) + 1)
    out = Builder([words[i - 1] for i in used.tolist()], paths.shape[1])
    out.add(code[paths], weights)
    return out.finish()


def union(parts: Iterable[tuple[list[bytes], np.ndarray, np.ndarray]]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words, sorted phrases and summed weights of several (words, phrases, weights)."""
    parts = list(parts)
    words = sorted(set().union(*(p[0] for p in parts)))
    code = {w: i for i, w in enumerate(words, 1)}
    paths = [np.array([END, *(code[w] for w in own)], np.int64)[p] for own, p, _ in parts]
    return words, *distinct_rows(np.concatenate(paths), np.concatenate([w for _, _, w in parts]), len(words) + 1)
