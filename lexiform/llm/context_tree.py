"""Context-tree weighting over sorted byte windows, as array operations.

A window is an integer: the byte just before the coded one is its highest byte, older ones follow, and the coded byte is the
lowest. In sorted windows every context of every depth is a run, so
a run of windows that share their first bytes is a whole subtree, to be worked on alone.

A byte is eight binary decisions. Each decision has its own context tree; the Krichevsky-Trofimov estimates of all depths are
mixed with the weights that the counts give them. Where a context has never met a decision, its share goes to the contexts
above it that have, halved from each to the one above: the weights they would have without counts.
"""

from __future__ import annotations

import numpy as np

HALF = np.log(2.0)
_STEPS = 1 << 12
#: ln gamma(n + 1/2) and ln gamma(n + 1) for small n.
_AT_HALF = np.concatenate([[0.5 * np.log(np.pi)], 0.5 * np.log(np.pi) + np.cumsum(np.log(np.arange(_STEPS) + 0.5))])
_AT_ONE = np.concatenate([[0.0], np.cumsum(np.log(np.arange(_STEPS) + 1.0))])


def _log_gamma(n: np.ndarray, shift: float, small: np.ndarray) -> np.ndarray:
    """ln gamma(n + shift) for whole n: from a table, or by Stirling's series."""
    out = small[np.minimum(n, _STEPS)]
    far = np.flatnonzero(n > _STEPS)
    if len(far):
        z = n[far] + shift
        out[far] = (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z)
    return out


def block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the estimate's probability of a sequence with so many zeros and ones."""
    return _log_gamma(zeros, 0.5, _AT_HALF) + _log_gamma(ones, 0.5, _AT_HALF) - np.log(np.pi) - _log_gamma(zeros + ones, 1.0, _AT_ONE)


def shorter(keys: np.ndarray) -> np.ndarray:
    """The windows with their oldest context byte left out."""
    return (keys >> np.uint64(16) << np.uint64(8)) | (keys & np.uint64(255))


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their counts added up."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


class _Nodes:
    """One decision of the byte tree's level ``level`` at all contexts of one depth."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, level: int):
        name = keys >> np.uint64(8 - level)
        self.first = np.flatnonzero(np.concatenate([np.ones(1, bool), name[1:] != name[:-1]]))
        self.of = np.repeat(np.arange(len(self.first)), np.diff(np.append(self.first, len(keys))))
        self.bit = (keys >> np.uint64(7 - level)) & np.uint64(1) == 1
        self.total = np.add.reduceat(counts, self.first)
        self.ones = np.add.reduceat(np.where(self.bit, counts, 0), self.first)
        self.seen = self.total > 0
        self.chance = (self.ones + 0.5) / (self.total + 1.0)
        name = name[self.first]
        #: context and decision: the decisions of a byte tree are numbered 1 to 255 from the root on
        self.name = (name >> np.uint64(level) << np.uint64(8)) | np.uint64(1 << level) | (name & np.uint64((1 << level) - 1))


class Subtree:
    """Contexts of depths ``top`` to ``depth`` of windows with ``depth`` context bytes, sorted, and their counts (0 allowed)."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, top: int, depth: int):
        self.top, self.depth = top, depth
        self.keys, self.counts, self.up = {depth: keys}, {depth: counts.astype(np.int64)}, {}
        for d in range(depth, top, -1):
            less = shorter(self.keys[d])
            self.keys[d - 1], self.counts[d - 1] = merged(less, self.counts[d])
            self.up[d] = np.searchsorted(self.keys[d - 1], less)

    def _level(self, level: int, below: dict[int, float] | tuple[np.ndarray, np.ndarray] | None) -> tuple[dict, dict, dict, dict]:
        """Nodes, parents, weighted logarithms and shares of each depth."""
        nodes = {d: _Nodes(self.keys[d], self.counts[d], level) for d in range(self.top, self.depth + 1)}
        parent = {d: nodes[d - 1].of[self.up[d][nodes[d].first]] for d in range(self.top + 1, self.depth + 1)}
        weighted, share = {}, {}
        for d in range(self.depth, self.top - 1, -1):
            own = block(nodes[d].total - nodes[d].ones, nodes[d].ones)
            if d == self.depth and below is None:
                weighted[d], share[d] = own, np.ones_like(own)
                continue
            if d < self.depth:
                split = np.bincount(parent[d + 1], weighted[d + 1], len(own))
            else:
                split = below[1][np.searchsorted(below[0], nodes[d].name)]
            weighted[d] = np.logaddexp(own, split) - HALF
            share[d] = np.exp(own - HALF - weighted[d])
        return nodes, parent, weighted, share

    def roots(self) -> tuple[np.ndarray, np.ndarray]:
        """(context of depth top - 1 and decision, sum of the weighted logarithms of its children), sorted."""
        names, values = [], []
        for level in range(8):
            nodes, _, weighted, _ = self._level(level, None)
            name = nodes[self.top].name
            names.append((name >> np.uint64(16) << np.uint64(8)) | (name & np.uint64(255)))
            values.append(weighted[self.top])
        return merged(np.concatenate(names), np.concatenate(values))

    def _down(self, level: int, start: tuple | None, below) -> tuple:
        nodes, parent, _, share = self._level(level, below)
        n = len(nodes[self.top].first)
        if start is None:
            told, mass, fall = np.zeros(n), np.ones(n), np.full(n, 0.5)
        else:
            name = nodes[self.top].name
            at = np.searchsorted(start[0], (name >> np.uint64(16) << np.uint64(8)) | (name & np.uint64(255)))
            told, mass, fall = (x[at] for x in start[1:])
        for d in range(self.top, self.depth + 1):
            if d > self.top:
                told, mass, fall = told[parent[d]], mass[parent[d]], fall[parent[d]]
            x = nodes[d]
            told = told + np.where(x.seen, mass * share[d] * x.chance, 0)
            mass = np.where(x.seen, mass * (1 - share[d]), mass)
            fall = np.where(x.seen, (x.chance + fall) / 2, fall)
        return nodes[self.depth], told, mass, fall

    def states(self, below: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
        """For the part above other subtrees: (context and decision, told, mass, fall) at its deepest contexts, sorted."""
        parts = [(n.name, *rest) for n, *rest in (self._down(level, None, below) for level in range(8))]
        whole = [np.concatenate(x) for x in zip(*parts, strict=True)]
        order = np.argsort(whole[0])
        return tuple(x[order] for x in whole)

    def logs(self, start: tuple | None = None) -> np.ndarray:
        """Natural logarithm of the probability of each window's last byte after its context."""
        out = np.zeros(len(self.keys[self.depth]))
        for level in range(8):
            nodes, told, mass, fall = self._down(level, start, None)
            one = (told + mass * fall)[nodes.of]
            out += np.log(np.where(nodes.bit, one, 1 - one))
        return out
