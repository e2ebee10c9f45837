"""Weighted acyclic automata over word sequences, as arrays.

An automaton accepts sequences of at most ``DEPTH`` labels, each with a weight. A state at
depth d has a final weight and arcs (label, state at depth d + 1); states with the same
weight and arcs are one. It is built from sorted sequences, from the ends inwards, so that
each state finds its equal in the register of those already there. The weight of a prefix
is the sum over all it leads to, so a prefix's count needs no entry of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEPTH = 5
#: Labels are from 1, below this; 0 fills up sequences shorter than ``DEPTH``.
LABELS = 1 << 31


def _keys(rows: np.ndarray) -> list[np.ndarray]:
    """Integers that order sequences as their labels do, the leading one first: two where
    labels have 21 bits at most, three otherwise."""
    r = [rows[:, d].astype(np.int64) for d in range(DEPTH)]
    if not len(rows) or rows.max() < 1 << 21:
        return [r[0] << 42 | r[1] << 21 | r[2], r[3] << 21 | r[4]]
    return [r[0] << 31 | r[1], r[2] << 31 | r[3], r[4]]


def summed(rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequences in order, equal ones as one with their weights added."""
    if not len(rows):
        return rows, weights
    keys = _keys(rows)
    order = np.lexsort(keys[::-1])
    first = np.ones(len(rows), bool)
    first[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    first = np.flatnonzero(first)
    return rows[order[first]], np.add.reduceat(weights[order], first)


def place(rows: np.ndarray, bound: list[int]) -> int:
    """How many of the sorted ``rows`` come before ``bound``."""
    start, stop = 0, len(rows)
    for d, label in enumerate(bound):
        column = rows[start:stop, d]
        start, stop = start + int(np.searchsorted(column, label)), start + int(np.searchsorted(column, label, side="right"))
    return start


def _register(final: np.ndarray, n_arcs: np.ndarray, label: np.ndarray, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which states are kept, and for every state its place among these. States share a
    place if weights and arcs are equal; the hash only proposes, the arcs decide."""
    start = np.cumsum(n_arcs) - n_arcs
    with np.errstate(over="ignore"):
        arc = (label.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (child.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        arc = (arc ^ arc >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        sums = np.append(np.uint64(0), np.cumsum(arc, dtype=np.uint64))
        sign = sums[start + n_arcs] - sums[start]
        sign = (sign ^ sign >> np.uint64(32)) * np.uint64(0x94D049BB133111EB) + final.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    _, first, which = np.unique(sign, return_index=True, return_inverse=True)
    model = first[which]
    same = (final == final[model]) & (n_arcs == n_arcs[model])
    owner = np.repeat(np.arange(len(final)), n_arcs)
    arcs = np.flatnonzero(same[owner])
    at = start[model[owner[arcs]]] + arcs - start[owner[arcs]]
    differs = (label[arcs] != label[at]) | (child[arcs] != child[at])
    same[owner[arcs[differs]]] = False
    kept = np.flatnonzero(~same | (model == np.arange(len(final))))
    number = np.zeros(len(final), np.int64)
    number[kept] = np.arange(len(kept))
    return kept, np.where(same, number[model], number)


@dataclass
class Automaton:
    """Per depth the states' final weights and numbers of arcs, and their arcs in order."""

    final: list[np.ndarray]
    n_arcs: list[np.ndarray]
    label: list[np.ndarray]
    child: list[np.ndarray]

    @classmethod
    def of(cls, rows: np.ndarray, weights: np.ndarray) -> Automaton:
        """From sorted, different sequences."""
        n = len(rows)
        changed = np.zeros((n, DEPTH + 1), bool)  # the first d labels differ from those before
        if n:
            changed[1:, 1:] = np.logical_or.accumulate(rows[1:] != rows[:-1], axis=1)
            changed[0] = True
        levels, below, of_node = [], None, None
        for d in range(DEPTH, -1, -1):
            here = changed[:, d] & (rows[:, d - 1] > 0) if d else changed[:, 0]
            nodes = np.flatnonzero(here)
            ends = rows[nodes, d] == 0 if d < DEPTH else np.ones(len(nodes), bool)
            final = np.where(ends, weights[nodes], 0)
            if below is None:
                label = child = np.zeros(0, np.int64)
                n_arcs = np.zeros(len(nodes), np.int64)
            else:
                label, child = rows[below, d].astype(np.int64), of_node
                n_arcs = np.bincount(np.searchsorted(nodes, below, side="right") - 1, minlength=len(nodes))
            kept, number = _register(final, n_arcs, label, child)
            arcs = _arcs_of(kept, n_arcs)
            levels.append((final[kept], n_arcs[kept], label[arcs], child[arcs]))
            below, of_node = nodes, number
        return cls(*(list(v) for v in zip(*levels[::-1])))

    @classmethod
    def unpacked(cls, sizes, final, n_arcs, label, child) -> Automaton:
        """From the flat columns of ``packed``."""
        cuts = np.cumsum(sizes)[:-1]
        final, n_arcs = np.split(np.asarray(final, np.int64), cuts), np.split(np.asarray(n_arcs, np.int64), cuts)
        arcs = np.cumsum([int(n.sum()) for n in n_arcs])[:-1]
        return cls(final, n_arcs, np.split(np.asarray(label, np.int64), arcs), np.split(np.asarray(child, np.int64), arcs))

    def packed(self) -> tuple[list[int], *tuple[np.ndarray, ...]]:
        return [len(f) for f in self.final], *(np.concatenate(v) for v in (self.final, self.n_arcs, self.label, self.child))

    def sequences(self) -> tuple[np.ndarray, np.ndarray]:
        """All sequences with their weights, in no order."""
        rows, weights = [], []
        for prefix, state, d in self._walk(None):
            ends = self.final[d][state] > 0
            rows.append(prefix[ends])
            weights.append(self.final[d][state[ends]])
        return np.concatenate(rows), np.concatenate(weights)

    def totals(self) -> list[np.ndarray]:
        """Per depth and state, the weight of all that it leads to."""
        out = [self.final[DEPTH]]
        for d in range(DEPTH - 1, -1, -1):
            sums = np.append(0, np.cumsum(out[0][self.child[d]]))
            end = np.cumsum(self.n_arcs[d])
            out.insert(0, self.final[d] + sums[end] - sums[end - self.n_arcs[d]])
        return out

    def heavy(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefixes, the empty one aside, of at least that weight, with it."""
        totals = self.totals()
        rows, weights = [np.zeros((0, DEPTH), np.int64)], [np.zeros(0, np.int64)]
        for prefix, state, d in self._walk([t >= least for t in totals]):
            if d:
                rows.append(prefix)
                weights.append(totals[d][state])
        return np.concatenate(rows), np.concatenate(weights)

    def _walk(self, wanted: list[np.ndarray] | None):
        """Prefixes and their states, depth by depth; only states that are wanted."""
        prefix, state = np.zeros((min(1, len(self.final[0])), DEPTH), np.int32), np.zeros(min(1, len(self.final[0])), np.int64)
        for d in range(DEPTH + 1):
            if wanted is not None:
                prefix, state = prefix[wanted[d][state]], state[wanted[d][state]]
            yield prefix, state, d
            if d == DEPTH:
                return
            start = np.cumsum(self.n_arcs[d]) - self.n_arcs[d]
            n = self.n_arcs[d][state]
            arcs = np.repeat(start[state] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            prefix = np.repeat(prefix, n, axis=0)
            prefix[:, d], state = self.label[d][arcs], self.child[d][arcs]

    def compose(self, other: Automaton) -> tuple[np.ndarray, np.ndarray]:
        """The sequences that both accept, with this one's weights: pairs of states move
        along equal labels."""
        rows, weights = [], []
        prefix, mine, its = np.zeros((1, DEPTH), np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        if not len(self.final[0]) or not len(other.final[0]):
            return np.zeros((0, DEPTH), np.int64), np.zeros(0, np.int64)
        for d in range(DEPTH + 1):
            ends = (self.final[d][mine] > 0) & (other.final[d][its] > 0)
            rows.append(prefix[ends])
            weights.append(self.final[d][mine[ends]])
            if d == DEPTH:
                break
            # My arcs as sorted (state, label), searched for (my state, its label).
            owner = np.repeat(np.arange(len(self.n_arcs[d])), self.n_arcs[d])
            known = owner * LABELS + self.label[d]
            n = other.n_arcs[d][its]
            start = np.cumsum(other.n_arcs[d]) - other.n_arcs[d]
            arcs = np.repeat(start[its] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            asked = np.repeat(mine, n) * LABELS + other.label[d][arcs]
            at = np.searchsorted(known, asked)
            hit = np.flatnonzero(known[np.minimum(at, len(known) - 1)] == asked) if len(known) else np.zeros(0, np.int64)
            prefix = np.repeat(prefix, n, axis=0)[hit]
            prefix[:, d] = other.label[d][arcs[hit]]
            mine, its = self.child[d][at[hit]], other.child[d][arcs[hit]]
        return np.concatenate(rows), np.concatenate(weights)


def _arcs_of(states: np.ndarray, n_arcs: np.ndarray) -> np.ndarray:
    """The arcs of the given states, in order."""
    start, n = np.cumsum(n_arcs) - n_arcs, n_arcs[states]
    return np.repeat(start[states] - (np.cumsum(n) - n), n) + np.arange(n.sum())


def union(parts: list[tuple[list[bytes], Automaton]]) -> tuple[list[bytes], Automaton]:
    """One automaton over the joint labels, weights of equal sequences added. Each part
    comes with its labels' words, sorted, label 1 first."""
    words = sorted(set().union(*(own for own, _ in parts)))
    number = {w: i + 1 for i, w in enumerate(words)}
    rows, weights = [], []
    for own, automaton in parts:
        label = np.array([0, *(number[w] for w in own)], np.int32)
        sequences, n = automaton.sequences()
        rows.append(label[sequences])
        weights.append(n)
    return words, Automaton.of(*summed(np.concatenate(rows), np.concatenate(weights)))
