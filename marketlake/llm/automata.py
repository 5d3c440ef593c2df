"""Weighted acyclic automata over word sequences, one depth at a time (numpy, inside tasks).

A state stands for a word sequence, an arc from it for the sequence that is one word longer, and the arc's weight
for the count of that sequence.  The arcs of one depth are three arrays sorted by (state, label), so that
building, union, pruning and composition are all sorts and merges.  States are numbered by whoever prunes.
"""

from __future__ import annotations

import numpy as np


class Arcs:
    """All arcs of one depth."""

    def __init__(self, state: np.ndarray, label: np.ndarray, weight: np.ndarray):
        self.state, self.label, self.weight = state, label, weight

    def __len__(self) -> int:
        return len(self.state)

    @classmethod
    def extend(cls, state: np.ndarray, label: np.ndarray) -> tuple[Arcs, np.ndarray]:
        """Arcs counted from every place where a state is followed by a label, and the arc of each place.

        States and labels are local codes, small enough that a pair of them fits 64 bits."""
        width = int(label.max()) + 1 if len(label) else 1
        pair, at, n = np.unique(state.astype(np.int64) * width + label, return_inverse=True, return_counts=True)
        return cls(pair // width, pair % width, n), at

    @classmethod
    def union(cls, parts: list[Arcs]) -> tuple[Arcs, list[np.ndarray]]:
        """One automaton with the summed weights of equal arcs, and where each part's arcs went."""
        state, label, weight = (np.concatenate([getattr(p, c) for p in parts]) for c in ("state", "label", "weight"))
        order = np.lexsort((label, state))
        s, t = state[order], label[order]
        head = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (t[1:] != t[:-1])])[:len(s)])
        out = cls(s[head], t[head], np.add.reduceat(weight[order].astype(np.int64), head) if len(head) else np.empty(0, np.int64))
        place = np.empty(len(s), np.int64)
        place[order] = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(s))))
        return out, np.split(place, np.cumsum([len(p) for p in parts])[:-1])

    def numbered(self, least: int, base: int) -> np.ndarray:
        """The target state of every arc of at least that weight, counted from ``base``; -1 for the pruned ones."""
        good = self.weight >= least
        return np.where(good, base + np.cumsum(good) - 1, -1)
