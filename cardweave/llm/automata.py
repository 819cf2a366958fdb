"""Weighted acyclic automata over words: counts of phrases, built from sorted phrases.

States with the same future are one state, so phrases share their beginnings and
their ends. An arc knows how many phrases lie before those it leads to; summed along a
path that numbers the phrases in their order, and the number finds the weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

Phrase = tuple[str, ...]


class CountTransducer:
    """Maps phrases to counts. ``arcs``: rows of (state, label, target, phrases before), by state and order."""

    def __init__(self, vocabulary: list[str], arcs: np.ndarray, finals: np.ndarray, weights: np.ndarray):
        self.vocabulary, self.arcs, self.finals, self.weights = vocabulary, arcs, finals, weights
        self.root = len(finals) - 1
        self.out: dict[tuple[int, str], tuple[int, int]] = {
            (state, vocabulary[label]): (target, before) for state, label, target, before in arcs.tolist()}

    def weight(self, phrase: Phrase) -> int:
        """Count of a phrase, 0 if it is none of these: the composition with the phrase's own path."""
        state, number = self.root, 0
        for word in phrase:
            step = self.out.get((state, word))
            if step is None:
                return 0
            state, number = step[0], number + step[1]
        return int(self.weights[number]) if self.finals[state] else 0

    def phrases(self) -> Iterator[tuple[Phrase, int]]:
        """All phrases in order, with their counts."""
        after: dict[int, list[tuple[str, int]]] = {}
        for state, label, target, _ in self.arcs.tolist():
            after.setdefault(state, []).append((self.vocabulary[label], target))
        weights = iter(self.weights.tolist())
        waiting: list[tuple[int, Phrase]] = [(self.root, ())]
        while waiting:
            state, path = waiting.pop()
            if self.finals[state]:
                yield path, next(weights)
            waiting += [(target, (*path, word)) for word, target in reversed(after.get(state, []))]


class Builder:
    """Takes phrases in ascending order of their words; equal ones in a row add up."""

    def __init__(self) -> None:
        self.labels: dict[str, int] = {}
        self.register: dict[tuple, int] = {}
        self.finals: list[bool] = []
        self.sizes: list[int] = []          # phrases that a state accepts
        self.arcs: list[tuple[int, int, int, int]] = []
        self.weights: list[int] = []
        self.last: Phrase | None = None
        # States on the path of the last phrase: [final, arcs, the arc under way].
        self.path: list[list] = [[False, []]]

    def __len__(self) -> int:
        return len(self.weights)

    def add(self, phrase: Phrase, weight: int) -> None:
        if phrase == self.last:
            self.weights[-1] += weight
            return
        if self.last is not None and phrase < self.last:
            raise ValueError("phrases must ascend")
        shared = 0
        for a, b in zip(phrase, self.last or ()):
            if a != b:
                break
            shared += 1
        self._freeze(shared)
        for word in phrase[shared:]:
            self.path[-1][1].append((self.labels.setdefault(word, len(self.labels)), -1))
            self.path.append([False, []])
        self.path[-1][0] = True
        self.weights.append(weight)
        self.last = phrase

    def _freeze(self, depth: int) -> None:
        """States below ``depth`` will not change any more: each becomes the registered one of the same future."""
        while len(self.path) - 1 > depth:
            state = self._state(*self.path.pop())
            arcs = self.path[-1][1]
            arcs[-1] = (arcs[-1][0], state)

    def _state(self, final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, *arcs)
        state = self.register.get(key)
        if state is None:
            state = self.register[key] = self._new(final, arcs)
        return state

    def _new(self, final: bool, arcs: list[tuple[int, int]]) -> int:
        state, before = len(self.finals), int(final)
        for label, target in arcs:
            self.arcs.append((state, label, target, before))
            before += self.sizes[target]
        self.finals.append(final)
        self.sizes.append(before)
        return state

    def done(self) -> CountTransducer:
        """The automaton; its root is the last state."""
        self._freeze(0)
        self._new(*self.path[0])
        return CountTransducer(list(self.labels), np.array(self.arcs, np.int64).reshape(-1, 4),
                               np.array(self.finals, bool), np.array(self.weights, np.int64))
