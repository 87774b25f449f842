"""Many patterns looked for in a text at once."""

from __future__ import annotations

import sys
from collections import deque

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Automaton:
    """Aho-Corasick automaton: a text is read once, whatever the number of patterns. An empty pattern is in every text."""

    def __init__(self, patterns: list[str]):
        self._next: list[dict[str, int]] = [{}]
        self._found: list[tuple[int, ...]] = [()]
        for number, pattern in enumerate(patterns):
            state = 0
            for sign in pattern:
                if sign not in self._next[state]:
                    self._next[state][sign] = len(self._next)
                    self._next.append({})
                    self._found.append(())
                state = self._next[state][sign]
            self._found[state] += (number,)
        self._back = [0] * len(self._next)
        waiting = deque(self._next[0].values())
        while waiting:
            state = waiting.popleft()
            for sign, child in self._next[state].items():
                self._back[child] = self._step(self._back[state], sign)
                self._found[child] += self._found[self._back[child]]
                waiting.append(child)

    def _step(self, state: int, sign: str) -> int:
        while state and sign not in self._next[state]:
            state = self._back[state]
        return self._next[state].get(sign, 0)

    def find(self, text: str) -> list[int]:
        """Numbers of the patterns that the text holds, ascending."""
        state, found = 0, set(self._found[0])
        for sign in text:
            state = self._step(state, sign)
            found.update(self._found[state])
        return sorted(found)
