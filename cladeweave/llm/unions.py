"""Union-find over small integers, for links found within one task."""

from __future__ import annotations

from collections.abc import Iterable


class Unions:
    def __init__(self, n: int):
        self._up = list(range(n))

    def root(self, i: int) -> int:
        up = self._up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self._up[max(i, j)] = min(i, j)

    def join_all(self, pairs: Iterable[tuple[int, int]]) -> None:
        for i, j in pairs:
            self.join(i, j)
