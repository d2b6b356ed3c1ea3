"""R-tree over vectors of group counts, for pairs of sets that may overlap enough.

A set is a point: how many of its tokens hash into each of ``GROUPS`` groups. Two sets
cannot share more than the sum of the coordinates' minima. A node of the tree keeps the
greatest coordinates and the least size below it, and a pair of nodes is left out when
even these cannot reach the overlap that its least sizes ask for.

A coordinate takes a byte; what exceeds it is summed in one number more, of which two
sets share the lesser at most.
"""

from __future__ import annotations

import numpy as np

GROUPS = 512
FANOUT = 16
_SHIFT = np.uint64(64 - GROUPS.bit_length() + 1)
_MOST = 255
#: bytes of a point: the coordinates and the sum of what exceeds them
POINT_BYTES = GROUPS + 4


def group_counts(tokens: np.ndarray) -> bytes:
    """Point of a set of 64-bit tokens; the upper bits choose the group."""
    counts = np.bincount((tokens >> _SHIFT).astype(np.int64), minlength=GROUPS)
    over = int(np.maximum(counts - _MOST, 0).sum())
    return np.minimum(counts, _MOST).astype(np.uint8).tobytes() + over.to_bytes(4, "little")


def read_points(points: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and excess of many points."""
    rows = np.frombuffer(b"".join(points), np.uint8).reshape(-1, POINT_BYTES)
    return np.ascontiguousarray(rows[:, :GROUPS]), rows[:, GROUPS:].copy().view("<u4").ravel().astype(np.int64)


def overlap_bound(a: np.ndarray, b: np.ndarray, over_a: np.ndarray, over_b: np.ndarray) -> np.ndarray:
    return np.minimum(a, b).sum(1, dtype=np.int64) + np.minimum(over_a, over_b)


def may_link(bound: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether an overlap of ``bound`` suffices for sets of ``sizes`` together.

    100 * overlap >= percent * (sizes - overlap).
    """
    return bound.astype(np.int64) * (100 + percent) >= percent * sizes


class CountTree:
    """Bulk-loaded by class and size. Entries of one class are not paired with each other,
    and a tree node knows its class if it has only one."""

    def __init__(self, points: np.ndarray, over: np.ndarray, sizes: np.ndarray, classes: np.ndarray, percent: int):
        self._percent = percent
        _, place, members = np.unique(classes, return_inverse=True, return_counts=True)
        grouped = np.where(members[place] > 1, place, -1)  # entries alone in their class mix
        self.order = np.lexsort((points[:, 0], sizes, grouped))
        least = sizes[self.order].astype(np.int64)
        level = (points[self.order], over[self.order], least, least)
        self._levels = [level]
        while len(level[0]) > 1:
            cuts = np.arange(0, len(level[0]), FANOUT)
            by = (np.maximum, np.maximum, np.minimum, np.maximum)
            level = tuple(f.reduceat(x, cuts) for f, x in zip(by, level))
            self._levels.append(level)
        self.classify(classes)

    def classify(self, classes: np.ndarray) -> None:
        """Give the entries other classes, also between two portions of ``pairs``: classes
        that have become one are not paired from then on."""
        low = high = classes[self.order]
        self._classes = [(low, high)]
        while len(low) > 1:
            cuts = np.arange(0, len(low), FANOUT)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self._classes.append((low, high))

    def _pass(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        (top, over, least, most), (low, high) = self._levels[level], self._classes[level]
        one_class = (low[i] == high[i]) & (low[j] == high[j]) & (low[i] == low[j])
        sized = (100 * most[i] >= self._percent * least[j]) & (100 * most[j] >= self._percent * least[i])
        keep = sized & ~one_class
        at = np.flatnonzero(keep)
        for k in range(0, len(at), 1 << 13):
            part = at[k : k + (1 << 13)]
            p, q = i[part], j[part]
            bound = np.minimum(overlap_bound(top[p], top[q], over[p], over[q]), np.minimum(most[p], most[q]))
            keep[part] = may_link(bound, least[p] + least[q], self._percent)
        return keep

    def pairs(self, level: int | None = None, i=None, j=None):
        """Arrays (i, j) of entries of different classes that may link, each pair once, in portions."""
        if level is None:
            level, i, j = len(self._levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64)
        for at in range(0, len(i), 1024):
            p, q = i[at : at + 1024], j[at : at + 1024]
            keep = self._pass(level, p, q)
            p, q = p[keep], q[keep]
            if not len(p):
                continue
            if level == 0:
                yield self.order[p], self.order[q]
                continue
            below = len(self._levels[level - 1][0])
            steps = np.arange(FANOUT)
            p2 = np.repeat((p[:, None] * FANOUT + steps), FANOUT, 1).ravel()
            q2 = np.tile((q[:, None] * FANOUT + steps), (1, FANOUT)).ravel()
            fits = (p2 < below) & (q2 < below) & (p2 <= q2)
            yield from self.pairs(level - 1, p2[fits], q2[fits])
