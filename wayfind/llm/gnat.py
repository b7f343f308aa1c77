"""A geometric near-neighbour access tree over the entries of a codebook, searched by many points at once.

A node has split points, and each other entry belongs to the nearest of them. For every split point and
every subtree the node keeps the range of distances between the two. A search measures its distances to
the split points; a subtree is left out where the range says that all of it is farther than the best
entry so far. Distances of decision are squared integers; the ranges are floating point, rounded so that
a subtree goes only if every entry in it is strictly farther, so that ties are still met and decided by
the lower index.
"""

from __future__ import annotations

import numpy as np

#: Split points of a node, and entries below which a node isn't split.
SPLITS, LEAF = 8, 12
#: Products are summed exactly in floating point below this.
EXACT = 1 << 53


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs of integer rows, exact."""
    most = int(max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)))
    if 4 * most * most * max(1, x.shape[1]) < EXACT:
        x, y = x.astype(np.float64), y.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(axis=1) for row in y], axis=1) if len(y) else np.zeros((len(x), 0), np.int64)


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.nextafter(x, -np.inf), -np.inf)


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.nextafter(x, np.inf), np.inf)


class Gnat:
    """A tree over the rows of entries, integers; index tells where each stands in the codebook."""

    def __init__(self, entries: np.ndarray, index: np.ndarray | None = None):
        index = np.arange(len(entries)) if index is None else index
        self.below: list[Gnat] = []
        if len(entries) <= LEAF:
            self.points, self.index = entries, index
            return
        chosen, far = [0], squared(entries, entries[:1])[:, 0]
        while len(chosen) < SPLITS:  # each next one as far as can be from those before
            chosen.append(int(np.argmax(np.where(np.isin(np.arange(len(entries)), chosen), -1, far))))
            far = np.minimum(far, squared(entries, entries[chosen[-1:]])[:, 0])
        rest = np.setdiff1d(np.arange(len(entries)), chosen)
        self.points, self.index = entries[chosen], index[chosen]
        from_split = squared(entries[rest], self.points)
        owner = from_split.argmin(axis=1)
        distance = np.sqrt(from_split.astype(np.float64))
        low, high = [], []
        for j in range(SPLITS):
            own = owner == j
            if own.any():
                self.below.append(Gnat(entries[rest[own]], index[rest[own]]))
                low.append(_down(distance[own].min(axis=0)))
                high.append(_up(distance[own].max(axis=0)))
        self.low, self.high = np.array(low), np.array(high)  # by subtree and split point

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of x the index of the nearest entry, ties to the lower one, and its squared distance."""
        at, best = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), np.iinfo(np.int64).max)
        self._search(x, np.arange(len(x)), at, best)
        return at, best

    def _search(self, x: np.ndarray, rows: np.ndarray, at: np.ndarray, best: np.ndarray) -> None:
        if not len(rows):
            return
        d = squared(x[rows], self.points)
        least = d.min(axis=1)
        index = np.where(d == least[:, None], self.index[None, :], np.iinfo(np.int64).max).min(axis=1)
        better = (least < best[rows]) | ((least == best[rows]) & (index < at[rows]))
        best[rows[better]], at[rows[better]] = least[better], index[better]
        if not self.below:
            return
        root = np.sqrt(d.astype(np.float64))
        lower, upper = _down(root), _up(root)
        bounds = np.stack([_down(np.maximum(lower - high, low - upper).max(axis=1)) for low, high in zip(self.low, self.high, strict=True)], axis=1)
        likely = bounds.argmin(axis=1)  # the subtree that may be nearest comes first, so that the others are measured against a good entry
        for first in (True, False):
            for j, child in enumerate(self.below):
                may = bounds[:, j] <= _up(np.sqrt(best[rows].astype(np.float64)))
                child._search(x, rows[may & ((likely == j) == first)], at, best)
