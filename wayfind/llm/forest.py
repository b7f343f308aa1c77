"""Union of rows of one task by links, in numpy."""

import numpy as np


def settle(parent: np.ndarray) -> np.ndarray:
    """Point each row at the root of its tree."""
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent[:] = up


def join_rows(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the rows of each link, every tree hanging from its smallest row."""
    while len(a):
        settle(parent)
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
