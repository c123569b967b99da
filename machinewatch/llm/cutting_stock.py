"""The cutting-stock linear program by column generation, on a histogram.

A pattern says how many items of each size class one stock length holds. The
program finds the least number of stock lengths that meets the demand of every
class; new patterns are priced by a knapsack dynamic program over the duals.
Its size depends on the number of classes, not of items.
"""

from __future__ import annotations

import numpy as np

#: Relative gap to the lower bound at which patterns are no longer sought.
GAP = 1e-4
#: Steps after which the inverse of the basis is computed anew.
REFRESH = 50


def price(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: unbounded knapsack over integer sizes (ascending)."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        if k := fitting[room]:
            gains = best[room - sizes[:k]] + values[:k]
            j = int(gains.argmax())
            if gains[j] > best[room] + 1e-12:
                best[room], taken[room] = gains[j], j
    pattern, room = np.zeros(len(sizes), dtype=np.int64), capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            pattern[taken[room]] += 1
            room -= int(sizes[taken[room]])
    return float(best[capacity]), pattern


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used (fractional), meeting ``demand`` exactly."""
    m = len(sizes)
    if not m:
        return np.zeros((0, 0), dtype=np.int64), np.zeros(0)
    basis = np.diag(capacity // sizes)
    inverse = np.linalg.inv(basis.astype(float))
    used = inverse @ demand
    step = 0
    while True:
        duals = inverse.sum(axis=0)  # every pattern costs one stock length
        value, pattern = price(sizes, duals, capacity)
        # Duals over the best value are feasible, so their worth is a lower bound.
        if value <= 1.0 + 1e-9 or used.sum() * (1.0 - 1.0 / value) <= gap * used.sum():
            break
        direction = inverse @ pattern
        rising = direction > 1e-9
        ratios = np.full(m, np.inf)
        ratios[rising] = np.maximum(used[rising], 0.0) / direction[rising]
        out = int(ratios.argmin())
        basis[:, out] = pattern
        step += 1
        if step % REFRESH:
            pivot = inverse[out] / direction[out]
            inverse -= np.outer(direction, pivot)
            inverse[out] = pivot
            used = used - ratios[out] * direction
            used[out] = ratios[out]
        else:
            inverse = np.linalg.inv(basis.astype(float))
            used = inverse @ demand
    return basis.T.copy(), np.maximum(used, 0.0)
