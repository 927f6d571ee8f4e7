"""Cutting stock by column generation: how often to use which pattern of piece lengths.

Sizes are small integers (length classes), so all of this is bounded by the number of
classes, whatever the number of pieces.  Linear program over patterns (Gilmore and
Gomory): a basis of patterns meets the demand exactly, a knapsack dynamic program over
the dual prices finds the pattern that improves it most, until none does.
"""

from __future__ import annotations

import numpy as np


def best_pattern(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """Unbounded knapsack: the counts of each size that maximise the summed price."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    sizes_up, prices_up = sizes[order], prices[order]
    fit = np.searchsorted(sizes_up, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        k = fit[c]
        if k:
            value = best[c - sizes_up[:k]] + prices_up[:k]
            top = int(value.argmax())
            if value[top] > best[c] + 1e-12:
                best[c], choice[c] = value[top], top
    counts = np.zeros(len(sizes), np.int64)
    c = capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            counts[order[choice[c]]] += 1
            c -= sizes_up[choice[c]]
    return counts, float(best[capacity])


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, max_pivots: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows of counts by size) and their fractional uses with patterns.T @ uses == demand."""
    m = len(sizes)
    patterns = np.diag(capacity // sizes).astype(np.float64)
    inverse = np.diag(1.0 / np.diag(patterns))  # inverse of patterns.T
    uses = demand / np.diag(patterns)
    for pivot in range(max_pivots or 12 * m + 50):
        prices = inverse.sum(axis=0)
        column, value = best_pattern(sizes, prices, capacity)
        if value <= 1 + 1e-7:
            break
        direction = inverse @ column
        ratios = np.full(m, np.inf)
        ok = direction > 1e-9
        ratios[ok] = np.maximum(uses[ok], 0) / direction[ok]
        row = int(ratios.argmin())
        if not np.isfinite(ratios[row]):
            break
        step = ratios[row]
        uses -= step * direction
        uses[row] = step
        patterns[row] = column
        pivot_row = inverse[row] / direction[row]
        inverse -= np.outer(direction, pivot_row)
        inverse[row] = pivot_row
        if pivot % 100 == 99:  # fresh inverse against rounding errors
            inverse = np.linalg.inv(patterns.T)
            uses = inverse @ demand
    return patterns.astype(np.int64), np.maximum(uses, 0)


def plan(demand: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pattern {size: count}, times) that hold exactly ``demand`` {size: pieces}.

    Uses of the linear program's patterns are rounded down; what they leave, at most one
    pattern's worth a size, goes into patterns filled from the largest size down."""
    sizes = np.array(sorted(s for s, n in demand.items() if n > 0), np.int64)
    if len(sizes) == 0:
        return []
    left = np.array([demand[int(s)] for s in sizes], np.int64)
    patterns, uses = solve(sizes, left.astype(np.float64), capacity)
    out = []
    for counts, used in zip(patterns, np.floor(uses + 1e-6).astype(np.int64)):
        some = counts > 0
        times = int(min(used, (left[some] // counts[some]).min())) if some.any() else 0
        if times > 0:
            out.append((counts, times))
            left = left - times * counts
    while left.any():
        counts, room = np.zeros(len(sizes), np.int64), capacity
        for i in range(len(sizes) - 1, -1, -1):
            counts[i] = min(left[i], room // sizes[i])
            room -= counts[i] * sizes[i]
        some = counts > 0
        times = int((left[some] // counts[some]).min())
        out.append((counts, times))
        left = left - times * counts
    return [({int(s): int(c) for s, c in zip(sizes, counts) if c}, times) for counts, times in out]
