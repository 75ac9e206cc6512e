"""Cutting-stock patterns by column generation.

Gilmore and Gomory, "A linear programming approach to the cutting-stock
problem", 1961, in its packing form: with how many full rows of stock can the
counts of all lengths be used up, each row by a pattern that fills it exactly?
The master program is solved by the revised simplex method; its duals price new
patterns by a knapsack dynamic program; rows already full of tokens bound it.
"""

from __future__ import annotations

import numpy as np


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Least price of filling each room up to ``capacity`` exactly, and the item taken last (-1: it can't be filled)."""
    order = np.argsort(lengths, kind="stable")
    lengths, prices = lengths[order], prices[order]
    best = np.full(capacity + 1, np.inf)
    best[0] = 0
    last = np.full(capacity + 1, -1, np.int64)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        n = upto[room]
        if n:
            cost = best[room - lengths[:n]] + prices[:n]
            i = int(cost.argmin())
            if cost[i] < np.inf:
                best[room], last[room] = cost[i], order[i]
    return best, last


def _items(lengths: np.ndarray, last: np.ndarray, room: int) -> list[int]:
    out = []
    while room > 0:
        out.append(int(last[room]))
        room -= int(lengths[out[-1]])
    return out


def relaxed(lengths: np.ndarray, counts: np.ndarray, capacity: int, gap: float = 0.01, pivots: int = 3000) -> list[tuple[float, dict[int, int]]]:
    """(multiplicity, count by position in ``lengths``) of the patterns in the master program's solution.

    It stops within ``gap`` of the bound that all tokens fill rows, when no
    pattern gains, or after ``pivots`` steps; every step's solution is feasible.
    """
    m = len(lengths)
    inverse, x, duals = np.eye(m), counts.astype(float), np.zeros(m)
    column_of: list[dict[int, int] | None] = [None] * m  # None: unused length
    done = 0

    def enter(items: list[int]) -> bool:
        nonlocal x, duals, done, inverse
        column: dict[int, int] = {}
        for i in items:
            column[i] = column.get(i, 0) + 1
        at, n = np.array(list(column)), np.array(list(column.values()), float)
        gain = 1 - duals[at] @ n
        if gain <= 1e-7:
            return False
        way = inverse[:, at] @ n
        up = way > 1e-9
        if not up.any():
            return False
        ratio = np.full(m, np.inf)
        ratio[up] = x[up] / way[up]
        out = int(ratio.argmin())
        row = inverse[out] / way[out]
        x = np.maximum(x - ratio[out] * way, 0)
        x[out] = ratio[out]
        changed = np.flatnonzero(np.abs(way) > 1e-12)
        inverse[changed] -= np.outer(way[changed], row)
        inverse[out] = row
        duals = duals + gain * row
        column_of[out] = column
        done += 1
        return True

    place = {int(v): i for i, v in enumerate(lengths)}
    for v, i in place.items():  # start with pairs
        if capacity - v in place and v <= capacity - v:
            enter([i, place[capacity - v]])
    bound = float(counts @ lengths) / capacity
    while done < pivots:
        if sum(x[i] for i in range(m) if column_of[i]) >= (1 - gap) * bound:
            break
        best, last = knapsack(lengths, np.maximum(duals, 0), capacity)
        cost = np.maximum(duals, 0) + best[capacity - lengths]  # of the cheapest pattern that holds each length
        tried = [enter([int(i), *_items(lengths, last, int(capacity - lengths[i]))]) for i in np.argsort(cost, kind="stable")[:96] if cost[i] < 1 - 1e-7]
        if not any(tried):
            break
    return [(float(x[i]), c) for i, c in enumerate(column_of) if c and x[i] > 1e-9]


def filled(lengths: np.ndarray, amounts: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Patterns one after another, each used as often as its lengths last; ``amounts`` falls accordingly.

    A length is the cheaper the more of it is left, so plentiful ones are used
    up together. A pattern that asks for more than there is makes its lengths
    dearer for the next try.
    """
    out, dearer, misses = [], np.ones(len(lengths)), 0
    while misses < 20:
        open_ = np.flatnonzero(amounts > 0)
        if amounts[open_] @ lengths[open_] < capacity:
            break
        best, last = knapsack(lengths[open_], dearer[open_] / amounts[open_], capacity)
        if best[capacity] == np.inf:
            break
        column: dict[int, int] = {}
        for i in _items(lengths[open_], last, capacity):
            column[int(open_[i])] = column.get(int(open_[i]), 0) + 1
        n = min(int(amounts[i]) // c for i, c in column.items())
        if not n:
            misses += 1
            for i, c in column.items():
                if c > amounts[i]:
                    dearer[i] *= 4
            continue
        misses = 0
        for i, c in column.items():
            amounts[i] -= n * c
        out.append((n, column))
    return out


def rounded(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Whole multiplicities and lengths of patterns that fill ``capacity`` exactly and never take more than ``counts``.

    Multiplicities are rounded down; then patterns with the largest fractions
    are used once more while their lengths last. What is left is filled by
    knapsack patterns priced by how much of each length there is.
    """
    lengths = np.array(sorted(length for length, n in counts.items() if 0 < length <= capacity and n > 0), np.int64)
    if not len(lengths):
        return []
    left = np.array([counts[int(v)] for v in lengths], np.int64)
    found = relaxed(lengths, left, capacity)
    times = []
    for x, column in found:
        n = min([int(x + 1e-6), *(int(left[i]) // c for i, c in column.items())])
        for i, c in column.items():
            left[i] -= n * c
        times.append(n)
    for j in sorted(range(len(found)), key=lambda j: (times[j] - found[j][0], j)):
        if all(left[i] >= c for i, c in found[j][1].items()):
            for i, c in found[j][1].items():
                left[i] -= c
            times[j] += 1
    every = [(n, column) for n, (_, column) in zip(times, found) if n] + filled(lengths, left, capacity)
    return [(n, [int(lengths[i]) for i, c in sorted(column.items(), reverse=True) for _ in range(c)]) for n, column in every]
