"""Optimal assignment by shortest augmenting paths."""

from __future__ import annotations

import numpy as np

INFINITE = float("inf")


#: Columns up to which plain numbers are quicker than arrays.
SMALL = 24


def _small(cost: list[list[float]]) -> list[tuple[int, int]]:
    """The same steps on plain numbers, for no more rows than columns."""
    rows, columns = len(cost), len(cost[0])
    row_price, column_price, owner = [0.0] * rows, [0.0] * columns, [-1] * columns
    for new in range(rows):
        best, via, left, done = [INFINITE] * columns, [-1] * columns, list(range(columns)), []
        row, base, last = new, 0.0, -1
        while row >= 0:
            own, price, least, at = cost[row], row_price[row], INFINITE, -1
            for c in left:
                reach = base + own[c] - price - column_price[c]
                if reach < best[c]:
                    best[c], via[c] = reach, last
                if best[c] < least:
                    least, at = best[c], c
            last, base = at, least
            left.remove(at)
            done.append(at)
            row = owner[at]
        row_price[new] += base
        for c in done:
            if owner[c] >= 0:
                row_price[owner[c]] += base - best[c]
            column_price[c] -= base - best[c]
        while last >= 0:
            before = via[last]
            owner[last] = new if before < 0 else owner[before]
            last = before
    return sorted((r, c) for c, r in enumerate(owner) if r >= 0)


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of least total cost, as many as the shorter side has; rows in order.

    Of equal optima the one that scanning columns from left finds is taken.
    """
    rows, columns = cost.shape
    if rows == columns == 1:
        return [(0, 0)]
    if rows > columns:
        return sorted((r, c) for c, r in assign(cost.T))
    if columns <= SMALL:
        return _small(cost.tolist())
    row_price, column_price = np.zeros(rows), np.zeros(columns)
    owner = np.full(columns, -1)
    for new in range(rows):
        best, via, done = np.full(columns, np.inf), np.full(columns, -1), np.zeros(columns, bool)
        row, base, last = new, 0.0, -1
        while row >= 0:
            reach = base + cost[row] - row_price[row] - column_price
            better = ~done & (reach < best)
            best[better], via[better] = reach[better], last
            open_ = np.where(done, np.inf, best)
            last = int(np.argmin(open_))
            base = open_[last]
            done[last] = True
            row = int(owner[last])
        seen = np.flatnonzero(done)
        row_price[new] += base
        held = seen[owner[seen] >= 0]
        row_price[owner[held]] += base - best[held]
        column_price[seen] -= base - best[seen]
        while last >= 0:
            before = via[last]
            owner[last] = new if before < 0 else owner[before]
            last = int(before)
    return sorted((int(owner[c]), int(c)) for c in np.flatnonzero(owner >= 0))
