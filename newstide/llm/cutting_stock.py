"""How to fill sequences from pieces of given lengths: cutting stock by column generation.

Few numbers go in (how many pieces there are of each length below the size) and few come out,
whatever the table holds, so this runs on the driver.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np

_EPS = 1e-9


@dataclass(frozen=True)
class Pattern:
    """``copies`` sequences, each filled to its end by ``parts`` = ((length, how many), ...)."""

    parts: tuple[tuple[int, int], ...]
    copies: int


class _Master:
    """The linear program: most sequences from patterns within the pieces there are.

    Revised simplex on an explicit inverse of the basis; ``price[l]`` is what one more piece
    of a length is worth, in sequences.
    """

    def __init__(self, counts: np.ndarray):
        self.inverse = np.eye(len(counts))
        # Unlike amounts keep the pivots moving; what is taken is rounded down anyway.
        self.amount = counts * (1 + 1e-6 * np.random.default_rng(0).random(len(counts)))
        self.basis = [-1] * len(counts)  # pattern by row, -1 for pieces left over
        self.price = np.zeros(len(counts))

    def enter(self, column: int, rows: np.ndarray, many: np.ndarray, gain: float) -> bool:
        """Bring a column into the basis; False if no pieces limit it."""
        d = self.inverse[:, rows] @ many
        limit = np.flatnonzero(d > _EPS)
        if not len(limit):
            return False
        ratio = self.amount[limit] / d[limit]
        ties = limit[ratio <= ratio.min() + _EPS]
        at = ties[np.argmax(d[ties])]
        step = self.amount[at] / d[at]
        self.amount -= step * d
        np.maximum(self.amount, 0, out=self.amount)
        self.amount[at] = step
        self.inverse[at] /= d[at]
        d[at] = 0
        use = np.flatnonzero(np.abs(d) > 1e-12)
        wide = np.flatnonzero(self.inverse[at])
        if len(use) * len(wide) * 8 < self.inverse.size:
            self.inverse[np.ix_(use, wide)] -= np.outer(d[use], self.inverse[at, wide])
        else:
            self.inverse[use] -= d[use, None] * self.inverse[at]
        self.price += gain * self.inverse[at]
        self.basis[at] = column
        return True


def _cheapest(price: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack: least price of pieces that fill c exactly, for every c, and one piece of them."""
    best, choice = np.full(size + 1, np.inf), np.full(size + 1, -1, np.int64)
    best[0] = 0
    for c in range(1, size + 1):
        fit = int(np.searchsorted(lengths, c, "right"))
        if fit:
            cost = price[:fit] + best[c - lengths[:fit]]
            k = int(np.argmin(cost))
            best[c], choice[c] = cost[k], k
    return best, choice


def _pattern(first: int, choice: np.ndarray, lengths: np.ndarray, size: int) -> tuple[tuple[int, int], ...]:
    """Rows and how often, of the cheapest filling that holds a piece of row ``first``."""
    rows, left = Counter([first]), size - int(lengths[first])
    while left:
        k = int(choice[left])
        rows[k] += 1
        left -= int(lengths[k])
    return tuple(sorted(rows.items()))


def _solve(counts: np.ndarray, lengths: np.ndarray, size: int, gap: float, pivots: int):
    """Patterns met, and how much of each the linear program takes.

    The knapsack is solved for prices between the program's own and a plain one, by tokens
    and a little by piece: the program's prices alone are zero for most lengths at first, and
    its patterns would then be made of the smallest pieces.
    """
    master, known, patterns = _Master(counts), set(), []
    plain = lengths / size + 0.05
    most, own = float((counts * lengths).sum()) / size, 0.2
    rows, many = np.zeros((0, 1), np.int64), np.zeros((0, 1))
    for _ in range(pivots * len(counts)):
        gains = 1 - (np.append(master.price, 0.0)[rows] * many).sum(axis=1)
        at = int(np.argmax(gains)) if len(gains) else -1
        if at >= 0 and gains[at] > 1e-7:
            used = rows[at] < len(counts)
            if master.enter(at, rows[at][used], many[at][used], gains[at]):
                continue
        low = int(np.argmin(master.price))
        if master.price[low] < -1e-7 and master.enter(-1, np.array([low]), np.ones(1), -master.price[low]):
            continue
        reached = sum(x for b, x in zip(master.basis, master.amount) if b >= 0)
        if reached >= (1 - gap) * most:
            break
        added = 0
        while not added:
            value = np.maximum(master.price, 0)
            best, choice = _cheapest(own * value + (1 - own) * plain, lengths, size)
            if own == 1 and best[size] > 0 and np.isfinite(best[size]):
                most = min(most, float(value @ counts) / best[size])
            for k in np.flatnonzero(np.isfinite(best[size - lengths])):
                made = _pattern(int(k), choice, lengths, size)
                if made not in known and sum(value[r] * m for r, m in made) < 1 - 1e-6:
                    known.add(made)
                    patterns.append(made)
                    added += 1
            if not added and own == 1:
                break
            own = own if added else min(1.0, own + 0.2)
        if not added:
            break
        width = max(map(len, patterns))
        rows = np.full((len(patterns), width), len(counts), np.int64)
        many = np.zeros((len(patterns), width))
        for i, made in enumerate(patterns):
            rows[i, : len(made)] = [r for r, _ in made]
            many[i, : len(made)] = [m for _, m in made]
    amounts = np.zeros(len(patterns))
    for b, x in zip(master.basis, master.amount):
        if b >= 0:
            amounts[b] += x
    return patterns, amounts


def _exact_filling(left: dict[int, int], size: int) -> Counter | None:
    """Pieces among those left that fill a sequence, or None: subset sums as bits of a number."""
    reach, steps = 1, []
    full = (1 << (size + 1)) - 1
    for length in sorted(left, reverse=True):
        many, k = min(left[length], size // length), 1
        while many > 0:
            take = min(k, many)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & full
            many, k = many - take, 2 * k
            if reach >> size & 1:
                break
        if reach >> size & 1:
            break
    else:
        return None
    found, at = Counter(), size
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            found[length] += take
            at -= length * take
    return found


def plan_patterns(histogram: dict[int, int], size: int, gap: float = 0.005, pivots: int = 3) -> list[Pattern]:
    """Patterns that fill sequences of ``size`` to the end, never using more pieces than there
    are; ``histogram`` says how many there are of each length from 1 to ``size`` - 1.

    The linear program is solved to within ``gap`` of its bound, or for ``pivots`` steps per
    length, which is nearly as good, then rounded down; patterns
    met on the way, the largest fractions first, and then exact subset sums are taken as long
    as the pieces left allow. What then remains fills no sequence, or little of it.
    """
    lengths = np.array(sorted(k for k, n in histogram.items() if n > 0), np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[int(k)] for k in lengths], np.int64)
    patterns, amounts = _solve(counts, lengths, size, gap, pivots)
    copies = np.floor(amounts * (1 - 1e-12) + 1e-9).astype(np.int64)
    left = counts.copy()
    for made, n in zip(patterns, copies):
        for row, many in made:
            left[row] -= many * n
    order = sorted(range(len(patterns)), key=lambda i: (copies[i] - amounts[i], i))
    for i in order:  # one more, or one fewer where rounding took too many
        made = patterns[i]
        while copies[i] > 0 and any(left[row] < 0 for row, _ in made):
            copies[i] -= 1
            for row, many in made:
                left[row] += many
        more = min(left[row] // many for row, many in made)
        if more > 0:
            copies[i] += more
            for row, many in made:
                left[row] -= many * more
    taken = {}
    for made, n in zip(patterns, copies):
        if n > 0:
            taken[tuple((int(lengths[r]), m) for r, m in made)] = int(n)
    rest = {int(k): int(n) for k, n in zip(lengths, left) if n > 0}
    while rest:
        found = _exact_filling(rest, size)
        if found is None:
            break
        n = min(rest[k] // m for k, m in found.items())
        parts = tuple(sorted(found.items()))
        taken[parts] = taken.get(parts, 0) + n
        for k, m in found.items():
            rest[k] -= m * n
            if not rest[k]:
                del rest[k]
    return [Pattern(parts, n) for parts, n in taken.items()]
