"""Unit commitment over two half fleets: what a task computes for its targets.

A commitment is one of the first half joined with one of the second, so 2 x 2^(N/2)
half commitments stand for all 2^N.  For a fixed first half of capacity a, the best second half
for a target T minimises  cost + P (T' - capacity)^2  with  T' = T - a.  Written out, each second half
is a line in T' (slope -2 P capacity, intercept cost + P capacity^2) on top of P T'^2, so the best
one for any T' lies on the lower envelope of these lines and is found by binary search.  One pass
over the first halves therefore solves a target; neither all commitments nor a list of
them by capacity exist anywhere.

Objectives are rounded to OBJECTIVE_DECIMALS before they are compared, and the smallest index
wins a tie, so everything near the minimum is computed again from its units, in unit order.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

OBJECTIVE_DECIMALS = 6
#: Values this close to the minimum may round to the same objective.
_NEAR = 2.0 * 10.0 ** -OBJECTIVE_DECIMALS


def _sums(values: list[float]) -> np.ndarray:
    """Sums over all subsets, indexed by bits (first value = most significant bit), added in order."""
    out = np.zeros(1)
    for v in values:
        out = (out[:, None] + np.array([0.0, v])).ravel()
    return out


def lower_envelope(capacity: np.ndarray, cost: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """(which, breaks): the lines that are lowest somewhere, by ascending capacity, and the T' between neighbours.

    ``capacity`` is strictly ascending."""
    if penalty == 0:
        return np.array([int(cost.argmin())]), np.zeros(0)
    height = cost + penalty * capacity * capacity
    x, y = capacity.tolist(), height.tolist()
    kept: list[int] = []
    for i in range(len(x)):  # lower convex hull of the points (capacity, height)
        while len(kept) > 1:
            a, b = kept[-2], kept[-1]
            if (y[b] - y[a]) * (x[i] - x[a]) < (y[i] - y[a]) * (x[b] - x[a]):
                break
            kept.pop()
        kept.append(i)
    which = np.array(kept)
    return which, np.diff(height[which]) / (2.0 * penalty * np.diff(capacity[which]))


class HalfFleets:
    """Both halves of a fleet of (name, capacity, cost) units."""

    def __init__(self, units: tuple[tuple[str, float, float], ...], penalty: float):
        self.units, self.penalty, self.n = units, penalty, len(units)
        first, second = units[:self.n // 2], units[self.n // 2:]
        self.shift = len(second)
        self.cap_a, self.cost_a = (_sums([u[i] for u in first]) for i in (1, 2))
        self.cap_b, self.cost_b = (_sums([u[i] for u in second]) for i in (1, 2))
        # of equal capacity, the cheapest counts (the first of those)
        self.a, self.b = (self._cheapest(cap, cost) for cap, cost in ((self.cap_a, self.cost_a), (self.cap_b, self.cost_b)))
        which, self.breaks = lower_envelope(self.cap_b[self.b], self.cost_b[self.b], penalty)
        self.line = self.b[which]

    @staticmethod
    def _cheapest(cap: np.ndarray, cost: np.ndarray) -> np.ndarray:
        order = np.lexsort((np.arange(len(cap)), cost, cap))
        return order[np.append(True, np.diff(cap[order]) > 0)]

    def exact(self, commitment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Capacity and cost, added up in unit order."""
        cap, cost = np.zeros(len(commitment)), np.zeros(len(commitment))
        for i, (_, c, k) in enumerate(self.units):
            on = (commitment >> (self.n - 1 - i)) & 1
            cap, cost = cap + np.where(on == 1, c, 0.0), cost + np.where(on == 1, k, 0.0)
        return cap, cost

    def cheapest_of(self, target: float, commitments: np.ndarray) -> tuple[int, float, float, float]:
        """(commitment, capacity, cost, objective) with the least (rounded objective, index)."""
        cap, cost = self.exact(commitments)
        gap = target - cap
        value = [round(v, OBJECTIVE_DECIMALS) for v in (cost + self.penalty * (gap * gap)).tolist()]
        i = min(range(len(value)), key=lambda j: (value[j], int(commitments[j])))
        return int(commitments[i]), float(cap[i]), float(cost[i]), value[i]

    def best(self, target: float) -> tuple[int, float, float, float]:
        """The best of all commitments for a target."""
        rest = target - self.cap_a[self.a]
        line = self.line[np.searchsorted(self.breaks, rest)]
        gap = rest - self.cap_b[line]
        value = self.cost_a[self.a] + self.cost_b[line] + self.penalty * (gap * gap)
        limit = value.min() + _NEAR
        found = []
        for i in np.flatnonzero(value <= limit).tolist():
            gap = rest[i] - self.cap_b[self.b]
            near = self.cost_a[self.a[i]] + self.cost_b[self.b] + self.penalty * (gap * gap) <= limit
            found.append((self.a[i] << self.shift) | self.b[near])
        return self.cheapest_of(target, np.concatenate(found))

    @lru_cache(4)
    def _by_capacity(self, k: int):
        """Both halves by capacity, with the first ``k`` of equal capacity: no k-best list needs more."""
        out = []
        for cap in (self.cap_a, self.cap_b):
            order = np.lexsort((np.arange(len(cap)), cap))
            new = np.append(True, np.diff(cap[order]) > 0)
            rank = np.arange(len(cap)) - np.maximum.accumulate(np.where(new, np.arange(len(cap)), 0))
            out.append(order[rank < k])
        return out

    def nearest(self, target: float, k: int) -> np.ndarray:
        """The ``k`` commitments whose capacity is nearest the target; ties go to the smaller index."""
        a, b = self._by_capacity(k)
        cap_b, rest = self.cap_b[b], target - self.cap_a[a]
        at = np.searchsorted(cap_b, rest)
        left, right = np.maximum(at - 1, 0), np.minimum(at, len(b) - 1)
        closest = np.minimum(np.abs(rest - cap_b[left]), np.abs(rest - cap_b[right]))
        if len(a) > k:  # the k closest first halves hold k commitments, so none farther away is needed
            near = closest <= np.partition(closest, k - 1)[k - 1] + 1e-9
            a, at = a[near], at[near]
        # 2k neighbours on either side hold the k nearest with all their ties
        spot = at[:, None] + np.arange(-2 * k, 2 * k)
        inside = (spot >= 0) & (spot < len(b))
        pairs = ((a[:, None] << self.shift) | b[np.where(inside, spot, 0)])[inside]
        cap, _ = self.exact(pairs)
        return pairs[np.lexsort((pairs, np.abs(target - cap)))[:k]]


@lru_cache(8)
def half_fleets(units: tuple[tuple[str, float, float], ...], penalty: float) -> HalfFleets:
    """The worker's halves of a fleet, built once."""
    return HalfFleets(units, penalty)
