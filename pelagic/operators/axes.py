"""Grid axes: from a coordinate to the index of a node (J-07, J-10..J-12, G-13).

Both kinds answer the same questions as column expressions, without a join or a
shuffle: an :class:`Axis` of equal steps by arithmetic, a :class:`NodeAxis` of any
sorted nodes by a binary search on its literal node array.  An axis is one
dimension of a grid, so its nodes are schema-sized: a few thousand numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from pelagic.functions.nulls import _c


def _known(x: Column, value: Column) -> Column:
    """``value`` where the coordinate is a number."""
    return F.when(x.isNotNull() & ~F.isnan(x), value)


def literal_array(values: Sequence[float], of: str = "double") -> Column:
    """A constant array in one expression, however long (folded once, not parsed per row)."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{of}>") if values else F.array().cast(f"array<{of}>")


def count_up_to(rising: Column, x: Column, most: int) -> Column:
    """How many entries of a rising array of at most ``most`` are <= x: a binary search, one step per halving."""
    steps = [1 << b for b in range(max(most, 1).bit_length() - 1, -1, -1)]
    return F.aggregate(literal_array(steps, "int"), F.lit(0), lambda k, s: F.when(F.get(rising, k + s - 1) <= x, k + s).otherwise(k))


@dataclass(frozen=True)
class Axis:
    """Regular axis: value_i = origin + i * step for i in [0, n)."""

    origin: float
    step: float
    n: int

    def frac_index(self, x: str | Column) -> Column:
        return (_c(x) - F.lit(self.origin)) / F.lit(self.step)

    def nearest(self, x: str | Column) -> Column:
        """J-07: index of the nearest node, clipped to the axis; null for a null (or NaN) coordinate."""
        f = self.frac_index(x)
        i = F.floor(f + F.lit(0.5)).cast("int")
        return _known(f, F.least(F.greatest(i, F.lit(0)), F.lit(self.n - 1)))

    def floor_index(self, x: str | Column) -> Column:
        """J-10: last node at or before x in axis order (may fall outside [0, n))."""
        return F.floor(self.frac_index(x)).cast("int")

    def bracket(self, x: str | Column) -> tuple[Column, Column]:
        """J-12: the node at or before x in axis order, and how far x lies towards the next one, in [0, 1)."""
        f = self.frac_index(x)
        return F.floor(f).cast("int"), f - F.floor(f)

    def first_within(self, x: str | Column, half_width: float) -> Column:
        """J-11: first node index strictly inside (x - hw, x + hw), or null."""
        a, b = self.frac_index(_c(x) - F.lit(half_width)), self.frac_index(_c(x) + F.lit(half_width))
        lo, hi = F.least(a, b), F.greatest(a, b)
        i = F.greatest((F.floor(lo) + 1).cast("int"), F.lit(0))
        return F.when((i.cast("double") < hi) & (i < self.n), i)

    def value(self, i: str | Column) -> Column:
        return F.lit(self.origin) + _c(i).cast("double") * F.lit(self.step)

    def inside(self, i: Column) -> Column:
        return (i >= 0) & (i < self.n)

    def coordinates(self) -> list[float]:
        return [self.origin + i * self.step for i in range(self.n)]


@dataclass(frozen=True)
class NodeAxis:
    """Axis of any strictly rising or falling nodes: value_i = nodes[i].

    Ties and edges are those of :class:`Axis`: half-way between two nodes the
    higher index is the nearest; a coordinate beyond the ends is nearest to the
    end node.  Brackets do not reach beyond the ends.
    """

    nodes: tuple[float, ...]

    def __post_init__(self):
        nodes = tuple(float(v) for v in self.nodes)
        object.__setattr__(self, "nodes", nodes)
        rising = [b > a for a, b in zip(nodes, nodes[1:])]
        falling = [b < a for a, b in zip(nodes, nodes[1:])]
        if not nodes or not all(map(math.isfinite, nodes)) or not (all(rising) or all(falling)):
            raise ValueError("an axis needs finite nodes, all rising or all falling")

    @property
    def n(self) -> int:
        return len(self.nodes)

    @property
    def sign(self) -> float:
        """1 for a rising axis; a falling one is searched by negated coordinates."""
        return -1.0 if self.n > 1 and self.nodes[1] < self.nodes[0] else 1.0

    def _up(self, x: str | Column) -> Column:
        return _c(x).cast("double") * F.lit(self.sign)

    def _node(self, i: Column) -> Column:
        """Node ``i`` of the rising array, null outside."""
        return F.get(literal_array([v * self.sign for v in self.nodes]), i)

    def _count_to(self, up: Column) -> Column:
        """How many nodes lie at or before a rising coordinate: a binary search, one step per halving."""
        return count_up_to(literal_array([v * self.sign for v in self.nodes]), up, self.n)

    def nearest(self, x: str | Column) -> Column:
        """J-07: index of the nearest node, clipped to the axis; null for a null (or NaN) coordinate."""
        up = self._up(x)
        after = self._count_to(up)

        def closer(k: Column) -> Column:
            return (F.when(k == 0, F.lit(0)).when(k == self.n, F.lit(self.n - 1))
                    .when(up - self._node(k - 1) < self._node(k) - up, k - 1).otherwise(k))

        return _known(up, _once(after, closer))

    def floor_index(self, x: str | Column) -> Column:
        """J-10: last node at or before x in axis order; -1 before the first."""
        up = self._up(x)
        return _known(up, self._count_to(up) - 1)

    def bracket(self, x: str | Column) -> tuple[Column, Column]:
        """J-12: the node at or before x in axis order, and how far x lies towards the next one, in [0, 1).

        Beyond the ends the index is -1 (no cell).
        """
        up = self._up(x)
        within = (up >= F.lit(self.nodes[0] * self.sign)) & (up <= F.lit(self.nodes[-1] * self.sign))
        i = F.when(within, self._count_to(up) - 1).otherwise(F.lit(-1))

        def share(k: Column) -> Column:
            t = (up - self._node(k)) / (self._node(k + 1) - self._node(k))
            return F.coalesce(F.when(within, t), F.lit(0.0))  # the last node has no next one

        return _known(up, i), _known(up, _once(i, share))

    def first_within(self, x: str | Column, half_width: float) -> Column:
        """J-11: first node index strictly inside (x - hw, x + hw), or null."""
        up = self._up(x)
        return _known(up, _once(self._count_to(up - F.lit(half_width)),
                                lambda k: F.when((self._node(k) < up + F.lit(half_width)), k)))

    def value(self, i: str | Column) -> Column:
        return F.get(literal_array(self.nodes), _c(i).cast("int"))

    def inside(self, i: Column) -> Column:
        return (i >= 0) & (i < self.n)

    def coordinates(self) -> list[float]:
        return list(self.nodes)


def _once(c: Column, use) -> Column:
    """``use(c)`` with ``c`` evaluated once per row, however often ``use`` names it."""
    return F.transform(F.array(c), use)[0]


def axis_from(coords: dict[int, float]) -> Axis | NodeAxis:
    """The axis of the coordinates by index: regular if all steps are equal, else by its nodes.

    A regular axis may lack rows (they follow from the step); an irregular one may not.
    """
    known = sorted(coords.items())
    if not known:
        raise ValueError("an axis needs a node")
    (i0, x0), (i1, x1) = known[0], known[-1]
    step = (x1 - x0) / (i1 - i0) if i1 > i0 else 1.0
    if all(abs(x0 + (i - i0) * step - x) <= 1e-6 * abs(step) for i, x in known):
        return Axis(x0 - i0 * step, step, i1 + 1)
    if [i for i, _ in known] != list(range(len(known))):
        raise ValueError("steps differ and some nodes have no row: name the axis by NodeAxis")
    return NodeAxis(tuple(x for _, x in known))
