"""Ground covered by polygons that overlap, exactly: a sweep over horizontal slabs.

Between two heights at which an edge ends or two edges cross, the edges stand in
one order. Each edge changes whether its own polygon (even-odd over all its
rings) covers the ground to its right, so the running number of covering
polygons is known between any two neighbours, and the ground between them is a
trapezoid. The cost follows the edges that reach a slab, not the area. Slabs are
swept many at once, those of several geometries together.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The order of edges is read at this share of a slab's height from its sides. A crossing nearer to one moves no more ground
# than the square of the share; more splits than these are rounding.
AT_SIDE = 1e-7
DEEPEST = 40
# Edges of slabs, of one group or several, that are sorted together.
AT_ONCE = 1 << 14

Counts = Callable[[np.ndarray], np.ndarray]


def _cover(owner: np.ndarray, slab: np.ndarray) -> np.ndarray:
    """How many owners cover the ground after each edge; edges stand slab by slab, in their order."""
    by_owner = np.lexsort((owner, slab))
    of, at = owner[by_owner], slab[by_owner]
    first = np.flatnonzero(np.concatenate(([True], (of[1:] != of[:-1]) | (at[1:] != at[:-1]))))
    turn = np.arange(len(of)) - np.repeat(first, np.diff(np.append(first, len(of))))
    step = np.empty(len(of), np.int64)
    step[by_owner] = 1 - 2 * (turn % 2)
    total = np.cumsum(step)
    begin = np.flatnonzero(np.concatenate(([True], slab[1:] != slab[:-1])))
    return total - np.repeat((total - step)[begin], np.diff(np.append(begin, len(slab))))


def _spans(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Neighbouring items in spans of about ``AT_ONCE`` together, each at least one item."""
    if not len(sizes):
        return []
    begin = np.cumsum(sizes) - sizes
    first = np.flatnonzero(np.concatenate(([True], np.diff(begin // AT_ONCE) > 0)))
    return list(zip(first.tolist(), [*first[1:].tolist(), len(sizes)]))


def _counted_up(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each size, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _slabs(slab: np.ndarray, low: np.ndarray, high: np.ndarray, owner: np.ndarray, height: np.ndarray, wanted: Counts,
           deep: int = 0) -> np.ndarray:
    """Covered area of each slab, from the edges' places at its lower and its upper side; ``slab`` ascends."""
    # seen a little inside, edges that meet on a side of the slab stand in their order between the sides
    inset = (high - low) * AT_SIDE
    order = np.lexsort((high - inset, low + inset, slab))
    a, b = (low + inset)[order], (high - inset)[order]
    together = slab[:-1] == slab[1:]
    # neighbours that change places cross inside the slab
    over = np.flatnonzero(together & (b[:-1] > b[1:]))
    area = np.zeros(len(height))
    if len(over) and deep < DEEPEST:
        gap = a[over + 1] - a[over]
        at = AT_SIDE + (1 - 2 * AT_SIDE) * (gap / (gap + (b[over] - b[over + 1])))
        area += _split(slab, low, high, owner, height, slab[over], at, wanted, deep)
    elif len(over):  # only rounding is left to part them
        crossed = np.isin(slab, slab[over])
        order = np.where(crossed, np.lexsort((np.where(crossed, low + high, 0.0), slab)), order)
    settled = np.ones(len(height), bool)
    if deep < DEEPEST:
        settled[slab[over]] = False
    keep = settled[slab]
    order, slab = order[keep], slab[keep]
    if len(slab):
        middle = (low[order] + high[order]) / 2
        counted = wanted(_cover(owner[order], slab)[:-1]) & (slab[:-1] == slab[1:])
        area += np.bincount(slab[:-1][counted], np.diff(middle)[counted], len(height)) * height
    return area


def _split(slab: np.ndarray, low: np.ndarray, high: np.ndarray, owner: np.ndarray, height: np.ndarray, of: np.ndarray,
           at: np.ndarray, wanted: Counts, deep: int) -> np.ndarray:
    """Covered area of the slabs ``of``, cut at the shares ``at`` of their heights; 0 for the others."""
    split = np.unique(of)
    order = np.lexsort((at, of))
    of, at = of[order], at[order]
    new = np.concatenate(([True], (of[1:] != of[:-1]) | (at[1:] != at[:-1])))
    of, at = of[new], at[new]
    cut_from, cut_to = np.searchsorted(of, split), np.searchsorted(of, split, side="right")
    edge_from, edge_to = np.searchsorted(slab, split), np.searchsorted(slab, split, side="right")
    edges, pieces = edge_to - edge_from, cut_to - cut_from + 1
    area = np.zeros(len(height))
    for begin, end in _spans(edges * pieces):
        mine = slice(begin, end)
        # the sides of the pieces, slab by slab
        lower = np.zeros(pieces[mine].sum())
        upper = np.ones(len(lower))
        place = np.cumsum(pieces[mine]) - pieces[mine]
        cuts = at[cut_from[begin]:cut_to[end - 1]]
        is_first = np.zeros(len(lower), bool)
        is_first[place] = True
        lower[~is_first] = cuts
        upper[np.append(~is_first[1:], False)] = cuts
        parent = np.repeat(np.arange(begin, end), pieces[mine])
        # every edge of a slab in each of its pieces
        piece = np.repeat(np.arange(len(parent)), edges[parent])
        edge = edge_from[parent[piece]] + _counted_up(edges[parent])
        lows, wide = low[edge], (high - low)[edge]
        found = _slabs(piece, lows + wide * lower[piece], lows + wide * upper[piece], owner[edge],
                       height[split[parent]] * (upper - lower), wanted, deep + 1)
        area[split[mine]] = np.add.reduceat(found, place)
    return area


def covered_areas(edges: np.ndarray, owner: np.ndarray, group: np.ndarray, groups: int, wanted: Counts,
                  low: float = -np.inf, high: float = np.inf) -> np.ndarray:
    """Area between the heights ``low`` and ``high``, in each group of edges, where the number of covering owners is wanted.

    ``edges`` has the columns x1, y1, x2, y2 of the edges of all rings, in any direction. Slabs of all groups are swept
    side by side, about ``AT_ONCE`` edges at once.
    """
    up = edges[:, 1] < edges[:, 3]
    edges = np.where(up[:, None], edges, edges[:, [2, 3, 0, 1]])
    rising = (edges[:, 1] < edges[:, 3]) & (edges[:, 3] > low) & (edges[:, 1] < high)
    edges, owner, group = edges[rising], owner[rising], group[rising]
    if not len(edges):
        return np.zeros(groups)
    x1, y1, x2, y2 = edges.T
    nearest = np.full(groups, np.inf)
    np.minimum.at(nearest, group, x1)
    x1, x2 = x1 - nearest[group], x2 - nearest[group]  # small numbers keep more digits
    ends = np.concatenate([np.maximum(y1, low), np.minimum(y2, high)])
    of = np.concatenate([group, group])
    order = np.lexsort((ends, of))
    new = np.concatenate(([True], (ends[order][1:] != ends[order][:-1]) | (of[order][1:] != of[order][:-1])))
    number = np.empty(len(ends), np.int64)
    number[order] = np.cumsum(new) - 1
    heights, height_of = ends[order][new], of[order][new]
    lean = (x2 - x1) / (y2 - y1)
    first, last = number[:len(x1)], number[len(x1):]
    # slab k lies above height k; the highest of a group has no edges
    reach = np.cumsum(np.bincount(first, minlength=len(heights)) - np.bincount(last, minlength=len(heights)))
    by_first = np.argsort(first, kind="stable")
    reached = np.searchsorted(first[by_first], np.arange(len(heights)))
    total, held = np.zeros(len(heights)), np.empty(0, np.int64)
    for begin, end in _spans(reach):
        # edges in the order of their begin; those of earlier slabs may reach these
        held = held[last[held] > begin]
        until = reached[end] if end < len(heights) else len(by_first)
        held = np.concatenate([held, by_first[reached[begin]:until]])
        since, many = np.maximum(first[held], begin), np.minimum(last[held], end)
        many = np.maximum(many - since, 0)
        edge, slab = np.repeat(held, many), np.repeat(since, many) + _counted_up(many)
        by_slab = np.argsort(slab, kind="stable")
        edge, slab = edge[by_slab], slab[by_slab]
        if not len(edge):
            continue
        bottom, top = heights[slab], heights[slab + 1]
        # an edge is met at its own ends exactly, so that edges with a common end meet there
        at_low = np.where(y1[edge] == bottom, x1[edge], x1[edge] + (bottom - y1[edge]) * lean[edge])
        at_high = np.where(y2[edge] == top, x2[edge], x1[edge] + (top - y1[edge]) * lean[edge])
        upper = np.minimum(np.arange(begin + 1, end + 1), len(heights) - 1)
        total[begin:end] = _slabs(slab - begin, at_low, at_high, owner[edge], heights[upper] - heights[begin:end], wanted)
    return np.bincount(height_of, total, groups)


def covered_area(edges: np.ndarray, owner: np.ndarray, wanted: Counts, low: float = -np.inf, high: float = np.inf) -> float:
    """``covered_areas`` of a single group."""
    return float(covered_areas(edges, owner, np.zeros(len(edges), np.int64), 1, wanted, low, high)[0])


def _edges_of(parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Edges of all rings of an Arrow array of geometries, and the row of each."""
    rings, points = parts.values.values, parts.values.values.values
    if not len(points):  # Arrow arrays without items need not have offsets
        return np.empty((0, 4)), np.empty(0, np.int64)
    xy = np.column_stack([points.field("x").to_numpy(zero_copy_only=False), points.field("y").to_numpy(zero_copy_only=False)])
    row_ends, part_ends, ring_ends = (np.asarray(a.offsets) for a in (parts, parts.values, rings))
    low, high = ring_ends[part_ends[row_ends[0]]], ring_ends[part_ends[row_ends[-1]]]
    at = np.arange(low, max(low, high - 1))
    inside = np.isin(at + 1, ring_ends, invert=True)
    at = at[inside]
    row = np.searchsorted(ring_ends[part_ends[row_ends]], at, side="right") - 1
    return np.hstack([xy[at], xy[at + 1]]), row


@F.arrow_udf(returnType=T.DoubleType())
def shared_area(one: pa.Array, two: pa.Array) -> pa.Array:
    """Area that two geometries both cover; null where one is null."""
    (a, a_row), (b, b_row) = _edges_of(one), _edges_of(two)
    owner = np.repeat([0, 1], [len(a), len(b)])
    areas = covered_areas(np.vstack([a, b]), owner, np.concatenate([a_row, b_row]), len(one), lambda n: n == 2)
    return pa.array(areas, pa.float64(), mask=np.logical_not(one.is_valid().to_numpy(False) & two.is_valid().to_numpy(False)))
