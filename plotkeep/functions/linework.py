"""Valid polygons from broken linework: the ground that crossing rings cover by the even-odd rule.

For the few geometries that a check has found broken; one row at a time. Edges
are split where they meet. Pieces that lie there an even number of times bound
nothing and go. What is left is walked face by face, with the ground on the
left; faces inside an odd number of edges are kept, their outlines are cut where
they touch themselves, and each hole goes to the smallest shell around it.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotkeep.functions.geometry import PARTS
from plotkeep.functions.sweep import _edges_of, covered_areas

# Edges compared with all others at once.
BLOCK = 256

Node = tuple[float, float]


def _pieces(edges: np.ndarray) -> list[tuple[Node, Node]]:
    """Edges split at all contacts, each once where it lies an odd number of times."""
    x1, y1, x2, y2 = edges.T
    left, right = np.minimum(x1, x2), np.maximum(x1, x2)
    low, high = np.minimum(y1, y2), np.maximum(y1, y2)
    nodes: list[set[Node]] = [{(a, b), (c, d)} for a, b, c, d in edges.tolist()]
    ends = edges.tolist()
    for at in range(0, len(edges), BLOCK):
        near = ((left[at:at + BLOCK, None] <= right) & (right[at:at + BLOCK, None] >= left)
                & (low[at:at + BLOCK, None] <= high) & (high[at:at + BLOCK, None] >= low))
        one, other = np.nonzero(near)
        later = one + at < other
        for i, j in zip((one[later] + at).tolist(), other[later].tolist()):
            for node in _contacts(ends[i], ends[j]):
                nodes[i].add(node)
                nodes[j].add(node)
    times: dict[tuple[Node, Node], int] = defaultdict(int)
    for (a, b, c, d), held in zip(ends, nodes):
        along = sorted(held, key=lambda p: (p[0] - a) * (c - a) + (p[1] - b) * (d - b))
        for p, q in zip(along, along[1:]):
            times[min(p, q), max(p, q)] += 1
    return [piece for piece, n in times.items() if n % 2]


def _contacts(e: list[float], f: list[float]) -> list[Node]:
    """Points that two edges share: one, or the ends of what overlaps."""
    (ax, ay, bx, by), (cx, cy, dx, dy) = e, f
    ux, uy, vx, vy = bx - ax, by - ay, dx - cx, dy - cy
    def turn(px, py, qx, qy, rx, ry):
        return (qx - px) * (ry - py) - (qy - py) * (rx - px)

    def between(p, q, r):
        return min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])

    a, b, c, d = (ax, ay), (bx, by), (cx, cy), (dx, dy)
    ends = [p for p, q, r in ((a, c, d), (b, c, d), (c, a, b), (d, a, b)) if turn(*q, *r, *p) == 0 and between(q, r, p)]
    if ends:
        return ends
    across = ux * vy - uy * vx
    if across == 0:
        return []
    t = ((cx - ax) * vy - (cy - ay) * vx) / across
    s = ((cx - ax) * uy - (cy - ay) * ux) / across
    return [(ax + t * ux, ay + t * uy)] if 0 < t < 1 and 0 < s < 1 else []


def _faces(pieces: list[tuple[Node, Node]]) -> list[list[Node]]:
    """Outlines of all faces, walked with the face on the left."""
    around: dict[Node, list[Node]] = defaultdict(list)
    for p, q in pieces:
        around[p].append(q)
        around[q].append(p)
    following: dict[tuple[Node, Node], Node] = {}
    for v, others in around.items():
        others.sort(key=lambda w: math.atan2(w[1] - v[1], w[0] - v[0]))
        # coming from w, the next edge clockwise
        for k, w in enumerate(others):
            following[w, v] = others[k - 1]
    faces, seen = [], set()
    for start in list(following):
        face, step = [], start
        while step not in seen:
            seen.add(step)
            face.append(step[0])
            step = (step[1], following[step])
        if face:
            faces.append(face)
    return faces


def _size(ring: list[Node]) -> float:
    """Signed area of an open ring, counter-clockwise positive."""
    x0, y0 = ring[0]
    return sum((a[0] - x0) * (b[1] - y0) - (b[0] - x0) * (a[1] - y0) for a, b in zip(ring, ring[1:] + ring[:1])) / 2


def _crossings(edges: np.ndarray, x: float, y: float) -> int:
    """Edges that a ray to the right of a point crosses; a point on an edge is not crossed by it."""
    x1, y1, x2, y2 = edges.T
    over = (y1 > y) != (y2 > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        return int(np.count_nonzero(over & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)))


def _covers(edges: np.ndarray, face: list[Node]) -> bool:
    """The ground on the left of a face's outline is inside an odd number of edges."""
    p, q = max(zip(face, face[1:] + face[:1]), key=lambda e: abs(e[1][1] - e[0][1]))
    x, y = (p[0] + q[0]) / 2, (p[1] + q[1]) / 2
    own = np.all(edges == [*min(p, q), *max(p, q)], axis=1)
    right = _crossings(edges[~own], x, y)
    return (right + (q[1] > p[1])) % 2 == 1


def _simple(face: list[Node]) -> list[list[Node]]:
    """An outline cut into rings that visit no node twice."""
    rings, walk, place = [], [], {}
    for node in face:
        if node in place:
            at = place[node]
            rings.append(walk[at:])
            for gone in walk[at + 1:]:
                del place[gone]
            del walk[at + 1:]
        else:
            place[node] = len(walk)
            walk.append(node)
    rings.append(walk)
    return [r for r in rings if len(r) > 2]


def valid_parts(edges: np.ndarray) -> list[list[list[Node]]]:
    """Parts (shell, holes) that cover what the edges' rings cover an odd number of times."""
    pieces = _pieces(edges)
    if not pieces:
        return []
    lines = np.array([(*p, *q) for p, q in pieces])
    rings = [r for face in _faces(pieces) if _covers(lines, face) for r in _simple(face)]
    sized = sorted(((_size(r), r) for r in rings), key=lambda s: abs(s[0]))
    shells = [(r, np.array([(*p, *q) for p, q in zip(r, r[1:] + r[:1])]), [r + r[:1]]) for size, r in sized if size > 0]
    for size, hole in sized:
        if size < 0:
            # the middle of an edge: a corner may touch the shell
            x, y = (hole[0][0] + hole[1][0]) / 2, (hole[0][1] + hole[1][1]) / 2
            of = next((part for _, outline, part in shells if _crossings(outline, x, y) % 2), None)
            if of is not None:
                of.append(hole + hole[:1])
    return [part for _, _, part in shells]


REDRAWN = T.StructType([T.StructField("ground", T.DoubleType()), T.StructField("parts", PARTS)])


@F.arrow_udf(returnType=REDRAWN)
def redrawn(parts: pa.Array, broken: pa.Array, area: pa.Array, close: pa.Array) -> pa.Array:
    """The ground inside an odd number of a geometry's rings, and valid polygons that cover it.

    The polygons are null where the rings are not ``broken`` and their ``area`` is ``close`` to the ground. Null stays null.
    """
    edges, row = _edges_of(parts)
    edges = edges + 0.0  # -0.0 becomes 0.0
    at = np.searchsorted(row, np.arange(len(parts) + 1))
    known = parts.is_valid().to_numpy(False)
    grounds = covered_areas(edges, np.zeros(len(edges), np.int64), row, len(parts), lambda n: n > 0)
    # an area that is null is of a null geometry
    off = np.abs(area.to_numpy(False) - grounds) > close.to_numpy(False)
    wanted = known & (broken.to_numpy(False).astype(bool) | off)
    found = []
    for k in np.flatnonzero(wanted).tolist():
        mine = edges[at[k]:at[k + 1]]
        found.append(valid_parts(mine[(mine[:, 0] != mine[:, 2]) | (mine[:, 1] != mine[:, 3])]))
    shapes = _as_arrow(found, wanted)
    return pa.StructArray.from_arrays([pa.array(grounds, pa.float64(), mask=~known), shapes], ["ground", "parts"])


def _as_arrow(found: list[list[list[list[Node]]]], wanted: np.ndarray) -> pa.Array:
    """Geometries as nested Arrow lists, one for each row that is ``wanted``, null for the others."""
    def ends(sizes: list[int]) -> pa.Array:
        return pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())

    parts = [part for shape in found for part in shape]
    rings = [ring for part in parts for ring in part]
    xy = np.array([node for ring in rings for node in ring], np.float64).reshape(-1, 2)
    points = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(xy[:, i])) for i in range(2)], ["x", "y"])
    nested = pa.ListArray.from_arrays(ends([len(r) for r in rings]), points)
    nested = pa.ListArray.from_arrays(ends([len(p) for p in parts]), nested)
    sizes = np.zeros(len(wanted), np.int64)
    sizes[wanted] = [len(shape) for shape in found]
    return pa.ListArray.from_arrays(ends(sizes), nested, mask=pa.array(~wanted))
