"""Planar geometry as nested arrays, measured with higher-order functions.

A geometry is ``parts``: parts -> rings -> points. Ring 0 of a part is the
shell, the others are holes, and rings are closed. A point is one part with
one ring of one vertex.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
PARTS = T.ArrayType(T.ArrayType(RING))


def let(value: Column, fn) -> Column:
    """Bind a value for use in a lambda body, so that it is evaluated once.

    An expression named inside a lambda is otherwise evaluated for every
    element the lambda visits.
    """
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def xy(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def point_parts(x: Column, y: Column) -> Column:
    return F.array(F.array(F.array(xy(x, y))))


def ring_parts(*points: Column) -> Column:
    """One part with one ring; the caller closes the ring."""
    return F.array(F.array(F.array(*points)))


def box_parts(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    return ring_parts(xy(xmin, ymin), xy(xmax, ymin), xy(xmax, ymax), xy(xmin, ymax), xy(xmin, ymin))


def rings(parts: Column) -> Column:
    return F.flatten(parts)


def vertices(parts: Column) -> Column:
    return F.flatten(F.flatten(parts))


def ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs of one ring."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(
        F.slice(ring, F.lit(1), n),
        F.slice(ring, F.lit(2), n),
        lambda a, b: F.struct(a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")),
    )


def edges(parts: Column) -> Column:
    """Every edge of every ring."""
    return F.flatten(F.transform(rings(parts), ring_edges))


def bbox(parts: Column) -> Column:
    """Covering struct; null for a null or empty geometry."""
    def extent(pts: Column) -> Column:
        xs, ys = F.transform(pts, lambda p: p.x), F.transform(pts, lambda p: p.y)
        box = F.struct(
            F.array_min(xs).alias("xmin"),
            F.array_min(ys).alias("ymin"),
            F.array_max(xs).alias("xmax"),
            F.array_max(ys).alias("ymax"),
        )
        return F.when(F.size(pts) > 0, box)

    return let(vertices(parts), extent)


def ring_area(ring: Column) -> Column:
    """Signed shoelace area, counter-clockwise positive.

    Measured from the first vertex, so large coordinates lose no digits.
    """
    def twice(edge_list: Column) -> Column:
        def from_first(first: Column) -> Column:
            return F.aggregate(
                edge_list,
                F.lit(0.0),
                lambda acc, e: acc
                + (e.x1 - first.x1) * (e.y2 - first.y1)
                - (e.x2 - first.x1) * (e.y1 - first.y1),
            )

        return let(F.get(edge_list, F.lit(0)), from_first)

    return F.coalesce(let(ring_edges(ring), twice) / F.lit(2.0), F.when(ring.isNotNull(), F.lit(0.0)))


def area(parts: Column) -> Column:
    """Shell areas minus hole areas; ring direction does not matter."""
    def shell_less_holes(sizes: Column) -> Column:
        total = F.aggregate(sizes, F.lit(0.0), lambda acc, s: acc + s)
        return F.coalesce(F.get(sizes, F.lit(0)), F.lit(0.0)) * 2 - total

    def part_area(part: Column) -> Column:
        return let(F.transform(part, lambda r: F.abs(ring_area(r))), shell_less_holes)

    return F.aggregate(F.transform(parts, part_area), F.lit(0.0), lambda acc, s: acc + s)


def length(parts: Column) -> Column:
    return F.aggregate(
        edges(parts), F.lit(0.0), lambda acc, e: acc + F.sqrt(F.pow(e.x2 - e.x1, 2.0) + F.pow(e.y2 - e.y1, 2.0))
    )


def boxes_overlap(a: Column, b: Column) -> Column:
    """Closed boxes share at least a point."""
    return (a.xmin <= b.xmax) & (a.xmax >= b.xmin) & (a.ymin <= b.ymax) & (a.ymax >= b.ymin)


def box_has_point(box: Column, x: Column, y: Column) -> Column:
    return (box.xmin <= x) & (box.xmax >= x) & (box.ymin <= y) & (box.ymax >= y)


def edges_contain(edge_list: Column, x: Column, y: Column) -> Column:
    """Even-odd ray casting over all rings, so holes count out.

    The rule is half-open: of two polygons sharing an edge, a point on it
    falls in exactly one.
    """
    crossed = F.filter(
        edge_list,
        lambda e: ((e.y1 > y) != (e.y2 > y)) & (x < (e.x2 - e.x1) * (y - e.y1) / (e.y2 - e.y1) + e.x1),
    )
    return F.size(crossed) % 2 == 1


def edges_touch_point(edge_list: Column, x: Column, y: Column) -> Column:
    """The point lies on an edge."""
    return F.exists(
        edge_list,
        lambda e: ((e.x2 - e.x1) * (y - e.y1) == (e.y2 - e.y1) * (x - e.x1))
        & x.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2))
        & y.between(F.least(e.y1, e.y2), F.greatest(e.y1, e.y2)),
    )


def turn(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """Sign of the turn a -> b -> c."""
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def segments_cross(e: Column, f: Column) -> Column:
    """The segments cross in the inside of both."""
    t1 = turn(e.x1, e.y1, e.x2, e.y2, f.x1, f.y1) * turn(e.x1, e.y1, e.x2, e.y2, f.x2, f.y2)
    t2 = turn(f.x1, f.y1, f.x2, f.y2, e.x1, e.y1) * turn(f.x1, f.y1, f.x2, f.y2, e.x2, e.y2)
    return (t1 < 0) & (t2 < 0)


def edge_boxes_overlap(e: Column, f: Column) -> Column:
    return (
        (F.least(e.x1, e.x2) <= F.greatest(f.x1, f.x2))
        & (F.greatest(e.x1, e.x2) >= F.least(f.x1, f.x2))
        & (F.least(e.y1, e.y2) <= F.greatest(f.y1, f.y2))
        & (F.greatest(e.y1, e.y2) >= F.least(f.y1, f.y2))
    )


def segments_meet(e: Column, f: Column) -> Column:
    """The closed segments share at least a point."""
    t1 = turn(e.x1, e.y1, e.x2, e.y2, f.x1, f.y1) * turn(e.x1, e.y1, e.x2, e.y2, f.x2, f.y2)
    t2 = turn(f.x1, f.y1, f.x2, f.y2, e.x1, e.y1) * turn(f.x1, f.y1, f.x2, f.y2, e.x2, e.y2)
    return edge_boxes_overlap(e, f) & (t1 <= 0) & (t2 <= 0)


def edges_in_box(edge_list: Column, box: Column) -> Column:
    return F.filter(
        edge_list,
        lambda e: (F.least(e.x1, e.x2) <= box.xmax)
        & (F.greatest(e.x1, e.x2) >= box.xmin)
        & (F.least(e.y1, e.y2) <= box.ymax)
        & (F.greatest(e.y1, e.y2) >= box.ymin),
    )


def polygons_intersect(a_parts: Column, a_edges: Column, a_box: Column,
                       b_parts: Column, b_edges: Column, b_box: Column) -> Column:
    """Boundaries meet, or one geometry holds a part of the other.

    Only edges inside the other geometry's box are paired up.
    """
    meet = let(
        edges_in_box(b_edges, a_box),
        lambda b_near: F.exists(
            edges_in_box(a_edges, b_box), lambda e: F.exists(b_near, lambda f: segments_meet(e, f))
        ),
    )

    def corner_inside(parts: Column, other_edges: Column) -> Column:
        corners = F.transform(parts, lambda part: F.get(F.get(part, F.lit(0)), F.lit(0)))
        return F.exists(corners, lambda corner: edges_contain(other_edges, corner.x, corner.y))

    def lone(parts: Column) -> Column:
        """Parts that are points: they have no edge that could meet another."""
        shells = F.transform(parts, lambda part: F.get(part, F.lit(0)))
        return F.flatten(F.filter(shells, lambda ring: F.size(ring) == 1))

    def point_on_edge(parts: Column, other_edges: Column) -> Column:
        return F.exists(lone(parts), lambda p: edges_touch_point(other_edges, p.x, p.y))

    return (
        meet | corner_inside(a_parts, b_edges) | corner_inside(b_parts, a_edges)
        | point_on_edge(a_parts, b_edges) | point_on_edge(b_parts, a_edges) | F.arrays_overlap(lone(a_parts), lone(b_parts))
    )


def canonical_ring(ring: Column, clockwise: bool) -> Column:
    """One direction, starting at the smallest vertex, closed.

    Where the smallest vertex occurs twice, the smallest of the possible
    rotations is taken, so the result depends on the shape alone.
    """
    plain = F.transform(ring, lambda p: xy(p.x + F.lit(0.0), p.y + F.lit(0.0)))  # -0.0 becomes 0.0
    turned = (ring_area(ring) > 0) if clockwise else (ring_area(ring) < 0)

    def opened(points: Column) -> Column:
        is_closed = F.get(points, F.lit(0)) == F.get(points, F.size(points) - 1)
        return F.when(
            (F.size(points) > 1) & is_closed, F.slice(points, F.lit(1), F.size(points) - 1)
        ).otherwise(points)

    def smallest_rotation(points: Column) -> Column:
        def from_lowest(lowest: Column) -> Column:
            starts = F.filter(F.sequence(F.lit(1), F.size(points)), lambda i: F.get(points, i - 1) == lowest)
            return F.array_min(
                F.transform(
                    starts,
                    lambda i: F.concat(
                        F.slice(points, i, F.size(points) - i + 1),
                        F.slice(points, F.lit(1), i - 1),
                        F.array(lowest),
                    ),
                )
            )

        return let(F.array_min(points), from_lowest)

    directed = F.when(turned, F.reverse(plain)).otherwise(plain)
    best = let(directed, lambda points: let(opened(points), smallest_rotation))
    return F.when(F.size(ring) > 1, best).otherwise(plain)


def canonical(parts: Column) -> Column:
    """Equal shapes become equal values, whatever their vertex order.

    Shells run clockwise, holes counter-clockwise; holes and parts are sorted.
    """
    def canonical_part(part: Column) -> Column:
        shell = F.slice(part, F.lit(1), F.lit(1))
        holes = F.slice(part, F.lit(2), F.greatest(F.size(part) - 1, F.lit(0)))
        return F.concat(
            F.transform(shell, lambda r: canonical_ring(r, clockwise=True)),
            F.array_sort(F.transform(holes, lambda r: canonical_ring(r, clockwise=False))),
        )

    return F.array_sort(F.transform(parts, canonical_part))


def map_points(parts: Column, fn) -> Column:
    """Apply ``fn(x, y) -> (x, y)`` to every vertex."""
    return F.transform(
        parts, lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: xy(*fn(p.x, p.y))))
    )
