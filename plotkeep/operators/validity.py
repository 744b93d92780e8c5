"""Find invalid geometries and repair them.

The checks are: unclosed ring, collapsed ring (all vertices on a line),
repeated vertex (only with ``strict``; the simple-features rules allow it),
edges that cross, overlap or touch where they must not, and rings in wrong
places (a hole outside its shell, a part inside another). Repairs close,
deduplicate, drop collapsed rings, and redraw what meets itself from its own
linework. Not found: holes that touch their shell so often that they cut it in
two. What keeps no area is counted as unrepaired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotkeep.functions import geometry as G
from plotkeep.functions import linework
from plotkeep.operators.skew import dealt
from plotkeep.session import cut_lineage


def _first(ring: Column) -> Column:
    return F.get(ring, F.lit(0))


def _last(ring: Column) -> Column:
    return F.get(ring, F.size(ring) - 1)


def _is_open(ring: Column) -> Column:
    return _first(ring) != _last(ring)


def _has_repeat(ring: Column) -> Column:
    return F.exists(G.ring_edges(ring), lambda e: (e.x1 == e.x2) & (e.y1 == e.y2))


def _is_collapsed(ring: Column) -> Column:
    """No three vertices span an area."""
    def flat(points: Column) -> Column:
        def seen_from(a: Column) -> Column:
            def along(away: Column) -> Column:
                def on_line(b: Column) -> Column:
                    return ~F.exists(
                        away, lambda p: (b.x - a.x) * (p.y - a.y) != (b.y - a.y) * (p.x - a.x)
                    )

                return G.let(_first(away), on_line)

            return G.let(F.filter(points, lambda p: p != a), along)

        return G.let(_first(points), seen_from)

    return F.coalesce(G.let(ring, flat), F.lit(True))


# What two edges of a geometry do that they must not: the smaller number counts.
CROSS, OVERLAP, TOUCH = 1, 2, 3
CONTACTS = {CROSS: "self_crossing", OVERLAP: "overlapping_edges", TOUCH: "self_touch"}
# Edges of a geometry up to which they are compared with each other in the row; those of larger ones meet in cells.
PAIRWISE = 48


def _closed(ring: Column) -> Column:
    return F.when(_is_open(ring), F.concat(ring, F.array(_first(ring)))).otherwise(ring)


def _without_repeats(ring: Column) -> Column:
    return G.let(ring, lambda r: F.filter(r, lambda p, i: (i == 0) | (p != F.get(r, i - 1))))


def _tidied(parts: Column) -> Column:
    """Rings closed and without repeated vertices."""
    return F.transform(parts, lambda part: F.transform(part, lambda ring: _without_repeats(_closed(ring))))


def _numbered_edges(parts: Column) -> Column:
    """Edges with their ring (counted over all parts), position and the ring's number of edges."""
    def of_ring(ring: Column, r: Column) -> Column:
        return G.let(G.ring_edges(ring), lambda edges: F.transform(
            edges,
            lambda e, i: F.struct(
                e.x1.alias("x1"), e.y1.alias("y1"), e.x2.alias("x2"), e.y2.alias("y2"),
                r.alias("r"), i.alias("i"), F.size(edges).alias("n"),
            ),
        ))

    return F.flatten(F.transform(G.rings(parts), of_ring))


def _contact(e: Column, f: Column) -> Column:
    """What ``e`` and the later edge ``f`` do, null if nothing is wrong.

    Rings may touch each other in points; a ring must not touch itself, and
    neighbours in a ring share one end only.
    """
    t1, t2 = G.turn(e.x1, e.y1, e.x2, e.y2, f.x1, f.y1), G.turn(e.x1, e.y1, e.x2, e.y2, f.x2, f.y2)
    u1, u2 = G.turn(f.x1, f.y1, f.x2, f.y2, e.x1, e.y1), G.turn(f.x1, f.y1, f.x2, f.y2, e.x2, e.y2)
    beyond = (
        (F.least(F.greatest(e.x1, e.x2), F.greatest(f.x1, f.x2)) > F.greatest(F.least(e.x1, e.x2), F.least(f.x1, f.x2)))
        | (F.least(F.greatest(e.y1, e.y2), F.greatest(f.y1, f.y2)) > F.greatest(F.least(e.y1, e.y2), F.least(f.y1, f.y2)))
    )
    one_line = (t1 == 0) & (t2 == 0) & (u1 == 0) & (u2 == 0)
    neighbours = (f.i - e.i == 1) | ((e.i == 0) & (f.i == f.n - 1))
    return (
        F.when((t1 * t2 < 0) & (u1 * u2 < 0), CROSS)
        .when(one_line, F.when(G.segments_meet(e, f), F.when(beyond, OVERLAP).when((e.r == f.r) & ~neighbours, TOUCH)))
        .when((e.r == f.r) & ~neighbours & G.segments_meet(e, f), TOUCH)
    )


def _later(e: Column, f: Column) -> Column:
    return (f.r > e.r) | ((f.r == e.r) & (f.i > e.i))


def _contact_in_row(edges: Column) -> Column:
    """The worst contact of a short list of edges, null if there is none."""
    def found(all_edges: Column) -> Column:
        def with_later(e: Column) -> Column:
            near = F.filter(all_edges, lambda f: _later(e, f) & G.edge_boxes_overlap(e, f))
            return F.array_min(F.transform(near, lambda f: _contact(e, f)))

        return F.array_min(F.transform(all_edges, with_later))

    return G.let(edges, found)


def contacts_by_cell(edges: DataFrame, key: list[str]) -> DataFrame:
    """(key, contact) of geometries with a wrong contact, from their edges (key, e).

    Edges are cut along a grid of their geometry's own, whose cells are as wide
    as its mean edge, or as a cell of its box if every edge had one: an edge
    lies in a few cells and a cell holds a few edges however many there are,
    unless long edges are crowded.
    """
    e = F.col("e")
    length = F.sqrt(F.pow(e.x2 - e.x1, 2.0) + F.pow(e.y2 - e.y1, 2.0))
    box = (F.max(F.greatest(e.x1, e.x2)) - F.min(F.least(e.x1, e.x2))) * (F.max(F.greatest(e.y1, e.y2)) - F.min(F.least(e.y1, e.y2)))
    spread = F.sqrt(box / F.count(F.lit(1)))
    sides = edges.groupBy(*key).agg(F.least(F.avg(length), F.when(spread > 0, spread)).alias("side"))
    side = F.col("side")
    lean = F.try_divide(e.x2 - e.x1, e.y2 - e.y1)
    low, high = F.least(e.y1, e.y2), F.greatest(e.y1, e.y2)

    def columns(row: Column) -> Column:
        """The cells of a grid row that an edge reaches, one more on each side for what rounding moves."""
        x0 = F.coalesce(e.x1 + (F.greatest(row * side, low) - e.y1) * lean, e.x1)
        x1 = F.coalesce(e.x1 + (F.least((row + 1) * side, high) - e.y1) * lean, e.x2)
        slack = (F.abs(e.x1) + F.abs(e.x2) + side) * F.lit(1e-12)
        return F.transform(
            F.sequence(F.floor((F.least(x0, x1) - slack) / side), F.floor((F.greatest(x0, x1) + slack) / side)),
            lambda column: F.struct(row.alias("row"), column.alias("column")))

    slack = (F.abs(e.y1) + F.abs(e.y2) + side) * F.lit(1e-12)
    rows = F.sequence(F.floor((low - slack) / side), F.floor((high + slack) / side))
    cells = edges.join(sides, key).select(*key, "e", F.explode(F.flatten(F.transform(rows, columns))).alias("cell"))
    cells = cut_lineage(cells, "cells")
    pairs = cells.alias("a").join(cells.withColumnRenamed("e", "f").alias("b"), [*key, "cell"])
    return (
        pairs.where(_later(F.col("e"), F.col("f")))
        .select(*key, _contact(F.col("e"), F.col("f")).alias("contact"))
        .where("contact IS NOT NULL").groupBy(*key).agg(F.min("contact").alias("contact"))
    )


def _solid(parts: Column) -> Column:
    """Without collapsed rings, and without parts whose shell is one."""
    none = F.array().cast(G.PARTS.elementType)
    kept = F.transform(parts, lambda rings: F.when(_is_collapsed(_first(rings)), none).otherwise(
        F.filter(rings, lambda ring: ~_is_collapsed(ring))))
    return F.filter(kept, lambda part: F.size(part) > 0)


def _in_ring(parts: Column, strict: bool) -> Column:
    """The first defect that a ring shows by itself."""
    def any_ring(test) -> Column:
        return F.exists(parts, lambda part: F.exists(part, test))

    found = F.when(parts.isNull(), "null").when(F.size(G.vertices(parts)) == 1, None).when(any_ring(_is_open), "unclosed")
    if strict:
        found = found.when(any_ring(_has_repeat), "repeated_vertex")
    return found.when(any_ring(_is_collapsed), "collapsed")


# What a repair adds to each row.
FLAGS = ("defect", "outcome")
_WORK = ("_tidy", "_contact", "_by_cell", "_key1", "_key2", "_found", "_area", "_close", "_drawn", "_candidate")
# Share of a geometry's box by which two sums of areas may differ.
CLOSE = 1e-9


def _tidy_of(parts: str) -> Column:
    g = F.col(parts)
    return F.when(g.isNotNull() & (F.size(G.vertices(g)) > 1), _solid(_tidied(g)))


def _with_contacts(df: DataFrame, parts: str) -> DataFrame:
    """Adds ``_tidy`` and ``_contact``: the worst contact of its edges, null if there is none."""
    edges = _numbered_edges(F.col("_tidy"))
    large = F.size(G.vertices(F.col("_tidy"))) > PAIRWISE
    key = ["_key1", "_key2"]
    # two hashes and not the geometry itself; copies are checked once
    keys = {"_key1": F.xxhash64("_tidy"), "_key2": F.hash("_tidy")}
    # tidying closes a ring by at most one vertex, so small shapes are left out before it
    g = F.col(parts)
    rows = dealt(df.where(F.size(G.vertices(g)) + F.size(G.rings(g)) > PAIRWISE).select(parts))
    once = rows.withColumn("_tidy", _tidy_of(parts)).where(large).withColumns(keys).groupBy(*key).agg(
        F.any_value("_tidy").alias("_tidy"))
    found = cut_lineage(contacts_by_cell(once.select(*key, F.explode(edges).alias("e")), key), "contacts")
    df = dealt(df).withColumn("_tidy", _tidy_of(parts)).withColumns(keys)
    # a small table where few geometries are broken, which Spark then sends to the rows
    df = df.join(found.withColumnRenamed("contact", "_by_cell"), key, "left")
    in_row = _contact_in_row(F.when(large, None).otherwise(edges))
    return df.withColumn("_contact", F.when(large, F.col("_by_cell")).otherwise(in_row)).drop("_by_cell")


def repair_geometries(df: DataFrame, parts: str = "parts", bbox: str = "bbox", strict: bool = False) -> DataFrame:
    """Repair invalid rows only; valid rows keep their bytes and their box.

    A table that has columns of these names itself is an error: they would be lost.

    Adds ``defect`` (what was found), ``outcome`` (valid, null, repaired or
    unrepaired) and recomputes ``bbox`` for repaired rows when it is present. A
    repaired geometry covers the ground inside an odd number of the old rings;
    where its area departs from that, the row stays as it was, unrepaired.
    """
    taken = sorted({*FLAGS, *_WORK} & set(df.columns))
    if taken:
        raise ValueError(f"the table already has the columns {', '.join(taken)}")
    g, tidy, contact, found = F.col(parts), F.col("_tidy"), F.col("_contact"), F.col("defect")
    checked = _with_contacts(df, parts)
    in_ring = _in_ring(g, strict)
    several = F.size(G.rings(tidy)) > 1
    box = G.bbox(tidy)
    checked = checked.withColumns({
        "_found": in_ring, "_area": G.area(tidy),
        "_close": F.coalesce(F.lit(CLOSE) * (box.xmax - box.xmin) * (box.ymax - box.ymin), F.lit(0.0))})
    # the ground is measured where a repair must keep it, and where rings may lie in wrong places
    measured = F.when(contact.isNotNull() | F.col("_found").isNotNull() | several, tidy)
    # a filter on the outcome must stay above this step: pushed below, it could not be evaluated
    redrawn = linework.redrawn.asNondeterministic()
    checked = checked.withColumn("_drawn", redrawn(measured, contact.isNotNull(), F.col("_area"), F.col("_close")))
    drawn = F.col("_drawn.parts")
    by_contact = F.when(F.lit(False), "")
    for kind, name in CONTACTS.items():
        by_contact = by_contact.when(contact == kind, name)
    misplaced = F.when(contact.isNull() & drawn.isNotNull(), "misplaced_ring")
    checked = checked.withColumn("defect", F.coalesce("_found", by_contact, misplaced))
    checked = checked.withColumn("_candidate", F.when(found.isNotNull() & (found != "null"), F.coalesce(drawn, tidy)))
    kept = F.abs(G.area(F.col("_candidate")) - F.col("_drawn.ground")) <= F.col("_close")
    checked = checked.withColumn(
        "outcome",
        F.when(found == "null", "null").when(found.isNull(), "valid")
        .when((F.size("_candidate") > 0) & kept, "repaired").otherwise("unrepaired"))
    fixed = F.col("outcome") == "repaired"
    out = checked.withColumn(parts, F.when(fixed, F.col("_candidate")).otherwise(g))
    if bbox in df.columns:
        out = out.withColumn(
            bbox,
            F.when(F.col("outcome") == "null", None).when(fixed, G.bbox(F.col(parts))).otherwise(F.col(bbox)),
        )
    return out.select(*df.columns, *FLAGS)


def quality_counters(checked: DataFrame, *by: str) -> DataFrame:
    """Rows, repaired, unrepaired and null geometries, in one pass."""
    outcome = F.col("outcome")
    return checked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(outcome == "repaired").alias("repaired_geometries"),
        F.count_if(outcome == "unrepaired").alias("unrepaired_geometries"),
        F.count_if(outcome == "null").alias("null_geometries"),
    )
