"""Spatial joins as equi-joins on a multi-level grid.

Every shape lives on the level whose cells are at least as wide as its box,
so it covers at most a few cells however large it is. Candidates from one cell are cut by box, then by the exact test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotkeep.functions import geometry as G
from plotkeep.functions.sweep import shared_area
from plotkeep.operators.skew import TARGET_ROWS, split_hot_keys
from plotkeep.session import cut_lineage

LOWEST_LEVEL = -30  # for shapes without extent


def _cell_side(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def _cell(v: Column, level: Column) -> Column:
    return F.floor(v / _cell_side(level))


def _with_shape_columns(df: DataFrame, parts: str) -> DataFrame:
    """Box, edge list and grid level; rows without geometry cannot match."""
    box = F.col("_box")
    side = F.greatest(box.xmax - box.xmin, box.ymax - box.ymin)
    level = F.greatest(F.coalesce(F.ceil(F.log2(side)), F.lit(LOWEST_LEVEL)), F.lit(LOWEST_LEVEL)).cast("int")
    return (
        df.withColumn("_box", G.bbox(F.col(parts)))
        .where(box.isNotNull())
        .withColumn("_edges", G.edges(F.col(parts)))
        .withColumn("_own_level", level)
    )


def _levels(df: DataFrame) -> list[int]:
    """The levels in use: one row per power of two between the smallest and the largest shape."""
    return sorted(r["_own_level"] for r in df.select("_own_level").distinct().collect())


def _row_columns(df: DataFrame) -> list[str]:
    """Columns that tell rows apart and can be hashed."""
    return [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]


def _cells(df: DataFrame, level: Column) -> DataFrame:
    """One row per covered cell of the given level."""
    box = F.col("_box")
    return (
        df.withColumn("_level", level)
        .withColumn("_cx", F.explode(F.sequence(_cell(box.xmin, F.col("_level")), _cell(box.xmax, F.col("_level")))))
        .withColumn("_cy", F.explode(F.sequence(_cell(box.ymin, F.col("_level")), _cell(box.ymax, F.col("_level")))))
    )


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    point_id: str,
    x: str = "x",
    y: str = "y",
    parts: str = "parts",
    include_boundary: bool = False,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Every (point, polygon) pair with the point inside.

    By default points on an edge follow the half-open rule; with
    ``include_boundary`` every touched polygon matches. A point meets a
    polygon in exactly one cell, so no duplicates arise. Cells that hold very
    many points or polygons are split; whether a side is broadcast is left to
    Spark, which knows the size of whole rows.
    """
    shapes = _with_shape_columns(polygons, parts)
    levels = _levels(shapes) or [0]
    cells = _cells(shapes, F.col("_own_level")).drop(parts)
    px, py = F.col(x), F.col(y)
    placed = (
        points.where(px.isNotNull() & py.isNotNull())
        .withColumn("_level", F.explode(F.array(*[F.lit(v) for v in levels])))
        .withColumn("_cx", _cell(px, F.col("_level")))
        .withColumn("_cy", _cell(py, F.col("_level")))
    )
    placed, cells, keys = split_hot_keys(
        placed, cells, ["_level", "_cx", "_cy"], [point_id], target_rows, _row_columns(cells))
    inside = G.edges_contain(F.col("_edges"), px, py)
    if include_boundary:
        inside = inside | G.edges_touch_point(F.col("_edges"), px, py)
    return (
        placed.join(cells, keys)
        .where(G.box_has_point(F.col("_box"), px, py) & inside)
        .drop("_box", "_edges", "_own_level", *keys)
    )


def shape_key(parts: str = "parts") -> Column:
    """Equal geometries have equal keys."""
    return F.sha2(F.to_json(F.struct(F.col(parts).alias("g"))), 256)


def members(df: DataFrame, id_col: str, parts: str = "parts") -> DataFrame:
    """(shape_key, id) of every row with a geometry: which rows the shape of a pair stands for."""
    return df.where(F.col(parts).isNotNull()).select(shape_key(parts).alias("shape_key"), F.col(id_col))


def row_pairs(pairs: DataFrame, left_members: DataFrame, right_members: DataFrame, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Pairs of shapes spelled out as pairs of rows. Shapes with very many copies are split on both sides."""
    left = left_members.withColumnRenamed("shape_key", "left_key")
    right = right_members.withColumnRenamed("shape_key", "right_key")
    id_col = [c for c in left.columns if c != "left_key"]
    left, narrow, keys = split_hot_keys(left, pairs, ["left_key"], id_col, target_rows)
    half = left.join(narrow, keys).drop("_salt")
    right, half, keys = split_hot_keys(
        right, half, ["right_key"], [c for c in right.columns if c != "right_key"], target_rows)
    return right.join(half, keys).drop("_salt")


def collapse_copies(df: DataFrame, id_col: str, parts: str = "parts") -> DataFrame:
    """One row per distinct geometry: (shape_key, parts, n_rows, first_id).

    A pile of identical features is joined once instead of row by row.
    """
    return (
        df.where(F.col(parts).isNotNull())
        .groupBy(shape_key(parts).alias("shape_key"))
        .agg(
            F.any_value(parts).alias("parts"),
            F.count(F.lit(1)).alias("n_rows"),
            F.min(id_col).alias("first_id"),
        )
    )


def overlapping_shapes(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, parts: str = "parts",
    target_rows: int = TARGET_ROWS, measure: bool = False,
) -> DataFrame:
    """Pairs of distinct shapes that share at least a point.

    Columns: left/right shape key, first id and row count, and with ``measure``
    the ``shared_area`` (0 where only boundaries meet). ``row_pairs`` spells out
    the rows of a pair from the ``members`` of both sides; their number is
    ``left_rows * right_rows``. A pair is reported only in the cell holding the
    lower-left corner of the shared box, so it appears once.
    """
    def prepared(df: DataFrame, id_col: str, side: str) -> DataFrame:
        shapes = collapse_copies(df, id_col, parts)
        renamed = shapes.select(
            F.col("shape_key").alias(f"{side}_key"),
            F.col("parts").alias(f"{side}_parts"),
            F.col("n_rows").alias(f"{side}_rows"),
            F.col("first_id").alias(f"{side}_id"),
        )
        # read three times below: levels, hot cells, join
        return cut_lineage(_with_shape_columns(renamed, f"{side}_parts"), "shapes")

    a, b = prepared(left, left_id, "left"), prepared(right, right_id, "right")
    a_levels, b_levels = _levels(a), _levels(b)

    def spread_levels(df: DataFrame, other: list[int], side: str) -> DataFrame:
        """A shape also appears on the coarser levels the other side uses."""
        own = F.col("_own_level")
        coarser = F.filter(F.array(*[F.lit(v) for v in other]).cast("array<int>"), lambda v: v > own)
        level = F.explode(F.concat(F.array(own), coarser))
        out = _cells(df, level)
        for name in ("_box", "_edges", "_own_level"):
            out = out.withColumnRenamed(name, f"{side}{name}")
        return out

    a, b = spread_levels(a, b_levels, "left"), spread_levels(b, a_levels, "right")
    a, b, keys = split_hot_keys(a, b, ["_level", "_cx", "_cy"], ["left_key"], target_rows, ["right_key"])
    a_box, b_box = F.col("left_box"), F.col("right_box")
    level = F.col("_level")
    pairs = (
        a.join(b, keys)
        .where(level == F.greatest("left_own_level", "right_own_level"))
        .where(G.boxes_overlap(a_box, b_box))
        .where(_cell(F.greatest(a_box.xmin, b_box.xmin), level) == F.col("_cx"))
        .where(_cell(F.greatest(a_box.ymin, b_box.ymin), level) == F.col("_cy"))
        .where(
            G.polygons_intersect(
                F.col("left_parts"), F.col("left_edges"), a_box,
                F.col("right_parts"), F.col("right_edges"), b_box,
            )
        )
    )
    names = ["left_key", "left_id", "left_rows", "right_key", "right_id", "right_rows"]
    return pairs.select(*names, *([shared_area("left_parts", "right_parts").alias("shared_area")] if measure else []))
