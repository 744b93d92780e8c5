"""Tiles of polygons: a quadtree descent that only enters tiles an edge crosses.

Shapes are given in world coordinates: the square Web Mercator world is the unit
square, x grows to the east and y to the south, so a tile of zoom z is a square of
side ``2**-z`` at a whole multiple of it.

A tile holds the pieces of edges inside it, and the heights at which its right side
changes between ground inside and outside of the shape. Every step cuts both down to the
four children. What falls to the right of a child is only noted on its right side, where
edges that follow each other cancel out; what falls to the other sides tells nothing
about a ray to the right and goes. A child without a piece of an edge is inside or
outside as a whole, as its right side says: inside it is done, outside it is dropped.
The others are cut further, down to the deepest zoom. Work follows the length of the
outlines, not the area.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotkeep.functions import geometry as G
from plotkeep.operators.tiles import MAX_LAT

# After so many steps the tiles of a shape are dealt out over the tasks, so that one large outline is no task's alone.
SPREAD_AFTER = 4
# Tiles that a task takes down together.
TILES_AT_ONCE = 512


def to_world(parts: Column) -> Column:
    """Longitude and latitude to world coordinates; an edge is straight on the map."""
    def place(lon: Column, lat: Column) -> tuple[Column, Column]:
        phi = F.radians(F.least(F.greatest(lat, F.lit(-MAX_LAT)), F.lit(MAX_LAT)))
        south = (F.lit(1.0) - F.log(F.tan(phi) + F.lit(1.0) / F.cos(phi)) / F.lit(math.pi)) / 2
        return (lon + 180.0) / 360.0, F.least(F.greatest(south, F.lit(0.0)), F.lit(1.0))

    return G.map_points(parts, place)


def _odd(of: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Places of one of each of the equal items that come an odd number of times."""
    order = np.lexsort((*keys, of))
    new = np.ones(len(order), bool)
    for key in (of, *keys):
        new[1:] &= key[order][1:] == key[order][:-1]
    new[1:] = ~new[1:]
    first = np.flatnonzero(new)
    return order[first[np.diff(np.append(first, len(order))) % 2 == 1]]


def _split(edges: np.ndarray, of: np.ndarray, bound: np.ndarray, axis: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges cut where they cross the line of their tile, their tiles, and the side of each piece: -1, 0 on the line, 1."""
    one, two = edges[:, axis], edges[:, axis + 2]
    line = bound[of]
    over = np.flatnonzero((np.minimum(one, two) < line) & (np.maximum(one, two) > line))
    cut, share = edges[over], (line[over] - one[over]) / (two[over] - one[over])
    meet = np.empty((len(over), 2))
    meet[:, axis] = line[over]
    meet[:, 1 - axis] = cut[:, 1 - axis] + share * (cut[:, 3 - axis] - cut[:, 1 - axis])
    edges = edges.copy()
    edges[over, 2:] = meet
    edges, of = np.vstack([edges, np.hstack([meet, cut[:, 2:]])]), np.concatenate([of, of[over]])
    return edges, of, np.sign((edges[:, axis] - bound[of]) + (edges[:, axis + 2] - bound[of]))


class _Tiles:
    """Tiles of several shapes, the pieces of edges in them and the changes of their right sides."""

    def __init__(self, row, zoom, x, y, edges, edge_of, turns, turn_of):
        self.row, self.zoom, self.x, self.y = row, zoom, x, y
        self.edges, self.edge_of, self.turns, self.turn_of = edges, edge_of, turns, turn_of

    def where(self, chosen: np.ndarray) -> _Tiles:
        place = np.cumsum(chosen) - 1
        e, t = chosen[self.edge_of], chosen[self.turn_of]
        return _Tiles(self.row[chosen], self.zoom[chosen], self.x[chosen], self.y[chosen], self.edges[e],
                      place[self.edge_of[e]], self.turns[t], place[self.turn_of[t]])

    def crossed(self) -> np.ndarray:
        return np.bincount(self.edge_of, minlength=len(self.row)) > 0

    def inside(self) -> np.ndarray:
        """Of tiles without edges: the ray from the middle meets the right side in the shape."""
        middle = (self.y + 0.5) * 0.5 ** self.zoom
        below = self.turn_of[self.turns < middle[self.turn_of]]
        return np.bincount(below, minlength=len(self.row)) % 2 == 1

    def left(self, bound: np.ndarray) -> _Tiles:
        edges, of, side = _split(self.edges, self.edge_of, bound, 0)
        gone = side >= 0
        return self._with(edges[~gone], of[~gone], np.concatenate([self.turns, edges[gone][:, [1, 3]].ravel()]),
                          np.concatenate([self.turn_of, np.repeat(of[gone], 2)]))

    def right(self, bound: np.ndarray) -> _Tiles:
        edges, of, side = _split(self.edges, self.edge_of, bound, 0)
        return self._with(edges[side > 0], of[side > 0], self.turns, self.turn_of)

    def upper(self, bound: np.ndarray) -> _Tiles:
        edges, of, side = _split(self.edges, self.edge_of, bound, 1)
        return self._with(edges[side < 0], of[side < 0], np.minimum(self.turns, bound[self.turn_of]), self.turn_of)

    def lower(self, bound: np.ndarray) -> _Tiles:
        edges, of, side = _split(self.edges, self.edge_of, bound, 1)
        return self._with(edges[side > 0], of[side > 0], np.maximum(self.turns, bound[self.turn_of]), self.turn_of)

    def _with(self, edges, edge_of, turns, turn_of) -> _Tiles:
        left = _odd(turn_of, turns)
        return _Tiles(self.row, self.zoom, self.x, self.y, edges, edge_of, turns[left], turn_of[left])

    def cut(self) -> _Tiles:
        """Edges of whole shapes cut down to the tiles; pieces that lie on each other cancel out."""
        flip = (self.edges[:, 0] > self.edges[:, 2]) | (
            (self.edges[:, 0] == self.edges[:, 2]) & (self.edges[:, 1] > self.edges[:, 3]))
        edges = np.where(flip[:, None], self.edges[:, [2, 3, 0, 1]], self.edges)
        own = _odd(self.edge_of, *edges.T)
        tiles, side = self._with(edges[own], self.edge_of[own], self.turns, self.turn_of), 0.5 ** self.zoom
        return tiles.left((self.x + 1) * side).right(self.x * side).upper((self.y + 1) * side).lower(self.y * side)

    def children(self) -> _Tiles:
        side = 0.5 ** (self.zoom + 1)
        mid_x, mid_y = (2 * self.x + 1) * side, (2 * self.y + 1) * side
        four = [half for column in (self.left(mid_x), self.right(mid_x)) for half in (column.upper(mid_y), column.lower(mid_y))]
        n = len(self.row)
        return _Tiles(
            np.tile(self.row, 4), np.tile(self.zoom + 1, 4), np.concatenate([2 * self.x + i for i in (0, 0, 1, 1)]),
            np.concatenate([2 * self.y + j for j in (0, 1, 0, 1)]), np.vstack([t.edges for t in four]),
            np.concatenate([t.edge_of + n * k for k, t in enumerate(four)]), np.concatenate([t.turns for t in four]),
            np.concatenate([t.turn_of + n * k for k, t in enumerate(four)]))


def _lists(values: np.ndarray, of: np.ndarray, n: int) -> pa.Array:
    order = np.argsort(of, kind="stable")
    ends = np.searchsorted(of[order], np.arange(n + 1)) * (values.size // max(len(values), 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[order].ravel(), pa.float64()))


def _flat(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(np.asarray(column.offsets)) // width
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width), np.repeat(np.arange(len(column)), sizes)


def _descend(batches, max_zoom: int, steps: int, fresh: bool):
    """Rows (id, zoom, tile_x, tile_y, whole, edges, turns) some steps further down."""
    def rows(batch, tiles, whole, names):
        n = len(tiles.row)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(tiles.row)), pa.array(tiles.zoom, pa.int32()), pa.array(tiles.x, pa.int64()),
             pa.array(tiles.y, pa.int64()), pa.array(np.full(n, whole)),
             _lists(tiles.edges, tiles.edge_of, n), _lists(tiles.turns, tiles.turn_of, n)], names)

    for whole_batch in batches:
        for at in range(0, whole_batch.num_rows, TILES_AT_ONCE):
            batch = whole_batch.slice(at, TILES_AT_ONCE)
            names = batch.schema.names
            zoom, x, y, done = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, 5))
            edges, edge_of = _flat(batch.column(5), 4)
            turns, turn_of = _flat(batch.column(6), 1)
            tiles = _Tiles(np.arange(batch.num_rows), zoom.astype(np.int64), x, y, edges, edge_of, turns.ravel(), turn_of)
            yield rows(batch, tiles.where(done), True, names)
            tiles = tiles.where(~done)
            if fresh:
                tiles = tiles.cut()
            for step in range(steps + 1):
                crossed = tiles.crossed()
                yield rows(batch, tiles.where(~crossed & tiles.inside()), True, names)
                deepest = tiles.zoom == max_zoom
                if step == steps:
                    deepest[:] = True
                yield rows(batch, tiles.where(crossed & deepest), False, names)
                tiles = tiles.where(crossed & ~deepest)
                if not len(tiles.row):
                    break
                tiles = tiles.children()


def tile_cover(df: DataFrame, id_col: str, parts: str = "parts", max_zoom: int = 13) -> DataFrame:
    """(id, zoom, tile_x, tile_y, whole) of the tiles that share ground with each shape.

    ``parts`` is in world coordinates, inside or outside by the even-odd rule over all
    rings. Tiles that lie in the shape are given once, at the coarsest zoom where they do
    (``whole``); those on its outline at ``max_zoom``. The tiles of a shape do not
    overlap. A null or empty shape, a point and a line there and back have none; a
    tile that is only touched has no shared ground. What lies outside the world is cut off.
    """
    box, n = G.bbox(F.col("_parts")), float(1 << max_zoom)

    def reach(v: Column) -> Column:
        return F.least(F.greatest(F.floor(v * n), F.lit(0)), F.lit((1 << max_zoom) - 1)).cast("long")

    # the smallest tile that holds the box: below the leading bits in which its corners agree
    apart = F.greatest(F.col("_x0").bitwiseXOR(F.col("_x1")), F.col("_y0").bitwiseXOR(F.col("_y1")))
    up = F.when(apart == 0, 0).otherwise(F.length(F.bin(apart)))
    edges = F.flatten(F.transform(G.edges(F.col("_parts")), lambda e: F.array(e.x1, e.y1, e.x2, e.y2)))
    tiles = (
        df.where(F.col(parts).isNotNull()).select(F.col(id_col), F.col(parts).alias("_parts"))
        .withColumn("_box", box).where("_box.xmax > 0 and _box.ymax > 0 and _box.xmin < 1 and _box.ymin < 1")
        .select(id_col, edges.alias("edges"), *[reach(F.col(f"_box.{c}")).alias(a) for c, a in (
            ("xmin", "_x0"), ("xmax", "_x1"), ("ymin", "_y0"), ("ymax", "_y1"))])
        .withColumn("_up", up)
        .select(
            F.col(id_col).alias("id"), (F.lit(max_zoom) - F.col("_up")).cast("int").alias("zoom"),
            F.expr("shiftright(_x0, _up)").alias("tile_x"), F.expr("shiftright(_y0, _up)").alias("tile_y"),
            F.lit(False).alias("whole"), "edges", F.array().cast("array<double>").alias("turns"))
    )
    schema = tiles.schema
    tiles = tiles.mapInArrow(lambda batches: _descend(batches, max_zoom, SPREAD_AFTER, True), schema)
    tiles = tiles.repartition("id", "zoom", "tile_x", "tile_y")
    tiles = tiles.mapInArrow(lambda batches: _descend(batches, max_zoom, max_zoom, False), schema)
    return tiles.select(F.col("id").alias(id_col), "zoom", "tile_x", "tile_y", "whole")


def cover_at(cover: DataFrame, id_col: str, zoom: int) -> DataFrame:
    """(id, tile_x, tile_y) of all tiles of one zoom that share ground, from a cover at least as deep."""
    def span(v: Column) -> Column:
        down = F.lit(zoom) - F.col("zoom")
        width = F.pow(F.lit(2.0), down).cast("long")
        return F.when(down >= 0, F.sequence(v * width, v * width + width - 1)).otherwise(
            F.array(F.floor(v * F.pow(F.lit(2.0), down)).cast("long")))

    return (
        cover.withColumn("tile_x", F.explode(span(F.col("tile_x"))))
        .withColumn("tile_y", F.explode(span(F.col("tile_y"))))
        .select(id_col, "tile_x", "tile_y").distinct()
    )
