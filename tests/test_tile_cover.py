"""Tiles of polygons against the area that each tile shares with the shape."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from plotkeep.functions import geometry as G
from plotkeep.functions.sweep import covered_area
from plotkeep.operators.tile_cover import cover_at, tile_cover, to_world
from plotkeep.operators.tiles import tile_x, tile_y

SCHEMA = "id int, parts array<array<array<struct<x:double,y:double>>>>"
ZOOM = 5


def closed(points):
    points = [(float(x), float(y)) for x, y in points]
    return [*points, points[0]]


def star(rng, x, y, radius, corners):
    turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    return closed([(x + math.cos(t) * r, y + math.sin(t) * r) for t in turns for r in [radius * rng.uniform(0.2, 1)]])


def box(x0, y0, x1, y1):
    return closed([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])


def edges(rings):
    return np.array([[*a, *b] for ring in rings for a, b in zip(ring, ring[1:])], float)


def shared(rings, zoom, x, y):
    side = 2.0 ** -zoom
    shape, tile = edges(rings), edges([box(x * side, y * side, (x + 1) * side, (y + 1) * side)])
    owner = np.repeat([0, 1], [len(shape), len(tile)])
    return covered_area(np.vstack([shape, tile]), owner, lambda n: n == 2) / side ** 2


def test_cover_against_shared_area(spark):
    rng = random.Random(5)
    shapes = {i: [[star(rng, rng.uniform(0.2, 0.8), rng.uniform(0.2, 0.8), rng.uniform(0.01, 0.5), rng.randint(3, 9))]]
              for i in range(25)}
    shapes[25] = [[box(0.1, 0.1, 0.9, 0.9), box(0.3, 0.35, 0.8, 0.7)], [box(0.4, 0.4, 0.45, 0.6)]]  # an island in a hole
    shapes[26] = [[box(0, 0, 1, 1)]]
    shapes[27] = [[box(0.25, 0.5, 0.5, 0.75)]]  # exactly a tile of zoom 2
    shapes[28] = [[box(-3, -3, 0.3, 0.3)]]  # reaches out of the world
    found = {}
    for r in tile_cover(spark.createDataFrame(list(shapes.items()), SCHEMA), "id", max_zoom=ZOOM).collect():
        found.setdefault(r.id, []).append((r.zoom, r.tile_x, r.tile_y, r.whole))
    assert found[26] == [(0, 0, 0, True)] and found[27] == [(2, 1, 2, True)]
    for i, parts in shapes.items():
        rings = [ring for part in parts for ring in part]
        expected = set()
        todo = [(0, 0, 0)]
        while todo:
            zoom, x, y = todo.pop()
            part = shared(rings, zoom, x, y)
            if part > 1 - 1e-9:
                expected.add((zoom, x, y, True))
            elif part > 1e-9 and zoom == ZOOM:
                expected.add((zoom, x, y, False))
            elif part > 1e-9:
                todo += [(zoom + 1, 2 * x + a, 2 * y + b) for a in (0, 1) for b in (0, 1)]
        assert len(found[i]) == len(set(found[i])) and set(found[i]) == expected, i


def test_shapes_without_ground_have_no_tiles(spark):
    none = [(1, None), (2, []), (3, [[[(0.3, 0.3)]]]), (4, [[[(0.1, 0.1), (0.9, 0.8), (0.1, 0.1)]]]),
            (5, [[box(1.5, 0.2, 1.7, 0.4)]]), (6, [[box(0.5, 0.2, 0.5, 0.4)]])]
    assert tile_cover(spark.createDataFrame(none, SCHEMA), "id", max_zoom=6).count() == 0


def test_one_zoom_of_a_cover(spark, rows):
    shapes = spark.createDataFrame([(1, [[box(0.1, 0.1, 0.6, 0.35)]])], SCHEMA)
    cover = tile_cover(shapes, "id", max_zoom=6)
    for zoom in (0, 2, 4, 6):
        n = 1 << zoom
        expected = {(1, x, y) for x in range(int(0.1 * n), math.ceil(0.6 * n)) for y in range(int(0.1 * n), math.ceil(0.35 * n))}
        found = rows(cover_at(cover, "id", zoom))
        assert len(found) == len(expected) and set(found) == expected


def test_world_coordinates_fit_the_tiles_of_points(spark):
    points = spark.createDataFrame([(-75.16, 39.95), (0.0, 0.0), (179.9, 85.0), (-180.0, -89.0)], "lon double, lat double")
    world = to_world(G.point_parts(F.col("lon"), F.col("lat")))
    got = points.select("lon", "lat", F.flatten(F.flatten(world))[0].alias("p"), tile_x(F.col("lon"), 9).alias("x"),
                        tile_y(F.col("lat"), 9).alias("y")).collect()
    assert all((min(int(r.p.x * 512), 511), min(int(r.p.y * 512), 511)) == (r.x, r.y) for r in got)
