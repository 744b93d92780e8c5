import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotkeep.functions import geometry as G
from plotkeep.operators import spatial_join
from plotkeep.operators.skew import split_hot_keys
from plotkeep.operators.spatial_join import members, overlapping_shapes, points_in_polygons, row_pairs
from plotkeep.operators.tiles import tile_counts, tile_features

SHAPES = T.StructType([T.StructField("pid", T.LongType()), T.StructField("parts", G.PARTS)])


def inside(parts, px, py):
    hits = 0
    for part in parts:
        for ring in part:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                hits += (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1
    return hits % 2 == 1


def random_polygons(rnd, n):
    out = []
    for i in range(n):
        x, y = rnd.uniform(-20, 20), rnd.uniform(-20, 20)
        w = rnd.choice([0.05, 0.6, 1.0, 3.0, 30.0])
        ring = [(x, y), (x + w, y + rnd.uniform(0, w / 4)), (x + w, y + w), (x + rnd.uniform(0, w / 2), y + w), (x, y)]
        parts = [[ring]]
        if i % 4 == 0:
            h = w / 8
            cx, cy = x + w / 2, y + w / 2
            parts[0].append([(cx, cy), (cx, cy + h), (cx + h, cy + h), (cx, cy)])
        if i % 5 == 0:
            parts.append([[(x - 8, y), (x - 7, y), (x - 7, y + 1), (x - 8, y)]])
        out.append((i, parts))
    return out


@pytest.mark.parametrize("target_rows", [1_000_000, 7])
def test_point_in_polygon_equals_brute_force(spark, target_rows):
    rnd = random.Random(1)
    polygons = random_polygons(rnd, 60)
    points = [(i, rnd.uniform(-30, 30), rnd.uniform(-30, 30)) for i in range(300)]
    points += [(i, 1.25, 1.25) for i in range(300, 450)]  # a third of the points at one place
    expected = sorted((i, p) for i, x, y in points for p, parts in polygons if inside(parts, x, y))
    got = points_in_polygons(
        spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(polygons, SHAPES), "id",
        target_rows=target_rows,
    )
    assert sorted((r.id, r.pid) for r in got.select("id", "pid").collect()) == expected


def test_boundary_points(spark):
    square = [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0)]]]
    right = [[[(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0), (1.0, 0.0)]]]
    polygons = spark.createDataFrame([(1, square), (2, right)], SHAPES)
    points = spark.createDataFrame([(1, 1.0, 0.5), (2, 2.0, 0.5), (3, None, 0.5)], "id long, x double, y double")
    pairs = lambda **kw: sorted(
        (r.id, r.pid) for r in points_in_polygons(points, polygons, "id", **kw).collect())
    assert pairs() == [(1, 2)]
    assert pairs(include_boundary=True) == [(1, 1), (1, 2), (2, 2)]


def test_no_polygons(spark):
    points = spark.createDataFrame([(1, 1.0, 0.5)], "id long, x double, y double")
    assert points_in_polygons(points, spark.createDataFrame([(1, None)], SHAPES), "id").collect() == []


def segments(parts):
    return [(a, b) for part in parts for ring in part for a, b in zip(ring, ring[1:])]


def meets(e, f):
    def turn(a, b, c):
        v = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        return (v > 0) - (v < 0)

    (a, b), (c, d) = e, f
    if max(a[0], b[0]) < min(c[0], d[0]) or max(c[0], d[0]) < min(a[0], b[0]):
        return False
    if max(a[1], b[1]) < min(c[1], d[1]) or max(c[1], d[1]) < min(a[1], b[1]):
        return False
    return turn(a, b, c) * turn(a, b, d) <= 0 and turn(c, d, a) * turn(c, d, b) <= 0


def intersects(p, q):
    if any(meets(e, f) for e in segments(p) for f in segments(q)):
        return True
    return any(inside(q, *part[0][0]) for part in p) or any(inside(p, *part[0][0]) for part in q)


@pytest.mark.parametrize("target_rows", [1_000_000, 5])
def test_overlap_equals_brute_force(spark, target_rows):
    rnd = random.Random(2)
    left, right = random_polygons(rnd, 50), random_polygons(rnd, 40)
    left += [(100 + i, left[3][1]) for i in range(30)]  # a pile of copies
    frame = lambda data: spark.createDataFrame(data, SHAPES)
    got = overlapping_shapes(
        frame(left), frame(right), "pid", "pid", target_rows=target_rows).collect()
    expected = {
        (i, j) for i, p in left[:50] for j, q in right if intersects(p, q)
    }
    assert {(r.left_id, r.right_id) for r in got} == expected
    assert len(got) == len(expected)
    assert {r.left_rows for r in got if r.left_id == 3} <= {31}
    assert sum(r.left_rows * r.right_rows for r in got) == sum(
        1 for _, p in left for _, q in right if intersects(p, q))


def test_split_hot_keys_keeps_every_pair_once(spark, rows):
    left = spark.range(1000).select("id", F.when(F.col("id") < 600, 0).otherwise(F.col("id") % 5).alias("k"))
    right = spark.range(20).select((F.col("id") % 6).alias("k"), F.col("id").alias("r"))
    a, b, keys = split_hot_keys(left, right, ["k"], ["id"], target_rows=50)
    assert rows(a.join(b, keys).select("id", "r")) == rows(left.join(right, "k").select("id", "r"))
    largest = a.groupBy(*keys).count().agg(F.max("count")).first()[0]
    assert largest < 120
    again = split_hot_keys(left.repartition(3), right, ["k"], ["id"], target_rows=50)[0]
    assert rows(a.select("id", "_salt")) == rows(again.select("id", "_salt"))


def test_tiles_against_brute_force(spark):
    import hashlib
    import math

    rnd = random.Random(4)
    boxes = []
    for i in range(400):
        x, y = (10.0, 10.0) if i % 3 == 0 else (rnd.uniform(-180, 180), rnd.uniform(-80, 80))
        w = rnd.choice([0.0, 0.0, 5.0, 40.0])
        boxes.append((i, (x, y, min(x + w, 180.0), min(y + w, 85.0))))
    df = spark.createDataFrame(boxes + [(999, None)], "id long, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>")

    def tile(lon, lat, z):
        n = 1 << z
        phi = math.radians(lat)
        ty = (1 - math.log(math.tan(phi) + 1 / math.cos(phi)) / math.pi) / 2 * n
        return min(int((lon + 180) / 360 * n), n - 1), min(int(ty), n - 1)

    expected = {}
    for i, (x0, y0, x1, y1) in boxes:
        for z in range(1, 4):
            (a, d), (b, c) = tile(x0, y0, z), tile(x1, y1, z)
            for tx in range(a, b + 1):
                for ty in range(c, d + 1):
                    expected.setdefault((z, tx, ty), []).append(i)
    counts = {(r.zoom, r.tile_x, r.tile_y): (r.features, r.kept, r.dropped)
              for r in tile_counts(df, min_zoom=1, max_zoom=3, limit=30).collect()}
    assert counts == {k: (len(v), min(len(v), 30), max(len(v) - 30, 0)) for k, v in expected.items()}

    rank = lambda i: (int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16), i)
    kept = {}
    for r in tile_features(df, "id", min_zoom=1, max_zoom=3, limit=30).where("kept").collect():
        kept.setdefault((r.zoom, r.tile_x, r.tile_y), []).append(r.id)
    assert {k: sorted(v) for k, v in kept.items()} == {
        k: sorted(sorted(v, key=rank)[:30]) for k, v in expected.items()}


def test_points_that_touch(spark):
    square = [[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]]]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("parts", G.PARTS)])
    left = spark.createDataFrame([(1, square), (2, [[[(9.0, 9.0)]]]), (3, [[[(9.0, 9.0)]]])], schema)
    right = spark.createDataFrame(
        [(10, [[[(4.0, 2.0)]]]), (11, [[[(9.0, 9.0)]]]), (12, [[[(4.5, 2.0)]]]), (13, [[[(1.0, 1.0)]]])], schema)
    pairs = overlapping_shapes(left, right, "id", "id", measure=True)
    assert {(r.left_id, r.right_id, r.shared_area) for r in pairs.collect()} == {(1, 10, 0.0), (1, 13, 0.0), (2, 11, 0.0)}
    rows = row_pairs(pairs.select("left_key", "right_key"), members(left, "id").withColumnRenamed("id", "l"),
                     members(right, "id").withColumnRenamed("id", "r"))
    assert {(r.l, r.r) for r in rows.collect()} == {(1, 10), (1, 13), (2, 11), (3, 11)}


def test_districts_of_one_shape_are_met_once(spark, tmp_path, monkeypatch):
    from plotkeep.plans import spatial_queries

    # keys 1500 apart have one district
    keys = [k + 1500 * i for k in (0, 1, 2, 100) for i in range(5)] + [0, None]
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    events = [(i, float(i % 60) / 2, i % 45) for i in range(2000)] + [(7, None, 1)]
    spark.createDataFrame(events, "event_id long, value double, user_id long").write.parquet(f"{tmp_path}/events.parquet")
    alone = spatial_join.points_in_polygons(
        spatial_queries.event_points(spark, str(tmp_path)), spatial_queries.customer_districts(spark, str(tmp_path)), "event_id")
    expected = {r.c_custkey: (r.n, r.s) for r in alone.groupBy("c_custkey").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("s")).collect()}
    met, join = [], spatial_join.points_in_polygons

    def counted(points, polygons, *args):
        met.append(polygons.count())
        return join(points, polygons, *args)

    monkeypatch.setattr(spatial_join, "points_in_polygons", counted)
    got = spatial_queries.spatial_pip(spark, str(tmp_path)).collect()
    assert {r.c_custkey: (r.points, r.id_sum) for r in got} == expected and len(got) == len(expected) >= 10
    assert met[0] <= 5
