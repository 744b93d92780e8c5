import math
import random
import struct
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotkeep.functions import geometry as G
from plotkeep.functions import projection as PR
from plotkeep.functions import sweep
from plotkeep.functions import wkb as W
from plotkeep.operators import dissolve, validity
from plotkeep.operators.cluster import hilbert_sorted, in_window, with_hilbert
from plotkeep.operators.dissolve import dissolved_area
from plotkeep.operators.validity import quality_counters, repair_geometries

SHAPES = T.StructType([T.StructField("id", T.LongType()), T.StructField("parts", G.PARTS)])
SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0), (1.0, 1.0)]
FAR = [(10.0, 0.0), (11.0, 0.0), (11.0, 1.0), (10.0, 0.0)]


def shapes(spark, *parts):
    return spark.createDataFrame([(i, p) for i, p in enumerate(parts)], SHAPES)


def measured(spark, parts, expr):
    return shapes(spark, parts).select(expr.alias("v")).first().v


def test_measures(spark):
    multi = [[SQUARE, HOLE], [FAR]]
    assert measured(spark, multi, G.area(F.col("parts"))) == 15.5
    assert measured(spark, multi, G.length(F.col("parts"))) == pytest.approx(16 + 4 + 2 + math.sqrt(2))
    assert tuple(measured(spark, multi, G.bbox(F.col("parts")))) == (0.0, 0.0, 11.0, 4.0)
    assert measured(spark, None, G.bbox(F.col("parts"))) is None
    assert measured(spark, [], G.bbox(F.col("parts"))) is None
    assert measured(spark, None, G.area(F.col("parts"))) is None
    assert measured(spark, [[list(reversed(SQUARE))]], G.area(F.col("parts"))) == 16.0


def test_area_far_from_the_origin_keeps_digits(spark):
    far = [(2.7e6 + x / 1000, 2.3e5 + y / 1000) for x, y in SQUARE]
    assert measured(spark, [[far]], G.area(F.col("parts"))) == pytest.approx(16e-6, rel=1e-4)


def test_contains_and_boundary(spark):
    edges = G.edges(F.col("parts"))
    points = {(0.5, 0.5): True, (1.5, 1.5): False, (10.8, 0.2): True, (5.0, 1.0): False, (4.0, 4.0): False, (0.0, 0.0): True}
    for (x, y), inside in points.items():
        assert measured(spark, [[SQUARE, HOLE], [FAR]], G.edges_contain(edges, F.lit(x), F.lit(y))) is inside
    for x, y, touch in [(4.0, 2.0, True), (4.0, 4.0, True), (3.9, 4.1, False), (2.0, 2.0, True)]:
        assert measured(spark, [[SQUARE, HOLE]], G.edges_touch_point(edges, F.lit(x), F.lit(y))) is touch


def test_canonical_form_ignores_vertex_order(spark):
    rnd = random.Random(3)
    variants = []
    for _ in range(12):
        def turned(ring):
            opened = ring[:-1]
            k = rnd.randrange(len(opened))
            opened = opened[k:] + opened[:k]
            if rnd.random() < 0.5:
                opened.reverse()
            return opened + [opened[0]]

        holes = [HOLE, [(3.0, 3.0), (3.5, 3.0), (3.5, 3.5), (3.0, 3.0)]]
        rnd.shuffle(holes)
        parts = [[turned(SQUARE)] + [turned(h) for h in holes], [turned(FAR)]]
        rnd.shuffle(parts)
        variants.append(parts)
    out = shapes(spark, *variants).select(G.canonical(F.col("parts")).alias("c")).distinct().collect()
    assert len(out) == 1
    other = [[SQUARE], [[(10.0, 0.0), (11.0, 0.0), (11.0, 2.0), (10.0, 0.0)]]]
    assert measured(spark, other, G.canonical(F.col("parts"))) != out[0].c


def test_canonical_ring_touching_its_lowest_vertex_twice(spark):
    # two triangles that meet in the smallest vertex
    loop = [(0.0, 0.0), (1.0, 2.0), (2.0, 1.0), (0.0, 0.0), (2.0, -1.0), (1.0, -2.0), (0.0, 0.0)]
    turned = loop[3:] + loop[1:4]
    got = shapes(spark, [[loop]], [[turned]]).select(G.canonical(F.col("parts")).alias("c")).distinct()
    assert got.count() == 1


def test_wkb_round_trip(spark):
    parts = [None, [[[(1.5, -2.5)]]], [[SQUARE, HOLE]], [[SQUARE], [FAR]], []]
    df = shapes(spark, *parts).withColumn("wkb", W.to_wkb("parts"))
    back = df.withColumn("again", W.from_wkb("wkb")).orderBy("id").collect()
    assert [r.again for r in back] == [r.parts for r in back]
    assert back[1].wkb == struct.pack("<BIdd", 1, 1, 1.5, -2.5)
    assert back[2].wkb[:9] == struct.pack("<BII", 1, 3, 2)
    assert df.select(W.to_wkb_multi("parts").alias("w")).collect()[2].w[:9] == struct.pack("<BII", 1, 6, 1)


def test_wkb_big_endian_and_unknown_type(spark):
    ring = struct.pack(">I", 4) + b"".join(struct.pack(">dd", *p) for p in FAR)
    df = spark.createDataFrame([(bytearray(struct.pack(">BII", 0, 3, 1) + ring),)], "w binary")
    assert [tuple(p) for p in df.select(W.from_wkb("w").alias("p")).first().p[0][0]] == FAR
    line = spark.createDataFrame([(bytearray(struct.pack("<BII", 1, 2, 0)),)], "w binary")
    with pytest.raises(Exception, match="unsupported WKB"):
        line.select(W.from_wkb("w")).collect()


def reference_hilbert(x, y, order):
    n, d, s = 1 << order, 0, 1 << (order - 1)
    while s:
        rx, ry = int(bool(x & s)), int(bool(y & s))
        d += s * s * ((3 * rx) ^ ry)
        if not ry:
            if rx:
                x, y = n - 1 - x, n - 1 - y
            x, y = y, x
        s >>= 1
    return d


def test_hilbert_matches_the_plain_loop_and_is_a_curve(spark):
    rnd = random.Random(7)
    cells = [(rnd.randrange(1 << 16), rnd.randrange(1 << 16)) for _ in range(300)] + [
        (x, y) for x in range(16) for y in range(16)]
    df = spark.createDataFrame([(float(x), float(y), x, y) for x, y in cells], "x double, y double, cx int, cy int")
    got = with_hilbert(df, F.col("x"), F.col("y"), frame=(0.0, 0.0, 65536.0, 65536.0)).collect()
    assert [r.hilbert for r in got] == [reference_hilbert(r.cx, r.cy, 16) for r in got]
    block = sorted((r.hilbert, r.cx, r.cy) for r in got if r.cx < 16 and r.cy < 16)[:256]
    assert [b[0] for b in block] == list(range(256))
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(block, block[1:]))


def test_hilbert_outside_the_frame_and_null(spark):
    df = spark.createDataFrame([(-999.0, 0.0), (999.0, 0.0), (None, 0.0)], "x double, y double")
    got = [r.hilbert for r in with_hilbert(df, F.col("x"), F.col("y")).collect()]
    assert got[0] is not None and got[1] is not None and got[2] is None


def test_sort_puts_missing_geometry_last_and_keeps_every_row(spark):
    boxes = spark.range(200).select(
        "id", F.when(F.col("id") % 3 != 0, F.struct(*[F.lit(v).alias(n) for n, v in (
            ("xmin", 1.0), ("ymin", 1.0), ("xmax", 1.0), ("ymax", 1.0))])).alias("bbox"))
    out = hilbert_sorted(boxes, "id", partitions=4).withColumn("p", F.spark_partition_id()).collect()
    assert sorted(r.id for r in out) == list(range(200))
    missing = [r.bbox is None for r in out]
    assert missing == sorted(missing)
    # rows at one place and rows without a place are both spread
    assert len({r.p for r in out if r.bbox is None}) > 1 or len({r.p for r in out if r.bbox}) > 1


def test_window_filter_reaches_the_scan(spark, tmp_path):
    df = shapes(spark, [[SQUARE]], [[FAR]], None).withColumn("bbox", G.bbox(F.col("parts")))
    df.write.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    found = in_window(spark.read.parquet(str(tmp_path / "t")), 9.0, 0.0, 20.0, 5.0)
    assert [r.id for r in found.collect()] == [1]
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(bbox.xmax,9.0)" in pushed and "LessThanOrEqual(bbox.ymin,5.0)" in pushed


def test_mercator_and_state_plane(spark):
    def both(fn, a, b):
        x, y = fn(F.lit(a), F.lit(b))
        return tuple(spark.range(1).select(x.alias("x"), y.alias("y")).first())

    x, y = both(PR.lonlat_to_mercator, -75.1652, 39.9526)
    assert both(PR.mercator_to_lonlat, x, y) == pytest.approx((-75.1652, 39.9526), abs=1e-9)
    assert both(PR.mercator_to_lonlat, 20037508.342789244, 0.0) == pytest.approx((180.0, 0.0), abs=1e-9)
    # the projection's origin maps to its false easting
    assert both(PR.lonlat_to_state_plane, -77.75, 39.0 + 20 / 60) == pytest.approx((600000.0 * 3937 / 1200, 0.0), abs=1e-5)
    # scale is one on a standard parallel: one second of longitude there, on GRS80
    phi = math.radians(39 + 56 / 60)
    e2 = (2 - 1 / PR.GRS80_INV_F) / PR.GRS80_INV_F
    metres = PR.GRS80_A * math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2) * math.radians(1 / 3600)
    a, b = both(PR.lonlat_to_state_plane, -75.0, 39 + 56 / 60), both(PR.lonlat_to_state_plane, -75.0 + 1 / 3600, 39 + 56 / 60)
    assert math.dist(a, b) * 1200 / 3937 == pytest.approx(metres, rel=1e-7)


# the ring's winding area counts the inner pentagon twice, the tips are what is left
STAR_TIPS = 8.2
DEFECTS = {
    "valid": ([[SQUARE]], "valid", None, 16.0),
    "with hole": ([[SQUARE, HOLE]], "valid", None, 15.0),
    "point": ([[[(1.0, 2.0)]]], "valid", None, 0.0),
    "null": (None, "null", "null", None),
    "unclosed": ([[SQUARE[:-1]]], "repaired", "unclosed", 16.0),
    "repeated and unclosed": ([[SQUARE[:2] + SQUARE[1:-1]]], "repaired", "unclosed", 16.0),
    "collapsed": ([[[(0.0, 0.0), (1.0, 1.0), (2.0, 2.0), (0.0, 0.0)]]], "unrepaired", "collapsed", 0.0),
    "collapsed hole": ([[SQUARE, [(1.0, 1.0), (2.0, 2.0), (1.0, 1.0), (1.0, 1.0)]]], "repaired", "collapsed", 16.0),
    "collapsed part": ([[SQUARE], [[(9.0, 9.0), (9.0, 9.0), (9.0, 9.0), (9.0, 9.0)]]], "repaired", "collapsed", 16.0),
    "bow-tie": ([[[(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)]]], "repaired", "self_crossing", 8.0),
    "uneven bow-tie": ([[[(0.0, 0.0), (6.0, 6.0), (6.0, 0.0), (0.0, 2.0), (0.0, 0.0)]]], "repaired", "self_crossing", 15.0),
    "bow-tie with hole": ([[[(0.0, 0.0), (4.0, 4.0), (4.0, 0.0), (0.0, 4.0), (0.0, 0.0)], HOLE]], "repaired",
                          "self_crossing", 8.0),
    "star": ([[[(0.0, 3.0), (6.0, 3.0), (1.0, 0.0), (3.0, 6.0), (5.0, 0.0), (0.0, 3.0)]]], "repaired", "self_crossing", STAR_TIPS),
}


def test_repair(spark):
    df = shapes(spark, *[d[0] for d in DEFECTS.values()])
    df = df.withColumn("bbox", G.bbox(F.col("parts"))).withColumn("before", F.col("parts"))
    out = repair_geometries(df).withColumn("area", G.area(F.col("parts"))).orderBy("id").collect()
    for row, (name, (parts, outcome, defect, area)) in zip(out, DEFECTS.items()):
        assert (row.outcome, row.defect) == (outcome, defect), name
        if area is not None:
            assert row.area == pytest.approx(area), name
        if outcome in ("valid", "unrepaired"):
            assert row.parts == row.before, name  # untouched
    shrunk = out[list(DEFECTS).index("collapsed part")]
    assert tuple(shrunk.bbox) == (0.0, 0.0, 4.0, 4.0)
    assert out[3].bbox is None


def even_odd(rings, x, y):
    edges = [e for ring in rings for e in zip(ring, ring[1:])]
    return sum((b[1] > y) != (c[1] > y) and x < (c[0] - b[0]) * (y - b[1]) / (c[1] - b[1]) + b[0] for b, c in edges) % 2 == 1


BROKEN = {
    "hole outside": ([[SQUARE, [(9.0, 1.0), (9.0, 2.0), (10.0, 2.0), (9.0, 1.0)]]], "misplaced_ring", 16.5, [1, 1]),
    "hole across the shell": ([[SQUARE, [(3.0, 1.0), (3.0, 2.0), (6.0, 2.0), (6.0, 1.0), (3.0, 1.0)]]], "self_crossing", 17.0, None),
    "hole along the shell": ([[SQUARE, [(0.0, 1.0), (0.0, 3.0), (2.0, 3.0), (2.0, 1.0), (0.0, 1.0)]]], "overlapping_edges", 12.0, [1]),
    "part in a part": ([[SQUARE], [HOLE]], "misplaced_ring", 15.0, [2]),
    "part twice": ([[SQUARE], [FAR], [FAR]], "overlapping_edges", 16.0, [1]),
    "pocket at a corner": ([[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 4.0), (1.0, 2.0), (3.0, 2.0), (2.0, 4.0), (0.0, 4.0), (0.0, 0.0)]]],
                           "self_touch", 14.0, [2]),
    "spike": ([[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (4.0, 9.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]]], "overlapping_edges", 16.0, [1]),
    "two squares at a corner": ([[[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]]],
                                "self_touch", 8.0, [1, 1]),
    "ring twice round": ([[SQUARE[:-1] * 2 + SQUARE[:1]]], "overlapping_edges", None, None),
    "crossing at vertices": ([[SQUARE, [(0.0, 2.0), (2.0, 4.0), (2.0, 6.0), (-2.0, 6.0), (0.0, 2.0)]]], "misplaced_ring", None, None),
    "island in a hole": ([[SQUARE, [(0.5, 0.5), (0.5, 3.5), (3.5, 3.5), (3.5, 0.5), (0.5, 0.5)]], [HOLE]], None, 8.0, [2, 1]),
    "hole at a corner": ([[SQUARE, [(0.0, 0.0), (1.0, 2.0), (2.0, 1.0), (0.0, 0.0)]]], None, 14.5, [2]),
    "parts at a corner": ([[SQUARE], [[(4.0, 4.0), (5.0, 4.0), (5.0, 5.0), (4.0, 4.0)]]], None, 16.5, [1, 1]),
}


@pytest.mark.parametrize("pairwise", [48, 0])
def test_linework(spark, monkeypatch, pairwise):
    monkeypatch.setattr(validity, "PAIRWISE", pairwise)
    rows = repair_geometries(shapes(spark, *[b[0] for b in BROKEN.values()])).withColumn("area", G.area(F.col("parts"))).orderBy("id")
    for row, (name, (parts, defect, area, rings)) in zip(rows.collect(), BROKEN.items()):
        empty = name == "ring twice round"
        assert row.defect == defect, name
        assert row.outcome == ("unrepaired" if empty else "repaired" if defect else "valid"), name
        if area is not None:
            assert row.area == pytest.approx(area), name
        if rings is not None:
            assert sorted(len(part) for part in row.parts) == sorted(rings), name


@pytest.mark.parametrize("pairwise", [48, 0])
def test_linework_of_random_rings(spark, monkeypatch, pairwise):
    monkeypatch.setattr(validity, "PAIRWISE", pairwise)
    rnd = random.Random(21)
    broken = []
    for _ in range(40):
        # a coarse lattice makes vertices and edges meet
        ring = [(float(rnd.randrange(7)), float(rnd.randrange(7))) for _ in range(rnd.randrange(4, 12))]
        broken.append([[ring + ring[:1]]])
    df = shapes(spark, *broken).withColumn("old", F.col("parts"))
    out = repair_geometries(df).cache()
    assert {r.outcome for r in out.collect()} <= {"valid", "repaired", "unrepaired"} and out.where("outcome = 'repaired'").count() > 25
    for row in out.collect():
        for _ in range(60):
            x, y = rnd.uniform(-0.5, 6.5), rnd.uniform(-0.5, 6.5)
            new = any(even_odd(part, x, y) for part in row.parts)
            assert new == even_odd([r for p in row.old for r in p], x, y), row.old
    again = repair_geometries(out.where("outcome = 'repaired'").select("id", "parts"))
    assert again.where("outcome <> 'valid'").count() == 0


def test_a_ring_of_many_vertices(spark):
    n = 20_000
    turns = [2 * math.pi * i / n for i in range(n)]
    ring = [(math.cos(t) * (2 + math.sin(37 * t)), math.sin(t) * (2 + math.sin(37 * t))) for t in turns]
    # the same ring with two vertices exchanged, far apart in the list of edges and near in the plane
    crossed = ring[:100] + [ring[102], ring[101], ring[100]] + ring[103:]
    start = time.perf_counter()
    rows = repair_geometries(shapes(spark, [[ring + ring[:1]]], [[crossed + crossed[:1]]])).select("defect", "outcome").collect()
    assert [tuple(r) for r in rows] == [(None, "valid"), ("self_crossing", "repaired")]
    assert time.perf_counter() - start < 60


def test_repeated_vertices_are_a_defect_only_when_strict(spark):
    ring = SQUARE[:2] + SQUARE[1:]
    df = shapes(spark, [[ring]])
    assert repair_geometries(df).first().outcome == "valid"
    strict = repair_geometries(df, strict=True).first()
    assert (strict.outcome, len(strict.parts[0][0])) == ("repaired", 5)


def test_repair_deals_the_rows_of_one_task(spark):
    df = shapes(spark, *[d[0] for d in DEFECTS.values()] * 4).coalesce(1)
    out = repair_geometries(df)
    tasks = out.select("id", "outcome", F.spark_partition_id().alias("task")).collect()
    assert len({r.task for r in tasks}) == 4
    assert [r.outcome for r in sorted(tasks)] == [d[1] for d in DEFECTS.values()] * 4


def test_quality_counters(spark):
    out = quality_counters(repair_geometries(shapes(spark, *[d[0] for d in DEFECTS.values()]))).first()
    expected = [d[1] for d in DEFECTS.values()]
    assert tuple(out) == (len(expected), *(expected.count(k) for k in ("repaired", "unrepaired", "null")))


def test_dissolve_against_fine_cells(spark):
    rnd = random.Random(11)
    polygons = []
    for _ in range(25):
        x, y, r = rnd.uniform(0, 10), rnd.uniform(0, 10), rnd.uniform(0.3, 3)
        k = rnd.randrange(3, 8)
        ring = [(x + r * math.cos(2 * math.pi * i / k), y + r * math.sin(2 * math.pi * i / k)) for i in range(k)]
        polygons.append([[ring + ring[:1]]])
    polygons[0] = [[SQUARE, HOLE]]

    def inside(parts, px, py):
        hits = 0
        for ring in parts[0]:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
                hits += (y1 > py) != (y2 > py) and px < (x2 - x1) * (py - y1) / (y2 - y1) + x1
        return hits % 2 == 1

    side = 0.02
    df = shapes(spark, *polygons).withColumn("zone", F.col("id") % 2)
    got = {r.zone: r for r in dissolved_area(df, "zone").collect()}
    for zone in (0, 1):
        own = [p for i, p in enumerate(polygons) if i % 2 == zone]
        cells = sum(any(inside(p, (cx + 0.5) * side, (cy + 0.5) * side) for p in own)
                    for cx in range(-150, 650, 5) for cy in range(-150, 650, 5))
        assert got[zone].dissolved_area == pytest.approx(cells * (5 * side) ** 2, rel=0.02)
        assert got[zone].raw_area > got[zone].dissolved_area


@pytest.mark.parametrize("strip_ends", [8192, 4])
def test_dissolve_of_large_and_copied_boxes(spark, monkeypatch, strip_ends):
    monkeypatch.setattr(dissolve, "STRIP_ENDS", strip_ends)
    boxes = [(-130.0, -2.0, 70.0, 1.0), (-64.0, 0.0, 64.0, 3.0), (63.0, -2.0, 129.0, -1.0), (63.0, -2.0, 129.0, -1.0)]
    ground = {(x, y) for x0, y0, x1, y1 in boxes for x in range(int(x0), int(x1)) for y in range(int(y0), int(y1))}
    boxes.append((10_000.0, 0.0, 14_000.0, 4_000.0))
    parts = [[[[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]] for x0, y0, x1, y1 in boxes]
    df = shapes(spark, *parts, None).withColumn("zone", F.lit(None).cast("string"))
    got = dissolved_area(df, "zone").first()
    raw = sum((x1 - x0) * (y1 - y0) for x0, y0, x1, y1 in boxes)
    assert tuple(got) == (None, 5, raw, pytest.approx(len(ground) + 4000.0**2, rel=1e-12))


def test_strips_do_not_change_the_sweep(spark, monkeypatch):
    rnd = random.Random(3)
    parts = []
    for _ in range(60):
        x, y = rnd.uniform(0, 9), rnd.uniform(0, 9)
        ring = [(x, y), (x + rnd.uniform(1, 5), y + rnd.uniform(-1, 1)), (x + rnd.uniform(-1, 3), y + rnd.uniform(1, 5))]
        parts.append([[ring + ring[:1]]])
    df = shapes(spark, *parts).withColumn("zone", F.lit(1))
    whole = dissolved_area(df, "zone").first().dissolved_area
    monkeypatch.setattr(dissolve, "STRIP_ENDS", 7)
    assert dissolved_area(df, "zone").first().dissolved_area == pytest.approx(whole, rel=1e-12)
    edges = np.array([(*a, *b) for p in parts for a, b in zip(p[0][0], p[0][0][1:])])
    assert sweep.covered_area(edges, np.repeat(np.arange(60), 3), lambda n: n > 0) == pytest.approx(whole, rel=1e-12)
    # ground covered once or more, twice or more, ... adds up to all areas
    levels = sum(sweep.covered_area(edges, np.repeat(np.arange(60), 3), lambda n, k=k: n >= k) for k in range(1, 30))
    assert levels == pytest.approx(dissolved_area(df, "zone").first().raw_area, rel=1e-9)


@pytest.mark.parametrize("at_once", [1 << 18, 5])
def test_groups_are_swept_side_by_side(monkeypatch, at_once):
    monkeypatch.setattr(sweep, "AT_ONCE", at_once)
    rnd = np.random.default_rng(5)
    corners = rnd.random((40, 3, 2)) * 4 + rnd.random((40, 1, 2)) * 8
    corners[::2] = np.round(corners[::2])  # shared heights, equal and flat edges
    edges = np.concatenate([corners, np.roll(corners, -1, 1)], 2).reshape(-1, 4)
    owner, group = np.repeat(np.arange(40), 3), np.repeat(np.arange(40) // 8 * 2, 3)  # every second group is empty
    got = sweep.covered_areas(edges, owner, group, 10, lambda n: n > 1)
    alone = [sweep.covered_area(edges[group == k], owner[group == k], lambda n: n > 1) for k in range(10)]
    assert got == pytest.approx(alone, rel=1e-12)
    # by cells: how often the triangles of a group cover a fine grid of points
    x, y = np.meshgrid(np.arange(0, 12, 0.02) + 0.00713, np.arange(0, 12, 0.02) + 0.00317)
    for k in (0, 4):
        covers = 0
        for t in range(k * 4, k * 4 + 8):
            hits = 0
            for x1, y1, x2, y2 in edges[owner == t]:
                if y1 != y2:
                    hits = hits + (((y1 > y) != (y2 > y)) & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1))
            covers = covers + hits % 2
        assert got[k] == pytest.approx(np.count_nonzero(covers > 1) * 0.02**2, abs=0.05)


def test_strips_of_one_group_are_swept_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(dissolve, "STRIP_ENDS", 16)
    parts = [[[[(i, i), (i + 1.5, i), (i + 1.5, i + 1.5), (i, i + 1.5), (i, i)]]] for i in np.arange(0.0, 200.0).tolist()]
    df = shapes(spark, *parts).withColumn("zone", F.lit("a"))
    plan = dissolved_area(df, "zone")
    assert plan.first().dissolved_area == pytest.approx(200 * 2.25 - 199 * 0.25)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_group" in text and "REPARTITION_BY_NUM" in text


def test_shared_area_of_pairs(spark):
    diamond = [[[(-3.0, 0.0), (0.0, -3.0), (3.0, 0.0), (0.0, 3.0), (-3.0, 0.0)]]]
    box = [[[(-2.0, -2.0), (2.0, -2.0), (2.0, 2.0), (-2.0, 2.0), (-2.0, -2.0)]]]
    ring = [[SQUARE, HOLE]]
    away, point = [[FAR]], [[[(1.0, 1.0)]]]
    cases = [(diamond, box, 14.0), (box, diamond, 14.0), (ring, box, 3.0), (ring, ring, 15.0), (ring, away, 0.0),
             (ring, point, 0.0), (None, box, None), (box, None, None), ([], box, 0.0), (box + away, away, 0.5)]
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("a", G.PARTS), T.StructField("b", G.PARTS)])
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], schema).repartition(2)
    got = {r.i: r.v for r in df.select("i", sweep.shared_area("a", "b").alias("v")).collect()}
    assert got == {i: pytest.approx(v, abs=1e-9) if v is not None else None for i, (_, _, v) in enumerate(cases)}
