"""Queries over geometry derived from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotkeep.functions import geometry as G
from plotkeep.functions import projection as PR
from plotkeep.functions import wkb as W
from plotkeep.operators import cluster, dissolve, spatial_join, tiles, validity
from plotkeep.operators import tile_cover as cover
from plotkeep.operators.skew import dealt
from plotkeep.plans.registry import query, table
from plotkeep.session import cut_lineage, scratch_path


def event_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "value", "user_id").select(
        "event_id", F.col("value").alias("x"), (F.col("user_id") % 100).cast("double").alias("y")
    )


def _closed_box(x: Column, y: Column, s: Column, reverse: bool = False) -> Column:
    points = [G.xy(x, y), G.xy(x + s, y), G.xy(x + s, y + s), G.xy(x, y + s), G.xy(x, y)]
    return F.array(*(reversed(points) if reverse else points))


# one district per customer: squares, triangles and squares with a hole, a few of them large;
# the offsets keep every point off the edges
_X0, _Y0 = "(c_custkey * 7) % 500 + 0.005", "(c_custkey * 13) % 100 + 0.0025"
_SIDE = "CASE WHEN c_custkey % 100 = 0 THEN 40.0 ELSE 1.0 + c_custkey % 4 END"


def customer_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # districts are made, read and hashed row by row, and a small file would be read by few tasks
    base = dealt(table(spark, sf_dir, "customer").select("c_custkey")).selectExpr(
        "c_custkey", f"cast({_X0} AS DOUBLE) AS x0", f"cast({_Y0} AS DOUBLE) AS y0", f"cast({_SIDE} AS DOUBLE) AS s"
    )
    x, y, s = F.col("x0"), F.col("y0"), F.col("s")
    square = _closed_box(x, y, s)
    triangle = F.array(G.xy(x, y), G.xy(x + s, y), G.xy(x, y + s), G.xy(x, y))
    hole = _closed_box(x + s / 4, y + s / 4, s / 2, reverse=True)
    parts = (
        F.when(F.col("c_custkey") % 3 == 0, F.array(F.array(square)))
        .when(F.col("c_custkey") % 3 == 1, F.array(F.array(triangle)))
        .otherwise(F.array(F.array(square, hole)))
    )
    return base.select("c_custkey", parts.alias("parts"))


@query(
    "spatial_pip",
    f"""
    WITH d AS (SELECT c_custkey, cast({_X0} AS DOUBLE) AS x0, cast({_Y0} AS DOUBLE) AS y0,
                      cast({_SIDE} AS DOUBLE) AS s FROM customer),
         p AS (SELECT event_id, value AS x, cast(user_id % 100 AS DOUBLE) AS y FROM events)
    SELECT c_custkey, count(*) AS points, cast(sum(event_id) AS BIGINT) AS id_sum
    FROM d JOIN p ON x > x0 AND x < x0 + s AND y > y0 AND y < y0 + s
    WHERE CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN (x - x0) + (y - y0) < s
               ELSE NOT (x > x0 + s / 4 AND x < x0 + 3 * s / 4 AND y > y0 + s / 4 AND y < y0 + 3 * s / 4) END
    GROUP BY c_custkey
    """,
)
def spatial_pip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per district they fall in; districts of one shape are met once, and each row of theirs has its totals."""
    districts = customer_districts(spark, sf_dir)
    # read several times by the join: levels, hot cells, rows
    shapes = cut_lineage(spatial_join.collapse_copies(districts, "c_custkey").select("shape_key", "parts"), "districts")
    pairs = spatial_join.points_in_polygons(event_points(spark, sf_dir), shapes, "event_id")
    totals = pairs.groupBy("shape_key").agg(F.count(F.lit(1)).alias("points"), F.sum("event_id").alias("id_sum"))
    rows = spatial_join.members(districts, "c_custkey").join(totals, "shape_key")
    return rows.groupBy("c_custkey").agg(F.sum("points").alias("points"), F.sum("id_sum").alias("id_sum"))


@query(
    "spatial_overlap",
    """
    WITH d AS (SELECT min(s_suppkey) AS left_id, count(*) AS left_rows, cast(k % 50 AS DOUBLE) AS cx,
                      cast(k // 50 * 3 AS DOUBLE) AS cy, 1.003 + (k % 5) * 0.5 AS r
               FROM (SELECT s_suppkey, s_suppkey % 900 AS k FROM supplier) GROUP BY k),
         b AS (SELECT p_partkey, cast(p_partkey % 50 AS DOUBLE) AS px, cast(p_partkey // 50 AS DOUBLE) AS py,
                      0.25 + p_size / 100 AS h FROM part)
    SELECT left_id, left_rows, p_partkey AS right_id, cast(1 AS BIGINT) AS right_rows
    FROM d JOIN b ON px - h <= cx + r AND px + h >= cx - r AND py - h <= cy + r AND py + h >= cy - r
    WHERE greatest(abs(cx - px) - h, 0) + greatest(abs(cy - py) - h, 0) <= r
    """,
)
def spatial_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diamonds around suppliers, some of them copies, against squares around parts."""
    k = F.col("s_suppkey") % 900
    cx, cy = (k % 50).cast("double"), (F.floor(k / 50) * 3).cast("double")
    r = F.lit(1.003) + (k % 5) * F.lit(0.5)
    diamond = G.ring_parts(G.xy(cx - r, cy), G.xy(cx, cy - r), G.xy(cx + r, cy), G.xy(cx, cy + r), G.xy(cx - r, cy))
    left = table(spark, sf_dir, "supplier").select("s_suppkey", diamond.alias("parts"))
    px, py = (F.col("p_partkey") % 50).cast("double"), F.floor(F.col("p_partkey") / 50).cast("double")
    h = F.lit(0.25) + F.col("p_size") / F.lit(100.0)
    right = table(spark, sf_dir, "part").select("p_partkey", G.box_parts(px - h, py - h, px + h, py + h).alias("parts"))
    pairs = spatial_join.overlapping_shapes(left, right, "s_suppkey", "p_partkey")
    return pairs.select("left_id", "left_rows", "right_id", "right_rows")


@query(
    "overlay_area",
    """
    WITH a AS (SELECT s_suppkey, s_suppkey % 400 AS k, s_suppkey % 3 AS kind, 2.03125 + s_suppkey % 5 / 4 AS r FROM supplier),
         b AS (SELECT p_partkey, p_partkey % 400 AS k, 0.75 + p_size / 16 AS h FROM part),
         p AS (SELECT s_suppkey, p_partkey, kind, r, h FROM a JOIN b USING (k))
    SELECT s_suppkey, p_partkey, round(CASE kind
             WHEN 0 THEN CASE WHEN r <= h THEN 2 * r * r WHEN r >= 2 * h THEN 4 * h * h
                         ELSE 4 * h * h - 2 * (2 * h - r) * (2 * h - r) END
             WHEN 1 THEN 4 * least(h, r) * least(h, r)
             ELSE 4 * least(h, r) * least(h, r) - r * r END, 6) AS shared_area
    FROM p WHERE kind < 2 OR h > r / 2
    """,
)
def overlay_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground that diamonds, squares and squares with a hole share with squares around the same centre, per pair of rows."""
    def centre(key: Column) -> tuple[Column, Column]:
        k = key % 400
        return (k % 20) * F.lit(16.0), F.floor(k / 20) * F.lit(16.0)

    x, y = centre(F.col("s_suppkey"))
    r, kind = F.lit(2.03125) + F.col("s_suppkey") % 5 / 4, F.col("s_suppkey") % 3
    diamond = F.array(G.xy(x - r, y), G.xy(x, y - r), G.xy(x + r, y), G.xy(x, y + r), G.xy(x - r, y))
    square, hole = _closed_box(x - r, y - r, 2 * r), _closed_box(x - r / 2, y - r / 2, r, reverse=True)
    shape = F.when(kind == 0, F.array(F.array(diamond))).when(kind == 1, F.array(F.array(square))).otherwise(
        F.array(F.array(square, hole)))
    left = table(spark, sf_dir, "supplier").select("s_suppkey", shape.alias("parts"))
    x, y = centre(F.col("p_partkey"))
    h = F.lit(0.75) + F.col("p_size") / 16
    right = table(spark, sf_dir, "part").select("p_partkey", G.box_parts(x - h, y - h, x + h, y + h).alias("parts"))
    pairs = spatial_join.overlapping_shapes(left, right, "s_suppkey", "p_partkey", measure=True)
    rows = spatial_join.row_pairs(
        pairs.select("left_key", "right_key", "shared_area"),
        spatial_join.members(left, "s_suppkey"), spatial_join.members(right, "p_partkey"))
    return rows.select("s_suppkey", "p_partkey", F.round("shared_area", 6).alias("shared_area"))


# part lots in degrees, around the projection's centre
_LON, _LAT = "-75.3 + (p_partkey % 50) * 0.008", "39.85 + (p_partkey // 50 % 40) * 0.008"
_DEG = "0.001 + p_size * 0.0001"
_LON_S = _LON
_LAT_S = "39.85 + (floor(p_partkey / 50) % 40) * 0.008"


def part_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "part").select("p_partkey", "p_size").selectExpr(
        "p_partkey", f"cast({_LON_S} AS DOUBLE) AS lon", f"cast({_LAT_S} AS DOUBLE) AS lat", f"cast({_DEG} AS DOUBLE) AS d"
    )
    lon, lat, d = F.col("lon"), F.col("lat"), F.col("d")
    return base.select("p_partkey", G.box_parts(lon, lat, lon + d, lat + d).alias("parts"))


def _sql_plane(lon: str, lat: str) -> tuple[str, str]:
    phi, e = f"radians({lat})", PR._E
    t = f"(tan(pi() / 4 - {phi} / 2) / pow((1 - {e!r} * sin({phi})) / (1 + {e!r} * sin({phi})), {e / 2!r}))"
    rho = f"({PR.GRS80_A * PR.CONE_F!r} * pow({t}, {PR.CONE_N!r}))"
    theta = f"({PR.CONE_N!r} * (radians({lon}) - ({PR.LAMBDA_0!r})))"
    return (
        f"(({PR.FALSE_EASTING_M!r} + {rho} * sin({theta})) / {PR.US_FOOT_M!r})",
        f"(({PR.CONE_RHO_0!r} - {rho} * cos({theta})) / {PR.US_FOOT_M!r})",
    )


_CORNERS = [_sql_plane("lon", "lat"), _sql_plane("lon + d", "lat"), _sql_plane("lon + d", "lat + d"),
            _sql_plane("lon", "lat + d")]


@query(
    "polygon_area",
    f"""
    WITH b AS (SELECT p_partkey, cast({_LON} AS DOUBLE) AS lon, cast({_LAT} AS DOUBLE) AS lat,
                      cast({_DEG} AS DOUBLE) AS d FROM part),
         c AS (SELECT p_partkey, lon, lat, d, {", ".join(f"{x} AS x{i}, {y} AS y{i}" for i, (x, y) in enumerate(_CORNERS))}
               FROM b)
    SELECT p_partkey, round(d * d, 10) AS degree_area,
           round(abs((x1 - x0) * (y2 - y0) - (x2 - x0) * (y1 - y0) + (x2 - x0) * (y3 - y0) - (x3 - x0) * (y2 - y0)) / 2, 1)
             AS area_sqft,
           round(sqrt(pow(x1 - x0, 2) + pow(y1 - y0, 2)) + sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2))
               + sqrt(pow(x3 - x2, 2) + pow(y3 - y2, 2)) + sqrt(pow(x0 - x3, 2) + pow(y0 - y3, 2)), 3) AS length_ft,
           round(lon + d, 9) AS xmax, round(lat, 9) AS ymin
    FROM c
    """,
)
def polygon_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas in square degrees say nothing; the measured columns are in survey feet."""
    parts = F.col("parts")
    box = G.bbox(parts)
    return part_lots(spark, sf_dir).select(
        "p_partkey",
        F.round(G.area(parts), 10).alias("degree_area"),
        F.round(PR.measured_area(parts), 1).alias("area_sqft"),
        F.round(PR.measured_length(parts), 3).alias("length_ft"),
        F.round(box.xmax, 9).alias("xmax"),
        F.round(box.ymin, 9).alias("ymin"),
    )


@query(
    "bbox_window",
    f"""
    WITH b AS (SELECT p_partkey, cast({_LON} AS DOUBLE) AS lon, cast({_LAT} AS DOUBLE) AS lat,
                      cast({_DEG} AS DOUBLE) AS d FROM part)
    SELECT p_partkey FROM b
    WHERE p_partkey % 10 <> 0 AND lon + d >= -75.2 AND lon <= -75.1 AND lat + d >= 39.9 AND lat <= 40.0
    """,
)
def bbox_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the lots along the curve, then read a window of them; a tenth has no geometry."""
    lots = part_lots(spark, sf_dir)
    parts = F.when(F.col("p_partkey") % 10 != 0, F.col("parts"))
    boxed = lots.withColumn("parts", parts).withColumn("bbox", G.bbox(F.col("parts")))
    path = scratch_path(spark, "lots")
    cluster.hilbert_sorted(boxed, "p_partkey").write.option("compression", "zstd").parquet(path)
    return cluster.in_window(spark.read.parquet(path), -75.2, 39.9, -75.1, 40.0).select("p_partkey")


@query(
    "mercator_roundtrip",
    """
    WITH p AS (SELECT event_id, value / 500 * 360 - 180 AS lon, (user_id % 100) * 1.6 - 80.1 AS lat FROM events)
    SELECT event_id, round(radians(lon) * 6378137, 2) AS mx,
           round(ln(tan(pi() / 4 + radians(lat) / 2)) * 6378137, 2) AS my,
           round(lon, 6) + 0.0 AS lon, cast(round(lat, 6) AS DOUBLE) + 0.0 AS lat
    FROM p
    """,
)
def mercator_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lon = F.col("value") / 500 * 360 - 180
    lat = (F.col("user_id") % 100) * F.lit(1.6) - F.lit(80.1)
    points = table(spark, sf_dir, "events").select("event_id", G.point_parts(lon, lat).alias("parts"))
    mercator = G.map_points(F.col("parts"), PR.lonlat_to_mercator)
    both = points.select("event_id", mercator.alias("m")).withColumn("back", G.map_points(F.col("m"), PR.mercator_to_lonlat))
    m, back = F.col("m")[0][0][0], F.col("back")[0][0][0]
    return both.select(
        "event_id", F.round(m.x, 2).alias("mx"), F.round(m.y, 2).alias("my"),
        (F.round(back.x, 6) + 0.0).alias("lon"), (F.round(back.y, 6) + 0.0).alias("lat"),
    )


def _ring_text(ring: Column) -> Column:
    return F.array_join(
        F.transform(ring, lambda p: F.concat(p.x.cast("int").cast("string"), F.lit(" "), p.y.cast("int").cast("string"))),
        ",",
    )


@query(
    "canonical_geometry_hash",
    """
    WITH b AS (SELECT p_partkey, p_partkey % 50 * 10 AS x, p_partkey // 50 * 10 AS y, 4 + p_size AS s FROM part)
    SELECT p_partkey,
           x || ' ' || y || ',' || x || ' ' || (y + s) || ',' || (x + s) || ' ' || (y + s) || ',' || (x + s) || ' ' || y
             || ',' || x || ' ' || y AS shell,
           (x + 1) || ' ' || (y + 1) || ',' || (x + 2) || ' ' || (y + 1) || ',' || (x + 2) || ' ' || (y + 2) || ','
             || (x + 1) || ' ' || (y + 2) || ',' || (x + 1) || ' ' || (y + 1) AS first_hole,
           true AS same_hash
    FROM b
    """,
)
def canonical_geometry_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings are turned, reversed and their holes swapped by key; the canonical form undoes all of it."""
    base = table(spark, sf_dir, "part").select("p_partkey", "p_size").selectExpr(
        "p_partkey", "cast(p_partkey % 50 * 10 AS DOUBLE) AS x", "floor(p_partkey / 50) * 10.0D AS y",
        "cast(4 + p_size AS DOUBLE) AS s",
    )
    x, y, s = F.col("x"), F.col("y"), F.col("s")
    shell = _closed_box(x, y, s)
    first, second = _closed_box(x + 1, y + 1, F.lit(1.0)), _closed_box(x + 3, y + 1, F.lit(0.5))
    turn = (F.col("p_partkey") % 4).cast("int")
    opened = F.slice(shell, 1, 4)
    turned = F.concat(F.slice(opened, turn + 1, 4 - turn), F.slice(opened, F.lit(1), turn))
    turned = F.concat(turned, F.slice(turned, 1, 1))
    turned = F.when(F.col("p_partkey") % 3 == 0, F.reverse(turned)).otherwise(turned)
    holes = F.when(F.col("p_partkey") % 5 == 0, F.array(second, first)).otherwise(F.array(first, F.reverse(second)))
    plain = F.array(F.array(shell, first, second))
    shapes = base.select(
        "p_partkey",
        G.canonical(F.array(F.concat(F.array(turned), holes))).alias("g"),
        G.canonical(plain).alias("expected"),
    )
    return shapes.select(
        "p_partkey", _ring_text(F.col("g")[0][0]).alias("shell"), _ring_text(F.col("g")[0][1]).alias("first_hole"),
        (F.xxhash64("g") == F.xxhash64("expected")).alias("same_hash"),
    )


HILBERT_FRAME = (0.0, 0.0, 512.0, 128.0)


def _sql_hilbert(order: int = 16) -> str:
    side = 1 << order
    sql = (
        f"SELECT event_id, cast(least(greatest(floor(value / 512.0 * {side}), 0), {side - 1}) AS BIGINT) AS hx, "
        f"cast(least(greatest(floor((user_id % 100) / 128.0 * {side}), 0), {side - 1}) AS BIGINT) AS hy, "
        "cast(0 AS BIGINT) AS d FROM events"
    )
    for bit in range(order - 1, -1, -1):
        s = 1 << bit
        rx, ry = f"(hx // {s}) % 2", f"(hy // {s}) % 2"
        sql = (
            f"SELECT event_id, CASE WHEN {ry} = 1 THEN hx WHEN {rx} = 1 THEN {side - 1} - hy ELSE hy END AS hx, "
            f"CASE WHEN {ry} = 1 THEN hy WHEN {rx} = 1 THEN {side - 1} - hx ELSE hx END AS hy, "
            f"d + {s * s} * xor(3 * ({rx}), {ry}) AS d FROM ({sql})"
        )
    return f"SELECT event_id, cast(d AS BIGINT) AS hilbert FROM ({sql})"


@query("hilbert_index", _sql_hilbert())
def hilbert_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir)
    return cluster.with_hilbert(points, F.col("x"), F.col("y"), frame=HILBERT_FRAME).select("event_id", "hilbert")


def defective_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares with one kind of defect per key: see the SQL of ``repair_report``."""
    base = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size").selectExpr(
        "p_partkey", "p_brand", "cast(p_partkey % 50 * 10 AS DOUBLE) AS x", "floor(p_partkey / 50) * 10.0D AS y",
        "cast(4 + p_size AS DOUBLE) AS s",
    )
    x, y, s = F.col("x"), F.col("y"), F.col("s")
    a, b, c, d = G.xy(x, y), G.xy(x + s, y), G.xy(x + s, y + s), G.xy(x, y + s)
    kind = F.col("p_partkey") % 7
    parts = (
        F.when(kind == 0, G.ring_parts(a, b, c, d))
        .when(kind == 1, G.ring_parts(a, b, b, c, d, a))
        .when(kind == 2, G.ring_parts(a, b, G.xy(x + 2 * s, y), a))
        .when(kind == 3, G.ring_parts(a, c, b, d, a))
        .when(kind == 5, G.ring_parts(a, b, c, d, a))
        .when(kind == 6, F.array(F.array(_closed_box(x, y, s), _closed_box(x + s / 4, y + s / 4, s / 2, reverse=True))))
    )
    return base.select("p_partkey", "p_brand", parts.alias("parts")).withColumn("bbox", G.bbox(F.col("parts")))


_SQL_OUTCOME = (
    "CASE p_partkey % 7 WHEN 0 THEN 'repaired' WHEN 1 THEN 'repaired' WHEN 2 THEN 'unrepaired' "
    "WHEN 3 THEN 'repaired' WHEN 4 THEN 'null' ELSE 'valid' END"
)


@query(
    "repair_report",
    f"""
    SELECT p_partkey,
           CASE p_partkey % 7 WHEN 0 THEN 'unclosed' WHEN 1 THEN 'repeated_vertex' WHEN 2 THEN 'collapsed'
                WHEN 3 THEN 'self_crossing' WHEN 4 THEN 'null' END AS defect,
           {_SQL_OUTCOME} AS outcome,
           CASE p_partkey % 7 WHEN 2 THEN 0.0 WHEN 3 THEN (4 + p_size) * (4 + p_size) / 2
                WHEN 4 THEN NULL WHEN 6 THEN (4 + p_size) * (4 + p_size) * 0.75
                ELSE (4 + p_size) * (4 + p_size) END::DOUBLE AS area,
           CASE WHEN p_partkey % 7 = 4 THEN NULL
                ELSE p_partkey % 50 * 10 + (4 + p_size) * CASE WHEN p_partkey % 7 = 2 THEN 2 ELSE 1 END END::DOUBLE AS xmax
    FROM part
    """,
)
def repair_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validity.repair_geometries(defective_lots(spark, sf_dir), strict=True)
    return checked.select(
        "p_partkey", "defect", "outcome", F.round(G.area(F.col("parts")), 6).alias("area"), F.col("bbox.xmax").alias("xmax")
    )


def broken_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons that meet themselves in one of nine ways, or are valid though rings touch: see the SQL of ``linework_repair``."""
    base = table(spark, sf_dir, "part").select("p_partkey", "p_size").selectExpr(
        "p_partkey", "cast(p_partkey % 50 * 200 AS DOUBLE) AS x", "floor(p_partkey / 50) * 200.0D AS y",
        "cast(4 + p_size AS DOUBLE) AS s")
    x, y, s = F.col("x"), F.col("y"), F.col("s")

    def ring(*points: tuple[float, float]) -> Column:
        return F.array(*[G.xy(x + s * a, y + s * b) for a, b in points])

    def box(x0: float, y0: float, x1: float, y1: float) -> Column:
        return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))

    def turned(step: int) -> Column:
        t = [F.radians(F.lit(90.0 + 72.0 * (step * i % 5))) for i in range(5)]
        return F.array(*[G.xy(x + s * F.cos(a), y + s * F.sin(a)) for a in [*t, t[0]]])

    square = box(0, 0, 1, 1)
    pocket = ring((0, 0), (1, 0), (1, 1), (0.5, 1), (0.25, 0.5), (0.75, 0.5), (0.5, 1), (0, 1), (0, 0))
    forms = [
        F.array(F.array(ring((0, 0), (1, 1), (1, 0), (0, 1), (0, 0)))),
        F.array(F.array(turned(2))),
        F.array(F.array(square, box(2, 0, 2.5, 0.5))),
        F.array(F.array(square, box(0.5, 0.25, 1.5, 0.75))),
        F.array(F.array(square), F.array(box(0.5, 0.5, 1.5, 1.5))),
        F.array(F.array(square, box(0, 0.25, 0.5, 0.75))),
        F.array(F.array(pocket)),
        F.array(F.array(square), F.array(box(0.25, 0.25, 0.75, 0.75))),
        # valid: an island in the hole, and a part that touches a corner
        F.array(F.array(square, box(0.125, 0.125, 0.875, 0.875)), F.array(box(0.25, 0.25, 0.75, 0.75)), F.array(box(1, 1, 1.5, 1.5))),
        # a triangle across an island, the hole around it and the ground
        F.array(F.array(box(0, 0, 2, 2), box(0.5, 0.5, 1.5, 1.5)), F.array(box(0.75, 0.75, 1.25, 1.25), ring((1, 1), (1.75, 1), (1.75, 1.125), (1, 1)))),
    ]
    parts = F.lit(None).cast(G.PARTS)
    for k, form in enumerate(forms):
        parts = F.when(F.col("p_partkey") % len(forms) == k, form).otherwise(parts)
    return base.select("p_partkey", parts.alias("parts"))


@query(
    "linework_repair",
    f"""
    WITH b AS (SELECT p_partkey, p_partkey % 10 AS k, cast(4 + p_size AS DOUBLE) AS s FROM part)
    SELECT p_partkey,
           CASE k WHEN 0 THEN 'self_crossing' WHEN 1 THEN 'self_crossing' WHEN 2 THEN 'misplaced_ring' WHEN 3 THEN 'self_crossing'
                  WHEN 4 THEN 'self_crossing' WHEN 5 THEN 'overlapping_edges' WHEN 6 THEN 'self_touch' WHEN 7 THEN 'misplaced_ring'
                  WHEN 9 THEN 'self_crossing' END AS defect,
           CASE k WHEN 8 THEN 'valid' ELSE 'repaired' END AS outcome,
           round(s * s * CASE k WHEN 0 THEN 0.5
                  WHEN 1 THEN 5 * sin(radians(36)) * cos(radians(72)) / cos(radians(36))
                              - 2.5 * pow(cos(radians(72)) / cos(radians(36)), 2) * sin(radians(72))
                  WHEN 2 THEN 1.25 WHEN 3 THEN 1.0 WHEN 4 THEN 1.5 WHEN 5 THEN 0.75 WHEN 6 THEN 0.875 WHEN 7 THEN 0.75
                  WHEN 8 THEN 1 - 0.5625 + 0.25 + 0.25
                  ELSE 3.234375 END, 4) AS area,
           CASE k WHEN 0 THEN 2 WHEN 1 THEN 5 WHEN 2 THEN 2 WHEN 3 THEN 2 WHEN 4 THEN 2 WHEN 5 THEN 1 WHEN 6 THEN 1 WHEN 7 THEN 1
                  WHEN 8 THEN 3 END AS n_parts
    FROM b
    """,
)
def linework_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validity.repair_geometries(broken_lots(spark, sf_dir))
    parts = F.when(F.col("p_partkey") % 10 != 9, F.size("parts"))
    return checked.select(
        "p_partkey", "defect", "outcome", F.round(G.area(F.col("parts")), 4).alias("area"), parts.alias("n_parts"))


@query(
    "quality_counters",
    f"""
    SELECT p_brand, count(*) AS row_count, count(*) FILTER (WHERE o = 'repaired') AS repaired_geometries,
           count(*) FILTER (WHERE o = 'unrepaired') AS unrepaired_geometries,
           count(*) FILTER (WHERE o = 'null') AS null_geometries
    FROM (SELECT p_brand, {_SQL_OUTCOME} AS o FROM part) GROUP BY p_brand
    """,
)
def quality_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validity.quality_counters(
        validity.repair_geometries(defective_lots(spark, sf_dir), strict=True), "p_brand"
    )


@query(
    "dissolved_area",
    """
    WITH b AS (SELECT l_returnflag AS zone, l_partkey % 200 AS x, l_suppkey % 100 AS y, 1 + l_linenumber % 3 AS w,
                      1 + l_linenumber % 2 AS h FROM lineitem),
         c AS (SELECT DISTINCT zone, x + i AS cx, y + j AS cy
               FROM b, range(0, 3) r(i), range(0, 2) q(j) WHERE i < w AND j < h),
         s AS (SELECT substr('ANR', 1 + p_partkey % 3, 1) AS zone, 1 + p_size / 64 AS h, (1 + p_size / 64) * 1.5 AS r FROM part),
         n AS (SELECT zone, cast(count(*) AS DOUBLE) AS ground FROM c GROUP BY zone
               UNION ALL SELECT zone, sum(2 * r * r + 2 * (2 * h - r) * (2 * h - r)) FROM s GROUP BY zone),
         a AS (SELECT zone, count(*) AS polygons, cast(sum(w * h) AS DOUBLE) AS raw_area FROM b GROUP BY zone
               UNION ALL SELECT zone, 2 * count(*), sum(2 * r * r + 4 * h * h) FROM s GROUP BY zone)
    SELECT zone, cast(sum(polygons) AS BIGINT) AS polygons, round(sum(raw_area), 4) AS raw_area,
           (SELECT round(sum(ground), 4) FROM n WHERE n.zone = a.zone) AS dissolved_area
    FROM a GROUP BY zone
    """,
)
def dissolved_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes that overlap each other, and apart from them diamonds whose tips reach out of a box."""
    x, y = (F.col("l_partkey") % 200).cast("double"), (F.col("l_suppkey") % 100).cast("double")
    w, h = F.col("l_linenumber") % 3 + 1, F.col("l_linenumber") % 2 + 1
    boxes = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_partkey", "l_suppkey", "l_linenumber").select(
        F.col("l_returnflag").alias("zone"), G.box_parts(x, y, x + w, y + h).alias("parts")
    )
    cx, cy = F.lit(1000.0) + F.col("p_partkey") % 500 * 8, F.floor(F.col("p_partkey") / 500) * 8.0
    side = F.lit(1.0) + F.col("p_size") / 64
    r = side * 1.5
    diamond = G.ring_parts(G.xy(cx - r, cy), G.xy(cx, cy - r), G.xy(cx + r, cy), G.xy(cx, cy + r), G.xy(cx - r, cy))
    box = G.box_parts(cx - side, cy - side, cx + side, cy + side)
    zone = F.substring(F.lit("ANR"), F.col("p_partkey").cast("int") % 3 + 1, F.lit(1))
    crossed = table(spark, sf_dir, "part").select("p_partkey", "p_size").select(
        zone.alias("zone"), F.explode(F.array(diamond, box)).alias("parts"))
    found = dissolve.dissolved_area(boxes.unionByName(crossed), "zone")
    return found.select(
        "zone", "polygons", F.round("raw_area", 4).alias("raw_area"), F.round("dissolved_area", 4).alias("dissolved_area"))


def lonlat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lon = F.col("value") / 500 * 360 - 180
    lat = (F.col("user_id") % 100) * F.lit(1.7) - 85
    box = F.struct(lon.alias("xmin"), lat.alias("ymin"), lon.alias("xmax"), lat.alias("ymax"))
    return table(spark, sf_dir, "events").select("event_id", box.alias("bbox"))


_SQL_TILED = """
    p AS (SELECT event_id, value / 500 * 360 - 180 AS lon, (user_id % 100) * 1.7 - 85 AS lat FROM events),
    t AS (SELECT event_id, zoom,
                 cast(least(greatest(floor((lon + 180) / 360 * (1 << zoom)), 0), (1 << zoom) - 1) AS BIGINT) AS tile_x,
                 cast(least(greatest(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * (1 << zoom)), 0),
                      (1 << zoom) - 1) AS BIGINT) AS tile_y
          FROM p, (SELECT cast(range AS INT) AS zoom FROM range(0, 7)))
"""


@query(
    "tile_counts",
    f"""
    WITH {_SQL_TILED}
    SELECT zoom, tile_x, tile_y, count(*) AS features, least(count(*), 50) AS kept, greatest(count(*) - 50, 0) AS dropped
    FROM t GROUP BY zoom, tile_x, tile_y
    """,
)
def tile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiles.tile_counts(lonlat_events(spark, sf_dir), max_zoom=6, limit=50)


@query(
    "tile_features",
    f"""
    WITH {_SQL_TILED}
    SELECT zoom, tile_x, tile_y, event_id, row_number() OVER (PARTITION BY zoom, tile_x, tile_y
      ORDER BY cast('0x' || substr(md5(cast(event_id AS VARCHAR)), 1, 8) AS BIGINT), event_id) <= 50 AS kept
    FROM t
    """,
)
def tile_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature of every tile, and whether a limit of 50 would keep it."""
    return tiles.tile_features(lonlat_events(spark, sf_dir), "event_id", max_zoom=6, limit=50)


@query(
    "wkb_roundtrip",
    """
    SELECT p_partkey, p_partkey % 7 = 4 AS missing,
           CASE p_partkey % 7 WHEN 0 THEN 4 WHEN 1 THEN 6 WHEN 2 THEN 4 WHEN 4 THEN NULL WHEN 6 THEN 10 ELSE 5 END::INT
             AS vertices,
           CASE p_partkey % 7 WHEN 0 THEN 77 WHEN 1 THEN 109 WHEN 2 THEN 77 WHEN 4 THEN NULL WHEN 6 THEN 177 ELSE 93
             END::INT AS wkb_bytes,
           CASE WHEN p_partkey % 7 <> 4 THEN true END AS same
    FROM part
    """,
)
def wkb_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lots = defective_lots(spark, sf_dir).select("p_partkey", "parts", W.to_wkb("parts").alias("geometry"))
    back = lots.withColumn("decoded", W.from_wkb("geometry"))
    return back.select(
        "p_partkey", F.col("decoded").isNull().alias("missing"),
        F.when(F.col("decoded").isNotNull(), F.size(G.vertices(F.col("decoded")))).alias("vertices"),
        F.octet_length("geometry").alias("wkb_bytes"), (F.col("decoded") == F.col("parts")).alias("same"),
    )


# the districts on a fine grid of the unit square; every number is a whole multiple of a power of two
_WORLD = """SELECT c_custkey, c_custkey % 3 AS shape, ((c_custkey * 7) % 450 + 0.28125) / 512 AS x0,
                   ((c_custkey * 13) % 450 + 0.40625) / 512 AS y0,
                   CASE WHEN c_custkey % 100 = 0 THEN 40.0 ELSE 1.0 + c_custkey % 4 END / 512 AS s FROM customer"""
_COVER_ZOOM = 10


def world_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares, triangles and squares with a hole, in world coordinates."""
    number = F.col("c_custkey")
    base = table(spark, sf_dir, "customer").select(
        number, ((number * 7 % 450 + 0.28125) / 512).cast("double").alias("x"),
        ((number * 13 % 450 + 0.40625) / 512).cast("double").alias("y"),
        (F.when(number % 100 == 0, 40.0).otherwise(1.0 + number % 4) / 512).alias("s"))
    x, y, s = F.col("x"), F.col("y"), F.col("s")
    square = _closed_box(x, y, s)
    triangle = F.array(G.xy(x, y), G.xy(x + s, y), G.xy(x, y + s), G.xy(x, y))
    hole = _closed_box(x + s / 4, y + s / 4, s / 2, reverse=True)
    parts = (
        F.when(number % 3 == 0, F.array(F.array(square))).when(number % 3 == 1, F.array(F.array(triangle)))
        .otherwise(F.array(F.array(square, hole)))
    )
    return base.select("c_custkey", parts.alias("parts"))


@query(
    "tile_cover",
    f"""
    WITH d AS (SELECT c_custkey, shape, cast(x0 AS DOUBLE) AS x0, cast(y0 AS DOUBLE) AS y0, cast(s AS DOUBLE) AS s
               FROM ({_WORLD})),
         z AS (SELECT *, pow(2, -zoom) AS w FROM d, (SELECT cast(range AS INT) AS zoom FROM range(0, {_COVER_ZOOM + 1}))),
         c AS (SELECT *, unnest(range(cast(floor(x0 / w) AS BIGINT), cast(floor((x0 + s) / w) AS BIGINT) + 1)) AS tile_x FROM z),
         t AS (SELECT *, unnest(range(cast(floor(y0 / w) AS BIGINT), cast(floor((y0 + s) / w) AS BIGINT) + 1)) AS tile_y FROM c),
         k AS (SELECT *, tile_x * w - x0 AS a, (tile_x + 1) * w - x0 AS b, tile_y * w - y0 AS e, (tile_y + 1) * w - y0 AS f FROM t),
         j AS (SELECT c_custkey, zoom, tile_x, tile_y,
                 CASE shape WHEN 1 THEN greatest(a, 0) + greatest(e, 0) < s
                            WHEN 2 THEN NOT (a >= s / 4 AND b <= 3 * s / 4 AND e >= s / 4 AND f <= 3 * s / 4) ELSE true END AS shares,
                 a >= 0 AND e >= 0 AND CASE shape WHEN 1 THEN b + f <= s WHEN 2 THEN b <= s AND f <= s
                            AND NOT (b > s / 4 AND a < 3 * s / 4 AND f > s / 4 AND e < 3 * s / 4) ELSE b <= s AND f <= s END AS whole
               FROM k)
    SELECT j.c_custkey, j.zoom, j.tile_x, j.tile_y, j.whole FROM j
    LEFT JOIN j p ON p.c_custkey = j.c_custkey AND p.zoom = j.zoom - 1 AND p.tile_x = j.tile_x // 2 AND p.tile_y = j.tile_y // 2
    WHERE j.shares AND NOT coalesce(p.whole, false) AND (j.whole OR j.zoom = {_COVER_ZOOM})
    """,
)
def tile_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles of every district: whole ones as coarse as can be, those on the outline at the deepest zoom."""
    return cover.tile_cover(world_districts(spark, sf_dir), "c_custkey", max_zoom=_COVER_ZOOM)
