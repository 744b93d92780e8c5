"""Vector-tile assignment: how many features each tile holds, and which it keeps."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Latitude limit of the square Web Mercator world.
MAX_LAT = 85.0511287798066
HASH_BUCKETS = 1 << 16


def tile_x(lon: Column, zoom: int) -> Column:
    n = 1 << zoom
    x = F.floor((lon + F.lit(180.0)) / F.lit(360.0) * F.lit(float(n)))
    return F.least(F.greatest(x, F.lit(0)), F.lit(n - 1)).cast("long")


def tile_y(lat: Column, zoom: int) -> Column:
    n = 1 << zoom
    phi = F.radians(F.least(F.greatest(lat, F.lit(-MAX_LAT)), F.lit(MAX_LAT)))
    y = F.floor((F.lit(1.0) - F.log(F.tan(phi) + F.lit(1.0) / F.cos(phi)) / F.lit(math.pi)) / 2 * F.lit(float(n)))
    return F.least(F.greatest(y, F.lit(0)), F.lit(n - 1)).cast("long")


def _deepest_range(box: Column, zoom: int) -> dict[str, Column]:
    return {
        "_x0": tile_x(box.xmin, zoom), "_x1": tile_x(box.xmax, zoom),
        "_y0": tile_y(box.ymax, zoom), "_y1": tile_y(box.ymin, zoom),
    }


def _explode_zooms(df: DataFrame, min_zoom: int, max_zoom: int) -> DataFrame:
    """All tiles of all zooms. A parent range is the deepest range shifted right."""
    shift = F.lit(max_zoom) - F.col("zoom")

    def up(name: str) -> Column:
        return F.floor(F.col(name) / F.pow(F.lit(2.0), shift)).cast("long")

    return (
        df.withColumn("zoom", F.explode(F.sequence(F.lit(min_zoom), F.lit(max_zoom))))
        .withColumn("tile_x", F.explode(F.sequence(up("_x0"), up("_x1"))))
        .withColumn("tile_y", F.explode(F.sequence(up("_y0"), up("_y1"))))
        .drop("_x0", "_x1", "_y0", "_y1")
    )


def tile_counts(
    df: DataFrame, box: str = "bbox", min_zoom: int = 0, max_zoom: int = 13, limit: int | None = None
) -> DataFrame:
    """Features per tile with how many the caller's limit (none by default) keeps and drops.

    Rows are counted by their deepest tile range first, so the zoom fan-out
    works on counts, not on features.
    """
    located = df.where(F.col(box).isNotNull()).select(F.col(box).alias("_b"))
    ranges = located.select(*[c.alias(n) for n, c in _deepest_range(F.col("_b"), max_zoom).items()])
    counted = ranges.groupBy("_x0", "_x1", "_y0", "_y1").agg(F.count(F.lit(1)).alias("_n"))
    n = F.col("features")
    return (
        _explode_zooms(counted, min_zoom, max_zoom)
        .groupBy("zoom", "tile_x", "tile_y")
        .agg(F.sum("_n").alias("features"))
        .withColumn("kept", n if limit is None else F.least(n, F.lit(limit)))
        .withColumn("dropped", n - F.col("kept"))
    )


def tile_features(
    df: DataFrame, id_col: str, box: str = "bbox", min_zoom: int = 0, max_zoom: int = 13, limit: int | None = None
) -> DataFrame:
    """(zoom, tile_x, tile_y, id, kept) of every feature in each tile.

    A tile keeps its ``limit`` lowest features by (identifier hash,
    identifier). A low-zoom tile can hold every row of the table, so ranking
    happens only inside one of many hash buckets per tile: counts per bucket
    tell how many features the lower buckets hold. Without a limit all are kept.
    """
    h = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("long")
    ranged = df.where(F.col(box).isNotNull()).select(
        F.col(id_col), h.alias("_h"), *[c.alias(n) for n, c in _deepest_range(F.col(box), max_zoom).items()]
    )
    tile = ["zoom", "tile_x", "tile_y"]
    placed = _explode_zooms(ranged, min_zoom, max_zoom).withColumn(
        "_bucket", F.floor(F.col("_h") / F.lit((1 << 32) // HASH_BUCKETS))
    )
    if limit is None:
        return placed.select(*tile, id_col, F.lit(True).alias("kept"))
    # at most HASH_BUCKETS rows per tile reach this window
    running = Window.partitionBy(*tile).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        placed.groupBy(*tile, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0)))
        .drop("_n")
    )
    # the rank is partitioned like the join, so it needs no further shuffle
    rank = F.row_number().over(Window.partitionBy(*tile, "_bucket").orderBy("_h", id_col))
    ranked = placed.join(before, [*tile, "_bucket"]).withColumn("_rank", rank)
    return ranked.select(*tile, id_col, (F.col("_rank") + F.col("_before") <= limit).alias("kept"))
