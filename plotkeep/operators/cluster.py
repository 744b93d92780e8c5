"""Space-filling-curve order for spatial tables, and the window query it serves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = 16
# The longitude/latitude frame.
LONLAT_FRAME = (-180.0, -90.0, 180.0, 90.0)


def _grid(v: Column, low: float, high: float, order: int) -> Column:
    side = 1 << order
    scaled = F.floor((v - F.lit(float(low))) / F.lit(float(high - low)) * F.lit(float(side)))
    # least and greatest skip nulls, so a missing coordinate is kept apart
    return F.when(v.isNotNull(), F.least(F.greatest(scaled, F.lit(0)), F.lit(side - 1))).cast("long")


def _curve_table() -> list[int]:
    """Four curve levels at a time: (orientation, x nibble, y nibble) -> 4 * index + orientation.

    An orientation is a swap of the axes and a flip of both; each level may
    change either.
    """
    table = []
    for start in range(4):
        for x in range(16):
            for y in range(16):
                swap, flip, index = start >> 1, start & 1, 0
                for bit in (3, 2, 1, 0):
                    right, upper = (x >> bit & 1) ^ flip, (y >> bit & 1) ^ flip
                    if swap:
                        right, upper = upper, right
                    index = index * 4 + ((3 * right) ^ upper)
                    if not upper:
                        swap, flip = swap ^ 1, flip ^ right
                table.append(index * 4 + swap * 2 + flip)
    return table


def with_hilbert(
    df: DataFrame, x: Column, y: Column, out: str = "hilbert",
    frame: tuple[float, float, float, float] = LONLAT_FRAME,
) -> DataFrame:
    """Add the Hilbert index of a location within a frame; null stays null.

    Four table look-ups of four levels each, one small projection per look-up,
    stay in generated code.
    """
    lookup = F.expr(f"array({', '.join(map(str, _curve_table()))})")
    step = df.withColumns({
        "_hx": _grid(x, frame[0], frame[2], ORDER),
        "_hy": _grid(y, frame[1], frame[3], ORDER),
        "_hv": F.lit(0),
        out: F.lit(0).cast("long"),
    })
    for shift in range(ORDER - 4, -1, -4):
        nibbles = [F.shiftright(F.col(c), shift).bitwiseAND(F.lit(15)) for c in ("_hx", "_hy")]
        at = F.col("_hv").bitwiseAND(F.lit(3)) * 256 + nibbles[0] * 16 + nibbles[1]
        step = step.withColumn("_hv", F.get(lookup, at.cast("int")))
        step = step.withColumn(out, F.col(out) * 256 + F.shiftright("_hv", 2))
    known = F.col("_hx").isNotNull() & F.col("_hy").isNotNull()
    return step.withColumn(out, F.when(known, F.col(out))).drop("_hx", "_hy", "_hv")


def hilbert_sorted(
    df: DataFrame, id_col: str, box: str = "bbox", partitions: int | None = None,
    frame: tuple[float, float, float, float] = LONLAT_FRAME,
) -> DataFrame:
    """Range-partition and sort along the curve, rows without a box last.

    The identifier hash breaks ties, so a pile of rows at one location (or
    without location) is spread over several partitions.
    """
    b = F.col(box)
    keyed = with_hilbert(df, (b.xmin + b.xmax) / 2, (b.ymin + b.ymax) / 2, "_curve", frame)
    keyed = keyed.withColumn("_tie", F.xxhash64(id_col))
    order = [F.col("_curve").asc_nulls_last(), F.col("_tie").asc()]
    ranged = keyed.repartitionByRange(partitions, *order) if partitions else keyed.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).drop("_curve", "_tie")


def in_window(df: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float, box: str = "bbox") -> DataFrame:
    """Rows whose box meets the window. The nested comparisons reach the Parquet scan."""
    b = F.col(box)
    return df.where((b.xmax >= xmin) & (b.xmin <= xmax) & (b.ymax >= ymin) & (b.ymin <= ymax))
