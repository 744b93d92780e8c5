"""Area of overlapping polygons without counting any ground twice, by a distributed plane sweep."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotkeep.functions import geometry as G
from plotkeep.functions.sweep import covered_area
from plotkeep.session import cut_lineage

# Heights are counted in so many steps of a group's extent, and strips are made of steps with about so many edge ends.
STEPS = 1 << 16
STRIP_ENDS = 1 << 13


def _step(y: Column) -> Column:
    """The step of a group's extent that a height falls in."""
    share = F.try_divide(y - F.col("_y0"), F.col("_y1") - F.col("_y0"))
    return F.least(F.floor(F.coalesce(share, F.lit(0.0)) * STEPS), F.lit(STEPS - 1)).cast("int")


def _height(step: Column) -> Column:
    """Where a step begins: neighbouring strips get the same number."""
    return F.col("_y0") + (F.col("_y1") - F.col("_y0")) * (step / F.lit(float(STEPS)))


def _strips(edges: DataFrame) -> DataFrame:
    """(group, step, strip, low, high) of the steps in which edges end; the window holds at most ``STEPS`` rows of a group."""
    ends = edges.select("_group", "_y0", "_y1", F.explode(F.array("_from", "_to")).alias("_step"))
    counted = ends.groupBy("_group", "_step").agg(
        F.count(F.lit(1)).alias("_n"), F.first("_y0").alias("_y0"), F.first("_y1").alias("_y1"))
    group = Window.partitionBy("_group")
    before = F.sum("_n").over(group.orderBy("_step")) - F.col("_n")
    counted = counted.withColumn("_strip", F.floor(before / F.lit(STRIP_ENDS)).cast("long"))
    # a strip reaches from its first step to the next strip's
    counted = counted.withColumn("_first", F.min("_step").over(Window.partitionBy("_group", "_strip")))
    after = F.min(F.when(F.col("_first") == F.col("_step"), F.col("_step"))).over(
        group.orderBy("_step").rowsBetween(1, Window.unboundedFollowing))
    low = F.when(F.col("_first") > F.min("_step").over(group), _height(F.col("_first")))
    # seen from the end, a running minimum
    later = group.orderBy(F.col("_step").desc()).rowsBetween(Window.unboundedPreceding, -1)
    after = F.min(F.when(F.col("_first") == F.col("_step"), F.col("_step"))).over(later)
    counted = counted.withColumns({"_low": low, "_next": after}).withColumn("_high", _height(F.col("_next")))
    counted = counted.withColumn("_strip", F.dense_rank().over(group.orderBy("_strip")) - 1)
    return counted.select("_group", "_step", "_strip", "_low", "_high")


def _swept(table: pa.Table) -> pa.Table:
    edges = np.column_stack([table.column(c).to_numpy() for c in ("x1", "y1", "x2", "y2")])
    owner = np.unique(table.column("_shape").to_numpy(), return_inverse=True)[1]
    low, high = table.column("_low")[0].as_py(), table.column("_high")[0].as_py()
    area = covered_area(edges, owner, lambda n: n > 0, -np.inf if low is None else low, np.inf if high is None else high)
    return pa.table({"_group": table.column("_group").slice(0, 1), "_area": pa.array([area], pa.float64())})


def dissolved_area(df: DataFrame, group: str, parts: str = "parts") -> DataFrame:
    """Per group: polygons, the sum of their areas, and the area of their union.

    Equal polygons of a group are swept once. The extent of a group is cut into
    horizontal strips with about ``STRIP_ENDS`` edge ends each, and every strip is
    swept exactly in a task of its own, with all edges that reach it. A polygon
    costs its edges, once for each strip it reaches. Ground is what a polygon's
    rings cover by the even-odd rule, so holes stay open; a group of null
    geometries has no row, and a null group is one like others (groups are
    compared as structs, in which nulls are equal).
    """
    shaped = df.where(F.col(parts).isNotNull()).groupBy(F.struct(F.col(group).alias("of")).alias("_group"), F.col(parts).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"))
    heights = F.transform(G.vertices(F.col("_p")), lambda p: p.y)
    shaped = shaped.select(
        "_group", "_n", F.xxhash64("_p").alias("_shape"), G.edges(F.col("_p")).alias("_e"), G.area(F.col("_p")).alias("_a"),
        F.array_min(heights).alias("_y0"), F.array_max(heights).alias("_y1"))
    shaped = cut_lineage(shaped, "dissolve")
    extent = shaped.groupBy("_group").agg(F.min("_y0").alias("_y0"), F.max("_y1").alias("_y1"))
    placed = shaped.select("_group", "_shape", F.inline("_e")).where("y1 <> y2").join(extent, "_group")
    placed = placed.withColumns({"_from": _step(F.least("y1", "y2")), "_to": _step(F.greatest("y1", "y2"))})
    strips = cut_lineage(_strips(placed), "strips")
    begins = strips.select("_group", F.col("_step").alias("_from"), F.col("_strip").alias("_s0"))
    ends = strips.select("_group", F.col("_step").alias("_to"), F.col("_strip").alias("_s1"))
    placed = placed.join(begins, ["_group", "_from"]).join(ends, ["_group", "_to"])
    bounds = strips.groupBy("_group", "_strip").agg(F.first("_low").alias("_low"), F.first("_high").alias("_high"))
    pieces = placed.select(
        "_group", "_shape", "x1", "y1", "x2", "y2", F.explode(F.sequence("_s0", "_s1")).alias("_strip")).join(bounds, ["_group", "_strip"])
    schema = T.StructType([shaped.schema["_group"], T.StructField("_area", T.DoubleType())])
    # named, or the tasks of an earlier join by group, as few as there are groups, would sweep all strips
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    swept = pieces.repartition(tasks, "_group", "_strip").groupBy("_group", "_strip").applyInArrow(_swept, schema).groupBy("_group").agg(F.sum("_area").alias("_area"))
    totals = shaped.groupBy("_group").agg(F.sum("_n").alias("polygons"), F.sum(F.col("_a") * F.col("_n")).alias("raw_area"))
    return totals.join(swept, "_group", "left").select(
        F.col("_group.of").alias(group), "polygons", "raw_area", F.coalesce("_area", F.lit(0.0)).alias("dissolved_area"))
