"""Facts about a table: counts, extents, value domains, class histograms, schema drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotkeep.functions.clean import typed_value


def field_list(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """(path, type) of every field, nested fields included."""
    out = []
    for field in schema.fields:
        path = f"{prefix}{field.name}"
        out.append((path, field.dataType.simpleString()))
        if isinstance(field.dataType, T.StructType):
            out += field_list(field.dataType, path + ".")
    return out


def table_facts(df: DataFrame, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> DataFrame:
    """Row count, column count and extent rounded to ten decimals, in one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.round(F.min(xmin), 10).alias("xmin"),
        F.round(F.min(ymin), 10).alias("ymin"),
        F.round(F.max(xmax), 10).alias("xmax"),
        F.round(F.max(ymax), 10).alias("ymax"),
    )


def _filled(df: DataFrame, type_name: str, count_name: str) -> DataFrame:
    """One row per field: its type and how many rows hold a value."""
    fields = field_list(df.schema)
    counts = df.agg(*[F.count(F.col(p)).alias(f"c{i}") for i, (p, _) in enumerate(fields)])
    rows = [
        F.struct(F.lit(p).alias("column"), F.lit(t).alias(type_name), F.col(f"c{i}").alias(count_name))
        for i, (p, t) in enumerate(fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Field-level drift between two versions, with the filled rows of each side."""
    joined = _filled(old, "old_type", "old_filled").join(_filled(new, "new_type", "new_filled"), "column", "full")
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
        .otherwise("same")
    )
    return joined.withColumn("change", change)


def distinct_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, num, str, n) of every value of several columns, in one scan.

    Numbers and text stay apart, so ``1`` and ``'1'`` are two values. Nulls
    are left out.
    """
    cells = []
    for name in columns:
        num, text = typed_value(F.col(f"`{name}`"), df.schema[name].dataType)
        cells.append(F.struct(F.lit(name).alias("column"), num.alias("num"), text.alias("str")))
    long = df.select(F.inline(F.array(*cells)))
    return (
        long.where(F.col("num").isNotNull() | F.col("str").isNotNull())
        .groupBy("column", "num", "str")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_index(value: Column, stops: Column) -> Column:
    """Index of the half-open class [stop, next stop) a value falls into.

    The top class ends below infinity, so infinity and NaN have no class; nor
    has null.
    """
    return F.when(value < F.lit(float("inf")), F.size(F.filter(stops, lambda s: s <= value)))


def step_histogram(df: DataFrame, value: Column, stops: Sequence[float]) -> DataFrame:
    """Rows per class, empty classes included; open ends are null."""
    edges = [float(s) for s in stops]
    stop_array = F.array(*[F.lit(s) for s in edges])
    counted = (
        df.select(class_index(value.cast("double"), stop_array).alias("class_index"))
        .where("class_index is not null")
        .groupBy("class_index")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    classes = df.sparkSession.createDataFrame(
        [(i, edges[i - 1] if i else None, edges[i] if i < len(edges) else None) for i in range(len(edges) + 1)],
        "class_index int, low double, high double",
    )
    # the class list has one row per stop, so it is the small side
    return counted.join(classes, "class_index", "right").select(
        "class_index", "low", "high",
        F.coalesce("n", F.lit(0)).alias("n"),
        F.col("n").isNull().alias("empty"),
    )


def row_parity(before: DataFrame, after: DataFrame, written: DataFrame) -> DataFrame:
    """Gate per collection: the source count before and after equals the rows written.

    Inputs are (collection, n); a collection missing on one side fails.
    """
    def named(df: DataFrame, name: str) -> DataFrame:
        return df.select("collection", F.col("n").alias(name))

    joined = named(before, "before").join(named(after, "after"), "collection", "full")
    joined = joined.join(named(written, "written"), "collection", "full")
    same = (F.col("before") == F.col("after")) & (F.col("after") == F.col("written"))
    return joined.withColumn("ok", F.coalesce(same, F.lit(False)))


def recorded_counts(versions: DataFrame, columns: Sequence[str], smallest: int = 100) -> DataFrame:
    """Every distinct count any version records, from ``smallest`` up."""
    cells = F.array(*[F.col(c).cast("long") for c in columns])
    return (
        versions.select(F.explode(cells).alias("recorded"))
        .where(F.col("recorded") >= smallest)
        .distinct()
    )
