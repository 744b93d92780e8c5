"""Landed pages of a feature service: typed rows and a completeness check.

A page is one JSON document with ``features[].attributes`` and
``exceededTransferLimit``; pages arrive as rows (collection, page_offset, body).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Service field types and the column types they map to.
FIELD_TYPES = {
    "esriFieldTypeOID": T.IntegerType(),
    "esriFieldTypeInteger": T.IntegerType(),
    "esriFieldTypeSmallInteger": T.ShortType(),
    "esriFieldTypeDouble": T.DoubleType(),
    "esriFieldTypeSingle": T.FloatType(),
    "esriFieldTypeString": T.StringType(),
    "esriFieldTypeGUID": T.StringType(),
    "esriFieldTypeGlobalID": T.StringType(),
    "esriFieldTypeDate": T.TimestampType(),
}


def column_types(fields: Sequence[tuple[str, str]]) -> T.StructType:
    """Column types of a (name, service type) list; an unmapped type is an error."""
    unmapped = [kind for _, kind in fields if kind not in FIELD_TYPES]
    if unmapped:
        raise ValueError(f"unmapped field type {unmapped[0]}")
    return T.StructType([T.StructField(name, FIELD_TYPES[kind]) for name, kind in fields])


def _page_schema(columns: T.StructType) -> T.StructType:
    # dates travel as epoch milliseconds
    wire = T.StructType(
        [T.StructField(f.name, T.LongType() if f.dataType == T.TimestampType() else f.dataType) for f in columns]
    )
    feature = T.StructType([T.StructField("attributes", wire)])
    return T.StructType(
        [T.StructField("features", T.ArrayType(feature)), T.StructField("exceededTransferLimit", T.BooleanType())]
    )


def _parsed(pages: DataFrame, columns: T.StructType) -> Column:
    return F.from_json("body", _page_schema(columns), {"mode": "FAILFAST"})


def page_rows(pages: DataFrame, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """One typed row per feature. Malformed pages fail the read."""
    columns = column_types(fields)
    attributes = pages.select(F.explode(_parsed(pages, columns)["features"]).alias("f")).select("f.attributes.*")
    typed = [
        F.timestamp_millis(F.col(f"`{f.name}`")).alias(f.name) if f.dataType == T.TimestampType()
        else F.col(f"`{f.name}`")
        for f in columns
    ]
    return attributes.select(*typed)


def page_completeness(pages: DataFrame) -> DataFrame:
    """(collection, pages, row_count, last_pages, gaps, complete).

    Offsets are contiguous when every page but the first starts where another
    ends. Each page gives a start and an end mark, and marks are met by
    (collection, position) in one grouped pass: every page is parsed once and
    no collection has to fit into one task. The read is complete with no gap,
    no two pages that start or end at one place, and one last page, which ends
    where the read ends: an empty one, or one that did not exceed the transfer
    limit.
    """
    shape = T.StructType([
        T.StructField("features", T.ArrayType(T.StructType([]))),
        T.StructField("exceededTransferLimit", T.BooleanType()),
    ])
    page = F.from_json("body", shape, {"mode": "FAILFAST"})
    sized = pages.select("collection", "page_offset", page.alias("p")).select(
        "collection", "page_offset",
        F.coalesce(F.size("p.features"), F.lit(0)).cast("long").alias("n"),
        F.coalesce("p.exceededTransferLimit", F.lit(False)).alias("more"),
    )
    is_last = (~F.col("more") | (F.col("n") == 0)).cast("long")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def mark(position: Column, starts: Column, ends: Column, n: Column, last: Column, end: Column) -> Column:
        return F.struct(
            position.cast("long").alias("position"), starts.alias("starts"), ends.alias("ends"),
            n.alias("n"), last.alias("last"), end.cast("long").alias("end"),
            F.when(last == 1, end.cast("long")).alias("last_end"),
        )

    stop = F.col("page_offset") + F.col("n")
    start = mark(F.col("page_offset"), one, zero, F.col("n"), is_last, stop)
    end = mark(stop, zero, (F.col("n") > 0).cast("long"), zero, zero, stop)
    by_position = sized.select("collection", F.inline(F.array(start, end))).groupBy("collection", "position").agg(
        F.sum("starts").alias("starts"), F.sum("ends").alias("ends"), F.sum("n").alias("n"), F.sum("last").alias("last"),
        F.max("end").alias("end"), F.max("last_end").alias("last_end"),
    )
    twice = (F.col("starts") > 1) | (F.col("ends") > 1)
    lost = (F.col("position") > 0) & (F.col("ends") == 0)
    return (
        by_position.groupBy("collection")
        .agg(
            F.sum("starts").alias("pages"), F.sum("n").alias("row_count"), F.sum("last").alias("last_pages"),
            F.sum(F.when(lost, F.col("starts")).otherwise(zero)).alias("gaps"),
            F.sum(F.when(F.col("position") == 0, F.col("starts")).otherwise(zero)).alias("_firsts"),
            F.count_if(twice).alias("_twice"), F.max("end").alias("_end"), F.max("last_end").alias("_last_end"),
        )
        .withColumn(
            "complete",
            (F.col("gaps") == 0) & (F.col("last_pages") == 1) & (F.col("_firsts") == 1)
            & (F.col("_twice") == 0) & F.col("_last_end").eqNullSafe(F.col("_end")),
        )
        .drop("_firsts", "_twice", "_end", "_last_end")
    )


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """Pages landed as ``<collection>/<offset>.json``, one file per page."""
    text = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    name = F.col("_metadata.file_path")
    return text.select(
        F.regexp_extract(name, r"([^/]+)/\d+\.json$", 1).alias("collection"),
        F.regexp_extract(name, r"(\d+)\.json$", 1).cast("long").alias("page_offset"),
        F.col("value").alias("body"),
    )


def probe_state(probes: DataFrame) -> DataFrame:
    """(collection, data_last_edit, row_count) from raw service answers.

    Input: (collection, data_edit_ms, edit_ms, row_count). The data edit wins
    over the schema edit; a service that reports neither cannot be tracked.
    """
    known = F.coalesce(F.nullif("data_edit_ms", F.lit(0)), F.nullif("edit_ms", F.lit(0)))
    message = F.concat(F.col("collection"), F.lit(" reports no edit time; cannot detect edits"))
    return probes.select(
        "collection",
        F.timestamp_millis(F.coalesce(known, F.raise_error(message).cast("long"))).alias("data_last_edit"),
        "row_count",
    )
