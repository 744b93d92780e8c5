"""Collection and style documents as tables."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

from plotkeep.functions.clean import parse_iso_utc

ARCHIVE_KEY = "version-"


def _asset_type(ns: str) -> T.StructType:
    text, number = T.StringType(), T.LongType()
    return T.StructType([
        T.StructField("href", text),
        T.StructField("roles", T.ArrayType(text)),
        T.StructField("version", text),
        T.StructField("created", text),
        T.StructField(f"{ns}:source_updated", text),
        T.StructField("table:row_count", number),
        T.StructField(f"{ns}:content_hash", text),
        T.StructField(f"{ns}:repaired_geometries", number),
        T.StructField(f"{ns}:null_geometries", number),
        T.StructField("file:size", number),
        T.StructField("file:checksum", text),
    ])


def _collection_type(ns: str) -> T.StructType:
    text = T.StringType()
    link = T.StructType([T.StructField("rel", text), T.StructField("href", text)])
    return T.StructType([
        T.StructField("id", text),
        T.StructField("type", text),
        T.StructField("description", text),
        T.StructField("updated", text),
        T.StructField("table:row_count", T.LongType()),
        T.StructField("geoparquet:feature_count", T.LongType()),
        T.StructField("stac_extensions", T.ArrayType(text)),
        T.StructField("links", T.ArrayType(link)),
        T.StructField("assets", T.MapType(text, _asset_type(ns))),
    ])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of every file below a folder."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def collection_documents(docs: DataFrame, ns: str) -> DataFrame:
    """Parse docs(path, text). ``ns`` is the prefix of the catalog's own fields."""
    return docs.select("path", F.from_json("text", _collection_type(ns), {"mode": "FAILFAST"}).alias("d")).select(
        "path", "d.*"
    )


def collection_versions(collections: DataFrame, ns: str) -> DataFrame:
    """Version records: the asset named after its collection, and each ``version-*`` asset."""
    asset = F.col("asset")

    def own(name: str) -> Column:
        return asset.getField(f"{ns}:{name}")

    is_current = (F.col("key") == F.col("id")) & asset["version"].isNotNull()
    is_archive = F.col("key").startswith(ARCHIVE_KEY)
    return (
        collections.select("id", F.explode("assets").alias("key", "asset"))
        .where(is_current | is_archive)
        .select(
            F.col("id").alias("collection"),
            asset["version"].alias("version"),
            parse_iso_utc(asset["created"]).alias("created"),
            parse_iso_utc(own("source_updated")).alias("source_updated"),
            asset.getField("table:row_count").alias("row_count"),
            own("content_hash").alias("content_hash"),
            own("repaired_geometries").alias("repaired_geometries"),
            own("null_geometries").alias("null_geometries"),
            asset.getField("file:size").alias("file_size"),
            asset.getField("file:checksum").alias("file_checksum"),
            asset["href"].alias("path"),
            F.when(is_current, "data").otherwise("archive").alias("role"),
        )
    )


def document_counts(collections: DataFrame, ns: str) -> DataFrame:
    """(count_a, count_b, ...) of every place a document records a count: itself and each asset."""
    own = collections.select(
        F.col("`table:row_count`").alias("rows"), F.col("`geoparquet:feature_count`").alias("features"),
        F.lit(None).cast("long").alias("repaired"), F.lit(None).cast("long").alias("nulls"),
    )
    asset = F.col("asset")
    assets = collections.select(F.explode("assets").alias("key", "asset")).select(
        asset.getField("table:row_count").alias("rows"), F.lit(None).cast("long").alias("features"),
        asset.getField(f"{ns}:repaired_geometries").alias("repaired"),
        asset.getField(f"{ns}:null_geometries").alias("nulls"),
    )
    return own.unionByName(assets)


def document_links(collections: DataFrame) -> DataFrame:
    """(path, source, href) of every link and asset."""
    linked = F.transform(
        "links", lambda l: F.struct(F.concat(F.lit("rel:"), l["rel"]).alias("source"), l["href"].alias("href"))
    )
    assets = F.transform(
        F.map_entries("assets"),
        lambda e: F.struct(F.concat(F.lit("asset "), e["key"]).alias("source"), e["value"]["href"].alias("href")),
    )
    none = F.array().cast("array<struct<source:string,href:string>>")
    return collections.select("path", F.inline(F.concat(F.coalesce(linked, none), F.coalesce(assets, none))))


def _style_rules(node: object) -> Iterator[tuple[str, str, list, list]]:
    """(kind, column, labels, stops) of each attribute-driven expression, outer ones first."""
    if isinstance(node, dict):
        for child in node.values():
            yield from _style_rules(child)
    elif isinstance(node, list):
        match node:
            case ["match", ["get", column], *branches] if branches:
                labels = []
                for label in branches[: len(branches) - 1 : 2]:  # the last item is the fallback
                    labels += label if isinstance(label, list) else [label]
                yield "match", column, labels, []
            case ["step", ["get", column], _, *rest]:
                yield "step", column, [], [float(stop) for stop in rest[0::2]]
        for child in node:
            yield from _style_rules(child)


def _typed(label: object) -> dict:
    if isinstance(label, (int, float)):
        return {"num": float(label), "str": None}
    return {"num": None, "str": label}


@udtf(
    returnType="rule_no: int, kind: string, column: string, "
    "labels: array<struct<num:double,str:string>>, stops: array<double>"
)
class StyleRules:
    """Rules of one style document. Expressions nest to any depth, hence Python."""

    def eval(self, text: str):
        number = 0
        for layer in json.loads(text).get("layers", []):
            for part in ("paint", "layout", "filter"):
                for kind, column, labels, stops in _style_rules(layer.get(part)):
                    yield number, kind, column, [_typed(v) for v in labels], stops
                    number += 1


def style_rules(docs: DataFrame) -> DataFrame:
    """docs(style, text) to rule rows."""
    return docs.lateralJoin(StyleRules(F.col("text").outer())).drop("text")
