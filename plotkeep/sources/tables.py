"""Versioned Parquet collections: write-once version folders and an append-only manifest.

Layout under a root that all executors share:

    <root>/<collection>/versions/<run>/     what one run wrote, never rewritten
    <root>/manifest/                        one row per version
    <root>/checks/                          one row per no-op check

The current version is the newest manifest row, so a version becomes visible
in one append and a failed run leaves nothing that a reader could see. The
layout assumes one writer at a time, as the refresh itself does.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotkeep.functions.clean import md5_hex, multihash
from plotkeep.functions.hashing import hash_sum
from plotkeep.operators.versions import MANIFEST_SCHEMA, as_of, newest, with_version_order

CHECKS_SCHEMA = "collection string, source_updated timestamp, checked timestamp"
STAMP_SCHEMA = "updated string"


def version_path(root: str, collection: str, run: str) -> str:
    """Named by run and not by label, so that a refused run blocks no label."""
    return f"{root}/{collection}/versions/{run}"


def write_table(df: DataFrame, path: str) -> None:
    """zstd Parquet; an existing path is an error."""
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)


def _read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return _read_or_empty(spark, f"{root}/manifest", MANIFEST_SCHEMA)


def read_stamps(spark: SparkSession, root: str) -> DataFrame:
    """(updated) of every stamp the root carried; the newest holds."""
    return _read_or_empty(spark, f"{root}/stamps", STAMP_SCHEMA)


def read_checks(spark: SparkSession, root: str) -> DataFrame:
    """The newest check of each collection. Checks older than its newest version are obsolete."""
    stored = _read_or_empty(spark, f"{root}/checks", CHECKS_SCHEMA)
    latest = stored.groupBy("collection").agg(
        F.max_by("source_updated", "checked").alias("source_updated"), F.max("checked").alias("checked")
    )
    created = newest(read_manifest(spark, root)).select("collection", "created")
    return latest.join(created, "collection", "left").where(
        F.col("created").isNull() | (F.col("checked") > F.col("created"))
    ).drop("created")


def append_rows(spark: SparkSession, rows: Sequence[tuple], schema: str, path: str) -> None:
    """Append a few control rows as one file, so they become visible together."""
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)


def _one_path(found: DataFrame, what: str) -> str:
    rows = found.select("path").take(2)
    if len(rows) != 1:
        raise ValueError(f"{what}: {len(rows)} matching versions")
    return rows[0][0]


def read_current(spark: SparkSession, root: str, collection: str, columns: Sequence[str] = ()) -> DataFrame:
    """The current version, projected; column pruning reaches the scan."""
    mine = read_manifest(spark, root).where(F.col("collection") == collection)
    df = spark.read.parquet(_one_path(newest(mine), collection))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, root: str) -> list[str]:
    """A temporary view per collection on its current version, for use from SQL."""
    names = []
    for row in newest(read_manifest(spark, root)).select("collection", "path").toLocalIterator():
        spark.read.parquet(row.path).createOrReplaceTempView(row.collection)
        names.append(row.collection)
    return sorted(names)


def read_version(spark: SparkSession, root: str, collection: str, label: str) -> DataFrame:
    """An earlier (or the current) version by label."""
    found = read_manifest(spark, root).where((F.col("collection") == collection) & (F.col("version") == label))
    return spark.read.parquet(_one_path(found, f"{collection} {label}"))


def read_as_of(spark: SparkSession, root: str, collection: str, moment: datetime) -> DataFrame:
    """The version a reader saw at a moment."""
    mine = read_manifest(spark, root).where(F.col("collection") == collection)
    return spark.read.parquet(_one_path(as_of(mine, moment), f"{collection} at {moment}"))


def file_digests(spark: SparkSession, *paths: str) -> DataFrame:
    """(folder, name, size, md5, multihash) of every data file below some paths.

    Each file is read whole by one task: part files must stay below 2 GiB.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.select(
        _version_folder(F.col("path")).alias("folder"),
        F.substring_index("path", "/", -1).alias("name"),
        F.col("length").alias("size"),
        md5_hex(F.col("content")).alias("md5"),
        multihash(F.col("content")).alias("multihash"),
    )


def _version_folder(path: Column) -> Column:
    """``<collection>/versions/<folder>``, the same for a folder and the files in it."""
    return F.regexp_extract(path, r"([^/]+/versions/[^/]+)(?:/[^/]*)?$", 1)


def folder_checksums(digests: DataFrame) -> DataFrame:
    """(folder, file_size, file_checksum) of folders of part files.

    The checksum is the file count and four sums over slices of the sha-256 of
    each (name, multihash): it does not depend on listing order, and nothing
    is gathered in one place however many files there are.
    """
    sha = F.sha2(F.concat_ws(":", "name", "multihash"), 256)
    slices = [F.conv(F.substring(sha, 1 + 15 * i, 15), 16, 10).cast("long") for i in range(4)]
    return digests.groupBy("folder").agg(
        F.sum("size").alias("file_size"),
        F.concat_ws(":", F.count(F.lit(1)).cast("string"), *[hash_sum(s) for s in slices]).alias("file_checksum"),
    )


def archive_integrity(spark: SparkSession, root: str, versions: DataFrame) -> DataFrame:
    """Versions whose files no longer match the recorded checksum, all checked in one job."""
    recorded = versions.select("collection", "version", "file_checksum", _version_folder(F.col("path")).alias("folder"))
    found = folder_checksums(file_digests(spark, f"{root}/*/versions")).select(
        "folder", F.col("file_checksum").alias("found_checksum")
    )
    same = F.col("found_checksum").eqNullSafe(F.col("file_checksum"))
    return recorded.join(found, "folder", "left").where(~same).select("collection", "version")


def ordered_versions(spark: SparkSession, root: str, collection: str) -> DataFrame:
    """Every version, oldest first."""
    mine = read_manifest(spark, root).where(F.col("collection") == collection)
    return with_version_order(mine).orderBy("version_day", "version_seq")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it, in whatever store it lies. A missing one is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
