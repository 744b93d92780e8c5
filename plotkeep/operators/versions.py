"""Version records: labels, the current/archive chain, as-of lookup.

A record is (collection, version, created, source_updated, ...). Labels are a
UTC day, with ``-2``, ``-3`` ... for further runs on that day.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MANIFEST_SCHEMA = (
    "collection string, version string, version_day date, version_seq int, "
    "created timestamp, source_updated timestamp, row_count bigint, content_hash string, "
    "repaired_geometries bigint, null_geometries bigint, file_size bigint, file_checksum string, "
    "path string, run string, unrepaired_geometries bigint, "
    "columns array<struct<name:string,type:string>>, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>"
)


def label_day(version: Column) -> Column:
    return F.to_date(F.substring(version, 1, 10))


def label_seq(version: Column) -> Column:
    """1 for a bare day. Sorting by number puts run 10 after run 2."""
    return F.coalesce(F.substr(version, F.lit(12)).try_cast("int"), F.lit(1))


def make_label(day: Column, seq: Column) -> Column:
    text = day.cast("string")
    return F.when(seq == 1, text).otherwise(F.concat(text, F.lit("-"), seq.cast("string")))


def with_version_order(df: DataFrame) -> DataFrame:
    v = F.col("version")
    return df.withColumns({"version_day": label_day(v), "version_seq": label_seq(v)})


def next_labels(taken: DataFrame, wanted: DataFrame) -> DataFrame:
    """Lowest free label per wanted (collection, day).

    A free number is 1, or follows a taken one. Candidates are anti-joined on
    the whole (collection, day, number), so no collection forms a group that
    must sit in one task.
    """
    used = with_version_order(taken).select("collection", F.col("version_day").alias("day"), "version_seq").distinct()
    wanted = wanted.select("collection", "day").distinct()
    first = wanted.withColumn("version_seq", F.lit(1))
    following = used.join(wanted, ["collection", "day"], "left_semi").withColumn(
        "version_seq", F.col("version_seq") + 1
    )
    return (
        first.unionByName(following)
        .join(used, ["collection", "day", "version_seq"], "left_anti")
        .groupBy("collection", "day")
        .agg(F.min("version_seq").alias("version_seq"))
        .withColumn("version", make_label(F.col("day"), F.col("version_seq")))
    )


def newest(versions: DataFrame) -> DataFrame:
    """The newest version record of each collection."""
    order = F.struct("version_day", "version_seq")
    rest = F.struct(*[c for c in versions.columns if c != "collection"])
    return (
        versions.groupBy("collection").agg(F.max_by(rest, order).alias("r")).select("collection", "r.*")
    )


def version_chain(versions: DataFrame, root: str) -> DataFrame:
    """Every version with its role and path: the newest is data, the others archives.

    The newest is matched on its full key, which is unique, so a collection
    with very many versions does not skew the join.
    """
    ordered = with_version_order(versions)
    key = ["collection", "version_day", "version_seq"]
    latest = ordered.groupBy("collection").agg(F.max(F.struct("version_day", "version_seq")).alias("v"))
    latest = latest.select("collection", "v.version_day", "v.version_seq", F.lit(True).alias("_latest"))
    base = F.concat(F.lit(f"{root}/"), F.col("collection"))
    is_latest = F.coalesce(F.col("_latest"), F.lit(False))
    return (
        ordered.join(latest, key, "left")
        .withColumn("role", F.when(is_latest, "data").otherwise("archive"))
        .withColumn(
            "href",
            F.when(is_latest, F.concat(base, F.lit("/"), F.col("collection"), F.lit(".parquet"))).otherwise(
                F.concat(base, F.lit("/versions/"), F.col("version"), F.lit(".parquet"))
            ),
        )
        .drop("_latest")
    )


def add_versions(manifest: DataFrame, new: DataFrame) -> DataFrame:
    """Append version records. A label that is recorded already, or twice in ``new``, is an error, not a replacement.

    The test runs when this is called, so no later projection can prune it away.
    """
    key = ["collection", "version"]
    recorded = new.select(*key).join(manifest.select(*key), key, "left_semi")
    repeated = new.groupBy(*key).count().where("count > 1").select(*key)
    clash = recorded.union(repeated).first()
    if clash is not None:
        raise ValueError(f"version already recorded: {clash.collection} {clash.version}")
    return manifest.unionByName(new.select(*manifest.columns))


def temporal_extent(versions: DataFrame) -> DataFrame:
    """First and last edit per collection; the extract time stands in for an unknown edit."""
    known = F.coalesce("source_updated", "created")
    return versions.groupBy("collection").agg(F.min(known).alias("extent_start"), F.max(known).alias("extent_end"))


def stamp_check(collections: DataFrame, stored: DataFrame) -> DataFrame:
    """(stored, newest, needs_stamp): the root carries the newest ``updated`` of any collection.

    Stamping twice changes nothing.
    """
    none = F.lit(None).cast("string")
    both = collections.select(F.col("updated").alias("newest"), none.alias("stored")).unionByName(
        stored.select(none.alias("newest"), F.col("updated").alias("stored"))
    )
    needs = F.col("newest").isNotNull() & ~F.col("stored").eqNullSafe(F.col("newest"))
    return both.agg(F.max("stored").alias("stored"), F.max("newest").alias("newest")).withColumn("needs_stamp", needs)


def as_of(versions: DataFrame, moment: datetime | Column) -> DataFrame:
    """The version of each collection a reader saw at a moment."""
    at = moment if isinstance(moment, Column) else F.lit(moment)
    return newest(with_version_order(versions).where(F.col("created") <= at))
