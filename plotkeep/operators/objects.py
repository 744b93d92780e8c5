"""Which staged objects differ from the published ones, and which must not be replaced."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotkeep.functions.clean import content_type, is_archive_key, is_data_object, object_key


def staged_objects(paths: DataFrame, prefix: str = "", data_only: bool = True) -> DataFrame:
    """Publishable files of a listing (path, ...) with their key and media type.

    The listing must name every file: Spark's own file sources skip paths that
    start with an underscore.
    """
    path = F.col("path")
    allowed = is_data_object(path) if data_only else ~path.rlike(r"(^|/)\.")
    return paths.where(allowed).withColumns({"key": object_key(prefix, path), "content_type": content_type(path)})


def changed_objects(staged: DataFrame, remote: DataFrame, force: bool = False) -> DataFrame:
    """staged(key, size, md5) against remote(key, size, etag).

    Adds ``status``, ``changed`` and ``verified``. A multipart etag (with a
    dash) is no digest: equal size then counts as unchanged but not verified.
    """
    listing = remote.select("key", F.col("size").alias("_rsize"), F.trim("etag", F.lit('"')).alias("_etag"))
    status = (
        F.when(F.col("_rsize").isNull(), "absent")
        .when(F.col("_rsize") != F.col("size"), "size")
        .when(F.col("_etag").contains("-"), "same_size")
        .when(F.col("_etag") == F.col("md5"), "same")
        .otherwise("digest")
    )
    return (
        staged.join(listing, "key", "left")
        .withColumn("status", status)
        .withColumn("changed", F.lit(force) | F.col("status").isin("absent", "size", "digest"))
        .withColumn("verified", F.col("status") == "same")
        .drop("_rsize", "_etag")
    )


def overwritten_archives(changed: DataFrame, remote: DataFrame) -> DataFrame:
    """Changed archive keys that already exist. Archives are written once.

    An empty listing cannot prove a key is new, so it refuses nothing.
    """
    return (
        changed.where(F.col("changed") & is_archive_key(F.col("key")))
        .join(remote.select("key"), "key", "left_semi")
        .select("key")
        .orderBy("key")
    )


def upload_phases(changed: DataFrame) -> DataFrame:
    """Phase 1 holds every archive, phase 2 the files that replace current ones."""
    return changed.where("changed").withColumn("phase", F.when(is_archive_key(F.col("key")), 1).otherwise(2))


def head_report(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The first ``n`` keys and one closing row saying how many more there are."""
    head = df.select(F.col(key).cast("string").alias("entry"), F.lit(None).cast("long").alias("more"))
    rest = df.agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).alias("more")).select(
        F.lit(None).cast("string").alias("entry"), F.col("more").cast("long")
    )
    return head.orderBy("entry").limit(n).unionByName(rest.where("more > 0"))
