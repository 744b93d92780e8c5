"""Which collections are due for a refresh, and why."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotkeep.functions.clean import iso_utc


def latest_known_edit(version_edit: Column, checked_edit: Column) -> Column:
    """The later of two dates; a missing one is skipped."""
    return F.greatest(version_edit, checked_edit)


def due_decisions(
    sources: DataFrame,
    probes: DataFrame,
    current: DataFrame,
    checks: DataFrame,
    now: datetime,
    force: bool = False,
) -> DataFrame:
    """(collection, due, reason) for all collections in one pass.

    sources(collection, min_days), probes(collection, data_last_edit),
    current(collection, created, source_updated) and
    checks(collection, source_updated) each hold one row per collection.
    A collection waits while its source has no newer edit, then until
    ``min_days`` after the current version, time of day included. One that was
    not probed is not due, forced or not, and says so.
    """
    joined = (
        sources.select("collection", "min_days")
        .join(probes.select("collection", "data_last_edit", F.lit(True).alias("_probed")), "collection", "left")
        .join(
            current.select("collection", "created", F.col("source_updated").alias("_version_edit")),
            "collection", "left",
        )
        .join(checks.select("collection", F.col("source_updated").alias("_checked_edit")), "collection", "left")
    )
    edit, created = F.col("data_last_edit"), F.col("created")
    known = latest_known_edit(F.col("_version_edit"), F.col("_checked_edit"))
    next_due = created + F.make_dt_interval(F.col("min_days"))
    edited = F.concat(F.lit("source edited "), iso_utc(edit))
    unchanged = known.isNotNull() & (edit <= known)
    waiting = F.lit(now) < next_due
    probed = F.col("_probed").isNotNull()
    due = F.when(~probed, False).when(created.isNull(), True).when(unchanged | waiting, False).otherwise(True)
    reason = (
        F.when(~probed, F.lit("no probe"))
        .when(created.isNull(), F.lit("no version yet"))
        .when(unchanged, F.concat(F.lit("source unchanged since "), iso_utc(known)))
        .when(
            waiting,
            F.concat(
                edited, F.lit(", but the current version is "), F.date_format(created, "yyyy-MM-dd"),
                F.lit("; next due "), F.date_format(next_due, "yyyy-MM-dd"),
            ),
        )
        .otherwise(edited)
    )
    if force:
        due, reason = probed, F.concat(F.lit("forced; "), reason)
    return joined.select("collection", due.alias("due"), reason.alias("reason"))


def unknown_collections(requested: DataFrame, sources: DataFrame) -> DataFrame:
    """Requested ids the registry does not have."""
    return requested.select("collection").distinct().join(sources, "collection", "left_anti")


def upsert_checks(checks: DataFrame, updates: DataFrame) -> DataFrame:
    """Keyed upsert: the update replaces the stored row of its collection."""
    return checks.join(updates.select("collection"), "collection", "left_anti").unionByName(updates)


def drop_checks(checks: DataFrame, refreshed: DataFrame) -> DataFrame:
    """A new version makes the stored check of its collection obsolete."""
    return checks.join(refreshed.select("collection"), "collection", "left_anti")
