"""One refresh run over the collections that are due."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotkeep.functions import geometry as G
from plotkeep.functions import wkb as W
from plotkeep.functions.projection import mercator_to_lonlat
from plotkeep.operators.cluster import hilbert_sorted
from plotkeep.operators.content import content_hash
from plotkeep.operators.gates import sync_gate
from plotkeep.operators.legend import legend_drift
from plotkeep.operators.refresh import due_decisions
from plotkeep.operators.skew import dealt
from plotkeep.operators.validity import quality_counters, repair_geometries
from plotkeep.operators.versions import MANIFEST_SCHEMA, newest, next_labels, stamp_check
from plotkeep.session import cut_lineage
from plotkeep.sources import tables as S
from plotkeep.sources.pages import page_completeness

ROWS_PER_FILE = 1_000_000
REPORT_SCHEMA = "collection string, status string, detail string, version string, row_count bigint"


class Refused(Exception):
    """A gate stopped the collection."""


class StyleDrift(Refused):
    """The new rows break the collection's legend."""


@dataclass
class Extract:
    """What a source delivered for one collection."""

    collection: str
    rows: DataFrame
    id_col: str
    source_updated: datetime
    count_before: int
    count_after: int
    parts: str | None = None  # geometry column of spatial collections, as nested arrays
    geometry: str | None = None  # or as WKB, which is what gets published then
    web_mercator: bool = False  # the geometry still is in the service's projection
    rules: DataFrame | None = None
    pages: DataFrame | None = None  # the landed pages, if completeness is to be read from them


def _prepared(extract: Extract) -> tuple[DataFrame, DataFrame | None, list[str]]:
    """Decode, reproject, repair and cluster a spatial collection; others are taken as they are.

    Also the repaired rows with their flags, for the counts, and the folders to remove in the end. Attributes travel
    in a struct meanwhile, so no flag meets a column of the same name; ``bbox``
    is derived from the geometry and replaced. WKB keeps its bytes unless the
    shape was reprojected or repaired.
    """
    column = extract.geometry or extract.parts
    if column is None:
        return extract.rows, None, []
    names = [c for c in extract.rows.columns if c != "bbox"]
    attributes = F.struct(*[c for c in names if c != column])
    parts = W.from_wkb(F.col(column)) if extract.geometry else F.col(column)
    rows = dealt(extract.rows).select(attributes.alias("row"), F.col(column).alias("source"), parts.alias("parts"))
    if extract.web_mercator:
        rows = rows.withColumn("parts", G.map_points(F.col("parts"), mercator_to_lonlat))
    # every check names the shape many times; written down, it is decoded and projected once
    rows = cut_lineage(rows, "decoded")
    checked = repair_geometries(rows.withColumn("bbox", G.bbox(F.col("parts"))))
    # range partitioning reads its input twice, so the repair is written down first
    files = max(1, -(-extract.count_before // ROWS_PER_FILE))
    altered = F.lit(extract.geometry is None or extract.web_mercator) | (F.col("outcome") == "repaired")
    # and the bytes are made before it: the sorted rows are in few tasks
    shape = F.col("parts")
    if extract.geometry:
        shape = F.coalesce(W.to_wkb(F.when(altered, shape)), F.when(~altered, F.col("source")))
    checked = cut_lineage(checked.select(
        "row", shape.alias("shape"), "bbox", "outcome", F.col("row")[extract.id_col].alias("id")), "repaired")
    ordered = hilbert_sorted(checked, "id", partitions=files)
    published = [F.col("shape").alias(c) if c == column else F.col("row")[c].alias(c) for c in names]
    copies = [file.rsplit("/", 1)[0] for df in (rows, checked) for file in df.inputFiles()[:1]]
    return ordered.select(*published, "bbox"), checked, copies


def _content(extract: Extract, data: DataFrame) -> str:
    """Hash of the published rows, over canonical shapes."""
    if extract.geometry or extract.parts:
        data = dealt(data)  # a version has few files
    if extract.geometry:
        data = data.withColumn(extract.geometry, W.from_wkb(F.col(extract.geometry)))
    return content_hash(data, parts=extract.geometry or extract.parts).first().content_hash


def _extent(data: DataFrame):
    box = F.col("bbox")
    return data.agg(
        F.min(box.xmin).alias("xmin"), F.min(box.ymin).alias("ymin"), F.max(box.xmax).alias("xmax"), F.max(box.ymax).alias("ymax")
    ).first()


def _require_all_pages(extract: Extract) -> None:
    """Landed pages that leave gaps, overlap or do not end are refused, as is another number of rows than they hold."""
    name = extract.collection
    read = page_completeness(extract.pages.where(F.col("collection") == name)).first()
    if read is None or not read.complete:
        raise Refused(f"the landed pages of {name} are not one complete read")
    if read.row_count != extract.count_before:
        raise Refused(f"the landed pages hold {read.row_count} rows of {extract.count_before}")


def _checksum(spark: SparkSession, folder: str):
    return S.folder_checksums(S.file_digests(spark, folder)).first()


def refresh_one(spark: SparkSession, root: str, extract: Extract, now: datetime, run: str) -> tuple:
    """Stage, check and commit one collection. Returns its report row.

    A staged folder that no version refers to in the end is removed again, and
    so is the intermediate copy of a repair.

    The new rows are written first and every gate reads what was written.
    Nothing refers to the staged folder until the manifest row is appended,
    so a refused or failed run leaves the collection as it was. Counts and
    hashes come from the written files and not from task-side counters, which
    a rerun task would increase twice.
    """
    name = extract.collection
    manifest = S.read_manifest(spark, root).where(F.col("collection") == name)
    current = newest(manifest).first()
    staged = S.version_path(root, name, run)
    if extract.pages is not None:
        _require_all_pages(extract)
    rows, checked, copies = _prepared(extract)
    try:
        S.write_table(rows, staged)
        report = _commit(spark, root, extract, now, run, manifest, current, staged, checked)
    except Exception:
        S.remove_folder(spark, staged)
        raise
    finally:
        for folder in copies:
            S.remove_folder(spark, folder)
    if current is not None and report[3] == current.version:
        S.remove_folder(spark, staged)
    return report


def _commit(
    spark: SparkSession, root: str, extract: Extract, now: datetime, run: str, manifest: DataFrame, current,
    staged: str, checked: DataFrame | None,
) -> tuple:
    """The gates over what was staged, and the record of the new version."""
    name = extract.collection
    data = spark.read.parquet(staged)
    content = _content(extract, data)
    row_count = int(content.rsplit(":", 1)[1])
    if not (extract.count_before == extract.count_after == row_count):
        raise Refused(
            f"wrote {row_count} rows, the source reported {extract.count_before} before "
            f"and {extract.count_after} after; it changed during the extract"
        )
    if current is not None and content == current.content_hash:
        S.append_rows(spark, [(name, extract.source_updated, now)], S.CHECKS_SCHEMA, f"{root}/checks")
        return name, "ok", f"rows unchanged since version {current.version}", current.version, row_count

    if extract.rules is not None:
        previous = spark.read.parquet(current.path) if current is not None else None
        findings = f"{root}/findings/{name}/{run}"
        legend_drift(extract.rules, data, previous).withColumn("collection", F.lit(name)).write.parquet(findings)
        found = spark.read.parquet(findings).count()
        if found:
            raise StyleDrift(f"{found} legend findings, all in {findings}")
        S.remove_folder(spark, findings)

    # the outgoing version must still hold the bytes its record describes
    if current is not None and _checksum(spark, current.path).file_checksum != current.file_checksum:
        raise Refused(f"version {current.version} does not match its recorded checksum")

    wanted = spark.createDataFrame([(name, now.date())], "collection string, day date")
    label = next_labels(manifest, wanted).first()
    repaired = nulls = unrepaired = 0
    box = None
    if checked is not None:
        quality = quality_counters(checked).first()
        repaired, nulls, unrepaired = quality.repaired_geometries, quality.null_geometries, quality.unrepaired_geometries
        box = _extent(data)
    files = _checksum(spark, staged)
    record = (
        name, label.version, label.day, label.version_seq, now, extract.source_updated, row_count,
        content, repaired, nulls, files.file_size, files.file_checksum, staged, run,
        unrepaired, [(f.name, f.dataType.simpleString()) for f in data.schema], box,
    )
    S.append_rows(spark, [record], MANIFEST_SCHEMA, f"{root}/manifest")
    return name, "ok", f"version {label.version}: {row_count} rows", label.version, row_count


def _guarded(
    spark: SparkSession, root: str, collection: str, make: Callable[[], Extract], now: datetime, run: str
) -> tuple:
    """The report row of one collection, whatever happens to it."""
    try:
        return refresh_one(spark, root, make(), now, run)
    except StyleDrift as exc:
        return collection, "style", str(exc), None, None
    except Exception as exc:  # noqa: BLE001 - report and go on with the next collection
        return collection, "error", str(exc).split("\n")[0], None, None


def _require_sync(spark: SparkSession, root: str, published: DataFrame | None) -> None:
    if published is not None:
        ahead = sync_gate(published, S.read_manifest(spark, root)).count()
        if ahead:
            raise Refused(f"{ahead} published versions are not recorded under {root}")


def stamp(spark: SparkSession, root: str) -> bool:
    """Renew the root's stamp if a collection is newer than it; whether that was so."""
    moment = F.date_format("created", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    updated = newest(S.read_manifest(spark, root)).select(moment.alias("updated"))
    found = stamp_check(updated, S.read_stamps(spark, root)).first()
    if found.needs_stamp:
        S.append_rows(spark, [(found.newest,)], S.STAMP_SCHEMA, f"{root}/stamps")
    return found.needs_stamp


def refresh_all(
    spark: SparkSession, root: str, extracts: Sequence[Extract], now: datetime, run: str,
    published: DataFrame | None = None,
) -> DataFrame:
    """Refresh each collection on its own; one that fails does not stop the others.

    The loop runs over collections, the data of each is processed by Spark.
    With ``published`` (collection, version), nothing is begun unless every
    published version is recorded here; the root's stamp is renewed at the end.
    """
    _require_sync(spark, root, published)
    report = [_guarded(spark, root, e.collection, lambda e=e: e, now, run) for e in extracts]
    stamp(spark, root)
    return spark.createDataFrame(report, REPORT_SCHEMA)


def decide_due(
    spark: SparkSession, root: str, sources: DataFrame, probes: DataFrame, now: datetime, force: bool = False
) -> DataFrame:
    """Due decisions against the stored versions and checks."""
    return due_decisions(sources, probes, newest(S.read_manifest(spark, root)), S.read_checks(spark, root), now, force)


def run_due(
    spark: SparkSession, root: str, decisions: DataFrame, extract: Callable[[str], Extract], now: datetime, run: str,
    dry_run: bool = False, published: DataFrame | None = None,
) -> DataFrame:
    """One whole run: collections that are not due are reported as skipped, the others refreshed.

    ``extract`` is called only for due collections. A dry run reports them as due.
    ``published`` and the stamp are as in ``refresh_all``.
    """
    _require_sync(spark, root, published)
    report = []
    for row in decisions.orderBy("collection").toLocalIterator():
        if not row.due or dry_run:
            report.append((row.collection, "due" if row.due else "skipped", row.reason, None, None))
        else:
            report.append(_guarded(spark, root, row.collection, lambda: extract(row.collection), now, run))
    if not dry_run:
        stamp(spark, root)
    return spark.createDataFrame(report, REPORT_SCHEMA)
