"""Quality gates over metadata and prose. Each returns the findings; none means pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotkeep.functions import prose as P
from plotkeep.operators.skew import TARGET_ROWS, split_hot_keys

# Suffixes of data files that live outside the metadata tree.
LINK_DATA_SUFFIXES = (
    ".parquet", ".pmtiles", ".tif", ".tiff", ".copc.laz", ".laz", ".gpkg",
    ".zarr", ".geojsonl", ".shp", ".zip",
)


def sync_gate(published: DataFrame, known: DataFrame) -> DataFrame:
    """Published (collection, version) pairs the local records do not have.

    A collection that was never published (no version) is fine.
    """
    return published.where("version is not null").join(known, ["collection", "version"], "left_anti")


def _relative(links: DataFrame, light: bool) -> DataFrame:
    """Links into the tree. ``light`` exempts assets with a data suffix, whose bytes live elsewhere.

    What is an asset is told by ``source``, as ``document_links`` gives it; a link to a data file is no asset.
    """
    href = F.col("href")
    relative = links.where((href != "") & ~P.is_remote_link(href))
    if light and "source" in links.columns:
        is_data = reduce(or_, [F.lower(href).endswith(suffix) for suffix in LINK_DATA_SUFFIXES])
        is_asset = F.coalesce(F.col("source").startswith("asset "), F.lit(False))
        relative = relative.where(~(is_asset & is_data))
    return relative


def unresolved_links(links: DataFrame, inventory: DataFrame, light: bool = False) -> DataFrame:
    """(target, referring) of relative links without a file.

    links(doc_dir, href, and source where ``light`` is asked for), inventory(path). Links are reduced to distinct
    targets first, so one popular target is one row.
    """
    # resolve distinct (folder, link) pairs, not every occurrence
    pairs = _relative(links, light).groupBy("doc_dir", "href").agg(F.count(F.lit(1)).alias("_n"))
    targets = pairs.groupBy(P.resolve_path(F.col("doc_dir"), F.col("href")).alias("target")).agg(
        F.sum("_n").alias("referring")
    )
    return targets.join(inventory.select(F.col("path").alias("target")), "target", "left_anti")


def broken_references(
    links: DataFrame, inventory: DataFrame, doc_id: str, light: bool = False, target_rows: int = TARGET_ROWS
) -> DataFrame:
    """Every reference to a missing file: the columns of ``links`` and the target.

    A missing target that very many documents name is split over several tasks.
    """
    missing = unresolved_links(links, inventory, light).select("target")
    resolved = _relative(links, light).withColumn("target", P.resolve_path(F.col("doc_dir"), F.col("href")))
    resolved, missing, on = split_hot_keys(resolved, missing, ["target"], [doc_id, "href"], target_rows)
    return resolved.join(missing, on).drop("_salt")


def _located(line: Column, pattern: str) -> Column:
    """(start, value) of every match, from the lengths of the gaps between them."""
    values = F.regexp_extract_all(line, F.lit(pattern), F.lit(0))
    gaps = F.split(line, pattern, -1)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(values)), values, lambda g, v: F.struct(
        F.length(g).alias("gap"), v.alias("v")))
    empty = F.array().cast("array<struct<start:int,value:string>>")
    folded = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + F.length(s["v"])).alias("at"),
            F.concat(
                acc["out"], F.array(F.struct((acc["at"] + s["gap"]).alias("start"), s["v"].alias("value")))
            ).alias("out"),
        ),
    )
    return folded["out"]


def prose_numbers(
    docs: DataFrame, counts: DataFrame | None = None, allowed: Sequence[str] = P.ALLOWED_NUMBERS
) -> DataFrame:
    """(path, line, value) of data numbers quoted in docs(path, text).

    Reported are thousands-separated numbers and percentages outside the
    allow-list, and any recorded count (``counts.recorded``) written with or
    without separators. Recorded counts are matched by an equi-join on the
    number, so their number is not limited by a pattern.
    """
    lines = docs.select(
        "path", F.posexplode(F.split(P.blank_fences(F.col("text")), "\n")).alias("_pos", "_line")
    ).where(F.col("_line").rlike(r"(?U)\d"))
    claims = F.filter(_located(F.col("_line"), P.NUMBER), lambda h: ~h["value"].isin(list(allowed)))
    lines = lines.select("path", (F.col("_pos") + 1).cast("long").alias("line"), "_line", claims.alias("_claims"))
    found = lines.select("path", "line", F.inline("_claims")).select("path", "line", "value")
    if counts is None:
        return found
    starts = F.transform("_claims", lambda h: h["start"])
    tokens = F.filter(
        _located(F.col("_line"), P.COUNT_TOKEN), lambda t: ~F.array_contains(starts, t["start"])
    )
    copied = (
        lines.select("path", "line", F.inline(tokens))
        .withColumn("recorded", F.replace("value", F.lit(",")).try_cast("bigint"))
        .where((F.col("recorded") >= P.SMALLEST_COUNT) & ~F.col("value").rlike(r"^0"))
        .join(counts.select("recorded"), "recorded", "left_semi")
    )
    return found.unionByName(copied.select("path", "line", "value"))


def dated_claims(docs: DataFrame) -> DataFrame:
    """(path, line, claim, sentence) of dates that the next refresh makes wrong."""
    text = P.blank_fences(F.col("text"))
    return docs.select("path", F.inline(P.dated_claims(text)))


def declares_profile(docs: DataFrame, pattern: str) -> DataFrame:
    """Documents (id, extensions) whose extension list names a profile; a ``#`` ending is ignored."""
    uri = rf"^(?:{pattern})#*$"
    return docs.withColumn(
        "declares", F.coalesce(F.exists("extensions", lambda u: F.coalesce(u.rlike(uri), F.lit(False))), F.lit(False))
    )


def blocking_findings(findings: DataFrame, accepted: DataFrame) -> DataFrame:
    """Errors whose rule nobody has accepted. A finding without rule blocks."""
    return findings.where("severity = 'error'").join(accepted, "rule", "left_anti")
