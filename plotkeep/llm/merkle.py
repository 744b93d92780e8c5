"""Merkle fixity audit of archive replicas.

Records are hashed where they lie: by archive, offset and length. Consecutive
offset ranges of an archive form the lowest nodes of its tree and ``FANOUT``
neighbouring nodes one node above, up to the root. Two replicas are compared at
the roots; only children of nodes that differ are compared further, down to
the records.

Cases: a null text is an empty record body; repeated records lie one after the
other and are separate; an archive that one side lacks is lost or added with all
its records; empty tables have no roots and no damage; extra columns do not
matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotkeep.llm.scratch import kept

RANGE_BYTES = 1 << 16
FANOUT = 64
# Levels of ranges above the records: the last covers 256 MiB, all of it is the root.
LEVELS = 3
# Records of an archive file, by ascending id.
ARCHIVE_IDS = 1000


def warc_record(url: Column, body: Column) -> Column:
    """The bytes of a WARC resource record."""
    body = F.coalesce(body, F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def laid_out(pages: DataFrame, record: Column, **carried: Column) -> DataFrame:
    """(archive, offset, length, page_id, digest and what is ``carried``): records in archives, in order of page_id.

    Bodies are hashed where they are read; only hashes and lengths are shuffled.
    """
    archive = F.floor(F.coalesce("page_id", F.lit(-1)) / ARCHIVE_IDS)
    sized = pages.select(
        archive.alias("archive"), F.octet_length(record).cast("long").alias("length"), "page_id", "url",
        F.sha2(record, 256).alias("digest"), *[column.alias(name) for name, column in carried.items()])
    order = Window.partitionBy("archive").orderBy("page_id", "url", "digest")
    before = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return sized.withColumn("offset", F.coalesce(before, F.lit(0).cast("long"))).drop("url")


def tree(leaves: DataFrame) -> list[DataFrame]:
    """Nodes (archive, node, hash) of each level, the lowest ranges first and the root (node 0) last."""
    def joined(df, *parts):
        text = F.concat_ws(":", *[F.col(p).cast("string") for p in parts])
        children = F.array_sort(F.collect_list(F.struct(parts[0], text.alias("text"))))
        return df.groupBy("archive", "node").agg(F.sha2(F.array_join(F.transform(children, lambda c: c["text"]), "\n"), 256).alias("hash"))

    levels = [kept(joined(leaves.withColumn("node", F.floor(F.col("offset") / RANGE_BYTES)), "offset", "length", "digest"), "nodes")]
    for _ in range(LEVELS - 1):
        below = levels[-1].withColumnRenamed("node", "child").withColumn("node", F.floor(F.col("child") / FANOUT))
        levels.append(joined(below, "child", "hash"))
    # what a long archive has left side by side is its root together
    levels.append(joined(levels[-1].withColumnRenamed("node", "child").withColumn("node", F.lit(0).cast("long")), "child", "hash"))
    return levels


def _differing(one: DataFrame, two: DataFrame) -> DataFrame:
    """Nodes whose hashes differ or that one side lacks."""
    two = two.withColumnRenamed("hash", "other")
    return one.join(two, ["archive", "node"], "full").where(~F.col("hash").eqNullSafe(F.col("other"))).select("archive", "node")


def audit(one: DataFrame, two: DataFrame) -> DataFrame:
    """(archive, offset, length, damage) of the records where replica ``two`` departs from ``one``.

    ``damage``: changed, lost (``two`` has no such record) or added.
    """
    first, second = tree(one), tree(two)
    bad = kept(_differing(first[-1], second[-1]), "differing")
    # node of the level above; the root is above all nodes of the last level
    for level in range(LEVELS - 1, -1, -1):
        above = F.lit(0).cast("long") if level == LEVELS - 1 else F.floor(F.col("node") / FANOUT)
        parents = bad.withColumnRenamed("node", "parent")
        below = [side[level].withColumn("parent", above).join(parents, ["archive", "parent"], "left_semi").drop("parent")
                 for side in (first, second)]
        bad = kept(_differing(*below), "differing")
    node = F.floor(F.col("offset") / RANGE_BYTES)
    left, right = (side.withColumn("node", node).join(bad, ["archive", "node"], "left_semi").drop("node") for side in (one, two))
    # records that share a place (of length 0, or in a damaged listing) are told apart by their order
    def numbered(df):
        return df.withColumn("again", F.row_number().over(Window.partitionBy("archive", "offset", "length").orderBy("digest")))

    met = numbered(left).join(
        numbered(right).withColumnRenamed("digest", "other"), ["archive", "offset", "length", "again"], "full")
    return met.where(~F.col("digest").eqNullSafe(F.col("other"))).select(
        "archive", "offset", "length",
        F.when(F.col("other").isNull(), "lost").when(F.col("digest").isNull(), "added").otherwise("changed").alias("damage"))
