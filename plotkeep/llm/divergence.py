"""Source divergence audit: how far the word distributions of a language's sources lie apart, and which terms mark each.

Each kept term of a language is a row of counts, one per source, most of them
zero. With every count at zero two sources differ by a known amount; each
nonzero count corrects it alone, and each two nonzero counts of one term
correct it together. The joint corrections come from a frequent-pattern tree:
rows are written as paths of (source, count) in one order of sources, those
with most terms first, equal paths once with their multiplicity, and paths that
begin alike share nodes. Every node is corrected against each of its ancestors
once, however many terms pass through it. Paths are sorted, so those that begin
alike lie side by side; a task makes a tree of each batch of them and holds one
level's combinations at a time.

All figures are integers. Terms that too few documents of a language hold are
left out; what is kept counts in full.

Cases: null texts, languages and sources are empty strings; sources without
terms and languages without kept terms have their pairs, at 0 if the language
keeps none; a language with one source has no pairs; repeated rows count each;
ties rank by name in byte order; an empty table gives no rows; extra columns do
not matter; memory in a task follows the longest text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plotkeep.llm.scratch import kept
from plotkeep.llm.text import slices

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
MIN_DOCS = 10
TOP_TERMS = 10
# Terms that a task counts before it hands them on, and combinations of a node and an ancestor it corrects at once.
OPEN_TERMS = 400_000
OPEN_COMBINATIONS = 1 << 20


# What ends a term becomes a blank, A-Z become a-z; bytes of other characters stay, so a term's bytes are its UTF-8 form.
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _counted(batches) -> Iterator[pa.RecordBatch]:
    """Counts of terms per language and source, handed on when ``OPEN_TERMS`` are held."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs) in groups.items():
            n = len(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()),
                 pa.array(counts.keys(), pa.binary()).cast(pa.string()),
                 pa.array(counts.values(), pa.int64()), pa.array([docs[t] for t in counts], pa.int64())],
                ["lang", "source", "term", "count", "docs"])
        groups.clear()

    held = 0
    for batch, texts in slices(batches, "text"):
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
            counts, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            terms = text.encode("utf-8").translate(_CLEAN).split()
            held -= len(counts)
            counts.update(terms)
            docs.update(set(terms))
            held += len(counts)
            if held >= OPEN_TERMS:
                yield from out()
                held = 0
    yield from out()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs): occurrences, and documents that hold the term."""
    rows = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")
    counted = rows.mapInArrow(_counted, "lang string, source string, term string, count long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def scaled_share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exact for counts of 18 digits."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(18,0)")
    below = (total + 2 * terms).cast("decimal(19,0)")
    return 1 + F.call_function("div", above, below)


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def tree_sums(
    langs: np.ndarray, starts: np.ndarray, nodes: tuple[np.ndarray, np.ndarray, np.ndarray], times: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Joint corrections summed over a tree of sorted paths: language, two source places, value.

    Path k has the elements ``starts[k]`` to before ``starts[k + 1]`` of ``nodes``: source places, shares,
    and shares of a zero count; it stands for ``times[k]`` terms.
    """
    place, share, zero = nodes
    begin, depth = starts[:-1], np.diff(starts)
    # how many elements a path shares with the one before
    shared, alike = np.zeros(len(begin), np.int64), np.flatnonzero(langs[1:] == langs[:-1]) + 1
    for level in range(int(depth.max(initial=0))):
        alike = alike[(depth[alike] > level) & (depth[alike - 1] > level)]
        here, last = begin[alike] + level, begin[alike - 1] + level
        alike = alike[(place[here] == place[last]) & (share[here] == share[last])]
        shared[alike] = level + 1
    before = np.concatenate([[0], np.cumsum(times)])
    for level in range(1, int(depth.max(initial=0))):
        # a node of this depth begins where a path departs at or above it, and reaches up to the next departure
        departs = np.flatnonzero(shared <= level)
        until = np.append(departs[1:], len(begin))
        is_node = depth[departs] > level
        paths, through = departs[is_node], before[until[is_node]] - before[departs[is_node]]
        for at in range(0, len(paths), max(1, OPEN_COMBINATIONS // level)):
            some, many = paths[at:at + max(1, OPEN_COMBINATIONS // level)], through[at:at + max(1, OPEN_COMBINATIONS // level)]
            above = begin[some][:, None] + np.arange(level)
            own = begin[some] + level
            p, p0, q, q0 = share[above], zero[above], share[own][:, None], zero[own][:, None]
            joint = (_difference(p, q) - _difference(p, q0) - _difference(p0, q) + _difference(p0, q0)) * many[:, None]
            one, two = place[above].ravel(), np.repeat(place[own], level)
            lang, value = np.repeat(langs[some], level), joint.ravel()
            order = np.lexsort((two, one, lang))
            lang, one, two, value = lang[order], one[order], two[order], value[order]
            new = np.flatnonzero(np.concatenate(
                ([True], (lang[1:] != lang[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1]))))
            yield lang[new], one[new], two[new], np.add.reduceat(value, new)


def _walked(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        path = batch.column("path")
        nodes = tuple(path.values.field(name).to_numpy().astype(np.int64) for name in ("place", "share", "zero"))
        coded = batch.column("lang").dictionary_encode()
        sums = tree_sums(coded.indices.to_numpy(), path.offsets.to_numpy().astype(np.int64), nodes, batch.column("times").to_numpy())
        for lang, one, two, value in sums:
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.take(pa.array(lang)), pa.array(one.astype(np.int32)), pa.array(two.astype(np.int32)), pa.array(value)],
                ["lang", "one", "two", "value"])


def joint_corrections(rows: DataFrame) -> DataFrame:
    """(lang, one, two, value) summed over the path tree. ``rows`` has (lang, term, place, share, zero) per nonzero count."""
    node = F.struct("place", "share", "zero")
    paths = rows.groupBy("lang", "term").agg(F.sort_array(F.collect_list(node)).alias("path")).where(F.size("path") > 1)
    paths = paths.groupBy("lang", "path").agg(F.count("*").alias("times"))
    # written, as the ranges are found by a first pass over the rows
    paths = kept(paths, "paths").repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    walked = paths.mapInArrow(_walked, "lang string, one int, two int, value long")
    return walked.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (text, lang, source).

    Part ``pair``: every other source of the language and the difference to it, ranked. Part
    ``term``: the ``TOP_TERMS`` terms that a source has most above its language.
    """
    counts = kept(term_counts(docs), "terms")
    named = kept(counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"))
                 .where(F.col("docs") >= MIN_DOCS).drop("docs"), "kept-terms")
    langs = named.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("count").alias("lang_total"))
    counts = kept(counts.join(named.select("lang", "term", F.col("count").alias("lang_count")), ["lang", "term"])
                  .select("lang", "source", "term", "count", "lang_count"), "kept-counts")
    present = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    sums = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count("*").alias("nonzero"))
    sources = present.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    by_size = Window.partitionBy("lang").orderBy(F.col("nonzero").desc(), "source")
    zero = F.when(F.col("terms") > 0, scaled_share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(1)
    sources = kept(sources.select("*", F.row_number().over(by_size).alias("place"), zero.alias("zero")), "sources")

    rows = counts.join(sources, ["lang", "source"])
    rows = rows.withColumn("share", scaled_share(F.col("count"), F.col("total"), F.col("terms")))
    rows = kept(rows.select(
        "lang", "source", "term", "place", "zero", "share",
        scaled_share(F.col("lang_count"), F.col("lang_total"), F.col("terms")).alias("lang_share")), "rows")

    joint = joint_corrections(rows)
    # a nonzero count corrects its source alone against every other source; equal shares of a source count together
    other = sources.select("lang", F.col("source").alias("item"), F.col("place").alias("other"), F.col("zero").alias("other_zero"))
    equal = rows.groupBy("lang", "place", "zero", "share").agg(F.count("*").alias("times"))
    alone = equal.join(other, "lang").where(F.col("other") != F.col("place")).groupBy("lang", "place", "other").agg(
        F.sum((difference(F.col("share"), F.col("other_zero")) - difference(F.col("zero"), F.col("other_zero"))) * F.col("times")).alias("value"))
    either = [F.least("place", "other").alias("one"), F.greatest("place", "other").alias("two")]
    corrections = alone.select("lang", *either, "value").unionByName(joint).groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))

    pairs = sources.join(other, "lang").where(F.col("other") != F.col("place")).select("lang", "source", "item", "zero", "other_zero", "terms", *either)
    none = difference(F.col("zero"), F.col("other_zero")) * F.col("terms")
    pairs = pairs.join(corrections, ["lang", "one", "two"], "left").select(
        "lang", "source", F.lit("pair").alias("part"), "item", (none + F.coalesce("value", F.lit(0))).cast("long").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    above = rows.where(F.col("share") > F.col("lang_share")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        difference(F.col("share"), F.col("lang_share")).alias("value"))
    # a limit on the rank is applied in every task before rows of a group meet
    terms = above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP_TERMS)
    return pairs.unionByName(terms)
