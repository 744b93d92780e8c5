"""SimHash fingerprints of documents and the search for near ones.

The terms of a text are its pairs of neighbouring words (a lone word is its own
term); a term weighs as often as it occurs. Each of the 64 bits of a term's
hash votes with that weight for or against the bit of the fingerprint. Near
fingerprints are found in block tables: the bits are cut into blocks, every
table permutes another choice of blocks to the front and is keyed by them, and
the choice is wide enough that two fingerprints within the radius agree in one
table at least.

Cases: null and empty texts have no votes and the fingerprint 0; equal texts
have equal fingerprints; a text's next one is by ascending doc_id (null first),
then by text, and the last is followed by the first; extra columns do not matter.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotkeep.llm.scratch import kept
from plotkeep.llm.text import SLICE_BYTES, U64, mix, word_hashes

BITS = 64
RADIUS = 3
# Blocks of a fingerprint; RADIUS differing bits leave BLOCKS - RADIUS blocks equal.
BLOCKS = 6


def fingerprints(texts: list[str]) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    words, owner = word_hashes([t.encode("utf-8", "replace") for t in texts])
    n = len(texts)
    if not len(words):
        return np.zeros(n, U64)
    with np.errstate(over="ignore"):
        pairs = mix(words[:-1] * U64(0x9E3779B97F4A7C15) + words[1:])
    inside = owner[1:] == owner[:-1]
    count = np.bincount(owner, minlength=n)
    lone = np.flatnonzero(count[owner] == 1)
    terms = np.concatenate([pairs[inside], mix(words[lone])])
    at = np.concatenate([owner[1:][inside], owner[lone]])
    order = np.argsort(at, kind="stable")
    terms, at = terms[order], at[order]
    votes = np.zeros((n, BITS), np.int64)
    step = 1 << 16
    for a in range(0, len(terms), step):
        part, own = terms[a:a + step], at[a:a + step]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        edges = np.flatnonzero(np.diff(own, prepend=-1))
        ones = np.add.reduceat(bits, edges, axis=0, dtype=np.int64)
        size = np.diff(np.append(edges, len(own)))
        votes[own[edges]] += 2 * ones - size[:, None]
    return np.packbits(votes > 0, axis=1, bitorder="little").view("<u8").ravel().astype(U64)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bits."""
    return 1.0 - np.bitwise_count(a ^ b) / BITS


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as many of the first characters of the following text."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "near_edited", "near_next"]
_RESULT = "doc_id long, n_chars long, edited_sha256 string, fp long, edited_fp long, near_edited double, near_next double"


def _compare(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
    """Result columns of texts whose following texts are known."""
    changed = [edited(a, b) for a, b in zip(texts, following)]
    prints = fingerprints([*texts, *changed])
    own, other = prints[: len(texts)], prints[len(texts):]
    # the following text is mostly the next of these; the last one's is fingerprinted here
    after = np.append(own[1:], fingerprints(following[-1:])) if texts else own
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed]),
        pa.array(own.view(np.int64)), pa.array(other.view(np.int64)),
        pa.array(likeness(own, other)), pa.array(likeness(own, after)),
    ]


def _runs(batches):
    """(ids, texts) of about SLICE_BYTES, in order."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids.append(i)
            texts.append(t or "")
            size += len(texts[-1])
            if size > SLICE_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def with_edits(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next) of every row.

    The texts are sorted into ranges once. A range compares its texts with their
    next ones; the last of a range and the first of the following range meet in
    a second step, on a text or two per range.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = _RESULT + ", part int, kind string, text string"

    def compare(batches):
        part = TaskContext.get().partitionId()

        def batch_of(columns, kind, texts=None):
            n = len(columns[0])
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array([part] * n, pa.int32()), pa.array([kind] * n), pa.array(texts or [None] * n, pa.string())],
                [*_COLUMNS, "part", "kind", "text"])

        def edge(doc_id, kind, text):
            empty = [pa.array([None], t) for t in (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
            return batch_of([pa.array([doc_id], pa.int64()), *empty], kind, [text])

        last = None
        for ids, texts in _runs(batches):
            if last is None:
                yield edge(ids[0], "first", texts[0])
            else:
                ids, texts = [last[0], *ids], [last[1], *texts]
            last = ids[-1], texts[-1]
            if len(ids) > 1:
                yield batch_of(_compare(ids[:-1], texts[:-1], texts[1:]), "row")
        if last is not None:
            yield edge(last[0], "last", last[1])

    ranges = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(parts, "doc_id")
    done = kept(ranges.sortWithinPartitions("doc_id", "text").mapInArrow(compare, schema), "simhash")

    numbers = sorted(r.part for r in done.where("kind = 'first'").select("part").collect())  # one per range
    follows = spark.createDataFrame(list(zip(numbers, numbers[1:] + numbers[:1])), "part int, next int")
    edges = (
        done.where("kind = 'last'").select("doc_id", "text", "part").join(F.broadcast(follows), "part")
        .join(done.where("kind = 'first'").select(F.col("part").alias("next"), F.col("text").alias("following")), "next")
    )

    def finish(batches):
        for batch in batches:
            for i, text, after in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following"))):
                yield pa.RecordBatch.from_arrays(_compare([i], [text or ""], [after or ""]), _COLUMNS)

    rest = edges.select("doc_id", "text", "following").mapInArrow(finish, _RESULT)
    return done.where("kind = 'row'").select(*_COLUMNS).union(rest)


def block_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """The bits that key each table: every choice of ``blocks - radius`` blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(choice) for choice in combinations(masks, blocks - radius)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_pairs(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(q, fp, times): each fingerprint of ``queries`` with each of ``prints`` (fp, times) within the radius, itself included.

    One row per pair of fingerprints, however many documents have them.
    """
    masks = block_masks(radius, blocks)

    def keyed(df, name):
        entries = F.array(*[F.struct(F.lit(k).alias("table"), F.col(name).bitwiseAND(F.lit(_signed(m))).alias("key"))
                            for k, m in enumerate(masks)])
        return df.withColumn("e", F.explode(entries)).select(*df.columns, "e.table", "e.key")

    left = keyed(queries.select(F.col("fp").alias("q")).distinct(), "q")
    right = keyed(prints.select("fp", "times"), "fp")
    differ = F.col("q").bitwiseXOR(F.col("fp"))
    # a pair counts in the first table that shows it
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(_signed(m))) == 0, F.lit(k)) for k, m in enumerate(masks)])
    met = left.join(right, ["table", "key"]).where((F.bit_count(differ) <= radius) & (first == F.col("table")))
    return met.select("q", "fp", "times")


def near_counts(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(fp, near): for each fingerprint of ``queries``, the rows of ``prints`` (fp, times) within the radius, itself included."""
    return near_pairs(prints, queries, radius, blocks).groupBy("q").agg(F.sum("times").alias("near")).withColumnRenamed("q", "fp")
