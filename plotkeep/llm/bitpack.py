"""Token ids in files of fixed bit width.

An image holds the ids of some whole documents in order: a header, the table of
documents, the byte offsets of the blocks, and the blocks, each of ``BLOCK`` ids
at the least width that holds the vocabulary. Any run of ids is read by
unpacking only its blocks. Images are rows of a Parquet table, so Spark's own
writer commits them and lost executors leave nothing half written.

Cases: a null or empty text is its end id; documents are in ascending doc_id
order (null first), equal ids in the order of their texts; an empty table gives
no images; extra columns do not matter.
"""

from __future__ import annotations

import struct
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotkeep.llm.scratch import kept
from plotkeep.llm.text import slices
from plotkeep.llm.tokens import encoder as encoder_of

MAGIC = b"TOKBITS1"
HEADER = "<8sIIQQQ"  # magic, width, block, first id in the shard, ids, documents
BLOCK = 4096
IMAGE_IDS = 1 << 19


def width_of(vocabulary_size: int) -> int:
    """Least bits for every id below the size."""
    return max(1, (vocabulary_size - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """Ids at ``width`` bits each, lowest bit first."""
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, width: int, start: int, count: int) -> np.ndarray:
    """``count`` ids from place ``start`` of packed data."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", count, start * width // 8).astype(np.uint32)
    at = (start + np.arange(count, dtype=np.int64)) * width
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(8, np.uint8)])
    window = raw[(at >> 3)[:, None] + np.arange(8)].copy().view("<u8").ravel()
    return ((window >> (at & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.uint32)


def write_image(doc_ids: list, ids: list[np.ndarray], width: int, first: int) -> bytes:
    flat = np.concatenate(ids) if ids else np.empty(0, np.uint32)
    ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
    blocks = [pack_bits(flat[a:a + BLOCK], width) for a in range(0, len(flat), BLOCK)]
    offsets = np.cumsum([0] + [len(b) for b in blocks], dtype=np.int64)
    return b"".join([
        struct.pack(HEADER, MAGIC, width, BLOCK, first, len(flat), len(ids)),
        np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
        np.array([i is None for i in doc_ids], np.uint8).tobytes(),
        ends.astype("<i8").tobytes(),
        offsets.astype("<i8").tobytes(),
        *blocks,
    ])


class Image:
    """Random access to the ids of one image."""

    def __init__(self, data: bytes):
        magic, self.width, self.block, self.first, self.n_ids, n = struct.unpack_from(HEADER, data)
        if magic != MAGIC:
            raise ValueError("not a token image")
        at = struct.calcsize(HEADER)
        raw = np.frombuffer(data, "<i8", n, at)
        at += 8 * n
        null = np.frombuffer(data, np.uint8, n, at)
        at += n
        self.doc_ids = [None if x else int(i) for i, x in zip(raw, null)]
        self.ends = np.frombuffer(data, "<i8", n, at)
        at += 8 * n
        blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(data, "<i8", blocks + 1, at)
        self.data, self.payload = data, at + 8 * (blocks + 1)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to before ``stop``, from the blocks that hold them."""
        if start >= stop:
            return np.empty(0, np.uint32)
        low, high = start // self.block, (stop - 1) // self.block
        # full blocks lie end to end without spare bits, so a run of blocks unpacks as one
        part = self.data[self.payload + self.offsets[low]:self.payload + self.offsets[high + 1]]
        return unpack_bits(part, self.width, start - low * self.block, stop - start)

    def documents(self):
        """(doc_id, start in the shard, ids) of each document."""
        for i, stop in enumerate(self.ends.tolist()):
            start = int(self.ends[i - 1]) if i else 0
            yield self.doc_ids[i], self.first + start, self.read(start, stop)


def write_images(docs: DataFrame, vocabulary: str, end_id: int, shards: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write them as images: (shard, part, n_ids, image), read back from the files."""
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        encoder = encoder_of(vocabulary)
        width, shard = width_of(max(encoder.size, end_id + 1)), TaskContext.get().partitionId()
        doc_ids, ids, n, first, part = [], [], 0, 0, 0

        def image():
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([part], pa.int64()), pa.array([n], pa.int64()),
                 pa.array([write_image(doc_ids, ids, width, first)], pa.binary())],
                ["shard", "part", "n_ids", "image"])

        for batch, texts in slices(batches, "text"):
            for doc, found in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                doc_ids.append(doc)
                ids.append(np.append(found, np.uint32(end_id)))
                n += len(ids[-1])
                if n >= IMAGE_IDS:
                    yield image()
                    doc_ids, ids, n, first, part = [], [], 0, first + n, part + 1
        if ids:
            yield image()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(shards, "doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    return kept(ordered.mapInArrow(run, "shard int, part long, n_ids long, image binary"), "tokens")


def read_images(images: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the images; start counts all ids before it."""
    totals = sorted((r.shard, r.n) for r in images.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())  # one per shard
    base = list(accumulate([n for _, n in totals], initial=0))
    bases = images.sparkSession.createDataFrame([(s, b) for (s, _), b in zip(totals, base)], "shard int, base long")

    def run(batches):
        for batch in batches:
            for shard, data in zip(batch.column("shard").to_pylist(), batch.column("image")):
                rows = [(d, s, len(x), zlib.crc32(x.astype("<u4").tobytes())) for d, s, x in Image(data.as_py()).documents()]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(rows), pa.int32()), *columns], ["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    found = images.select("shard", "image").mapInArrow(
        run, "shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return found.join(F.broadcast(bases), "shard").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")
