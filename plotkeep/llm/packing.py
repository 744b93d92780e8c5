"""Cost-balanced packing of documents into sequences of a fixed number of tokens.

A sequence costs ``linear * tokens + quadratic * sum of squared piece lengths``
(attention stays inside a piece). Whole multiples of the sequence length are
cut from long documents; what remains is taken in descending length and goes to
the cheapest sequence with room for it. What fits nowhere whole is cut over the
room that is left. The last, partly filled sequence of a batch is made of
pieces of powers of two, which need no padding, so nothing is padded.

Every task packs the rows it reads, in batches of at most ``BATCH_TOKENS``, so
no text is shuffled. Sequence ids are the task's number and a running one.

Cases: a null or empty text is its end id alone; equal rows and repeated ids
are packed as separate documents; an empty table gives no rows; extra columns
do not matter.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from plotkeep.llm.text import slices
from plotkeep.llm.tokens import encoder as encoder_of

LENGTH = 1024
LINEAR, QUADRATIC = 1.0, 1.0 / 512
BATCH_TOKENS = 2_000_000
# Sequence ids of a task start at its number times this.
TASK_STEP = 1 << 40


class OpenSequences:
    """Sequences by room, with the cheapest one of any room from ``least`` up in logarithmic time."""

    def __init__(self, length: int, count: int):
        self.length = length
        self.leaves = 1 << length.bit_length()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(length + 1)]
        self.best: list[tuple[float, int] | None] = [None] * (2 * self.leaves)
        self.used = [0] * count
        self.heaps[length] = [(0.0, i) for i in range(count)]
        self._refresh(length)

    def _refresh(self, room: int) -> None:
        heap = self.heaps[room]
        at = self.leaves + room
        self.best[at] = heap[0] if heap else None
        at >>= 1
        while at:
            one, two = self.best[2 * at], self.best[2 * at + 1]
            self.best[at] = one if two is None or (one is not None and one <= two) else two
            at >>= 1

    def cheapest(self, least: int) -> tuple[float, int] | None:
        low, high, found = self.leaves + least, self.leaves + self.length + 1, None
        while low < high:
            if low & 1:
                if self.best[low] is not None and (found is None or self.best[low] < found):
                    found = self.best[low]
                low += 1
            if high & 1:
                high -= 1
                if self.best[high] is not None and (found is None or self.best[high] < found):
                    found = self.best[high]
            low >>= 1
            high >>= 1
        return found

    def put(self, sequence: tuple[float, int], tokens: int) -> int:
        """Fill a sequence that ``cheapest`` gave; the place of the piece in it."""
        cost, number = sequence
        offset = self.used[number]
        room = self.length - offset
        heapq.heappop(self.heaps[room])
        self._refresh(room)
        self.used[number] += tokens
        left = room - tokens
        if left:
            heapq.heappush(self.heaps[left], (cost + LINEAR * tokens + QUADRATIC * tokens * tokens, number))
            self._refresh(left)
        return offset


def pack(lengths: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, tokens, sequence, offset) of documents with these numbers of tokens.

    ``length`` is a power of two. Every sequence holds ``length`` tokens or a power of two.
    """
    pieces, rest, sequences = [], [], 0
    for doc, n in enumerate(lengths):
        whole = n // length * length
        for start in range(0, whole, length):
            pieces.append((doc, start, length, sequences, 0))
            sequences += 1
        if n > whole:
            rest.append((n - whole, doc, whole))
    full, tail = divmod(sum(n for n, _, _ in rest), length)
    bins = OpenSequences(length, full)
    rest.sort(key=lambda x: (-x[0], x[1]))
    # the smallest remainders fill the tail's powers of two, if their tokens do not fill a sequence
    spare = []
    while tail and rest:
        n, doc, start = rest.pop()
        take = min(n, tail)
        if n > take:
            rest.append((n - take, doc, start))
            start += n - take
        spare.append((take, doc, start))
        tail -= take
    rest.sort(key=lambda x: (-x[0], x[1]))
    left = []
    for n, doc, start in rest:
        found = bins.cheapest(n)
        if found is None:
            left.append((n, doc, start))
        else:
            pieces.append((doc, start, n, sequences + found[1], bins.put(found, n)))
    for n, doc, start in left:
        while n:
            found = bins.cheapest(1)
            take = min(n, length - bins.used[found[1]])
            pieces.append((doc, start, take, sequences + found[1], bins.put(found, take)))
            start, n = start + take, n - take
    sequences += full
    total = sum(n for n, _, _ in spare)
    rooms = [1 << k for k in range(total.bit_length() - 1, -1, -1) if total >> k & 1]
    at = used = 0
    for n, doc, start in spare:
        while n:
            take = min(n, rooms[at] - used)
            pieces.append((doc, start, take, sequences + at, used))
            used, start, n = used + take, start + take, n - take
            if used == rooms[at]:
                at, used = at + 1, 0
    return pieces


SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids array<int>")


def packed(docs: DataFrame, vocabulary: str, end_id: int, length: int = LENGTH, with_ids: bool = True) -> DataFrame:
    """A row per piece of ``docs`` (doc_id, text), with its ids, in the columns of ``SCHEMA``."""
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    if not with_ids:
        names = names[:-1]

    def rows(doc_ids, ids, first_sequence):
        pieces = pack([len(x) for x in ids], length)
        cut = [ids[d][s:s + n] for d, s, n, _, _ in pieces]
        columns = [
            pa.array([doc_ids[p[0]] for p in pieces], pa.int64()),
            pa.array([p[1] for p in pieces], pa.int64()),
            pa.array([p[2] for p in pieces], pa.int64()),
            pa.array([zlib.crc32(c.astype("<u4").tobytes()) for c in cut], pa.int64()),
            pa.array([len(ids[p[0]]) for p in pieces], pa.int64()),
            pa.array([first_sequence + p[3] for p in pieces], pa.int64()),
            pa.array([p[4] for p in pieces], pa.int64()),
        ]
        if with_ids:
            ends = np.cumsum([0] + [len(c) for c in cut])
            flat = np.concatenate(cut) if cut else np.empty(0)
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32))))
        sequences = 1 + max((p[3] for p in pieces), default=-1)
        return pa.RecordBatch.from_arrays(columns, names), sequences

    def run(batches):
        encoder = encoder_of(vocabulary)
        next_sequence = TaskContext.get().partitionId() * TASK_STEP
        doc_ids, ids, tokens = [], [], 0
        small = np.uint16 if max(encoder.size, end_id + 1) <= 1 << 16 else np.uint32
        for batch, texts in slices(batches, "text"):
            fresh = [np.append(x, np.uint32(end_id)).astype(small) for x in encoder.encode(texts)]
            doc_ids += batch.column("doc_id").to_pylist()
            ids += fresh
            tokens += sum(map(len, fresh))
            if tokens >= BATCH_TOKENS:
                out, sequences = rows(doc_ids, ids, next_sequence)
                yield out
                next_sequence += sequences
                doc_ids, ids, tokens = [], [], 0
        if ids:
            yield rows(doc_ids, ids, next_sequence)[0]

    schema = ", ".join(SCHEMA.split(", ")[: len(names)])
    return docs.select("doc_id", "text").mapInArrow(run, schema)
