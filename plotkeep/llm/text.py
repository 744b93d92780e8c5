"""Helpers inside tasks: bounded slices of Arrow batches and vectorised word hashes.

Words are hashed from the bytes of a whole buffer at once, so no Python object
is made per word. Memory follows ``SLICE_BYTES`` and the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

# Texts handled together, and bytes hashed at once.
SLICE_BYTES = 2 << 20
BLOCK_BYTES = 1 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    with np.errstate(over="ignore"):
        x = x.astype(U64, copy=True)
        x ^= x >> U64(30)
        x *= U64(0xBF58476D1CE4E5B9)
        x ^= x >> U64(27)
        x *= U64(0x94D049BB133111EB)
        x ^= x >> U64(31)
    return x


def separators(is_separator) -> np.ndarray:
    """A table over bytes: true where the byte ends a word."""
    return np.array([bool(is_separator(b)) for b in range(256)])


# ASCII white space: the blank and \t to \r.
WHITE = separators(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)


def _byte_values() -> np.ndarray:
    """A random 64-bit value per byte; A-Z have the values of a-z."""
    values = mix(np.arange(1, 257, dtype=U64))
    values[ord("A"):ord("Z") + 1] = values[ord("a"):ord("z") + 1]
    return values


_VALUES = _byte_values()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse."""
    out = []
    for base in (_BASE, _INVERSE):
        row = np.full(n, U64(base))
        row[:1] = 1
        with np.errstate(over="ignore"):
            out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def _blocks(data: np.ndarray, ends_word: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut a buffer at separators into ranges of about BLOCK_BYTES."""
    start, n = 0, len(data)
    while start < n:
        end, reach = min(n, start + BLOCK_BYTES), BLOCK_BYTES
        while end < n:
            cut = np.flatnonzero(ends_word[data[start:end]])
            if len(cut):
                end = start + int(cut[-1]) + 1
                break
            reach *= 2  # one word longer than the block
            end = min(n, start + reach)
        yield start, end
        start = end


def word_hashes(texts: list[bytes], ends_word: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased) in order, and the index of each one's text.

    A hash depends on the word's bytes alone, not on its place.
    """
    gap = bytes([int(np.flatnonzero(ends_word)[0])])
    data = np.frombuffer(gap.join(texts) + gap, np.uint8)
    hashes, starts = [], []
    one = inverse = np.empty(0, U64)
    for a, b in _blocks(data, ends_word):
        block = data[a:b]
        if len(one) < len(block):
            one, inverse = powers(len(block))
        inside = ~ends_word[block]
        edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        with np.errstate(over="ignore"):
            sums = np.zeros(len(block) + 1, U64)
            np.cumsum(_VALUES[block] * one[: len(block)], out=sums[1:])
            raw = (sums[last] - sums[first]) * inverse[first]
            hashes.append(mix(raw + (last - first).astype(U64) * U64(0xD6E8FEB86659FD93)))
        starts.append(first + a)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    begin = np.concatenate(starts) if starts else np.empty(0, np.int64)
    owner = np.searchsorted(offsets, begin, side="right") - 1
    return (np.concatenate(hashes) if hashes else np.empty(0, U64)), owner


def slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches cut into runs of rows with about SLICE_BYTES of text, and their texts (null: empty)."""
    for batch in batches:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        start = size = 0
        for i, text in enumerate(texts):
            if size and size + len(text) > SLICE_BYTES:
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(text)
        if start < len(texts):
            yield batch.slice(start), texts[start:]
