"""Periodic run detection by recompression: stretches of words that repeat with a period, and texts with them collapsed.

A run is a stretch of words with smallest period q and at least
``max(MIN_WORDS, MIN_REPEATS * q)`` words that cannot be made longer on either
side. For every period p the places of a grid are compared with those p words
later; the grid's steps grow with p, so there are harmonically many of them,
and it is wide enough only for stretches that are too short. Where both words
agree, the exact extension to both sides comes from a run-length grammar over
the words (``recompression``), and what is long enough is a run. Candidates
inside a known run whose period divides p would find it again and are left out.

Texts are handled in slices: the words of a slice form one array in which every
text ends with a symbol of its own, so no extension leaves a text, and all
steps work on the whole array at once.

Cases: null and empty texts have no words and no runs; white space is that of
ASCII only; a null doc_id stays; repeated rows are treated alike; an empty table
gives no rows; extra columns do not matter. A long text is a slice of its own,
so memory follows the longest text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from plotkeep.llm.recompression import Grammar
from plotkeep.llm.text import slices

MIN_WORDS = 24
MIN_REPEATS = 3
# Periods searched together before the runs found so far are taken into account.
GROWTH = 2


@dataclass
class Runs:
    """Runs in order of their start, then period."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray

    def __len__(self) -> int:
        return len(self.start)


def _covered(known: Runs, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Candidates inside a known run whose period divides theirs (of all runs begun before, the one that reaches furthest)."""
    if not len(known):
        return np.zeros(len(at), bool)
    ends = known.start + known.length
    reach = np.maximum.accumulate(ends)
    furthest = np.maximum.accumulate(np.where(ends == reach, np.arange(len(ends)), 0))
    run = np.searchsorted(known.start, at, side="right") - 1
    held = furthest[np.maximum(run, 0)]
    return (run >= 0) & (at + period < ends[held]) & (period % known.period[held] == 0)


def _merged(known: Runs, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> Runs:
    """Known and new stretches; of equal stretches the smallest period."""
    start, length, period = (np.concatenate(c) for c in zip((known.start, known.length, known.period), (start, length, period)))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    return Runs(start[first], length[first], period[first])


def runs_of(symbols: np.ndarray, longest: int) -> Runs:
    """All runs of an array of symbols, of which stretches of up to ``longest`` can hold one."""
    none = np.empty(0, np.int64)
    known, limit = Runs(none, none, none), longest // MIN_REPEATS
    if longest < MIN_WORDS:
        return known
    forward, n = None, len(symbols)
    low = 1
    while low <= limit:
        high = min(limit, low * GROWTH - 1)
        grid, periods = [], []
        for p in range(low, high + 1):
            step = max(MIN_WORDS - p, (MIN_REPEATS - 1) * p)
            # a stretch that is long enough holds a place of the grid and the one p words later
            at = np.flatnonzero(symbols[:n - p:step] == symbols[p::step]) * step
            grid.append(at)
            periods.append(np.full(len(at), p))
        low = high + 1
        at, period = np.concatenate(grid), np.concatenate(periods)
        new = ~_covered(known, at, period)
        at, period = at[new], period[new]
        if not len(at):
            continue
        if forward is None:
            forward = Grammar(symbols)
            backward = forward.mirrored()
        after = forward.extension(at, at + period)
        before = backward.extension(n - at, n - at - period)
        length = before + period + after
        found = length >= np.maximum(MIN_WORDS, MIN_REPEATS * period)
        known = _merged(known, (at - before)[found], length[found], period[found])
    order = np.lexsort((known.period, known.start))
    return Runs(known.start[order], known.length[order], known.period[order])


def _words(text: str) -> list[bytes]:
    # bytes are split at ASCII white space, strings at all
    return text.encode("utf-8").split()


def _digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth text by the checksum of its id gets a periodic end; the others stay."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


Change = Callable[[int | None, list[bytes]], list[bytes]]


def _described(runs: list[tuple[int, int, int]], words: list[bytes]) -> tuple:
    """Counts, the strongest run, and digests of all runs and of the collapsed text, with that text."""
    if not runs:
        text = b" ".join(words)
        return 0, None, None, None, None, _digest(b""), _digest(text), text.decode("utf-8")
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    text = b" ".join([w for w, g in zip(words, np.cumsum(gone).tolist()) if not g])
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (len(runs), *best, 1000 * best[1] // best[2], _digest(listed.encode()), _digest(text), text.decode("utf-8"))


def slice_rows(doc_ids: list, texts: list[str], change: Change | None) -> Iterator[tuple]:
    """One described row per text, from the runs of all of them together."""
    words = [_words(t) for t in texts]
    if change:
        words = [change(d, w) for d, w in zip(doc_ids, words)]
    names: dict[bytes, int] = {}
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes + 1)
    symbols = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    for at, of in zip((ends - sizes - 1).tolist(), words):
        symbols[at:at + len(of)] = [names.setdefault(w, len(names)) for w in of]
    # each text ends with a symbol that occurs nowhere else
    symbols[ends - 1] = len(names) + np.arange(len(ends))
    runs = runs_of(symbols, int(sizes.max(initial=0)))
    of = np.searchsorted(ends, runs.start, side="right")
    held: dict[int, list[tuple[int, int, int]]] = {}
    for k, s, n, q in zip(of.tolist(), (runs.start - (ends - sizes - 1)[of]).tolist(), runs.length.tolist(), runs.period.tolist()):
        held.setdefault(k, []).append((s, n, q))
    for k, (doc_id, its) in enumerate(zip(doc_ids, words)):
        yield (doc_id, *_described(held.get(k, []), its))


def periodic_runs(docs: DataFrame, change: Change | None = None, with_text: bool = True) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_runs, the run with most repeats (start, length, period, exponent_milli), digests, collapsed.

    Words that a run repeats after its first period are dropped from ``collapsed``, where words are
    joined by one blank. ``change`` alters a text's words beforehand.
    """
    longs = ("n_runs", "start", "length", "period", "exponent_milli")
    strings = ("runs_sha256", "collapsed_sha256") + (("collapsed",) if with_text else ())
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType)] + [T.StructField(c, T.LongType()) for c in longs]
        + [T.StructField(c, T.StringType()) for c in strings])

    def run(batches):
        for batch, texts in slices(batches, "text"):
            ids = batch.column("doc_id")
            _, *columns = zip(*slice_rows(ids.to_pylist(), texts, change))
            arrays = [pa.array(c, pa.int64()) for c in columns[:len(longs)]]
            arrays += [pa.array(c, pa.string()) for c in columns[len(longs):len(longs) + len(strings)]]
            yield pa.RecordBatch.from_arrays([ids, *arrays], ["doc_id", *longs, *strings])

    return docs.select("doc_id", "text").mapInArrow(run, schema)
