"""Text quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's evidence is its own features and those of
the lines before and after it; two neighbouring lines' labels are tied by a
2 x 2 table. Forward-backward gives every line's chance to be good, and a
text's score is the mean of these weighted by line length.

Cases: a null or empty text is one empty line and gets that line's score; a
blank line counts as a line of length 1; without labelled rows (empty tables)
every score is 0.5; repeated rows are scored alike; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotkeep.llm.text import U64, mix, slices, word_hashes

# Labelled texts that the field is fitted on at most, chosen by a hash of their id.
TRAINING_TEXTS = 3000
# Scores from this on are predicted 1.
ACCEPT = 0.3

_CLASSES = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"abcdefghijklmnopqrstuvwxyz",
    b"0123456789",
    b" \t",
    b".,;:'\"-?()",
    b"!",
    b"|",
    b"#$%&*@^~+=<>/\\_{}[]`",
]
OWN = len(_CLASSES) + 9


def _class_table() -> np.ndarray:
    table = np.full(256, len(_CLASSES), np.uint8)
    for k, members in enumerate(_CLASSES):
        table[list(members)] = k
    return table


_TABLE = _class_table()


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of all lines (a row each), every line's text, and its bytes."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    lines: list[bytes] = []
    per_text = []
    for t in raw:
        own = t.split(b"\n")
        per_text.append(len(own))
        lines += own
    owner = np.repeat(np.arange(len(raw)), per_text)
    size = np.fromiter(map(len, lines), np.int64, len(lines))
    n = len(lines)
    data = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    kinds = _TABLE[data]
    starts = np.cumsum(size + 1) - size - 1
    shares = np.empty((n, len(_CLASSES) + 1))
    for k in range(len(_CLASSES) + 1):
        shares[:, k] = np.add.reduceat((kinds == k).astype(np.int32), starts)
    shares[:, -1] -= 1  # the line feed itself
    shares /= np.maximum(size, 1)[:, None]

    words, at = word_hashes(lines)
    count = np.bincount(at, minlength=n)
    some = np.maximum(count, 1)
    doc = owner[at]
    _, inverse, times = np.unique(mix(words ^ mix(doc.astype(U64))), return_inverse=True, return_counts=True)
    again = 1.0 / times[inverse]
    doc_words = np.maximum(np.bincount(doc, minlength=len(raw)), 1)
    same_line = np.empty(len(words), bool)
    same_line[:1] = False
    same_line[1:] = (at[1:] == at[:-1]) & (words[1:] == words[:-1])
    pairs = np.zeros(len(words), U64)
    with np.errstate(over="ignore"):
        pairs[1:] = mix(words[1:] + words[:-1] * U64(0x9E3779B97F4A7C15)) ^ mix(doc[1:].astype(U64))
    _, inverse2, times2 = np.unique(pairs, return_inverse=True, return_counts=True)
    extra = np.column_stack([
        np.log1p(size),
        size / some / 10.0,
        np.bincount(at, again, n) / some,  # near 1 where a text's words differ
        np.bincount(at, 1.0 / times2[inverse2], n) / some if len(words) else np.zeros(n),
        np.bincount(at, same_line, n) / some,
        np.bincount(at, times[inverse] / doc_words[doc], n) / some,
        np.log1p(count),
        count == 0,
    ]) if n else np.empty((0, 8))
    return np.column_stack([shares, extra]), owner, np.maximum(size, 1)


def with_neighbours(own: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """A line's features, those of the line before and after it in its text (0 at the ends), and 1."""
    n, k = own.shape
    out = np.zeros((n, 3 * k + 3), np.float64)
    out[:, :k] = own
    if n > 1:
        same = owner[1:] == owner[:-1]
        out[1:, k:2 * k][same] = own[:-1][same]
        out[:-1, 2 * k:3 * k][same] = own[1:][same]
        out[1:, -3] = same
        out[:-1, -2] = same
    out[:, -1] = 1
    return out


def _chains(values: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of texts with like numbers of lines, as (places in ``values``, mask) of equal length."""
    if not len(owner):
        return
    texts, first, count = np.unique(owner, return_index=True, return_counts=True)
    order = np.argsort(count, kind="stable")
    start = 0
    while start < len(order):
        longest = max(8, 2 * int(count[order[start]]))
        stop = start + int(np.searchsorted(count[order[start:]], longest, side="right"))
        group = order[start:max(stop, start + 1)]
        steps = np.arange(int(count[group].max()))
        mask = steps[None, :] < count[group][:, None]
        yield np.where(mask, first[group][:, None] + steps, 0), mask
        start += len(group)


def _marginals(score: np.ndarray, ties: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward in logs. ``score``: [chain, step, label]. Label and label-pair chances."""
    chains, steps, _ = score.shape
    forward = np.empty_like(score)
    backward = np.zeros_like(score)
    forward[:, 0] = score[:, 0]
    for t in range(1, steps):
        step = np.logaddexp.reduce(forward[:, t - 1, :, None] + ties[None], axis=1) + score[:, t]
        forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
    for t in range(steps - 2, -1, -1):
        step = np.logaddexp.reduce(ties[None] + (score[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
        backward[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
    total = np.logaddexp.reduce(forward[:, -1], axis=1)
    single = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
    pair = np.zeros((2, 2))
    if steps > 1:
        joint = (forward[:, :-1, :, None] + ties[None, None] + (score[:, 1:] + backward[:, 1:])[:, :, None, :]
                 - total[:, None, None, None])
        pair = (np.exp(np.minimum(joint, 0)) * mask[:, 1:, None, None]).sum(axis=(0, 1))
    return single, pair


@dataclass
class LineField:
    """A fitted field: scaling of features, weights towards good, and ties of neighbouring labels."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    ties: np.ndarray
    neutral: bool = False

    def good(self, own: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Every line's chance to be good."""
        if self.neutral or not len(own):
            return np.full(len(own), 0.5)
        evidence = ((with_neighbours(own, owner) - self.mean) / self.scale) @ self.weights
        chance = np.empty(len(own))
        for places, mask in _chains(evidence, owner):
            score = np.stack([np.zeros(places.shape), np.where(mask, evidence[places], 0.0)], axis=2)
            single, _ = _marginals(score, self.ties, mask)
            chance[places[mask]] = single[mask][:, 1]
        return np.clip(chance, 0.0, 1.0)

    def scores(self, texts: list[str]) -> np.ndarray:
        """Length-weighted chance of good lines of each text."""
        own, owner, size = line_features(texts)
        return np.bincount(owner, self.good(own, owner) * size, len(texts)) / np.bincount(owner, size, len(texts))


def neutral_field() -> LineField:
    empty = np.zeros(0)
    return LineField(empty, empty, empty, np.zeros((2, 2)), True)


def fit_field(own: np.ndarray, owner: np.ndarray, label: np.ndarray, rounds: int = 150, ridge: float = 1e-3) -> LineField:
    """Fit by gradient steps on the chains' likelihood. ``label``: of each line, its text's mark."""
    if not len(own):
        return neutral_field()
    x = with_neighbours(own, owner)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[-1], scale[scale < 1e-9] = 0.0, 1.0
    x = (x - mean) / scale
    n, k = x.shape
    chains = list(_chains(label, owner))
    pairs = np.zeros((2, 2))
    same = owner[1:] == owner[:-1]
    np.add.at(pairs, (label[:-1][same], label[1:][same]), 1)
    theta = np.zeros(k + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        weights, ties = theta[:k], theta[k:].reshape(2, 2)
        evidence, chance, expected = x @ weights, np.zeros(n), np.zeros((2, 2))
        for places, mask in chains:
            score = np.stack([np.zeros(places.shape), np.where(mask, evidence[places], 0.0)], axis=2)
            single, pair = _marginals(score, ties, mask)
            chance[places[mask]] = single[mask][:, 1]
            expected += pair
        slope = np.concatenate([x.T @ (chance - label) / n, ((expected - pairs) / n).ravel()]) + ridge * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope ** 2
        theta -= 0.08 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return LineField(mean, scale, theta[:k], theta[k:].reshape(2, 2))


def held_out(doc_id) -> F.Column:
    """True for the fifth of ids that no label is learned from."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, texts: int = TRAINING_TEXTS) -> LineField:
    """Fit on at most ``texts`` labelled rows outside the held-out fifth.

    The chosen ids (a bounded table) are sent to the text table; features are
    computed where the texts are and only they reach the driver.
    """
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    chosen = marked.orderBy(F.xxhash64(F.lit("sample"), "doc_id"), "doc_id").limit(texts)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def measure(batches):
        for batch, found in slices(batches, "text"):
            own, owner, _ = line_features(found)
            cuts = np.searchsorted(owner, np.arange(len(found) + 1))
            blobs = [own[a:b].astype(np.float32).tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("quality"), pa.array(blobs, pa.binary())],
                ["doc_id", "quality", "lines"],
            )

    rows = sample.mapInArrow(measure, "doc_id long, quality int, lines binary").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.lines)))
    own = [np.frombuffer(r.lines, np.float32).reshape(-1, OWN) for r in rows]
    if not own:
        return neutral_field()
    counts = [len(o) for o in own]
    return fit_field(
        np.concatenate(own).astype(float),
        np.repeat(np.arange(len(rows)), counts),
        np.repeat(np.array([r.quality for r in rows]), counts),
    )


def score(docs: DataFrame, field: LineField, column: str = "score") -> DataFrame:
    """All rows and columns with one more, the score of ``text``. Clashing names are an error."""
    if column.lower() in map(str.lower, docs.columns):
        raise ValueError(f"the table already has a column {column}")
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])

    def run(batches):
        for batch, found in slices(batches, "text"):
            values = pa.array(field.scores(found), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], [*batch.schema.names, column])

    return docs.mapInArrow(run, schema)


def accepted(docs: DataFrame, field: LineField, threshold: float = ACCEPT) -> DataFrame:
    """Rows whose score reaches the threshold, with the columns they came with."""
    column = "score"
    while column in map(str.lower, docs.columns):
        column += "_"
    return score(docs, field, column).where(F.col(column) >= threshold).drop(column)
