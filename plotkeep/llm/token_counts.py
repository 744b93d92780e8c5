"""Token counts by a two-tier lookup in the tasks: no pre-token is ever shuffled.

A byte-pair vocabulary cuts a text into pre-tokens and encodes each on its own,
so a text's count is the sum of its pre-tokens' lengths. The lengths of frequent
pre-tokens are found once and broadcast as a table of at most ``FREQUENT`` short
strings. Every other pre-token is encoded by the library where it is met; a
worker keeps those lengths, up to ``CACHED`` of them, and starts anew beyond.
The frequent ones come from a bounded sample of texts and only decide where a
length is looked up: counts are exact for any table.

Pre-tokens are found by the vocabulary's own pattern. Texts with characters that
pattern engines may class differently (scripts outside ``SETTLED``) are cut by the
library itself, and vocabularies of another kind (other pre-tokenizers,
``.model`` files) encode whole texts.

Cases: null and empty texts have 0 bytes and 0 tokens; a null doc_id stays;
repeated rows are counted each; strings of special tokens inside a text are
one token each, as the library does by default; an empty table gives no rows;
long texts are cut into pre-tokens ``CHUNK`` characters at a time, so memory
follows the longest run without a blank; extra columns do not matter.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotkeep.llm.text import slices

# The pattern of byte-level pre-tokenizers, for characters that all versions of the character tables class alike: ASCII
# without controls, Latin, Greek and Cyrillic letters, general punctuation, kana, unified ideographs, Hangul syllables.
PATTERN = r" ?[^\W\d_]+| ?\d+|'(?:[stmd]|re|ve|ll)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
SETTLED = "\t-\r -~\u00c0-\u0557\u2010-\u2027\u3041-\u3096\u4e00-\u9fa5\uac00-\ud7a3"

# Entries of the broadcast table, and the longest of them: at most 32,768 strings of 32 characters.
FREQUENT = 32_768
FREQUENT_CHARS = 32
# Texts that the table is taken from, and pre-tokens that one task reports of them.
SAMPLE_TEXTS = 1_000
SAMPLE_PRETOKENS = 1_024
# Lengths of other pre-tokens that a worker keeps, and the longest of them.
CACHED = 400_000
CACHED_CHARS = 64
# Characters cut into pre-tokens at once, and pre-tokens given to the library at once.
CHUNK = 1 << 16
TOGETHER = 1 << 17

_PIECES = re.compile(PATTERN)
_UNSETTLED = re.compile(f"[^{SETTLED}]")
# A blank after text: no pre-token reaches across its left edge.
_CUT = re.compile(r"(?<=[!-~]) ")


class Pretokenizer:
    """One vocabulary file: the pre-tokens of a text, and the lengths of pre-tokens."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.cache: dict[str, int] = {}
        self.model = self.tokenizer = None
        if vocabulary.endswith(".model"):
            import sentencepiece

            self.model, self.by_pretoken = sentencepiece.SentencePieceProcessor(model_file=vocabulary), False
            return
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(vocabulary, encoding="utf-8") as file:
            stated = json.load(file)
        before = stated["pre_tokenizer"] or {}
        added = stated["added_tokens"]
        # an added token that takes in blanks or stands for words only is more than its string
        self.by_pretoken = (
            stated["normalizer"] is None and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space") and before.get("use_regex", True)
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added))
        strings = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, strings))) if strings else None

    def whole(self, texts: list[str]) -> list[int]:
        """Counts of texts, or of single pre-tokens, by the library."""
        if self.model is not None:
            return [len(ids) for ids in self.model.encode(texts, num_threads=1)]
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _runs(self, text: str) -> tuple[list[str], int]:
        """What lies between special tokens, and how many of these there are."""
        if self.special is None or not self.special.search(text):
            return [text], 0
        return self.special.split(text), len(self.special.findall(text))

    def pretokens(self, run: str) -> Iterator[list[str]]:
        """The pre-tokens of a text without special tokens, some at a time."""
        at = 0
        while at < len(run):
            cut = _CUT.search(run, at + CHUNK) if len(run) - at > CHUNK else None
            part = run[at:cut.start()] if cut else run[at:]
            at += len(part)
            if _UNSETTLED.search(part):
                yield [part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
            else:
                yield _PIECES.findall(part)

    def lengths(self, pieces: set[str]) -> dict[str, int]:
        """Lengths of pre-tokens that the table lacks, from the cache or the library."""
        known = {p: n for p in pieces if (n := self.cache.get(p)) is not None}
        new = [p for p in pieces if p not in known]
        found = dict(zip(new, self.whole(new) if new else ()))
        if len(self.cache) + len(found) > CACHED:
            self.cache.clear()
        for piece, n in found.items():
            if len(piece) <= CACHED_CHARS and len(self.cache) < CACHED:
                self.cache[piece] = n
        return known | found

    def counts(self, texts: list[str], frequent: dict[str, int]) -> list[int]:
        """Tokens of each text. What the table lacks is encoded together, ``TOGETHER`` pre-tokens at a time."""
        if not self.by_pretoken:
            return self.whole(texts)
        totals, missed, open_ = [0] * len(texts), [], 0

        def settle():
            lengths = self.lengths({p for _, pieces in missed for p in pieces})
            for i, pieces in missed:
                totals[i] += sum(map(lengths.__getitem__, pieces))
            missed.clear()

        for i, text in enumerate(texts):
            runs, totals[i] = self._runs(text)
            for run in runs:
                for pieces in self.pretokens(run):
                    first = list(map(frequent.get, pieces))
                    if None in first:
                        missed.append((i, [p for p, n in zip(pieces, first) if n is None]))
                        first = [n for n in first if n is not None]
                        open_ += len(missed[-1][1])
                    totals[i] += sum(first)
                    if open_ >= TOGETHER:
                        settle()
                        open_ = 0
        settle()
        return totals


def pretokenizer(vocabulary: str) -> Pretokenizer:
    """The one of a vocabulary file; a worker process that runs several tasks keeps it with its cache."""
    # functions of this package travel by value, so their globals end with a task; modules stay
    held = sys.modules.setdefault("plotkeep_worker_pretokenizers", types.ModuleType("plotkeep_worker_pretokenizers")).__dict__
    if vocabulary not in held:
        held[vocabulary] = Pretokenizer(vocabulary)
    return held[vocabulary]


def frequent_lengths(docs: DataFrame, vocabulary: str) -> dict[str, int]:
    """Lengths of the pre-tokens met most often in a sample of about ``SAMPLE_TEXTS`` texts."""
    if not pretokenizer(vocabulary).by_pretoken:
        return {}
    rows = docs.count()
    if not rows:
        return {}

    def run(batches):
        cutter, seen = pretokenizer(vocabulary), Counter()
        for _, texts in slices(batches, "text"):
            for text in texts:
                for part in cutter._runs(text)[0]:
                    for pieces in cutter.pretokens(part):
                        seen.update(pieces)
                if len(seen) > CACHED:
                    seen = Counter(dict(seen.most_common(SAMPLE_PRETOKENS)))
        top = [(p, n) for p, n in seen.most_common(SAMPLE_PRETOKENS) if len(p) <= FREQUENT_CHARS]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["pretoken", "times"])

    sample = docs.select("text").sample(min(1.0, SAMPLE_TEXTS / rows), seed=11)
    seen: Counter = Counter()
    # at most SAMPLE_PRETOKENS of each task that holds one of the sampled texts
    for row in sample.mapInArrow(run, "pretoken string, times long").toLocalIterator():
        seen[row.pretoken] += row.times
    top = [p for p, _ in seen.most_common(FREQUENT)]
    return dict(zip(top, pretokenizer(vocabulary).whole(top)))


def counted(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs`` (doc_id, text)."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, vocabulary))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")

    def run(batches):
        counter, frequent = pretokenizer(vocabulary), table.value
        for batch, texts in slices(batches, "text"):
            counts = counter.counts(texts, frequent)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {doc_id}, n_bytes long, n_tokens long")
