"""Token ids of whole texts through the tokenizers library.

Byte-pair encoders of words never merge across a blank or line feed that
follows other text. A text is cut there, every distinct piece is encoded
once in a worker by the library, and the ids are put together again in numpy. The
pieces are found by hash and compared byte by byte, so the ids are those of the
whole text (``tests/llm`` compares them). Texts with other white space or with
the string of an added token, which the library takes as that token, and
vocabularies for which a cut would show (``by_piece=False``), are encoded whole.
"""

from __future__ import annotations

import os
import re
import sys
import types

import numpy as np

from plotkeep.llm.text import BLOCK_BYTES, U64, mix, powers

# White space other than blank and line feed.
OTHER_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0  -     　]")
# Distinct pieces kept by a worker before it starts anew, and characters and texts given to the library at once.
KNOWN_PIECES = 1_000_000
JOINED_CHARS, JOINED_TEXTS = 1 << 11, 64

_VALUES = mix(np.arange(1001, 1257, dtype=U64))
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x0A]] = True


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of all items of the given runs, run after run."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


def _run_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each of the runs that lie end to end in ``data``."""
    out = np.zeros(len(starts), U64)
    one, inverse = powers(BLOCK_BYTES)
    ends = starts + lengths
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            stop = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK_BYTES, side="right")))
            a, b = int(starts[at]), int(ends[stop - 1])
            if b - a > len(one):  # a single long run
                one, inverse = powers(b - a)
            sums = np.zeros(b - a + 1, U64)
            np.cumsum(_VALUES[data[a:b]] * one[: b - a], out=sums[1:])
            first = starts[at:stop] - a
            out[at:stop] = mix((sums[ends[at:stop] - a] - sums[first]) * inverse[first] + lengths[at:stop].astype(U64))
            at = stop
    return out


class Encoder:
    """Texts to arrays of ids with one vocabulary file."""

    def __init__(self, vocabulary: str, by_piece: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # a string with a gap in it could come about where pieces are joined
        self.by_piece = by_piece and not any(" " in a or "\n" in a for a in self.added)
        self.size = self.tokenizer.get_vocab_size()
        self.forget()

    def forget(self) -> None:
        self.hashes, self.codes = np.empty(0, U64), np.empty(0, np.int64)
        self.bytes, self.byte_start, self.byte_length = np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids, self.id_start, self.id_length = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> None:
        """Encode new pieces; those that begin with a gap and end without one are given to the library joined."""
        joins = _GAP[data[starts]] & ~_GAP[data[starts + lengths - 1]]
        order = np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])
        starts, lengths, joined = starts[order], lengths[order], int(joins.sum())
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        fresh = data[_gather(starts, lengths)]
        ends = np.cumsum(lengths)
        chars = np.concatenate([[0], np.cumsum((fresh & 0xC0) != 0x80)])
        ids, counts = [], np.zeros(len(starts), np.int64)
        at, texts, offsets = 0, [], []
        while at < joined:
            begin = int(ends[at] - lengths[at])
            stop = int(np.searchsorted(chars[ends[:joined]], chars[begin] + JOINED_CHARS, side="right"))
            stop = max(at + 1, stop)
            texts.append(fresh[begin:ends[stop - 1]].tobytes().decode("utf-8"))
            offsets.append(int(chars[begin]))
            at = stop
        first_char = chars[ends - lengths]
        joined_texts = (
            e for k in range(0, len(texts), JOINED_TEXTS)
            for e in self.tokenizer.encode_batch(texts[k:k + JOINED_TEXTS], add_special_tokens=False))
        for base, e in zip(offsets, joined_texts):
            found = np.array(e.ids, np.uint32)
            place = np.fromiter((o[0] for o in e.offsets), np.int64, len(found)) + base
            ids.append(found)
            piece = np.searchsorted(first_char[:joined], place, side="right") - 1
            if len(piece):
                low = int(piece[0])
                part = np.bincount(piece - low)
                counts[low:low + len(part)] += part
        alone = [fresh[e - n:e].tobytes().decode("utf-8") for e, n in zip(ends[joined:].tolist(), lengths[joined:].tolist())]
        for i, found in enumerate(self.whole(alone)):
            ids.append(found)
            counts[joined + i] = len(found)
        known = len(self.byte_start)
        self.byte_start = np.concatenate([self.byte_start, len(self.bytes) + ends - lengths])
        self.byte_length = np.concatenate([self.byte_length, lengths])
        self.bytes = np.concatenate([self.bytes, fresh])
        self.id_start = np.concatenate([self.id_start, len(self.ids) + np.cumsum(counts) - counts])
        self.id_length = np.concatenate([self.id_length, counts])
        self.ids = np.concatenate([self.ids, *ids])
        hashes = np.concatenate([self.hashes, hashes])
        codes = np.concatenate([self.codes, known + rank])
        sort = np.argsort(hashes, kind="stable")  # two sorted runs: a merge
        self.hashes, self.codes = hashes[sort], codes[sort]

    def _by_piece(self, texts: list[str]) -> list[np.ndarray]:
        raw = [t.encode("utf-8") for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        if not len(data):
            return [np.empty(0, np.uint32) for _ in texts]
        if len(self.codes) > KNOWN_PIECES:
            self.forget()
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        gap = _GAP[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = gap[1:] & ~gap[:-1]
        cut[bounds] = True
        starts = np.flatnonzero(cut[:-1])
        lengths = np.diff(np.append(starts, len(data)))
        hashes = _run_hashes(data, starts, lengths)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, distinct)
        new = place == len(self.hashes)
        new[~new] = self.hashes[place[~new]] != distinct[~new]
        if new.any():
            self._learn(data, starts[first[new]], lengths[first[new]], distinct[new])
            place = np.searchsorted(self.hashes, distinct)
        codes = self.codes[place][inverse]
        if not (np.array_equal(self.byte_length[codes], lengths)
                and np.array_equal(self.bytes[_gather(self.byte_start[codes], lengths)], data)):
            return self.whole(texts)  # two pieces with one hash
        counts = self.id_length[codes]
        flat = self.ids[_gather(self.id_start[codes], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(starts, bounds)]
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (unsigned 32 bit) of each text. No special token is put around it; those it spells out are read as such."""
        if not self.by_piece:
            return self.whole(texts)
        odd = [bool(OTHER_SPACE.search(t)) or any(a in t for a in self.added) for t in texts]
        whole = iter(self.whole([t for t, x in zip(texts, odd) if x]))
        cut = iter(self._by_piece([t for t, x in zip(texts, odd) if not x]))
        return [next(whole) if x else next(cut) for x in odd]


def encoder(vocabulary: str) -> Encoder:
    """The encoder of a vocabulary file. A worker process that runs several tasks keeps it, with the pieces it knows."""
    # functions of this package travel by value, so their globals end with a task; modules stay
    held = sys.modules.setdefault("plotkeep_worker_encoders", types.ModuleType("plotkeep_worker_encoders")).__dict__
    if vocabulary not in held:
        held[vocabulary] = Encoder(vocabulary)
    return held[vocabulary]
