"""Chat formatting by rendering growing prefixes of a conversation.

The template is a black box from turns to text. Rendering one turn more and
comparing the outputs shows where that turn lies; rendering the turn with two
different probe characters as its text shows what stands before and after the
text. A template whose output for more turns does not begin with the output
for fewer has rewritten history: the conversation is marked and has no mask.

The own template marks turns as ``### role: text</turn>`` and escapes ``\\``,
``#`` and ``<`` (in roles ``:`` too) by a backslash, so no mark can occur in a
text and reading back is exact.

Cases: a null role or text is empty; turns are ordered by turn (null first),
then role and text; rows without conv_id form one conversation; empty tables
give no rows; extra columns do not matter. A conversation is one record.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

_ESCAPED = re.compile(r"[\\#<]")
_ESCAPED_ROLE = re.compile(r"[\\#<:]")
_ANY = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### ((?:[^\\:]+|\\.)*): ((?:[^\\<]+|\\.)*)</turn>\n", re.S)
_PROBES = "\ue000", "\ue001"


def marked_turns(turns: list[Turn]) -> str:
    """The own template."""
    return "".join(
        f"### {_ESCAPED_ROLE.sub(r'\\\g<0>', role)}: {_ESCAPED.sub(r'\\\g<0>', text)}</turn>\n" for role, text in turns)


def unescape(text: str) -> str:
    return _ANY.sub(r"\1", text)


def read_turns(formatted: str) -> list[Turn]:
    """The turns of a text of the own template; anything else is an error."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def locate(turns: list[Turn], template: Template) -> tuple[str, list[tuple[int, int, int, int]], int | None]:
    """The formatted text; (start, text start, text end, end) of each turn; the first turn that rewrote history."""
    before, spans = template([]), []
    for k, (role, _) in enumerate(turns):
        now = template(turns[:k + 1])
        if not now.startswith(before):
            return template(turns), [], k
        one, two = (template([*turns[:k], (role, probe)]) for probe in _PROBES)
        head = _common(one, two)
        tail = _common(one[head:][::-1], two[head:][::-1])
        spans.append((len(before), head, len(now) - tail, len(now)))
        before = now
    return before, spans, None


def formatted(conversations: DataFrame, template: Template = marked_turns, trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, text, spans, loss, rewritten_at) of every conversation.

    ``spans`` holds (start, text start, text end, end) of each turn in ``text``;
    ``loss`` says of each whether its text is trained on.
    """
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))

    def run(batches):
        for batch in batches:
            for conv, rows in zip(batch.column("conv_id"), batch.column("turns")):
                said = [(r["role"], r["text"]) for r in rows.as_py()]
                text, spans, rewritten = locate(said, template)
                loss = [role in trained for role, _ in said] if spans else []
                yield pa.RecordBatch.from_arrays([
                    pa.array([conv.as_py()], pa.int64()), pa.array([text], pa.string()),
                    pa.array([[list(s) for s in spans]], pa.list_(pa.list_(pa.int64()))),
                    pa.array([loss], pa.list_(pa.bool_())), pa.array([rewritten], pa.int32()),
                ], ["conv_id", "text", "spans", "loss", "rewritten_at"])

    return turns.mapInArrow(run, "conv_id long, text string, spans array<array<long>>, loss array<boolean>, rewritten_at int")


def read_back(texts: DataFrame) -> DataFrame:
    """Digests of what ``formatted`` made with the own template, from its text and mask alone."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches):
        for batch in batches:
            rows = []
            for conv, text, spans, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "spans", "loss"))):
                turns = read_turns(text)
                told = "".join(f"{role}\n{said}\n" for role, said in turns)
                learned = "".join(unescape(text[s[1]:s[2]]) for s, use in zip(spans, loss) if use)
                rows.append((conv, len(turns), hashlib.sha256(told.encode()).hexdigest(), len(learned),
                             hashlib.sha256(learned.encode()).hexdigest(), len(text)))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return texts.select("conv_id", "text", "spans", "loss").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
