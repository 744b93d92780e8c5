"""Expressions over whole documents: fences, numbers, dated claims, links.

Patterns use ``(?U)`` so that word characters and digits are Unicode-aware.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns that define a claim.
FENCE = r"(?s)```.*?```"
NUMBER = r"(?U)(?<![\w.])\d{1,3}(?:,\d{3})+(?:\.\d+)?(?!\w)|\d+(?:\.\d+)?%"
COUNT_TOKEN = r"(?U)(?<![\w.,])(?:\d{1,3}(?:,\d{3})+|\d+)(?![\w,])"
ISO_DATE = r"(?U)(?<![\w/-])(?:19|20)\d\d-\d\d-\d\d(?![\w-])"
ARCHIVE_PATH = r"(?U)versions/(?:19|20)\d\d-\d\d-\d\d(?:-\d+)?\.parquet"
DATED_EXTRACT = (
    r"(?iU)\b(?:extracted|written|retrieved|downloaded|fetched|as of)\b"
    r"[^.\n]{0,60}?\b(?:19|20)\d\d\b"
)
FIRST_VERSION = r"(?iU)\bfirst (?:version|one|extract)\b"
SENTENCE_BREAK = r"(?U)((?<=[.!?])\s+|\n\s*\n|\n(?=\s*(?:[-*#|]|\d+\.\s)))"

# Configuration, not a measurement: the tile writer's feature limit.
ALLOWED_NUMBERS = ("200,000",)
SMALLEST_COUNT = 100


def newlines(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n")))


def blank_fences(text: Column) -> Column:
    """Remove fenced code, keeping its newlines so line numbers still match."""
    prose = F.split(text, FENCE, -1)
    fences = F.regexp_extract_all(text, F.lit(FENCE), F.lit(0))
    blanks = F.transform(fences, lambda f: F.repeat(F.lit("\n"), newlines(f)))
    pieces = F.zip_with(prose, blanks, lambda p, b: F.concat(p, F.coalesce(b, F.lit(""))))
    return F.array_join(pieces, "")


def sentences(text: Column) -> Column:
    """Sentences, each with the white space that ends it."""
    ends = F.regexp_extract_all(text, F.lit(SENTENCE_BREAK), F.lit(0))
    return F.zip_with(F.split(text, SENTENCE_BREAK, -1), ends, lambda s, e: F.concat(s, F.coalesce(e, F.lit(""))))


def dated_claim(sentence: Column) -> Column:
    """The stale-able date in a sentence, or null."""
    text = F.regexp_replace(sentence, ARCHIVE_PATH, "")
    iso = F.regexp_substr(text, F.lit(ISO_DATE))
    verb = F.regexp_substr(text, F.lit(DATED_EXTRACT))
    return F.when(~sentence.rlike(FIRST_VERSION), F.coalesce(iso, verb))


def dated_claims(text: Column) -> Column:
    """(line, claim, sentence) of every sentence that holds a dated claim.

    The line is only worked out for sentences that are reported.
    """
    def scan(pieces: Column) -> Column:
        index = F.sequence(F.lit(0), F.size(pieces) - 1)
        flagged = F.filter(index, lambda i: dated_claim(F.get(pieces, i)).isNotNull())

        def report(i: Column) -> Column:
            before = F.array_join(F.slice(pieces, F.lit(1), i), "")
            sentence = F.get(pieces, i)
            return F.struct(
                (newlines(before) + 1).cast("long").alias("line"),
                dated_claim(sentence).alias("claim"),
                F.trim(F.regexp_replace(sentence, r"(?U)^\s+|\s+$", "")).alias("sentence"),
            )

        return F.transform(flagged, report)

    # a one-element array so that the split runs once per document
    return F.flatten(F.transform(F.array(sentences(text)), scan))


def html_links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'href="([^"]*)"'), F.lit(1))


def is_remote_link(href: Column) -> Column:
    return href.contains("://") | href.startswith("#") | href.startswith("mailto:")


def resolve_path(base_dir: Column, href: Column) -> Column:
    """Join a relative link to its folder and fold ``.`` and ``..``.

    A leading ``/`` starts again at the root. What leaves the tree keeps its
    leading ``..`` and so names no file in it.
    """
    joined = F.when(href.startswith("/"), href).otherwise(F.concat(base_dir, F.lit("/"), href))
    steps = F.filter(F.split(joined, "/"), lambda s: ~s.isin("", "."))
    folded = F.aggregate(
        steps,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(
            (s == "..") & (F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1) != ".."),
            F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    return F.array_join(folded, "/")
