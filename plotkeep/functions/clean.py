"""Scalar cleaning rules for attribute columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Literal strings that stand for a missing value.
NULL_TOKENS = ("null", "NULL")

# The four published confidence ranks.
RANKS = (0.5, 0.667, 0.833, 1.0)

# Media type per file suffix.
CONTENT_TYPES = {
    ".json": "application/json",
    ".geojson": "application/geo+json",
    ".parquet": "application/vnd.apache.parquet",
    ".pmtiles": "application/vnd.pmtiles",
    ".md": "text/markdown; charset=utf-8",
    ".txt": "text/plain; charset=utf-8",
    ".png": "image/png",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".webp": "image/webp",
    ".svg": "image/svg+xml",
    ".tif": "image/tiff; application=geotiff",
    ".tiff": "image/tiff; application=geotiff",
    ".laz": "application/vnd.laszip",
    ".xml": "application/xml",
    ".yaml": "application/yaml",
}
DEFAULT_CONTENT_TYPE = "application/octet-stream"
STYLE_CONTENT_TYPE = "application/vnd.mapbox.style+json"

# Suffixes of data objects that may be published.
DATA_SUFFIXES = (".parquet", ".pmtiles", ".tif", ".tiff", ".laz")


def null_tokens_to_null(col: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Exact token matches become null; everything else is kept."""
    return F.when(~col.isin(list(tokens)), col)


def split_items(col: Column, sep: str = ";") -> Column:
    """Multi-valued text to an array of trimmed, non-empty items."""
    items = F.transform(F.split(col, re.escape(sep)), lambda item: F.trim(item))
    return F.filter(items, lambda item: item != "")


def snap_to(col: Column, values: Sequence[float] = RANKS, eps: float = 5e-4) -> Column:
    """The listed value within ``eps`` of a float, else null."""
    hit = F.lit(None).cast("double")
    for value in values:
        hit = F.when(F.abs(col - F.lit(float(value))) < F.lit(eps), F.lit(float(value))).otherwise(hit)
    return hit


def code_label(col: Column, book: Mapping[object, str]) -> Column:
    """Decode a clean code through a small fixed code book; unknown codes are null."""
    pairs = [F.lit(x) for pair in book.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), col)


def address_key(col: Column) -> Column:
    """Upper case, single spaces, no outer blanks."""
    return F.upper(F.trim(F.regexp_replace(col, r"\s+", " ")))


def first_known(*cols: Column, empty: object = 0) -> Column:
    """First value that is neither null nor ``empty`` (0 for numbers, '' for text)."""
    return F.coalesce(*[F.nullif(c, F.lit(empty)) for c in cols])


def utc_from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms.cast("long"))


def iso_utc(ts: Column) -> Column:
    """Second-precision ISO text; assumes the session time zone is UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_iso_utc(text: Column) -> Column:
    return F.to_timestamp(text, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def typed_value(col: Column, data_type: T.DataType) -> tuple[Column, Column]:
    """A value as a (number, text) pair, exactly one of which is set.

    Numbers compare as doubles and text compares as text, so ``'1'`` and ``1``
    stay different. Booleans count as numbers, like true = 1.
    """
    null_num, null_str = F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(data_type, T.BooleanType):
        return col.cast("int").cast("double"), null_str
    if isinstance(data_type, T.NumericType):
        return col.cast("double"), null_str
    return null_num, col.cast("string")


def suffix(path: Column) -> Column:
    """Lower-case suffix of the last path component, or empty text.

    A leading dot alone is part of the name, not a suffix.
    """
    return F.lower(F.regexp_extract(path, r"[^/]+?(\.[^./]+)$", 1))


def content_type(path: Column) -> Column:
    """Media type from suffix and location."""
    name = F.substring_index(path, "/", -1)
    in_styles = F.array_contains(F.split(path, "/"), "styles")
    is_style = path.rlike(r"\.json$") & (name.endswith(".style.json") | in_styles)
    pairs = [F.lit(x) for pair in CONTENT_TYPES.items() for x in pair]
    known = F.try_element_at(F.create_map(*pairs), suffix(path))
    return F.when(is_style, STYLE_CONTENT_TYPE).otherwise(F.coalesce(known, F.lit(DEFAULT_CONTENT_TYPE)))


def has_dot_component(path: Column) -> Column:
    return path.rlike(r"(^|/)\.")


def is_data_object(path: Column) -> Column:
    """No dot component, and a suffix from the allow-list."""
    return ~has_dot_component(path) & suffix(path).isin(list(DATA_SUFFIXES))


def is_archive_key(key: Column) -> Column:
    return F.concat(F.lit("/"), key).contains("/versions/")


def split_bucket_uri(uri: Column) -> tuple[Column, Column]:
    """(bucket, prefix) of an ``s3://`` URI; outer slashes are dropped. Others give null."""
    rest = F.when(uri.startswith("s3://"), F.trim(F.substr(uri, F.lit(6)), F.lit("/")))
    return F.regexp_extract(rest, r"^([^/]*)", 1), F.regexp_extract(rest, r"^[^/]*/(.*)$", 1)


def object_key(prefix: str, rel: Column) -> Column:
    return F.concat(F.lit(f"{prefix}/"), rel) if prefix else rel


def md5_hex(content: Column) -> Column:
    return F.md5(content)


def multihash(content: Column) -> Column:
    """sha2-256 multihash: code 12, length 20, then the digest."""
    return F.concat(F.lit("1220"), F.sha2(content, 256))
