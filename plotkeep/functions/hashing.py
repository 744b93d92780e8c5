"""Row hashes whose sums do not depend on row order.

Two forms. The fast one is Spark's xxhash64; the portable one hashes a text
encoding with md5, so other engines can repeat it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMB_BITS = 21
LIMB_MASK = (1 << LIMB_BITS) - 1


def _explicit_nulls(col: Column, dt: T.DataType) -> Column:
    """Rewrite nested values so that nulls and lengths take part in the hash.

    xxhash64 skips nulls, so ``[1, null]`` and ``[null, 1]`` would collide.
    """
    if isinstance(dt, T.ArrayType):
        items = F.transform(
            col, lambda e: F.struct(e.isNull().alias("n"), _explicit_nulls(e, dt.elementType).alias("v"))
        )
        return F.struct(F.size(col).alias("size"), items.alias("items"))
    if isinstance(dt, T.MapType):
        entry = T.StructType([T.StructField("key", dt.keyType), T.StructField("value", dt.valueType)])
        return _explicit_nulls(F.array_sort(F.map_entries(col)), T.ArrayType(entry))
    if isinstance(dt, T.StructType):
        fields = []
        for field in dt.fields:
            child = col.getField(field.name)
            fields.append(child.isNull().alias(f"n_{field.name}"))
            fields.append(_explicit_nulls(child, field.dataType).alias(f"v_{field.name}"))
        return F.struct(*fields)
    return col


def fast_row_hash(schema: T.StructType, columns: Sequence[str] | None = None) -> Column:
    """64-bit hash of a row with a null bitmask in front."""
    names = list(columns or schema.names)
    terms: list[Column] = []
    for start in range(0, len(names), 60):
        mask = F.lit(0).cast("long")
        for bit, name in enumerate(names[start : start + 60]):
            mask = mask + F.when(F.col(f"`{name}`").isNull(), F.lit(1 << bit).cast("long")).otherwise(
                F.lit(0).cast("long")
            )
        terms.append(mask)
    terms += [_explicit_nulls(F.col(f"`{n}`"), schema[n].dataType) for n in names]
    return F.xxhash64(*terms)


def _text(col: Column, dt: T.DataType, scale: int) -> Column:
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        value = col.cast("double")
        odd = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
        return F.when(odd, value.cast("string")).otherwise(
            F.when(~odd, value).cast(T.DecimalType(38, scale)).cast("string")
        )
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")).cast("string")
    if isinstance(dt, T.BinaryType):
        return F.lower(F.hex(col))
    if isinstance(dt, T.ArrayType):
        return F.array_join(F.transform(col, lambda e: _field(e, dt.elementType, scale)), "")
    if isinstance(dt, T.StructType):
        fields = [_field(col.getField(f.name), f.dataType, scale) for f in dt.fields]
        return F.when(col.isNotNull(), F.concat(*fields))
    if isinstance(dt, T.MapType):
        raise TypeError("the portable hash has no stable text for maps; use the fast hash")
    return col.cast("string")


def _field(col: Column, dt: T.DataType, scale: int) -> Column:
    """Length-prefixed text, or ``N`` for null, so that no two rows share an encoding."""
    text = _text(col, dt, scale)
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("N"))


def portable_row_hash(schema: T.StructType, columns: Sequence[str] | None = None, scale: int = 6) -> Column:
    """60-bit hash of a row from md5 over a length-prefixed text encoding.

    Floating point goes through a decimal of the stated scale.
    """
    names = list(columns or schema.names)
    encoded = F.concat(*[_field(F.col(f"`{n}`"), schema[n].dataType, scale) for n in names])
    return F.conv(F.substring(F.md5(encoded), 1, 15), 16, 10).cast("long")


def hash_sum(h: Column) -> Column:
    """Exact sum of 64-bit hashes as decimal text, from three long sums.

    Long sums stay in generated code and are combined on the map side. A limb
    overflows only past 2**41 rows, and then ANSI mode raises.
    """
    low = F.sum(h.bitwiseAND(F.lit(LIMB_MASK)))
    mid = F.sum(F.shiftrightunsigned(h, LIMB_BITS).bitwiseAND(F.lit(LIMB_MASK)))
    top = F.sum(F.shiftright(h, 2 * LIMB_BITS))  # signed
    wide = T.DecimalType(38, 0)
    total = (
        top.cast(wide) * F.lit(1 << (2 * LIMB_BITS)).cast(T.DecimalType(14, 0))
        + mid.cast(wide) * F.lit(1 << LIMB_BITS).cast(T.DecimalType(8, 0))
        + low.cast(wide)
    )
    return F.coalesce(total.cast(wide).cast("string"), F.lit("0"))


def content_digest(h: Column) -> Column:
    """``sum:count``. A sum, unlike XOR, does not cancel a duplicated row."""
    return F.concat(hash_sum(h), F.lit(":"), F.count(F.lit(1)).cast("string"))
