"""Order-independent content hashes and row-level differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotkeep.functions import geometry as G
from plotkeep.functions.hashing import content_digest, fast_row_hash, portable_row_hash


def with_canonical_geometry(df: DataFrame, parts: str = "parts") -> DataFrame:
    """Replace one column by its canonical form, keeping all others."""
    return df.withColumn(parts, G.canonical(F.col(parts)))


def content_hash(
    df: DataFrame,
    by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    portable: bool = False,
    scale: int = 6,
    parts: str | None = None,
    out: str = "content_hash",
) -> DataFrame:
    """``sum:count`` of row hashes, for the table or per group.

    Equal multisets of rows give equal hashes whatever their order; a
    repeated, missing or changed row shows. An empty table gives ``0:0``.
    Geometry named by ``parts`` is canonicalised first. Partial sums are built
    before the shuffle, so a group of any size reaches its reducer as one row
    per task.
    """
    source = with_canonical_geometry(df, parts) if parts else df
    names = [c for c in (columns or source.columns) if c not in by]
    make = portable_row_hash(source.schema, names, scale) if portable else fast_row_hash(source.schema, names)
    hashed = source.select(*by, make.alias("_h"))
    return hashed.groupBy(*by).agg(content_digest(F.col("_h")).alias(out))


def changed_rows(old: DataFrame, new: DataFrame, diff: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that left and rows that came, from the keys of ``version_diff``. A null key is a key like others."""
    def of(rows: DataFrame, one_sided: str) -> DataFrame:
        named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]
        keys = diff.where(F.col("change").isin(one_sided, "changed")).select(*named)
        same = [rows[k].eqNullSafe(keys[f"_k{i}"]) for i, k in enumerate(key)]
        return rows.join(keys, same, "left_semi")

    return of(old, "removed"), of(new, "added")


def advance_hash(
    previous: DataFrame,
    removed: DataFrame,
    added: DataFrame,
    by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    portable: bool = False,
    scale: int = 6,
    parts: str | None = None,
    out: str = "content_hash",
) -> DataFrame:
    """The content hash of a version from its predecessor's and the rows that left and came.

    ``previous`` is what ``content_hash`` gave with the same arguments; the result equals
    what it gives for the new version, as sums of row hashes can be taken back. Only the
    rows that changed are read. A repeated row is taken or added as often as it is there.
    A group that has no rows left has no hash; a whole table that is empty has ``0:0``.
    Both sides must have the same columns; a version with other columns is hashed anew.
    """
    names = [c for c in (columns or added.columns) if c not in by]
    types = [[df.schema[c].dataType for c in (*by, *names)] for df in (removed, added)]
    if types[0] != types[1]:
        raise ValueError("rows of both versions must have the same columns")

    def change(df: DataFrame, sign: int) -> DataFrame:
        digest = F.split(out, ":")
        return content_hash(df.select(*by, *names), by, columns, portable, scale, parts, out).select(
            *by, (digest[0].cast("decimal(38,0)") * sign).cast("decimal(38,0)").alias("_sum"),
            (digest[1].cast("long") * sign).alias("_n"))

    digest = F.split(out, ":")
    known = previous.select(*by, digest[0].cast("decimal(38,0)").alias("_sum"), digest[1].cast("long").alias("_n"))
    total = known.union(change(removed, -1)).union(change(added, 1)).groupBy(*by).agg(
        F.coalesce(F.sum("_sum").cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")).alias("_sum"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"))
    left = total.where("_n <> 0 or _sum <> 0") if by else total
    return left.select(*by, F.concat(F.col("_sum").cast("string"), F.lit(":"), F.col("_n").cast("string")).alias(out))


def version_diff(old: DataFrame, new: DataFrame, key: Sequence[str], parts: str | None = None) -> DataFrame:
    """(key, change) of rows added, removed or changed between two versions.

    Both sides are reduced to row hashes and met in one grouped aggregation:
    repeated keys are compared as multisets, and a hot key is combined before
    the shuffle instead of being joined with itself. Rows are compared over the
    columns of both sides: a column one side lacks is null there, and a column
    of another type changes every row.
    """
    names = sorted({*old.columns, *new.columns} - set(key))
    drifted = [c for c in names if c in old.columns and c in new.columns and old.schema[c].dataType != new.schema[c].dataType]

    def side(df: DataFrame, is_new: int) -> DataFrame:
        other = old if is_new else new
        df = df.withColumns({c: F.lit(None).cast(other.schema[c].dataType) for c in names if c not in df.columns})
        source = with_canonical_geometry(df, parts) if parts else df
        types = ",".join(df.schema[c].dataType.simpleString() for c in drifted)
        source = source.withColumn("_types", F.lit(types))
        h = fast_row_hash(source.schema, [*names, "_types"])
        return source.select(*key, h.alias("_h"), F.lit(is_new).alias("_new"))

    both = side(old, 0).unionByName(side(new, 1))
    is_new = F.col("_new") == 1
    # 32-bit halves keep the sums inside a long
    high, low = F.shiftright("_h", 32), F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF))

    def total(v, cond):
        return F.coalesce(F.sum(F.when(cond, v)), F.lit(0))

    return (
        both.groupBy(*key)
        .agg(
            F.count_if(~is_new).alias("_n_old"),
            F.count_if(is_new).alias("_n_new"),
            (
                (total(high, is_new) == total(high, ~is_new)) & (total(low, is_new) == total(low, ~is_new))
            ).alias("_equal"),
        )
        .select(
            *key,
            F.when(F.col("_n_old") == 0, "added")
            .when(F.col("_n_new") == 0, "removed")
            .when((F.col("_n_old") != F.col("_n_new")) | ~F.col("_equal"), "changed")
            .alias("change"),
        )
        .where("change is not null")
    )


def no_op_checks(current: DataFrame, extracted: DataFrame) -> DataFrame:
    """Compare content hashes per collection: (collection, current, extracted, no_op).

    An equal hash means no new version, also for a forced run.
    """
    return (
        extracted.select("collection", F.col("content_hash").alias("extracted_hash"))
        .join(current.select("collection", F.col("content_hash").alias("current_hash")), "collection", "left")
        .withColumn("no_op", F.coalesce(F.col("extracted_hash") == F.col("current_hash"), F.lit(False)))
    )
