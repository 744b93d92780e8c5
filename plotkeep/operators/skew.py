"""Spread rows and hot join keys over several tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TARGET_ROWS = 1_000_000


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over the shuffle partitions, for costly work on each: a small file would be read by few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _parts(df: DataFrame, keys: list[str], target_rows: int, name: str) -> DataFrame:
    """Keys with more than ``target_rows`` rows and the number of parts they are cut into."""
    return df.groupBy(*keys).count().where(F.col("count") > target_rows).select(
        *keys, F.ceil(F.col("count") / F.lit(target_rows)).alias(name))


def split_hot_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    target_rows: int = TARGET_ROWS,
    spread_right: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Give an equi-join (inner, left or semi) an extra key that splits hot keys.

    Rows of a key that is hot in ``left`` are spread by a hash of ``spread`` (a
    row identifier, so that copies spread too) and the matching ``right`` rows
    are repeated once per split. With ``spread_right`` (inner joins only) keys
    that are hot in ``right`` are cut the same way the other way round. The hash
    is deterministic: a rerun task places rows alike. Every pair still meets
    exactly once. Rows without a key match nothing and are spread as well. At
    most rows / ``target_rows`` keys are hot; how that table is joined is left
    to Spark.
    """
    keys = list(keys)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    hot = _parts(left, keys, target_rows, "_splits")
    if spread_right:
        hot = hot.join(_parts(right, keys, target_rows, "_cuts"), keys, "full")

    def salt(columns: Sequence[str], parts: str) -> Column:
        row_hash = F.xxhash64(*columns)
        return F.when(no_key, row_hash).otherwise(F.coalesce(F.pmod(row_hash, F.col(parts)), zero))

    def every(parts: str) -> Column:
        return F.explode(F.sequence(zero, F.coalesce(F.col(parts), one) - 1))

    left = left.join(hot, keys, "left").withColumn("_salt", salt(spread, "_splits"))
    right = right.join(hot, keys, "left").withColumn("_salt", every("_splits"))
    if not spread_right:
        return left.drop("_splits"), right.drop("_splits"), keys + ["_salt"]
    left = left.withColumn("_cut", every("_cuts")).drop("_splits", "_cuts")
    right = right.withColumn("_cut", salt(spread_right, "_cuts")).drop("_splits", "_cuts")
    return left, right, keys + ["_salt", "_cut"]
