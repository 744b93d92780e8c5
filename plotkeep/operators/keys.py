"""Joins by code or address, and how well a candidate key matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotkeep.functions.clean import address_key, split_items
from plotkeep.operators.skew import TARGET_ROWS, split_hot_keys


def decoded_counts(
    facts: DataFrame, code: str, lookup: DataFrame, lookup_code: str, labels: Sequence[str], out: str = "n"
) -> DataFrame:
    """Rows per label, most frequent first.

    Facts are counted per code before the join: a code that holds a third of
    all rows crosses the shuffle as one row per task. Whether the lookup is
    broadcast is left to its measured size.
    """
    counted = facts.groupBy(F.col(code).alias("_code")).agg(F.count(F.lit(1)).alias("_n"))
    return (
        counted.join(lookup, F.col("_code") == F.col(lookup_code))
        .groupBy(*labels)
        .agg(F.sum("_n").alias(out))
        .orderBy(F.desc(out), *labels)
    )


def unmatched_codes(facts: DataFrame, code: Column, lookup: DataFrame, lookup_code: str) -> DataFrame:
    """(code, n) of codes without a lookup row. An empty result means complete."""
    counted = facts.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"))
    known = lookup.select(F.col(lookup_code).alias("code"))
    return counted.join(known, "code", "left_anti")


def key_match_rate(left: DataFrame, left_key: Column, right: DataFrame, right_key: Column) -> DataFrame:
    """Share of distinct keys that occur on the other side, in both directions.

    One grouped pass over both key columns; no join, so no hot key can multiply.
    """
    keys = left.select(left_key.alias("k"), F.lit(True).alias("in_left")).unionByName(
        right.select(right_key.alias("k"), F.lit(False).alias("in_left"))
    )
    sides = keys.where("k is not null").groupBy("k").agg(
        F.bool_or("in_left").alias("l"), F.bool_or(~F.col("in_left")).alias("r")
    )
    totals = sides.agg(
        F.count_if("l").alias("n_left"), F.count_if("r").alias("n_right"),
        F.count_if(F.col("l") & F.col("r")).alias("n_both"),
    )

    def row(direction: str, total: Column) -> Column:
        rate = F.when(total > 0, F.round(F.col("n_both") / total, 6))
        return F.struct(
            F.lit(direction).alias("direction"), total.alias("distinct_keys"),
            F.col("n_both").alias("matched_keys"), rate.alias("match_rate"),
        )

    return totals.select(
        F.inline(F.array(row("left_to_right", F.col("n_left")), row("right_to_left", F.col("n_right"))))
    )


def match_by_address(
    left: DataFrame, left_address: str, left_id: str, right: DataFrame, right_address: str, right_id: str,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Left rows with the number of right rows at the same address and the lowest of their ids.

    The right side is reduced to one row per address first, so a shared
    address never multiplies rows; a placeholder address that many left rows
    carry is split over several tasks.
    """
    by_address = (
        right.select(address_key(F.col(right_address)).alias("address_key"), F.col(right_id).alias("_rid"))
        .where("address_key is not null")
        .groupBy("address_key")
        .agg(F.count(F.lit(1)).alias("matches"), F.min("_rid").alias("first_match"))
    )
    keyed = left.withColumn("address_key", address_key(F.col(left_address)))
    keyed, by_address, on = split_hot_keys(keyed, by_address, ["address_key"], [left_id], target_rows)
    return (
        keyed.join(by_address, on, "left")
        .withColumn("matches", F.coalesce("matches", F.lit(0)))
        .drop("_salt")
    )


def code_book(df: DataFrame, code: str, label: str) -> DataFrame:
    """The label of each code, from rows whose label is text and not a bare digit.

    The most frequent label wins, the alphabetically first among equals.
    """
    # a bare number is a code repeated, not a label
    usable = df.where(F.col(label).isNotNull() & ~F.trim(F.col(label)).rlike(r"^\d*$"))
    counted = usable.groupBy(F.col(code).alias("code"), F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("label"))).alias("best")
    return counted.groupBy("code").agg(best).select("code", "best.label", (-F.col("best.minus_n")).alias("n"))


def item_counts(df: DataFrame, column: str, sep: str = ";") -> DataFrame:
    """Rows per single item of a multi-valued column."""
    return (
        df.select(F.explode(split_items(F.col(column), sep)).alias("item"))
        .groupBy("item")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def unit_totals(df: DataFrame, column: str, by: Sequence[str], units: Sequence[str], sep: str = ";") -> DataFrame:
    """Unit sums per item, plus an ``(all)`` row per group from the unsplit rows.

    A row with two items counts under both, so item sums do not add up to
    the total.
    """
    # reduce by the raw combination first; the split then works on few rows
    sums = [F.sum(u).alias(u) for u in units]
    combos = df.groupBy(*by, column).agg(*sums)
    items = combos.withColumn("item", F.explode(split_items(F.col(column), sep))).groupBy(*by, "item").agg(*sums)
    return items.unionByName(combos.groupBy(*by).agg(*sums).withColumn("item", F.lit("(all)")))


def rollup_by(df: DataFrame, by: Sequence[str], measure: str) -> DataFrame:
    """Count and mean per attribute, without a spatial join."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(measure), 4).alias("mean"))
