"""Legend drift: does a map style still describe the data it paints?

Rules are rows (style, rule_no, kind, column, labels, stops): ``match`` rules
carry typed labels, ``step`` rules carry class stops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plotkeep.operators.profile import class_index, distinct_value_counts

RULES_SCHEMA = (
    "style string, rule_no int, kind string, column string, "
    "labels array<struct<num:double,str:string>>, stops array<double>"
)
_RULE = ["style", "rule_no", "kind", "column"]


def _shown(num: Column, text: Column) -> Column:
    """Whole numbers without a fraction, text in quotes."""
    whole = num == F.floor(num)
    number = F.when(whole, num.cast("decimal(20,0)").cast("string")).otherwise(num.cast("string"))
    return F.coalesce(F.concat(F.lit("'"), text, F.lit("'")), number)


def _same_value(a: DataFrame, b: DataFrame) -> Column:
    """Numbers equal as doubles, text as text, never across; NaN equals nothing."""
    return (
        a["num"].eqNullSafe(b["num"])
        & a["str"].eqNullSafe(b["str"])
        & ~F.coalesce(F.isnan(a["num"]), F.lit(False))
    )


def _finding(df: DataFrame, finding: str, detail: Column, n: Column) -> DataFrame:
    return df.select(*_RULE, F.lit(finding).alias("finding"), detail.alias("detail"), n.cast("long").alias("n"))


def _paths(schema: T.StructType) -> dict[str, Column]:
    """Every field by its own name. Of several of one name, the least nested counts."""
    found: dict[str, Column] = {}
    level = [(field, F.col(f"`{field.name}`")) for field in schema.fields]
    while level:
        for field, column in level:
            found.setdefault(field.name, column)
        level = [
            (inner, column.getField(inner.name))
            for field, column in level if isinstance(field.dataType, T.StructType) for inner in field.dataType.fields
        ]
    return found


def _flat(df: DataFrame, names: list[str]) -> DataFrame:
    """The named fields that a table has, nested ones among them, as its columns."""
    paths = _paths(df.schema)
    return df.select(*[paths[name].alias(name) for name in names if name in paths])


def legend_drift(rules: DataFrame, new: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Findings: column_gone, empty_branch, empty_class and new_value.

    A styled column may be a field of a struct and is found by its own name.
    Values that already fell to the fallback before are left alone. All
    styled columns are profiled in one scan per table; the joins work on
    distinct values.
    """
    styled = [r[0] for r in rules.select("column").distinct().collect()]  # one entry per styled column
    new = _flat(new, styled)
    previous = None if previous is None else _flat(previous, styled)
    here = new.columns
    gone = rules.where(~F.col("column").isin(here)) if here else rules
    findings = _finding(gone, "column_gone", F.lit("the column is gone from the new data"), F.lit(None))
    if not here:
        return findings
    live = rules.where(F.col("column").isin(here))
    counts = distinct_value_counts(new, here)
    labels = live.where("kind = 'match'").select(*_RULE, F.inline("labels")).distinct()

    l, c = labels.alias("l"), counts.alias("c")
    hit = (F.col("l.column") == F.col("c.column")) & F.col("l.num").eqNullSafe(F.col("c.num")) & F.col(
        "l.str"
    ).eqNullSafe(F.col("c.str"))
    unused = l.join(c, hit, "left_anti")
    findings = findings.unionByName(
        _finding(
            unused, "empty_branch",
            F.concat(F.lit("branch "), _shown(F.col("num"), F.col("str")), F.lit(" matches no row")), F.lit(None),
        )
    )

    steps = live.where("kind = 'step'")
    number = F.coalesce(F.col("num"), F.col("str").try_cast("double"))
    filled = (
        steps.join(counts.withColumn("_v", number), "column")
        .select(*_RULE, class_index(F.col("_v"), F.col("stops")).alias("class"))
        .where("class is not null")
        .distinct()
    )
    classes = steps.select("*", F.explode(F.sequence(F.lit(0), F.size("stops"))).alias("class"))
    low = F.coalesce(F.get("stops", F.col("class") - 1).cast("string"), F.lit("-inf"))
    high = F.coalesce(F.get("stops", F.col("class")).cast("string"), F.lit("inf"))
    empty = classes.join(filled, [*_RULE, "class"], "left_anti")
    findings = findings.unionByName(
        _finding(
            empty, "empty_class",
            F.concat(F.lit("class ["), low, F.lit(", "), high, F.lit(") holds no row")), F.lit(None),
        )
    )

    known = [c for c in here if previous is not None and c in previous.columns]
    if known:
        before = distinct_value_counts(previous, known)
        match_rules = live.where((F.col("kind") == "match") & F.col("column").isin(known)).select(*_RULE).distinct()
        values = counts.join(match_rules, "column").select(*_RULE, "num", "str", "n")
        rule_is = [values[k] == labels[k] for k in _RULE]
        unnamed = values.join(labels, [*rule_is, _same_value(values, labels)], "left_anti")
        fresh = unnamed.join(
            before, (unnamed["column"] == before["column"]) & _same_value(unnamed, before), "left_anti"
        )
        detail = F.concat(F.lit("new value "), _shown(F.col("num"), F.col("str")), F.lit(" has no branch"))
        findings = findings.unionByName(_finding(fresh, "new_value", detail, F.col("n")))
    return findings
