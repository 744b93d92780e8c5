"""URL filters: rules first, then a tree of path templates per host, in built-in functions only.

Level by level, down to the end of every path, segments that fewer than
``SUPPORT`` urls of their branch have become a wildcard ``*``. Then, from the
deepest level up, sibling branches (equal but for one fixed segment) whose
labelled share does not differ from their common one by more than ``Z`` standard
errors become one branch, with ``?`` in that place. A branch is rejected if its
purity, the share of good labels smoothed towards the host's and that towards
the whole table's, is below ``REJECT``. ``*`` and ``?`` inside a path are
written ``%2A`` and ``%3F`` in templates.

Cases: a null url or one without ``://`` has an empty host and path; unlabelled
templates have the purity of their host, unlabelled hosts that of the table,
and an unlabelled table 1; repeated rows are judged alike and each counts; empty
tables give no rows; extra columns do not matter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plotkeep.llm.scratch import kept

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A segment stays fixed from this number of its branch's urls on.
SUPPORT = 10
# Thousands of siblings are compared at once: at three errors few differ by chance.
Z = 3.0
SMOOTH = 5.0
REJECT = 0.5

# (verdict, host, path): fits the host and its subdomains where the path begins so.
Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, null where none fits."""
    text = verdict = F.lit(None).cast("string")
    for says, of, begins in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(begins)
        text = F.when(fits, F.lit(of + begins)).otherwise(text)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def path_templates(paths: DataFrame) -> DataFrame:
    """Rows (host, path, n, labelled, good) with their ``template``: fixed segments or ``*``, all levels of the path.

    A level takes one round over the urls that still stand in a branch of ``SUPPORT`` urls.
    """
    segments = F.transform(
        F.array_remove(F.split("path", "/"), ""),
        lambda s: F.replace(F.replace(s, F.lit("*"), F.lit("%2A")), F.lit("?"), F.lit("%3F")))
    going = paths.withColumns({"segments": segments, "template": F.lit("")})
    finished, level = [], 0
    while True:
        left = F.greatest(F.size("segments") - level, F.lit(0))
        large = going.where(left > 0).groupBy("host", "template").agg(F.sum("n").alias("urls")).where(F.col("urls") >= SUPPORT)
        rows = going.join(large.select("host", "template", F.lit(True).alias("large")), ["host", "template"], "left")
        rows = kept(rows.withColumn("open", F.coalesce("large", F.lit(False)) & (left > 0)).drop("large"), "paths")
        # no segment of a small branch can be fixed
        whole = F.concat("template", F.repeat(F.lit("/*"), left))
        finished.append(rows.where(~F.col("open")).withColumn("template", whole).drop("open", "segments"))
        going = rows.where("open").drop("open").withColumn("segment", F.get("segments", F.lit(level)))
        if going.isEmpty():
            return reduce(DataFrame.unionByName, finished)
        key = ["host", "template", "segment"]
        fixed = going.groupBy(*key).agg(F.sum("n").alias("urls")).where(F.col("urls") >= SUPPORT)
        going = going.join(fixed.select(*key, F.lit(True).alias("fixed")), key, "left")
        token = F.when(F.col("fixed"), F.concat(F.lit("/"), "segment")).otherwise("/*")
        going = going.withColumn("template", F.concat("template", token)).drop("fixed", "segment")
        level += 1


def _merged(branches: DataFrame, place: int) -> DataFrame:
    """``branches`` (host, template, branch, labelled, good), alike siblings that differ at ``place`` with ``?`` there."""
    opened = F.regexp_replace("branch", rf"^((?:/[^/]*){{{place}}})/(?!\*(?:/|$))[^/]+", "$1/?")
    sums = branches.withColumn("shape", opened).where("shape <> branch").groupBy("host", "shape", "branch").agg(
        F.sum("labelled").alias("labelled"), F.sum("good").alias("good"))
    pool = sums.groupBy("host", "shape").agg(
        F.sum("labelled").alias("all"), F.sum("good").alias("all_good"), F.count("*").alias("siblings")).where("siblings > 1")
    share, common = F.col("good") / F.col("labelled"), F.col("all_good") / F.col("all")
    error = F.sqrt(common * (1 - common) / F.col("labelled"))
    alike = F.when(F.col("labelled") == 0, True).otherwise(F.abs(share - common) <= Z * error)
    merged = sums.join(pool, ["host", "shape"]).where(alike).select("host", "branch", "shape")
    return branches.join(merged, ["host", "branch"], "left").select(
        "host", "template", F.coalesce("shape", "branch").alias("branch"), "labelled", "good")


def purities(templates: DataFrame) -> DataFrame:
    """(host, template, branch, purity) from rows (host, template, labelled, good); ``branch`` is the merged template."""
    per = templates.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("good").alias("good"))
    per = kept(per.withColumn("branch", F.col("template")), "branches")
    levels = F.length("template") - F.length(F.replace("template", F.lit("/"), F.lit("")))
    for place in reversed(range(per.agg(F.max(levels)).first()[0] or 0)):  # one number
        per = kept(_merged(per, place), "branches")
    table = per.agg(F.sum("labelled").alias("labelled"), F.sum("good").alias("good")).first()  # two numbers
    prior = F.lit(table.good / table.labelled if table.labelled else 1.0)
    hosts = per.groupBy("host").agg(
        ((F.sum("good") + SMOOTH * prior) / (F.sum("labelled") + SMOOTH)).alias("host_purity"))
    branches = per.groupBy("host", "branch").agg(F.sum("labelled").alias("labelled"), F.sum("good").alias("good"))
    purity = (F.col("good") + SMOOTH * F.col("host_purity")) / (F.col("labelled") + SMOOTH)
    branches = branches.join(hosts, "host").select("host", "branch", purity.alias("purity"))
    return per.select("host", "template", "branch").join(branches, ["host", "branch"])


def judged(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row of ``pages`` (page_id, url, label).

    ``label`` is 1 (good), 0 or null.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), "label")
    paths = rows.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("good"))
    templates = path_templates(kept(paths, "urls"))
    known = templates.select("host", "path", "template").join(purities(templates), ["host", "template"])
    text, verdict = ruled(F.col("host"), F.col("path"), rules)
    by_tree = F.when(F.col("purity") < REJECT, "block").otherwise("allow")
    return rows.drop("label").join(known, ["host", "path"]).select(
        "page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, by_tree).alias("verdict"),
        F.col("branch").alias("template"), "purity")
