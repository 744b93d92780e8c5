import re

from pyspark.sql import functions as F

from plotkeep.functions import prose as P
from plotkeep.operators import gates


def docs(spark, *texts):
    return spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "path string, text string")


def numbers(spark, text, counts=()):
    recorded = spark.createDataFrame([(c,) for c in counts], "recorded long") if counts else None
    return sorted((r.line, r["value"]) for r in gates.prose_numbers(docs(spark, text), recorded).collect())


def test_fences_keep_line_numbers(spark):
    text = "a\n```sql\nselect 1,000\n```\nb ```x``` c\n```\nopen"
    out = docs(spark, text).select(P.blank_fences(F.col("text")).alias("t")).first().t
    assert out == re.sub(r"(?s)```.*?```", lambda m: "\n" * m.group(0).count("\n"), text)
    assert numbers(spark, "```\n1,000\n```\nthe 2,000 rows") == [(4, "2,000")]


def test_numbers(spark):
    text = ("608,085 rows\nabout 94% and 3.5%\nid x1,234 and 1.1,234 stay\nlimit 200,000 is allowed\n"
            "1,234,567.89 and 12,34\n1,2345")
    assert numbers(spark, text) == [(1, "608,085"), (2, "3.5%"), (2, "94%"), (5, "1,234,567.89")]


def test_recorded_counts(spark):
    text = "the 195 overlays\n1950 and x195 and 195,000\nsee 195.\n1234 and 1,234\nlimit 200,000\n150% of 150\n39 rows"
    assert numbers(spark, text, [195, 1234, 200000, 150, 39]) == [
        (1, "195"), (2, "195,000"), (3, "195"), (4, "1,234"), (4, "1234"), (5, "200,000"), (6, "150"), (6, "150%")]


def test_unicode_neighbours(spark):
    assert numbers(spark, "é1,234 ü 1,234") == [(1, "1,234")]


DATED = """The rows change.
Extracted 2026-08-26 from the service. Nothing else.

The first version is 2026-08-26 and stays.
- written by hand in 2024
- see versions/2026-08-26.parquet, which never changes
# As of
spring 2025 it holds. Dated 22 August 2012 in words.
path/2026-01-02 and 2026-01-02-3 are no dates
"""


def test_dated_claims(spark):
    got = sorted((r.line, r.claim) for r in gates.dated_claims(docs(spark, DATED)).collect())
    assert got == [(2, "2026-08-26"), (5, "written by hand in 2024")]


def test_sentences_match_python(spark):
    text = "One. Two!  Three?\n\nFour\nwraps here\n- item one\n1. item two\n| a | b |\nEnd"
    pattern = re.compile(r"(?<=[.!?])\s+|\n\s*\n|\n(?=\s*(?:[-*#|]|\d+\.\s))")
    got = docs(spark, text).select(P.sentences(F.col("text")).alias("s")).first().s
    assert [s.rstrip() for s in got] == [s.rstrip() for s in pattern.split(text)]
    assert "".join(got) == text


def test_links(spark, rows):
    links = spark.createDataFrame([
        ("a/b", "./x.json"), ("a/b", "../x.json"), ("a/b", "../../../y.json"), ("a/b", "/root.json"), ("a/b", "gone.json"),
        ("a/b", "gone.json"), ("a/b", "https://x.org/a"), ("a/b", "#top"), ("a/b", "mailto:a@b.c"), ("a/b", ""),
        ("a", "b//gone.json"), ("", "data.PARQUET"),
    ], "doc_dir string, href string")
    inventory = spark.createDataFrame([("a/b/x.json",), ("a/x.json",), ("y.json",), ("root.json",)], "path string")
    assert rows(gates.unresolved_links(links, inventory)) == [("../y.json", 1), ("a/b/gone.json", 3), ("data.PARQUET", 1)]
    # a link to a data file must resolve in either mode; only an asset of that kind is exempt
    assert rows(gates.unresolved_links(links, inventory, light=True)) == rows(gates.unresolved_links(links, inventory))
    mixed = spark.createDataFrame([
        ("", "one.PARQUET", "asset data"), ("", "two.parquet", "rel:item"), ("", "three.json", "asset data"), ("", "four.zip", None),
    ], "doc_dir string, href string, source string")
    assert rows(gates.unresolved_links(mixed, inventory, light=True)) == [("four.zip", 1), ("three.json", 1), ("two.parquet", 1)]
    assert gates.unresolved_links(mixed, inventory).count() == 4


def test_broken_references_name_their_documents(spark, rows):
    data = [(i, "a", "gone.json") for i in range(50)] + [(50, "b", "../a/gone.json"), (51, "a", "here.json")]
    links = spark.createDataFrame(data, "doc int, doc_dir string, href string")
    inventory = spark.createDataFrame([("a/here.json",)], "path string")
    got = gates.broken_references(links, inventory, "doc", target_rows=10)
    assert rows(got.select("doc", "target")) == sorted(((i, "a/gone.json") for i in range(51)), key=repr)


def test_profile(spark):
    df = spark.createDataFrame([
        (1, ["https://p.org/v0.1.0/s.json"]), (2, ["https://p.org/v0.1.0/s.json##"]), (3, ["https://p.org/v0.1/s.json"]),
        (4, None), (5, [None, "x"]), (6, ["see https://p.org/v0.1.0/s.json"]),
    ], "id int, extensions array<string>")
    got = gates.declares_profile(df, r"https://p\.org/v\d+\.\d+\.\d+/s\.json")
    assert [r.declares for r in got.orderBy("id").collect()] == [True, True, False, False, False, False]


def test_blocking(spark, rows):
    findings = spark.createDataFrame([("error", "a"), ("error", "b"), ("warning", "c"), ("error", None)],
                                     "severity string, rule string")
    accepted = spark.createDataFrame([("b",)], "rule string")
    assert rows(gates.blocking_findings(findings, accepted).select("rule")) == [("a",), (None,)]
