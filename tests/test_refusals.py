"""Gates on inputs they must refuse, and results that must not lose rows or columns."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from plotkeep.functions import prose
from plotkeep.functions.clean import split_items
from plotkeep.operators.content import version_diff
from plotkeep.operators.legend import RULES_SCHEMA
from plotkeep.operators.refresh import due_decisions
from plotkeep.operators.skew import split_hot_keys
from plotkeep.operators.tiles import tile_counts, tile_features
from plotkeep.operators.validity import repair_geometries
from plotkeep.plans.refresh_run import Extract, Refused, refresh_all
from plotkeep.sources import tables as S
from plotkeep.sources.pages import page_completeness

NOW = datetime(2025, 6, 2, 8, tzinfo=timezone.utc)


def pages(spark, *parts):
    body = lambda n, more: '{"features":[%s],"exceededTransferLimit":%s}' % (
        ",".join(['{"attributes":{}}'] * n), str(more).lower())
    rows = [("c", offset, body(n, more)) for offset, n, more in parts]
    return page_completeness(spark.createDataFrame(rows, "collection string, page_offset long, body string")).first().complete


def test_pages(spark):
    assert pages(spark, (0, 3, True), (3, 2, False))
    assert pages(spark, (0, 3, True), (3, 0, False))
    assert not pages(spark, (0, 3, True), (3, 2, False), (0, 3, True))  # landed twice
    assert not pages(spark, (0, 3, True), (2, 1, True), (3, 2, False))  # overlap
    assert not pages(spark, (0, 3, False), (3, 2, True))  # the middle page is marked last


def test_unprobed_sources_are_reported(spark):
    sources = spark.createDataFrame([("a", 1), ("b", 1)], "collection string, min_days int")
    probes = spark.createDataFrame([("a", NOW)], "collection string, data_last_edit timestamp")
    current = spark.createDataFrame([], "collection string, created timestamp, source_updated timestamp")
    checks = spark.createDataFrame([], "collection string, source_updated timestamp")
    for force in (False, True):
        got = {r.collection: (r.due, r.reason) for r in due_decisions(sources, probes, current, checks, NOW, force).collect()}
        assert got["a"][0] and not got["b"][0] and got["b"][1].endswith("no probe")


@pytest.mark.parametrize("sep", ["^", "]", "\\", ";", "|"])
def test_any_separator(spark, sep):
    df = spark.createDataFrame([(f"a {sep} b{sep}{sep}c",)], "x string")
    assert df.select(split_items(F.col("x"), sep).alias("x")).first().x == ["a", "b", "c"]


def test_flags_do_not_replace_columns(spark):
    df = spark.createDataFrame([(1, "mine", None)], "id int, outcome string, parts array<array<array<struct<x:double,y:double>>>>")
    with pytest.raises(ValueError, match="outcome"):
        repair_geometries(df)


def folders(spark, root):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/c/versions")
    return [s.getPath().getName() for s in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]


def test_refresh_keeps_columns_and_removes_what_it_staged(spark, tmp_path):
    root = str(tmp_path)

    def run(name, rows, n, rules=None):
        extract = Extract("c", rows, "id", NOW, n, n, rules=rules)
        return refresh_all(spark, root, [extract], NOW, name).first()

    one = spark.createDataFrame([(1, "valid"), (2, "null")], "id long, outcome string")
    two = one.withColumn("outcome", F.lit("changed"))
    assert run("r1", one, 2).status == "ok"
    assert run("r2", one, 2).detail.startswith("rows unchanged")
    assert run("r3", two, 5).status == "error"
    labels = [(float(i), None) for i in range(100, 130)]
    rules = spark.createDataFrame([("s", 0, "match", "id", labels, [])], RULES_SCHEMA)
    refused = run("r4", two, 2, rules)
    assert refused.status == "style" and refused.detail.startswith("30 legend findings")
    assert spark.read.parquet(f"{root}/findings/c/r4").where("finding = 'empty_branch'").count() == 30
    assert folders(spark, root) == ["r1"]
    assert run("r5", two, 2).detail.startswith("version")
    assert {r.outcome for r in S.read_current(spark, root, "c").collect()} == {"changed"}


def test_no_limit_on_tiles_unless_asked(spark):
    df = spark.range(100).select("id", F.struct(*[F.lit(1.0).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")]).alias("bbox"))
    assert tile_features(df, "id", min_zoom=0, max_zoom=1).where("kept").count() == 200
    flags = tile_features(df, "id", min_zoom=0, max_zoom=0, limit=30)
    assert flags.count() == 100 and flags.where("kept").count() == 30
    assert tile_counts(df, min_zoom=0, max_zoom=0).first().dropped == 0


def test_every_hot_key_is_split(spark):
    left = spark.range(300).select((F.col("id") % 3).alias("k"), "id")
    right = spark.range(3).select(F.col("id").alias("k"))
    one, two, on = split_hot_keys(left, right, ["k"], ["id"], target_rows=10)
    assert two.groupBy("k").count().where("count = 10").count() == 3
    assert one.join(two, on).count() == 300


def test_version_diff_over_drifted_columns(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "id long, x string, gone int")
    changes = lambda new: {r.id: r.change for r in version_diff(old, new, ["id"]).collect()}
    assert changes(old) == {}
    assert changes(old.drop("gone")) == {1: "changed", 2: "changed", 3: "changed"}
    more = old.withColumn("more", F.when(F.col("id") == 2, "new"))
    assert changes(more) == {2: "changed"}
    assert changes(old.withColumn("gone", F.col("gone").cast("long"))) == {1: "changed", 2: "changed", 3: "changed"}


def test_control_characters_do_not_end_sentences(spark):
    df = spark.createDataFrame([("Extracted\x01 on 2024-05-06. Next.",)], "text string")
    assert df.select(prose.sentences(F.col("text")).alias("s")).first().s == ["Extracted\x01 on 2024-05-06. ", "Next."]


def test_keys_hot_on_either_side_meet_once(spark):
    left = spark.range(90).select((F.col("id") % 3).alias("k"), F.col("id").alias("a"))
    right = spark.range(120).select((F.col("id") % 3 + 1).alias("k"), F.col("id").alias("b"))
    one, two, on = split_hot_keys(left, right, ["k"], ["a"], 10, ["b"])
    got = sorted((r.a, r.b) for r in one.join(two, on).collect())
    assert got == sorted((a, b) for a in range(90) for b in range(120) if a % 3 == b % 3 + 1)
    assert two.where("k = 2").select("_salt", "_cut").distinct().count() > 3


def test_refresh_refuses_first_and_stamps_last(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(3)
    page = '{"features": [{"attributes": {}}, {"attributes": {}}, {"attributes": {}}]%s}'

    def run(label, published=None, body=page % "", n=3):
        pages = spark.createDataFrame([("c", 0, body)], "collection string, page_offset long, body string")
        extract = Extract("c", rows, "id", NOW, n, n, pages=pages)
        return refresh_all(spark, root, [extract], NOW, label, published).first()

    assert run("r1", body=page % ', "exceededTransferLimit": true').status == "error"
    assert run("r2", n=4).detail == "the landed pages hold 3 rows of 4"
    assert S.read_stamps(spark, root).count() == 0
    assert run("r3").version == "2025-06-02"
    assert [r.updated for r in S.read_stamps(spark, root).collect()] == ["2025-06-02T08:00:00Z"]
    facts = S.read_manifest(spark, root).first()
    assert [tuple(c) for c in facts.columns] == [("id", "bigint")] and facts.bbox is None
    ahead = spark.createDataFrame([("c", "2025-06-02"), ("c", "2025-07-01"), ("d", None)], "collection string, version string")
    with pytest.raises(Refused, match="1 published versions"):
        run("r4", ahead)
    assert folders(spark, root) == ["r3"]
    # an unchanged collection leaves the stamp as it is
    assert run("r5", ahead.limit(1)).detail.startswith("rows unchanged")
    assert S.read_stamps(spark, root).count() == 1
