import math
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from plotkeep.functions.geometry import bbox, box_parts
from plotkeep.operators import keys, profile
from plotkeep.plans.refresh_run import Extract, decide_due, refresh_all, run_due
from plotkeep.sources import pages as P
from plotkeep.sources import tables as S

FIELDS = (("objectid", "esriFieldTypeOID"), ("name", "esriFieldTypeString"), ("h", "esriFieldTypeDouble"),
          ("edited", "esriFieldTypeDate"), ("flag", "esriFieldTypeSmallInteger"))


def page(rows, more):
    import json
    features = [{"attributes": dict(zip([f for f, _ in FIELDS], r))} for r in rows]
    return json.dumps({"features": features, "exceededTransferLimit": more, "other": 1})


def test_page_rows(spark):
    df = spark.createDataFrame([
        ("c", 0, page([(1, "a", 1.5, 1791446400000, 1), (2, None, None, None, None)], True)),
        ("c", 2, page([(3, "c", 2, 0, 2)], False)),
    ], "collection string, page_offset long, body string")
    out = P.page_rows(df, FIELDS).orderBy("objectid")
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "string", "double", "timestamp", "smallint"]
    assert [tuple(r) for r in out.collect()] == [
        (1, "a", 1.5, datetime(2026, 10, 8, 8), 1), (2, None, None, None, None), (3, "c", 2.0, datetime(1970, 1, 1), 2)]


def test_unmapped_field_type():
    with pytest.raises(ValueError, match="unmapped field type esriFieldTypeBlob"):
        P.column_types([("a", "esriFieldTypeBlob")])


def test_malformed_page_fails(spark):
    df = spark.createDataFrame([("c", 0, '{"features": [{"attri')], "collection string, page_offset long, body string")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        P.page_rows(df, FIELDS).collect()


def test_completeness(spark):
    row = (1, "a", 1.0, None, None)
    data = [("whole", 0, page([row] * 2, True)), ("whole", 2, page([row], False)),
            ("empty end", 0, page([row] * 2, True)), ("empty end", 2, page([], True)),
            ("gap", 0, page([row] * 2, True)), ("gap", 4, page([row], False)),
            ("no end", 0, page([row] * 2, True)),
            ("no start", 2, page([row] * 2, False)),
            ("empty", 0, page([], False))]
    df = spark.createDataFrame(data, "collection string, page_offset long, body string")
    got = {r.collection: (r.row_count, r.gaps, r.complete) for r in P.page_completeness(df).collect()}
    assert got == {"whole": (3, 0, True), "empty end": (2, 0, True), "gap": (3, 1, False), "no end": (2, 0, False),
                   "no start": (2, 1, False), "empty": (0, 0, True)}


def test_page_files(spark, tmp_path):
    (tmp_path / "roads").mkdir()
    (tmp_path / "roads" / "0.json").write_text(page([(1, "a", 1.0, None, None)], False))
    out = P.read_page_files(spark, str(tmp_path)).first()
    assert (out.collection, out.page_offset) == ("roads", 0)
    assert P.page_rows(P.read_page_files(spark, str(tmp_path)), FIELDS).count() == 1


def test_probe_state(spark):
    df = spark.createDataFrame([("a", 1791446400000, 5, 1), ("b", 0, 1791446400000, 2)],
                               "collection string, data_edit_ms long, edit_ms long, row_count long")
    assert {r.data_last_edit for r in P.probe_state(df).collect()} == {datetime(2026, 10, 8, 8)}
    lost = spark.createDataFrame([("c", None, None, 1)], df.schema)
    with pytest.raises(Exception, match="reports no edit time"):
        P.probe_state(lost).collect()


def test_step_histogram(spark):
    df = spark.createDataFrame([(v,) for v in (-math.inf, 0.1, 0.5, 0.6, math.inf, math.nan, None)], "v double")
    got = [(r.class_index, r.n, r.empty) for r in profile.step_histogram(df, F.col("v"), [0.5, 0.9]).orderBy("class_index").collect()]
    assert got == [(0, 2, False), (1, 2, False), (2, 0, True)]


def test_distinct_values(spark, rows):
    df = spark.createDataFrame([(1, "1"), (1, None), (None, "x")], "n int, s string")
    assert rows(profile.distinct_value_counts(df, ["n", "s"])) == [("n", 1.0, None, 2), ("s", None, "1", 1), ("s", None, "x", 1)]


def test_parity(spark):
    frame = lambda data: spark.createDataFrame(data, "collection string, n long")
    got = profile.row_parity(frame([("a", 3), ("b", 3), ("c", 3)]), frame([("a", 3), ("b", 4), ("c", 3)]),
                             frame([("a", 3), ("b", 3)]))
    assert {r.collection: r.ok for r in got.collect()} == {"a": True, "b": False, "c": False}


def test_code_book(spark, rows):
    data = [(1, "1"), (1, "1 Residential"), (1, "1 Residential"), (1, "Homes"), (2, "b"), (2, "a"), (3, "3"), (3, None),
            (4, " 4 ")]
    df = spark.createDataFrame(data, "code int, label string")
    assert rows(keys.code_book(df, "code", "label")) == [(1, "1 Residential", 2), (2, "a", 1)]


def test_match_rate(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,), (3,), (4,)], "k int")
    got = {r.direction: (r.distinct_keys, r.matched_keys, r.match_rate)
           for r in keys.key_match_rate(a, F.col("k"), b, F.col("k")).collect()}
    assert got == {"left_to_right": (2, 1, 0.5), "right_to_left": (3, 1, 0.333333)}


def test_store_versions(spark, tmp_path):
    root = str(tmp_path / "store")
    at = lambda day, hour=7: datetime(2026, 10, day, hour, tzinfo=timezone.utc)
    lots = spark.range(12).select(
        "id", box_parts(F.col("id") * 1.0, F.lit(0.0), F.col("id") + 1.0, F.lit(1.0)).alias("parts"))
    lots = lots.withColumn("bbox", bbox(F.col("parts")))

    def run(rows, when, label, before=None, after=None):
        n = rows.count()
        extract = Extract("lots", rows, "id", when, before or n, after or n, parts="parts")
        return refresh_all(spark, root, [extract], when, label).first()

    first = run(lots, at(1), "r1")
    assert (first.status, first.version, first.row_count) == ("ok", "2026-10-01", 12)
    # the same rows in another order and with turned rings: nothing new
    turned = lots.withColumn("parts", F.transform("parts", lambda p: F.transform(p, lambda r: F.reverse(r))))
    again = run(turned.orderBy(F.desc("id")), at(2), "r2")
    assert again.detail == "rows unchanged since version 2026-10-01"
    assert S.read_checks(spark, root).first().checked == datetime(2026, 10, 2, 7)
    moved = run(lots.where("id < 5"), at(3), "r3", after=6)
    assert moved.status == "error" and "changed during the extract" in moved.detail
    assert S.read_current(spark, root, "lots").count() == 12
    second = run(lots.where("id < 10"), at(8), "r4")
    third = run(lots.where("id < 9"), at(8, 9), "r5")
    assert (second.version, third.version) == ("2026-10-08", "2026-10-08-2")
    assert S.read_checks(spark, root).count() == 0  # a new version makes the check obsolete
    assert [r.version for r in S.ordered_versions(spark, root, "lots").collect()] == [
        "2026-10-01", "2026-10-08", "2026-10-08-2"]
    assert S.read_current(spark, root, "lots", ["id"]).count() == 9
    assert S.read_version(spark, root, "lots", "2026-10-01").count() == 12
    assert S.read_as_of(spark, root, "lots", at(8, 8)).count() == 10
    with pytest.raises(ValueError, match="0 matching"):
        S.read_as_of(spark, root, "lots", at(1, 6))

    # a byte changed outside the refresh stops the next version
    broken = lambda: [tuple(r) for r in S.archive_integrity(spark, root, S.read_manifest(spark, root)).collect()]
    assert broken() == []
    path = S.ordered_versions(spark, root, "lots").collect()[-1].path
    part = sorted((tmp_path / "store").glob(f"lots/versions/{path.rsplit('/', 1)[-1]}/part-*"))[0]
    part.with_name("part-extra.parquet").write_bytes(part.read_bytes())
    assert broken() == [("lots", "2026-10-08-2")]
    refused = run(lots, at(20), "r6")
    assert refused.status == "error" and "recorded checksum" in refused.detail


def test_web_mercator_is_reprojected_on_ingest(spark, tmp_path):
    root = str(tmp_path / "store")
    edge = 20037508.342789244
    rows = spark.range(3).select("id", box_parts(F.lit(0.0), F.lit(0.0), F.lit(edge), F.lit(edge)).alias("parts"))
    when = datetime(2026, 10, 1, 7, tzinfo=timezone.utc)
    done = refresh_all(spark, root, [Extract("m", rows, "id", when, 3, 3, parts="parts", web_mercator=True)], when, "r")
    assert done.first().status == "ok"
    box = S.read_current(spark, root, "m", ["bbox"]).first().bbox
    assert tuple(box) == pytest.approx((0.0, 0.0, 180.0, 85.0511287798066))


def test_address_match_splits_a_hot_address(spark, rows):
    left = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, " unknown ").when(
        F.col("id") % 3 == 1, F.concat(F.col("id").cast("string"), F.lit("  Main st"))).alias("a"))
    right = spark.createDataFrame([(1, "UNKNOWN"), (2, "unknown"), (3, "4 main ST"), (4, None)], "rid int, b string")
    got = keys.match_by_address(left, "a", "id", right, "b", "rid", target_rows=10)
    expected = sorted(
        ((i, 2, 1) if i % 3 == 0 else (4, 1, 3) if i == 4 else (i, 0, None) for i in range(300)), key=repr)
    assert rows(got.select("id", "matches", "first_match")) == expected


def test_inventory_lists_every_data_file(spark, tmp_path):
    from plotkeep.operators.objects import staged_objects
    from plotkeep.sources.inventory import list_files

    for rel in ("a/roads.parquet", "a/.hidden/x.parquet", "b/notes.md", "tiles.PMTILES"):
        (tmp_path / rel).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / rel).write_text("hello")
    listed = list_files(spark, str(tmp_path))
    assert rows_of(staged_objects(listed, "base").select("key", "size")) == [
        ("base/a/roads.parquet", 5), ("base/tiles.PMTILES", 5)]


def test_listing_holds_underscore_folders_and_no_dot_names(spark, tmp_path):
    from plotkeep.sources.inventory import list_files

    names = ("_assets/deep/x y/roads.parquet", "_SUCCESS", "a/é.md", "a/.crc", ".git/config", "a/.hidden/x.parquet", "a/b/c/d/e/empty")
    for rel in names:
        (tmp_path / rel).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / rel).write_text("" if rel.endswith("empty") else "hello")
    (tmp_path / "hollow").mkdir()
    expected = [("_SUCCESS", 5), ("_assets/deep/x y/roads.parquet", 5), ("a/b/c/d/e/empty", 0), ("a/é.md", 5)]
    for root in (str(tmp_path), f"{tmp_path}/", f"file:{tmp_path}"):
        listed = list_files(spark, root)
        assert rows_of(listed.select("path", "size")) == expected
    assert listed.where("modified IS NULL").count() == 0
    assert list_files(spark, str(tmp_path / "hollow")).count() == 0
    with pytest.raises(Exception, match="nowhere"):
        list_files(spark, str(tmp_path / "nowhere"))


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_documented_query_runs_on_views(spark, tmp_path):
    root = str(tmp_path / "store")
    when = datetime(2026, 10, 1, 7, tzinfo=timezone.utc)
    districts = spark.createDataFrame([(i, "RSA5" if i % 3 else "CMX2") for i in range(9)], "objectid int, long_code string")
    names = spark.createDataFrame([(1, "RSA5", "Residential"), (2, "CMX2", "Mixed")],
                                  "objectid int, new_code string, code_description string")
    done = refresh_all(spark, root, [
        Extract("base_districts", districts, "objectid", when, 9, 9),
        Extract("descriptions", names, "objectid", when, 2, 2),
    ], when, "r")
    assert [r.status for r in done.collect()] == ["ok", "ok"]
    assert S.register_views(spark, root) == ["base_districts", "descriptions"]
    out = spark.sql("""
        SELECT z.long_code, d.code_description, count(*) AS polygons
        FROM base_districts z JOIN descriptions d ON z.long_code = d.new_code
        GROUP BY 1, 2 ORDER BY 3 DESC
    """)
    assert [tuple(r) for r in out.collect()] == [("RSA5", "Residential", 6), ("CMX2", "Mixed", 3)]


def test_read_documents(spark, tmp_path):
    from plotkeep.sources.documents import read_documents

    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "collection.json").write_text('{"id": "c",\n "type": "Collection"}')
    row = read_documents(spark, str(tmp_path)).first()
    assert row.path.endswith("/c/collection.json") and row.text.count("\n") == 1


def test_daily_runs(spark, tmp_path):
    root = str(tmp_path / "store")
    at = lambda day: datetime(2026, 10, day, 7, tzinfo=timezone.utc)
    sources = spark.createDataFrame([("a", 7), ("b", 1), ("broken", 1)], "collection string, min_days int")

    def day(n, edits, rows, dry_run=False):
        probes = spark.createDataFrame([(c, at(d)) for c, d in edits.items()], "collection string, data_last_edit timestamp")

        def extract(name):
            if name == "broken":
                raise RuntimeError("service unavailable")
            return Extract(name, spark.range(rows).withColumnRenamed("id", "objectid"), "objectid", at(edits[name]), rows, rows)

        decisions = decide_due(spark, root, sources, probes, at(n))
        out = run_due(spark, root, decisions, extract, at(n), f"day{n}", dry_run)
        return {r.collection: (r.status, r.detail) for r in out.collect()}

    edits = {"a": 1, "b": 1, "broken": 1}
    assert day(2, edits, 5, dry_run=True) == {c: ("due", "no version yet") for c in edits}
    assert day(2, edits, 5) == {
        "a": ("ok", "version 2026-10-02: 5 rows"), "b": ("ok", "version 2026-10-02: 5 rows"),
        "broken": ("error", "service unavailable")}
    got = day(3, {"a": 3, "b": 3, "broken": 1}, 5)
    assert got["a"][0] == "skipped" and got["a"][1].endswith("next due 2026-10-09")
    assert got["b"] == ("ok", "rows unchanged since version 2026-10-02")
    # the no-op check is remembered, so the same edit is not fetched again
    assert day(4, {"a": 3, "b": 3, "broken": 1}, 5)["b"] == ("skipped", "source unchanged since 2026-10-03T07:00:00Z")
    got = day(9, {"a": 3, "b": 8, "broken": 1}, 6)
    assert got["a"] == ("ok", "version 2026-10-09: 6 rows") and got["b"] == ("ok", "version 2026-10-09: 6 rows")


def test_tables_are_dealt_anew_over_all_shuffle_partitions(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from plotkeep.plans import tables_queries

    # one value in the second column of every row
    spark.range(400).selectExpr("id", "'same' AS name", "id * 2 AS v").write.parquet(f"{tmp_path}/region.parquet")
    monkeypatch.setattr(tables_queries, "ALL_TABLES", ("region",))
    used, deal = [], DataFrame.repartition

    def watched(self, *args):
        out = deal(self, *args)
        used.extend(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        return out

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(DataFrame, "repartition", watched)
    try:
        got = tables_queries.content_hash_fast(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [tuple(r) for r in got] == [("region", 400, True, True, True)]
    assert len(used) == 4 and max(used) < 200
