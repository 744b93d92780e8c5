import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from plotkeep.operators import gates, objects, refresh, versions
from plotkeep.operators.profile import recorded_counts
from plotkeep.sources import documents as D

NOW = datetime(2025, 3, 14, 18, 30, tzinfo=timezone.utc)


def t(text):
    return datetime.strptime(text, "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=timezone.utc) if text else None


BASE = ("2025-03-04T18:30:00Z", "2025-03-03T09:15:00Z")
CASES = [
    ("no version", "2025-03-09T22:00:00Z", None, None, True, "no version yet"),
    ("unedited", BASE[1], BASE, None, False, f"source unchanged since {BASE[1]}"),
    ("old enough", "2025-03-09T22:00:00Z", BASE, None, True, "source edited 2025-03-09T22:00:00Z"),
    ("too soon", "2025-03-13T11:00:00Z", ("2025-03-11T18:30:00Z", BASE[1]), None, False,
     "source edited 2025-03-13T11:00:00Z, but the current version is 2025-03-11; next due 2025-03-18"),
    ("checked", "2025-03-09T22:00:00Z", BASE, "2025-03-09T22:00:00Z", False,
     "source unchanged since 2025-03-09T22:00:00Z"),
    ("no source date", "2025-03-09T22:00:00Z", (BASE[0], None), None, True, "source edited 2025-03-09T22:00:00Z"),
    ("exactly due", "2025-03-13T11:00:00Z", ("2025-03-07T18:30:00Z", BASE[1]), None, True,
     "source edited 2025-03-13T11:00:00Z"),
    ("an hour early", "2025-03-13T11:00:00Z", ("2025-03-07T19:30:00Z", BASE[1]), None, False,
     "source edited 2025-03-13T11:00:00Z, but the current version is 2025-03-07; next due 2025-03-14"),
]


def decide(spark, force=False):
    frame = spark.createDataFrame
    sources = frame([(c[0], 7) for c in CASES], "collection string, min_days int")
    probes = frame([(c[0], t(c[1])) for c in CASES], "collection string, data_last_edit timestamp")
    current = frame([(c[0], t(c[2][0]), t(c[2][1])) for c in CASES if c[2]],
                    "collection string, created timestamp, source_updated timestamp")
    checks = frame([(c[0], t(c[3])) for c in CASES if c[3]], "collection string, source_updated timestamp")
    return {r.collection: (r.due, r.reason)
            for r in refresh.due_decisions(sources, probes, current, checks, NOW, force).collect()}


def test_due_decisions(spark):
    assert decide(spark) == {c[0]: (c[4], c[5]) for c in CASES}


def test_forced(spark):
    assert decide(spark, force=True) == {c[0]: (True, "forced; " + c[5]) for c in CASES}


def manifest(spark):
    records = [(v, t(f"{v[:10]}T07:00:00Z"), t(f"{v[:10]}T01:00:00Z") if v != "2026-10-01" else None)
               for v in ("2026-10-01", "2026-10-08", "2026-10-08-10", "2026-10-08-2")]
    return spark.createDataFrame([("c", *r) for r in records],
                                 "collection string, version string, created timestamp, source_updated timestamp")


def test_order_is_numeric(spark):
    ordered = versions.with_version_order(manifest(spark)).orderBy("version_day", "version_seq")
    assert [r.version for r in ordered.collect()] == ["2026-10-01", "2026-10-08", "2026-10-08-2", "2026-10-08-10"]


def test_chain(spark):
    chain = {r.version: (r.role, r.href) for r in versions.version_chain(manifest(spark), "base").collect()}
    assert chain["2026-10-08-10"] == ("data", "base/c/c.parquet")
    assert chain["2026-10-08-2"] == ("archive", "base/c/versions/2026-10-08-2.parquet")
    assert sorted(r for r, _ in chain.values()) == ["archive"] * 3 + ["data"]


def test_next_label_is_lowest_free(spark):
    days = spark.createDataFrame([("c", d) for d in ("2026-10-08", "2026-10-01", "2026-11-01")],
                                 "collection string, day string").withColumn("day", F.to_date("day"))
    got = {str(r.day): r.version for r in versions.next_labels(manifest(spark), days).collect()}
    assert got == {"2026-10-08": "2026-10-08-3", "2026-10-01": "2026-10-01-2", "2026-11-01": "2026-11-01"}


def test_extent_uses_created_where_the_edit_is_unknown(spark):
    row = versions.temporal_extent(manifest(spark)).first()
    assert (row.extent_start, row.extent_end) == (datetime(2026, 10, 1, 7), datetime(2026, 10, 8, 1))


def test_as_of(spark):
    seen = lambda text: [r.version for r in versions.as_of(manifest(spark), t(text)).collect()]
    assert seen("2026-09-01T00:00:00Z") == []
    assert seen("2026-10-01T07:00:00Z") == ["2026-10-01"]
    assert seen("2026-10-09T00:00:00Z") == ["2026-10-08-10"]


def test_label_is_never_reused(spark):
    m = manifest(spark)
    with pytest.raises(Exception, match="already recorded"):
        versions.add_versions(m, m.limit(1)).collect()


def test_stamp_is_idempotent(spark):
    colls = spark.createDataFrame([("2026-10-08T07:00:00Z",), ("2026-09-01T00:00:00Z",), (None,)], "updated string")

    def needs(stored):
        return versions.stamp_check(colls, spark.createDataFrame([(stored,)], "updated string")).first().needs_stamp

    assert needs("2026-08-26T00:00:00Z") and needs(None)
    assert not needs("2026-10-08T07:00:00Z")


def test_collection_documents(spark, rows):
    doc = {
        "id": "c", "type": "Collection", "table:row_count": 500, "geoparquet:feature_count": 501, "updated": "2026-10-08T07:00:00Z",
        "links": [{"rel": "root", "href": "../catalog.json"}, {"rel": "via", "href": "https://x.org"}],
        "assets": {
            "c": {"href": "c.parquet", "version": "2026-10-08", "created": "2026-10-08T07:00:00Z",
                  "geo:source_updated": "2026-10-08T01:00:00Z", "table:row_count": 5, "geo:content_hash": "h2", "geo:null_geometries": 137},
            "version-2026-10-01": {"href": "versions/2026-10-01.parquet", "version": "2026-10-01",
                                   "created": "2026-10-01T07:00:00Z", "geo:source_updated": None,
                                   "table:row_count": 3, "geo:content_hash": "h1", "file:checksum": "1220aa"},
            "c-tiles": {"href": "c.pmtiles"},
        },
    }
    unpublished = {"id": "d", "assets": {"d": {"href": "d.parquet"}}}
    docs = spark.createDataFrame([("c/collection.json", json.dumps(doc)), ("d/collection.json", json.dumps(unpublished))],
                                 "path string, text string")
    parsed = D.collection_documents(docs, "geo")
    got = rows(D.collection_versions(parsed, "geo").select("collection", "version", "row_count", "content_hash", "role"))
    assert got == [("c", "2026-10-01", 3, "h1", "archive"), ("c", "2026-10-08", 5, "h2", "data")]
    counts = recorded_counts(D.document_counts(parsed, "geo"), ["rows", "features", "repaired", "nulls"])
    assert rows(counts) == [(137,), (500,), (501,)]
    assert ("c/collection.json", "rel:root", "../catalog.json") in rows(D.document_links(parsed))
    assert ("c/collection.json", "asset c-tiles", "c.pmtiles") in rows(D.document_links(parsed))


def test_changed_objects(spark):
    md5 = "5d41402abc4b2a76b9719d911017c592"
    listing = {"same": (5, md5), "quoted": (5, f'"{md5}"'), "other": None, "digest": (5, "0" * 32), "size": (9, md5),
               "multipart": (5, '"abc-2"')}
    staged = spark.createDataFrame([(k, 5, md5) for k in listing], "key string, size long, md5 string")
    remote = spark.createDataFrame([(k, *v) for k, v in listing.items() if v], "key string, size long, etag string")
    got = {r.key: (r.changed, r.verified) for r in objects.changed_objects(staged, remote).collect()}
    assert got == {"same": (False, True), "quoted": (False, True), "other": (True, False), "digest": (True, False),
                   "size": (True, False), "multipart": (False, False)}
    assert all(r.changed for r in objects.changed_objects(staged, remote, force=True).collect())


def test_archive_refusal(spark):
    keys = ["p/land_use/versions/2026-08-26.parquet", "p/land_use/versions/2026-10-06.parquet", "p/land_use/land_use.parquet"]
    changed = spark.createDataFrame([(k, True) for k in keys], "key string, changed boolean")
    listing = spark.createDataFrame([(keys[0],), (keys[2],)], "key string")
    assert [r.key for r in objects.overwritten_archives(changed, listing).collect()] == [keys[0]]
    assert objects.overwritten_archives(changed, listing.limit(0)).collect() == []
    phases = {r.key: r.phase for r in objects.upload_phases(changed).collect()}
    assert phases == {keys[0]: 1, keys[1]: 1, keys[2]: 2}


def test_head_report(spark):
    df = spark.range(23).select(F.format_string("k%02d", "id").alias("key"))
    report = objects.head_report(df, "key", 20).collect()
    assert [r.entry for r in report if r.entry] == [f"k{i:02d}" for i in range(20)]
    assert [r.more for r in report if r.more] == [3]
    assert len(objects.head_report(df.where("key < 'k05'"), "key", 20).collect()) == 5


def test_sync_gate(spark, rows):
    frame = lambda data: spark.createDataFrame(data, "collection string, version string")
    known = frame([("a", "1"), ("a", "2"), ("b", "1")])
    assert rows(gates.sync_gate(frame([("a", "2"), ("b", "3"), ("c", None)]), known)) == [("b", "3")]


def test_state_upsert(spark, rows):
    frame = lambda data: spark.createDataFrame(data, "collection string, v int")
    merged = refresh.upsert_checks(frame([("a", 1), ("b", 1)]), frame([("b", 2), ("c", 2)]))
    assert rows(merged) == [("a", 1), ("b", 2), ("c", 2)]
    assert rows(refresh.drop_checks(merged, frame([("a", 0)]))) == [("b", 2), ("c", 2)]
