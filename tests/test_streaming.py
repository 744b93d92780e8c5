from datetime import datetime, timedelta, timezone

from plotkeep.streaming import jobs

START = datetime(2026, 10, 1, tzinfo=timezone.utc)


def land(spark, path, name, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{path}/{name}")


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(path)


PROBES = "collection string, probed timestamp, data_last_edit timestamp, min_days int"


def test_due_events_keep_state_between_runs(spark, tmp_path):
    landed, root = str(tmp_path / "in"), str(tmp_path / "job")
    day = lambda n, hour=7: START + timedelta(days=n, hours=hour)

    def probe(n, edit_day, collection="c"):
        return (collection, day(n), day(edit_day, 0), 3)

    # many probes on one day count as one sweep
    land(spark, landed, "a", [probe(0, 0)] * 50 + [probe(1, 1), probe(2, 1), probe(3, 1), probe(4, 4)], PROBES)
    run = lambda: jobs.run_due_events(stream(spark, landed, PROBES), root)
    days = lambda df: sorted(
        (datetime.fromtimestamp(r.sweep, timezone.utc) - START).days for r in df.where("collection = 'c'").collect())
    assert days(run()) == [0]  # day 3 is not closed yet
    assert days(run()) == [0]  # nothing new landed, nothing is decided twice
    land(spark, landed, "b", [probe(5, 4), probe(6, 4), probe(8, 8), probe(9, 8), probe(12, 8)], PROBES)
    # day 3: edit of day 1 and three days passed; day 6: edit of day 4; day 9: edit of day 8
    assert days(run()) == [0, 3, 6, 9]
    land(spark, landed, "late", [probe(2, 2)], PROBES)
    assert days(run()) == [0, 3, 6, 9]


def test_edit_rate_drops_late_rows(spark, tmp_path):
    landed = str(tmp_path / "in")
    schema = "collection string, edited timestamp"
    at = lambda n: START + timedelta(days=n)
    land(spark, landed, "a", [("c", at(0)), ("c", at(1)), ("c", at(2)), ("c", at(20))], schema)

    def run():
        return sorted((r.window_start.day, r.edits) for r in jobs.drain(
            jobs.edit_rate(stream(spark, landed, schema)), str(tmp_path / "out"), str(tmp_path / "cp")).collect())

    assert run() == [(1, 3)]  # weeks start on the epoch's weekday: 1 October 2026 is one
    land(spark, landed, "b", [("c", at(1)), ("c", at(40))], schema)
    assert run() == [(1, 3), (15, 1)]


def test_extract_consistency(spark, tmp_path):
    landed = str(tmp_path / "in")
    schema = "collection string, extract string, read timestamp, page_rows int, reported int"
    at = lambda n, h: START + timedelta(days=n, hours=h)
    land(spark, landed, "a", [
        ("still", "a", at(0, 1), 10, 15), ("still", "a", at(0, 2), 5, 15),
        ("moved", "a", at(0, 1), 10, 15), ("moved", "a", at(0, 2), 5, 16),
        ("short", "a", at(0, 1), 10, 15), ("later", "a", at(9, 1), 1, 1),
        ("night", "a", at(0, 23), 10, 15), ("night", "a", at(1, 1), 5, 15),
        ("twice", "a", at(0, 1), 15, 15), ("twice", "b", at(0, 2), 10, 16), ("twice", "b", at(0, 3), 6, 16),
        ("no id", None, at(0, 1), 7, 7),
    ], schema)
    out = jobs.drain(jobs.extract_consistency(stream(spark, landed, schema)), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted((r.collection, r.extract or "", r.keep) for r in out.collect()) == [
        ("moved", "a", False), ("night", "a", True), ("no id", "", True), ("short", "a", False), ("still", "a", True),
        ("twice", "a", True), ("twice", "b", True)]


def test_page_ingest_appends_once(spark, tmp_path):
    landed = str(tmp_path / "in")
    fields = (("objectid", "esriFieldTypeOID"), ("name", "esriFieldTypeString"))
    body = lambda *ids: '{"features":[%s]}' % ",".join(
        '{"attributes":{"objectid":%d,"name":"n%d"}}' % (i, i) for i in ids)
    run = lambda: sorted(r.objectid for r in jobs.drain(
        jobs.page_ingest(stream(spark, landed, "body string"), fields), str(tmp_path / "out"), str(tmp_path / "cp")
    ).collect())
    land(spark, landed, "a", [(body(1, 2),), (body(3),)], "body string")
    assert run() == [1, 2, 3]
    assert run() == [1, 2, 3]
    land(spark, landed, "b", [(body(4),)], "body string")
    assert run() == [1, 2, 3, 4]
