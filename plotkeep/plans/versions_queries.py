"""Queries over version records, refresh decisions and object listings."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotkeep.functions import clean as C
from plotkeep.functions import wkb as W
from plotkeep.operators import gates, objects, profile, refresh, versions
from plotkeep.operators.versions import MANIFEST_SCHEMA
from plotkeep.plans.refresh_run import Extract, refresh_all
from plotkeep.plans.registry import query, table
from plotkeep.plans.spatial_queries import defective_lots
from plotkeep.session import scratch_path
from plotkeep.sources import tables as S

NOW = datetime(2001, 9, 1, 7, 0, tzinfo=timezone.utc)


@query(
    "due_decisions",
    """
    WITH last AS (SELECT o_custkey, max(CASE WHEN o_custkey % 13 <> 0 THEN o_orderdate END) AS created FROM orders
                  GROUP BY o_custkey),
         s AS (SELECT c_custkey, 30 * (1 + c_custkey % 24) AS min_days,
                 TIMESTAMP '2001-07-01 12:00:00' + to_days(cast(c_custkey % 60 AS INT)) AS edit,
                 created,
                 CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE created - to_days(1) END AS version_edit,
                 CASE WHEN c_custkey % 11 = 0 THEN TIMESTAMP '2001-07-31 12:00:00' END AS checked_edit
               FROM customer LEFT JOIN last ON c_custkey = o_custkey),
         k AS (SELECT *, greatest(version_edit, checked_edit) AS known, created + to_days(cast(min_days AS INT)) AS next_due
               FROM s),
         d AS (SELECT *, CASE WHEN c_custkey % 17 = 3 THEN 'unprobed' WHEN created IS NULL THEN 'new' WHEN known IS NOT NULL AND edit <= known THEN 'same'
                              WHEN TIMESTAMP '2001-09-01 07:00:00' < next_due THEN 'wait' ELSE 'go' END AS k4 FROM k)
    SELECT c_custkey AS collection, k4 IN ('new', 'go') AS due,
           CASE k4 WHEN 'unprobed' THEN 'no probe' WHEN 'new' THEN 'no version yet'
                   WHEN 'same' THEN 'source unchanged since ' || strftime(known, '%Y-%m-%dT%H:%M:%SZ')
                   WHEN 'wait' THEN 'source edited ' || strftime(edit, '%Y-%m-%dT%H:%M:%SZ')
                        || ', but the current version is ' || strftime(created, '%Y-%m-%d')
                        || '; next due ' || strftime(next_due, '%Y-%m-%d')
                   ELSE 'source edited ' || strftime(edit, '%Y-%m-%dT%H:%M:%SZ') END AS reason
    FROM d
    """,
)
def due_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One collection per customer; its last order stands for the current version."""
    key = F.col("c_custkey").alias("collection")
    customer = table(spark, sf_dir, "customer")
    sources = customer.select(key, (30 * (1 + F.col("c_custkey") % 24)).cast("int").alias("min_days"))
    edit = F.expr("timestamp'2001-07-01 12:00:00'") + F.make_dt_interval((F.col("c_custkey") % 60).cast("int"))
    probes = customer.where("c_custkey % 17 <> 3").select(key, edit.alias("data_last_edit"))
    # one collection in thirteen has no version yet
    created = F.max(F.when(F.col("o_custkey") % 13 != 0, F.col("o_orderdate").cast("timestamp")))
    current = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("collection"))
        .agg(created.alias("created"))
        .withColumn(
            "source_updated",
            F.when(F.col("collection") % 7 != 0, F.col("created") - F.make_dt_interval(F.lit(1))),
        )
    )
    checks = customer.where("c_custkey % 11 = 0").select(
        key, F.expr("timestamp'2001-07-31 12:00:00'").alias("source_updated")
    )
    return refresh.due_decisions(sources, probes, current, checks, NOW)


def event_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version records from events: collection = user, one run per event number modulo 13."""
    seq = (F.col("event_id") % 13 + 1).cast("int")
    day = F.to_date("ts")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").cast("string").alias("collection"), day.alias("day"), seq.alias("seq"))
        .agg(F.max(F.col("ts").cast("timestamp")).alias("created"), F.count(F.lit(1)).alias("row_count"))
        .select(
            "collection",
            versions.make_label(F.col("day"), F.col("seq")).alias("version"),
            "created",
            F.when(F.dayofmonth("day") % 3 != 0, F.col("created") - F.make_dt_interval(F.lit(2))).alias("source_updated"),
            "row_count",
        )
    )


SQL_VERSIONS = """
    v AS (SELECT cast(user_id AS VARCHAR) AS collection, cast(ts AS DATE) AS version_day,
                 cast(event_id % 13 + 1 AS INT) AS version_seq, max(ts) AS created, count(*) AS row_count
          FROM events GROUP BY 1, 2, 3),
    versions AS (SELECT *, cast(version_day AS VARCHAR) || CASE WHEN version_seq = 1 THEN '' ELSE '-' || version_seq END
                             AS version,
                        CASE WHEN day(version_day) % 3 <> 0 THEN created - to_days(2) END AS source_updated FROM v)
"""
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"


@query(
    "version_labels",
    f"""
    WITH {SQL_VERSIONS},
         days AS (SELECT DISTINCT collection, version_day FROM versions),
         free AS (SELECT collection, version_day, unnest(range(1, 15)) AS seq FROM days)
    SELECT collection, cast(version_day AS VARCHAR) AS day, cast(min(seq) AS INT) AS version_seq,
           cast(version_day AS VARCHAR) || CASE WHEN min(seq) = 1 THEN '' ELSE '-' || min(seq) END AS version
    FROM free f
    WHERE NOT EXISTS (SELECT 1 FROM versions v WHERE v.collection = f.collection AND v.version_day = f.version_day
                      AND v.version_seq = f.seq)
    GROUP BY collection, version_day
    """,
)
def version_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next free label of every (collection, day), with gaps among the taken ones."""
    taken = event_versions(spark, sf_dir)
    wanted = taken.select("collection", versions.label_day(F.col("version")).alias("day"))
    return versions.next_labels(taken, wanted).withColumn("day", F.col("day").cast("string"))


@query(
    "version_chain",
    f"""
    WITH {SQL_VERSIONS},
         r AS (SELECT *, row_number() OVER (PARTITION BY collection ORDER BY version_day DESC, version_seq DESC) = 1
                 AS newest FROM versions)
    SELECT collection, version, row_count, CASE WHEN newest THEN 'data' ELSE 'archive' END AS role,
           's3://bucket/' || collection || '/' || CASE WHEN newest THEN collection ELSE 'versions/' || version END
           || '.parquet' AS href
    FROM r
    """,
)
def version_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    chain = versions.version_chain(event_versions(spark, sf_dir), "s3://bucket")
    return chain.select("collection", "version", "row_count", "role", "href")


@query(
    "version_order",
    f"""
    WITH {SQL_VERSIONS}
    SELECT collection, version, cast(version_day AS VARCHAR) AS version_day, version_seq FROM versions
    """,
)
def version_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Oldest first by day and number; text order would put run 10 before run 2."""
    ordered = versions.with_version_order(event_versions(spark, sf_dir))
    return ordered.orderBy("collection", "version_day", "version_seq").select(
        "collection", "version", F.col("version_day").cast("string").alias("version_day"), "version_seq"
    )


@query(
    "version_extent",
    f"""
    WITH {SQL_VERSIONS}
    SELECT collection, {_ISO.format("min(coalesce(source_updated, created))")} AS extent_start,
           {_ISO.format("max(coalesce(source_updated, created))")} AS extent_end
    FROM versions GROUP BY collection
    """,
)
def version_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    extent = versions.temporal_extent(event_versions(spark, sf_dir))
    return extent.select(
        "collection", C.iso_utc(F.col("extent_start")).alias("extent_start"),
        C.iso_utc(F.col("extent_end")).alias("extent_end"),
    )


@query(
    "version_asof",
    f"""
    WITH {SQL_VERSIONS}
    SELECT collection, version, row_count FROM versions WHERE created <= TIMESTAMP '2024-01-17 09:30:00'
    QUALIFY row_number() OVER (PARTITION BY collection ORDER BY version_day DESC, version_seq DESC) = 1
    """,
)
def version_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = versions.as_of(event_versions(spark, sf_dir), datetime(2024, 1, 17, 9, 30, tzinfo=timezone.utc))
    return seen.select("collection", "version", "row_count")


@query(
    "add_versions",
    f"""
    WITH {SQL_VERSIONS}
    SELECT collection, version, row_count FROM versions
    UNION ALL SELECT DISTINCT collection, '2024-02-29', cast(0 AS BIGINT) FROM versions
    """,
)
def add_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record one more version per collection; a clash with a recorded label would raise."""
    manifest = event_versions(spark, sf_dir).select("collection", "version", "row_count")
    new = manifest.select("collection").distinct().select(
        "collection", F.lit("2024-02-29").alias("version"), F.lit(0).cast("long").alias("row_count")
    )
    return versions.add_versions(manifest, new)


@query(
    "sync_gate",
    f"""
    WITH {SQL_VERSIONS}
    SELECT collection, version FROM versions WHERE version_seq = 5 AND day(version_day) % 4 = 0
    """,
)
def sync_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The local records lack some published versions; users without events were never published."""
    published = event_versions(spark, sf_dir).select("collection", "version")
    never = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("collection"),
        F.lit(None).cast("string").alias("version"),
    )
    v = F.col("version")
    lost = (versions.label_seq(v) == 5) & (F.dayofmonth(versions.label_day(v)) % 4 == 0)
    return gates.sync_gate(published.unionByName(never), published.where(~lost))


@query(
    "recorded_counts",
    f"""
    WITH {SQL_VERSIONS},
         perday AS (SELECT version_day, cast(sum(row_count) AS BIGINT) AS row_count, count(*) AS version_count
                    FROM versions GROUP BY 1)
    SELECT DISTINCT c AS recorded FROM (SELECT unnest([row_count, version_count]) AS c FROM perday) WHERE c >= 100
    """,
)
def recorded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_day = versions.with_version_order(event_versions(spark, sf_dir)).groupBy("version_day").agg(
        F.sum("row_count").alias("row_count"), F.count(F.lit(1)).alias("version_count")
    )
    return profile.recorded_counts(per_day, ["row_count", "version_count"])


@query(
    "stamp_check",
    """
    SELECT strftime(min(m), '%Y-%m-%dT%H:%M:%SZ') AS stored, strftime(max(m), '%Y-%m-%dT%H:%M:%SZ') AS newest,
           min(m) <> max(m) AS needs_stamp
    FROM (SELECT user_id, max(ts) AS m FROM events GROUP BY user_id)
    """,
)
def stamp_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The root still carries the oldest collection's stamp."""
    updated = F.max(F.col("ts").cast("timestamp")).alias("updated")
    collections = table(spark, sf_dir, "events").groupBy("user_id").agg(updated)
    collections = collections.select(C.iso_utc(F.col("updated")).alias("updated"))
    return versions.stamp_check(collections, collections.agg(F.min("updated").alias("updated")))


@query(
    "state_upsert",
    """
    SELECT c_custkey AS collection, CASE WHEN c_custkey % 6 = 0 THEN 'checked again' ELSE 'stored' END AS state
    FROM customer WHERE (c_custkey % 2 = 0 OR c_custkey % 6 = 0) AND c_custkey % 10 <> 0
    """,
)
def state_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks are replaced by newer ones and dropped once a version is recorded."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("collection"))
    stored = customer.where("collection % 2 = 0").withColumn("state", F.lit("stored"))
    again = customer.where("collection % 6 = 0").withColumn("state", F.lit("checked again"))
    return refresh.drop_checks(refresh.upsert_checks(stored, again), customer.where("collection % 10 = 0"))


@query(
    "unknown_collections",
    """
    SELECT DISTINCT user_id + 100 AS collection FROM events
    WHERE user_id + 100 NOT IN (SELECT user_id FROM events)
    """,
)
def unknown_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = table(spark, sf_dir, "events").select(F.col("user_id").alias("collection")).distinct()
    requested = table(spark, sf_dir, "events").select((F.col("user_id") + 100).alias("collection"))
    return refresh.unknown_collections(requested, registry)


def staged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as staged objects, half of them archives."""
    rel = F.when(F.col("doc_id") % 2 == 0, F.concat("source", F.lit("/versions/d"))).otherwise(
        F.concat("source", F.lit("/d"))
    )
    paths = table(spark, sf_dir, "documents").select(
        F.concat(rel, F.col("doc_id").cast("string"), F.lit(".parquet")).alias("path"),
        "doc_id", F.octet_length("text").cast("long").alias("size"), F.md5("text").alias("md5"),
    )
    return objects.staged_objects(paths, "base")


def remote_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published listing: some keys missing, some of other size, digest, or multipart."""
    i = F.col("doc_id")
    etag = (
        F.when(i % 11 == 0, F.lit("0" * 32))
        .when(i % 13 == 0, F.concat(F.substring("md5", 1, 8), F.lit("-2")))
        .otherwise(F.concat(F.lit('"'), "md5", F.lit('"')))
    )
    return staged_documents(spark, sf_dir).where("doc_id % 5 <> 0").select(
        "key", (F.col("size") + F.when(i % 7 == 0, 1).otherwise(0)).alias("size"), etag.alias("etag")
    )


_SQL_KEY = (
    "'base/' || source || CASE WHEN doc_id % 2 = 0 THEN '/versions/d' ELSE '/d' END || doc_id || '.parquet'"
)
_SQL_STATUS = (
    "CASE WHEN doc_id % 5 = 0 THEN 'absent' WHEN doc_id % 7 = 0 THEN 'size' WHEN doc_id % 11 = 0 THEN 'digest' "
    "WHEN doc_id % 13 = 0 THEN 'same_size' ELSE 'same' END"
)


@query(
    "changed_objects",
    f"""
    SELECT {_SQL_KEY} AS "key", {_SQL_STATUS} AS status, {_SQL_STATUS} IN ('absent', 'size', 'digest') AS changed,
           {_SQL_STATUS} = 'same' AS verified,
           CASE WHEN {_SQL_STATUS} IN ('absent', 'size', 'digest')
                THEN CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 2 END END AS phase
    FROM documents
    """,
)
def changed_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = objects.changed_objects(staged_documents(spark, sf_dir), remote_documents(spark, sf_dir))
    phases = objects.upload_phases(changed).select("key", "phase")
    return changed.join(phases, "key", "left").select("key", "status", "changed", "verified", "phase")


@query(
    "archive_refusal",
    f"""
    SELECT {_SQL_KEY} AS "key" FROM documents WHERE doc_id % 2 = 0 AND {_SQL_STATUS} IN ('size', 'digest')
    """,
)
def archive_refusal(spark: SparkSession, sf_dir: str) -> DataFrame:
    remote = remote_documents(spark, sf_dir)
    return objects.overwritten_archives(objects.changed_objects(staged_documents(spark, sf_dir), remote), remote)


@query(
    "refresh_run",
    """
    WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE c_custkey % 17 <> 0) AS kept FROM customer)
    SELECT 1 AS run, 'edited' AS collection, 'ok' AS status, '2024-03-01' AS version, n AS row_count FROM n
    UNION ALL SELECT 1, 'legend', 'ok', '2024-03-01', n FROM n
    UNION ALL SELECT 1, 'moving', 'error', NULL, NULL FROM n
    UNION ALL SELECT 1, 'steady', 'ok', '2024-03-01', n FROM n
    UNION ALL SELECT 2, 'edited', 'ok', '2024-03-01-2', kept FROM n
    UNION ALL SELECT 2, 'legend', 'style', NULL, NULL FROM n
    UNION ALL SELECT 2, 'moving', 'ok', '2024-03-01', n FROM n
    UNION ALL SELECT 2, 'steady', 'ok', '2024-03-01', n FROM n
    """,
)
def refresh_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over four collections: edited, unchanged, moving while read, and breaking its legend."""
    customer = table(spark, sf_dir, "customer")
    n = customer.count()
    kept = customer.where("c_custkey % 17 <> 0")
    rules = customer.groupBy(F.lit(1).alias("one")).agg(
        F.array_sort(F.collect_set(F.struct(F.lit(None).cast("double").alias("num"), F.col("c_mktsegment").alias("str"))))
        .alias("labels")
    ).select(
        F.lit("a.json").alias("style"), F.lit(0).alias("rule_no"), F.lit("match").alias("kind"),
        F.lit("c_mktsegment").alias("column"), "labels", F.array().cast("array<double>").alias("stops"),
    )
    renamed = customer.withColumn("c_mktsegment", F.replace("c_mktsegment", F.lit("BUILDING"), F.lit("BRIDGES")))
    root = scratch_path(spark, "refresh-run")
    first, second = datetime(2024, 3, 1, 7, tzinfo=timezone.utc), datetime(2024, 3, 1, 9, tzinfo=timezone.utc)

    def extract(name: str, rows: DataFrame, before: int, after: int, styled: DataFrame | None = None) -> Extract:
        return Extract(name, rows, "c_custkey", first, before, after, rules=styled)

    one = refresh_all(spark, root, [
        extract("edited", customer, n, n),
        extract("legend", customer, n, n, rules),
        extract("moving", customer, n, n + 1),
        extract("steady", customer, n, n),
    ], first, "run1")
    n_kept = kept.count()
    two = refresh_all(spark, root, [
        extract("edited", kept, n_kept, n_kept),
        extract("legend", renamed, n, n, rules),
        extract("moving", customer, n, n),
        extract("steady", customer.repartition(3, "c_name"), n, n),
    ], second, "run2")
    both = one.withColumn("run", F.lit(1)).unionByName(two.withColumn("run", F.lit(2)))
    return both.select("run", "collection", "status", "version", "row_count")


@query(
    "refresh_run_spatial",
    """
    WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE p_partkey % 7 IN (0, 3)) AS repaired,
                      count(*) FILTER (WHERE p_partkey % 7 = 2) AS unrepaired,
                      count(*) FILTER (WHERE p_partkey % 7 = 4) AS nulls,
                      round(max(p_partkey % 50 * 10 + (4 + p_size) * CASE WHEN p_partkey % 7 = 2 THEN 2 ELSE 1 END)
                            FILTER (WHERE p_partkey % 7 <> 4) / 6378137 * 180 / pi(), 9) AS xmax
               FROM part)
    SELECT 1 AS run, 'lots' AS collection, 'ok' AS status, '2024-03-01' AS version, n AS row_count, repaired, unrepaired,
           nulls, xmax FROM n
    UNION ALL SELECT 1, 'moving', 'error', NULL, NULL, NULL, NULL, NULL, NULL FROM n
    UNION ALL SELECT 2, 'lots', 'ok', '2024-03-01', n, repaired, unrepaired, nulls, xmax FROM n
    UNION ALL SELECT 3, 'lots', 'error', NULL, NULL, NULL, NULL, NULL, NULL FROM n
    UNION ALL SELECT 4, 'lots', 'ok', '2024-03-01-2', n, repaired, unrepaired, nulls, xmax FROM n
    """,
)
def refresh_run_spatial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs over WKB shapes in the service's projection, a seventh of them null, others defective.

    ``lots`` comes again with turned rings in another order (no new version), then with an
    attribute changed, at first without its last page; ``moving`` changes while read.
    """
    lots = defective_lots(spark, sf_dir).drop("bbox").withColumn("outcome", F.col("p_brand"))
    # a flat ring has no direction, and a crossing is rounded by the order of its edges
    turned = F.when((F.col("p_partkey") % 7).isin(2, 3), F.col("parts")).otherwise(
        F.transform("parts", lambda part: F.transform(part, F.reverse)))
    n = lots.count()
    root = scratch_path(spark, "refresh-run-spatial")
    moments = [datetime(2024, 3, 1, hour, tzinfo=timezone.utc) for hour in (7, 9, 11, 13)]
    changed = lots.withColumn("outcome", F.lit("changed"))

    def extract(name: str, rows: DataFrame, after: int = n, pages: DataFrame | None = None) -> Extract:
        rows = rows.withColumn("geometry", W.to_wkb("parts")).drop("parts")
        return Extract(name, rows, "p_partkey", moments[0], n, after, geometry="geometry", web_mercator=True, pages=pages)

    # a page of one row per lot, and an empty one at the end
    first_key = table(spark, sf_dir, "part").agg(F.min("p_partkey")).first()[0]
    keys = table(spark, sf_dir, "part").select(F.col("p_partkey") - F.lit(first_key))
    pages = keys.toDF("page_offset").select(
        F.lit("lots").alias("collection"), "page_offset",
        F.lit('{"features": [{"attributes": {}}], "exceededTransferLimit": true}').alias("body"))
    last = spark.createDataFrame([("lots", n, '{"features": []}')], pages.schema)
    runs = [
        [extract("lots", lots), extract("moving", lots, n + 1)],
        [extract("lots", lots.withColumn("parts", turned).orderBy(F.desc("p_partkey")))],
        [extract("lots", changed, pages=pages)],
        [extract("lots", changed, pages=pages.union(last))],
    ]
    out = None
    for i, (extracts, moment) in enumerate(zip(runs, moments), 1):
        known = S.read_manifest(spark, root).select("collection", "version")
        done = refresh_all(spark, root, extracts, moment, f"run{i}", known).withColumn("run", F.lit(i))
        out = done if out is None else out.union(done)
    facts = S.read_manifest(spark, root).select(
        "collection", "version", F.col("repaired_geometries").alias("repaired"),
        F.col("unrepaired_geometries").alias("unrepaired"), F.col("null_geometries").alias("nulls"),
        F.round("bbox.xmax", 9).alias("xmax"))
    report = out.select("run", "collection", "status", "version", "row_count")
    return report.join(facts, ["collection", "version"], "left")


def store(spark: SparkSession, root: str, collection: str, rows: DataFrame, day: datetime, seq: int = 1) -> str:
    """Write a version and its record; the folder it lies in."""
    label = day.strftime("%Y-%m-%d") + (f"-{seq}" if seq > 1 else "")
    path = S.version_path(root, collection, f"run-{label}")
    S.write_table(rows, path)
    files = S.folder_checksums(S.file_digests(spark, path)).first()
    record = (collection, label, day.date(), seq, day, day, rows.count(), "", 0, 0, files.file_size, files.file_checksum,
              path, f"run-{label}", 0, [(f.name, f.dataType.simpleString()) for f in rows.schema], None)
    S.append_rows(spark, [record], MANIFEST_SCHEMA, f"{root}/manifest")
    return path


@query(
    "stored_versions",
    """
    WITH c AS (SELECT count(*) AS n, sum(c_custkey) AS keys FROM customer)
    SELECT 'current' AS "read", 2 * n AS row_count, cast(2 * keys + 1000000 * n AS BIGINT) AS keys FROM c
    UNION ALL SELECT 'label', n, cast(keys AS BIGINT) FROM c
    UNION ALL SELECT 'moment', n, cast(keys AS BIGINT) FROM c
    """,
)
def stored_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of two versions, read as it is, by the first one's label, and as of a moment between them."""
    customer = table(spark, sf_dir, "customer")
    root = scratch_path(spark, "stored-versions")
    first, second = datetime(2024, 5, 1, 7, tzinfo=timezone.utc), datetime(2024, 5, 9, 7, tzinfo=timezone.utc)
    store(spark, root, "customer", customer, first)
    store(spark, root, "customer", customer.union(customer.withColumn("c_custkey", F.col("c_custkey") + 1_000_000)), second)
    reads = {
        "current": S.read_current(spark, root, "customer", ["c_custkey"]),
        "label": S.read_version(spark, root, "customer", "2024-05-01"),
        "moment": S.read_as_of(spark, root, "customer", datetime(2024, 5, 4, tzinfo=timezone.utc)),
    }
    out = None
    for name, df in reads.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count"), F.sum("c_custkey").alias("keys")).select(
            F.lit(name).alias("read"), "row_count", "keys")
        out = one if out is None else out.union(one)
    return out


@query(
    "archive_integrity",
    """
    SELECT 'supplier' AS collection, '2024-05-01' AS version WHERE EXISTS (SELECT 1 FROM supplier)
    UNION ALL SELECT 'customer', '2024-05-01-2' WHERE EXISTS (SELECT 1 FROM customer)
    """,
)
def archive_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored versions, one of which got a file more and one other bytes after it was recorded."""
    root = scratch_path(spark, "archive-integrity")
    day = datetime(2024, 5, 1, 7, tzinfo=timezone.utc)
    paths = {}
    for name in ("customer", "supplier", "part"):
        rows = table(spark, sf_dir, name)
        for seq in (1, 2):
            paths[name, seq] = store(spark, root, name, rows, day, seq)
    table(spark, sf_dir, "supplier").write.mode("append").parquet(paths["supplier", 1])
    table(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal") + 1).write.mode("overwrite").parquet(
        paths["customer", 2])
    return S.archive_integrity(spark, root, S.read_manifest(spark, root))
