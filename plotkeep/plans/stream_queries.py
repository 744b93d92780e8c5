"""Registered streaming jobs: events and order pages as landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotkeep.functions.clean import iso_utc
from plotkeep.plans.registry import query, table
from plotkeep.plans.tables_queries import ORDER_FIELDS, order_pages
from plotkeep.session import scratch_path
from plotkeep.streaming import jobs


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    landed = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    # a watermark needs a timestamp with time zone
    return landed.withColumn("at", F.col("ts").cast("timestamp"))


# a window is closed once the newest event, less the delay, has passed its end
_CLOSED = "(SELECT max(ts) - INTERVAL 1 DAY FROM events)"


@query(
    "stream_due_events",
    f"""
    WITH RECURSIVE sweeps AS (
      SELECT user_id, cast(ts AS DATE) AS day, cast(floor(epoch(max(ts))) AS BIGINT) AS sweep,
             cast(floor(epoch(max(ts)) / 259200) * 259200 AS BIGINT) AS edit, 1 + user_id % 4 AS min_days,
             row_number() OVER (PARTITION BY user_id ORDER BY cast(ts AS DATE)) AS i
      FROM events GROUP BY user_id, cast(ts AS DATE)
      HAVING cast(ts AS DATE) + INTERVAL 1 DAY <= {_CLOSED}),
    walk AS (
      SELECT user_id, i, sweep AS created, edit AS known, true AS due FROM sweeps WHERE i = 1
      UNION ALL
      SELECT s.user_id, s.i,
             CASE WHEN s.edit > w.known AND s.sweep >= w.created + s.min_days * 86400 THEN s.sweep ELSE w.created END,
             CASE WHEN s.edit > w.known AND s.sweep >= w.created + s.min_days * 86400 THEN s.edit ELSE w.known END,
             s.edit > w.known AND s.sweep >= w.created + s.min_days * 86400
      FROM walk w JOIN sweeps s ON s.user_id = w.user_id AND s.i = w.i + 1)
    SELECT cast(user_id AS VARCHAR) AS collection, created AS sweep, known AS edit,
           CASE WHEN i = 1 THEN 'no version yet' ELSE 'source edited' END AS reason
    FROM walk WHERE due
    """,
)
def stream_due_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a probe of its user's collection; the source is edited every third day."""
    probes = event_stream(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("collection"),
        F.col("at").alias("probed"),
        F.timestamp_seconds(F.floor(F.unix_seconds("at") / 259200) * 259200).alias("data_last_edit"),
        (F.col("user_id") % 4 + 1).alias("min_days"),
    )
    return jobs.run_due_events(probes, scratch_path(spark, "due-events"))


@query(
    "stream_edit_rate",
    f"""
    WITH w AS (SELECT event_type AS collection, cast(floor(epoch(ts) / 604800) * 604800 AS BIGINT) AS s FROM events)
    SELECT collection, strftime(make_timestamp(s * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS window_start, count(*) AS edits
    FROM w WHERE make_timestamp((s + 604800) * 1000000) <= {_CLOSED} GROUP BY collection, s
    """,
)
def stream_edit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed weeks, starting on the epoch's weekday."""
    edits = event_stream(spark, sf_dir).select(F.col("event_type").alias("collection"), F.col("at").alias("edited"))
    root = scratch_path(spark, "edit-rate")
    rate = jobs.drain(jobs.edit_rate(edits), f"{root}/out", f"{root}/checkpoint")
    return rate.select("collection", iso_utc(F.col("window_start")).alias("window_start"), "edits")


@query(
    "stream_extract_consistency",
    f"""
    WITH x AS (SELECT event_type AS collection, cast(ts - INTERVAL 6 HOUR AS DATE) AS day, ts FROM events),
         e AS (SELECT *, count(*) OVER (PARTITION BY collection, day) AS n FROM x),
         r AS (SELECT *, n + CASE WHEN day(day) % 5 = 0 AND hour(ts) >= 12 THEN 1 ELSE 0 END AS reported FROM e)
    SELECT collection, strftime(day, '%Y-%m-%d') AS extract, min(reported) AS count_low, max(reported) AS count_high,
           count(*) AS received, min(reported) = max(reported) AND max(reported) = count(*) AS keep
    FROM r GROUP BY collection, day HAVING max(ts) + INTERVAL 1 DAY <= {_CLOSED}
    """,
)
def stream_extract_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One extract per event type, from six to six over midnight; on every fifth day of the month the count moves at noon."""
    day = F.to_date(F.col("ts") - F.expr("INTERVAL 6 HOURS"))
    totals = table(spark, sf_dir, "events").groupBy("event_type", day.alias("day")).agg(F.count(F.lit(1)).alias("total"))
    stream = event_stream(spark, sf_dir).withColumn("day", day).join(totals, ["event_type", "day"])
    moved = (F.dayofmonth("day") % 5 == 0) & (F.hour("at") >= 12)
    pages = stream.select(
        F.col("event_type").alias("collection"), F.date_format("day", "yyyy-MM-dd").alias("extract"),
        F.col("at").alias("read"), F.lit(1).alias("page_rows"),
        (F.col("total") + F.when(moved, 1).otherwise(0)).alias("reported"),
    )
    root = scratch_path(spark, "consistency")
    checked = jobs.drain(jobs.extract_consistency(pages), f"{root}/out", f"{root}/checkpoint")
    return checked.select("collection", "extract", "count_low", "count_high", "received", "keep")


@query(
    "stream_page_ingest",
    """
    SELECT cast(o_orderkey AS INT) AS o_orderkey, cast(o_custkey AS INT) AS o_custkey, o_orderstatus, o_totalprice,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS o_orderdate
    FROM orders
    """,
)
def stream_page_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are landed as files, read as a stream, and appended once each."""
    root = scratch_path(spark, "pages")
    order_pages(spark, sf_dir).select("body").write.parquet(f"{root}/landed")
    stream = spark.readStream.schema("body string").parquet(f"{root}/landed")
    rows = jobs.drain(jobs.page_ingest(stream, ORDER_FIELDS), f"{root}/out", f"{root}/checkpoint")
    return rows.withColumn("o_orderdate", iso_utc(F.col("o_orderdate")))
