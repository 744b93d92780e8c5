"""Streaming forms of the refresh steps.

Every job reads whatever has landed and stops (``availableNow``), so a
scheduler may start it as often as it likes; the checkpoint remembers what was
read, and the Parquet sink adds each batch exactly once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from plotkeep.sources.pages import page_rows

DAY = 86_400
DUE_SCHEMA = "collection string, sweep bigint, edit bigint, reason string"
_STATE_SCHEMA = "created bigint, known bigint"


def drain(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over what has landed, then read the sink.

    State is kept in ``spark.sql.shuffle.partitions`` partitions as set at the
    first run of a checkpoint, which fixes the number for later runs.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def _decide(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Walk the daily sweeps of one collection in time order."""
    sweeps = pd.concat(list(chunks)).sort_values("sweep")
    created, known = state.get if state.exists else (None, None)
    due = []
    for row in sweeps.itertuples(index=False):
        if created is None:
            reason = "no version yet"
        elif row.edit <= known or row.sweep < created + row.min_days * DAY:
            continue
        else:
            reason = "source edited"
        created, known = int(row.sweep), int(row.edit)
        due.append((key[0], created, known, reason))
    if created is not None:
        state.update((created, known))
    yield pd.DataFrame(due, columns=["collection", "sweep", "edit", "reason"])


def daily_sweeps(probes: DataFrame, delay: str = "1 day") -> DataFrame:
    """Probe stream to one sweep per collection and closed day.

    probes(collection, probed timestamp, data_last_edit timestamp, min_days).
    The reduction combines on the map side, so a collection that is probed
    without end still gives one short row per day. Late probes of a closed day
    are dropped. Times are epoch seconds.
    """
    return (
        probes.withWatermark("probed", delay)
        .groupBy(F.window("probed", "1 day"), "collection")
        .agg(
            F.unix_seconds(F.max("probed")).alias("sweep"),
            F.unix_seconds(F.max("data_last_edit")).alias("edit"),
            F.max("min_days").alias("min_days"),
        )
        .select("collection", "sweep", "edit", "min_days")
    )


def due_events(sweeps: DataFrame) -> DataFrame:
    """Sweep stream to due events, at most one per collection per ``min_days``.

    A due event counts as a version from then on. Replaying landed files
    changes nothing: the checkpoint holds the read position and the state.
    Spark does not allow custom state after an aggregation in one query, so
    this reads the sink of ``daily_sweeps``.
    """
    return sweeps.groupBy("collection").applyInPandasWithState(
        _decide, DUE_SCHEMA, _STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )


def run_due_events(probes: DataFrame, root: str) -> DataFrame:
    """Both steps over what has landed; returns all due events so far."""
    spark = probes.sparkSession
    sweeps = drain(daily_sweeps(probes), f"{root}/sweeps", f"{root}/sweeps-checkpoint")
    landed = spark.readStream.schema(sweeps.schema).parquet(f"{root}/sweeps")
    return drain(due_events(landed), f"{root}/due", f"{root}/due-checkpoint")


def page_ingest(pages: DataFrame, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """Landed pages (body) to typed rows; the sink appends every page once."""
    return page_rows(pages, fields)


def edit_rate(edits: DataFrame, width: str = "7 days", delay: str = "1 day") -> DataFrame:
    """Edits per collection and week: the cadence a source really keeps.

    edits(collection, edited timestamp). A window is reported once it closed.
    """
    return (
        edits.withWatermark("edited", delay)
        .groupBy(F.window("edited", width).alias("w"), "collection")
        .agg(F.count(F.lit(1)).alias("edits"))
        .select("collection", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "edits")
    )


def extract_consistency(pages: DataFrame, silence: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Did the source hold still while it was read?

    pages(collection, extract, read timestamp, page_rows, reported). An extract is told by its id, whatever
    days it touches and however many there are in a day, and has ended once no page of it came for
    ``silence``. One whose reported count moved, or differs from the rows received, is discarded; so are both
    halves of one that paused for longer. Pages without an id are one extract of their collection.
    """
    return (
        pages.withWatermark("read", delay)
        .groupBy(F.session_window("read", silence).alias("w"), "collection", "extract")
        .agg(
            F.min("reported").alias("count_low"),
            F.max("reported").alias("count_high"),
            F.sum("page_rows").alias("received"),
        )
        .select(
            "collection", "extract", F.col("w.start").alias("extract_start"), "count_low", "count_high", "received",
            ((F.col("count_low") == F.col("count_high")) & (F.col("count_high") == F.col("received"))).alias("keep"),
        )
    )
