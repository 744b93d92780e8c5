"""Connected components of links between ids, without gathering them anywhere.

Rounds of large-star and small-star point every id at the smallest id it
knows; each round is a grouping and a join over the links that remain. The
links a task holds are first shortened by union-find.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotkeep.llm.scratch import kept


def _union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of ids to the smallest id they are tied to by these links."""
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = flat[: len(a)], flat[len(a):]
    root = np.arange(len(ids))
    for x, y in zip(left.tolist(), right.tolist()):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        while root[y] != y:
            root[y] = root[root[y]]
            y = root[y]
        if x != y:
            root[max(x, y)] = min(x, y)
    while True:
        up = root[root]
        if np.array_equal(up, root):
            break
        root = up
    moved = np.flatnonzero(root != np.arange(len(ids)))
    return ids[moved], ids[root[moved]]


def _shorten(batches):
    """Union-find over bounded batches of a task's links: at most one link per id and batch."""
    for batch in batches:
        a, b = _union_find(*(batch.column(i).to_numpy(zero_copy_only=False) for i in range(2)))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id that has a link; the component is its smallest id.

    ``links`` has the columns a and b (long, no nulls); repeated links and
    links of an id to itself do no harm. An empty table gives an empty table.
    """
    edges = links.select("a", "b").where(F.col("a") != F.col("b")).mapInArrow(_shorten, "a long, b long").distinct()
    edges = kept(edges, "links")
    state = None
    while True:
        # large star: larger neighbours of an id move to the smallest one around it
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        # small star: an id and its smaller neighbours move to the smallest of these
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").where(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = kept(small.union(least.select("a", F.col("least").alias("b"))).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    return edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component").union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
