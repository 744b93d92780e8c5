"""Files below a folder as a listing table."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plotkeep.session import cut_lineage

_ENTRIES = "path string, folder boolean, size long, modified timestamp"


def _opened(root: str) -> tuple[pafs.FileSystem, str]:
    # Spark writes local addresses with one slash
    root = "file:///" + root.removeprefix("file:").lstrip("/") if root.startswith("file:") else root
    store, base = pafs.FileSystem.from_uri(root)
    return store, base.rstrip("/")


def _entries(root: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What lies directly in each of the folders, one batch per folder, without names that start with a dot."""
    store, base = _opened(root)
    for batch in batches:
        for inside in batch.column("path").to_pylist():
            found = store.get_file_info(pafs.FileSelector(f"{base}/{inside}".rstrip("/"), allow_not_found=False))
            found = [f for f in found if not f.base_name.startswith(".")]
            folder = [f.type == pafs.FileType.Directory for f in found]
            yield pa.RecordBatch.from_arrays([
                pa.array([f"{inside}/{f.base_name}".lstrip("/") for f in found], pa.string()),
                pa.array(folder, pa.bool_()),
                pa.array([None if d else f.size for f, d in zip(found, folder)], pa.int64()),
                pa.array([f.mtime for f in found], pa.timestamp("us", tz="UTC")),
            ], ["path", "folder", "size", "modified"])


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path relative to the root, size, modified). No file content is read.

    One round per level of folders; the folders of a level are listed side by
    side in tasks, and only their number comes to the driver. A single folder's
    entries are held by one task while it lists it. Names that start with an
    underscore count, which Spark's own file sources leave out; names that start
    with a dot do not, nor what is below them. ``root`` is an absolute path or an
    address of a store that Arrow opens on the executors; one that is not there
    is an error, an empty one gives no rows.
    """
    width = max(spark.sparkContext.defaultParallelism, 1)
    folders = spark.createDataFrame([("",)], "path string")
    levels = []
    while True:
        listed = cut_lineage(folders.mapInArrow(lambda batches: _entries(root, batches), _ENTRIES), "listing")
        levels.append(listed.where("NOT folder").select("path", "size", "modified"))
        folders = listed.where("folder").select("path").repartition(width, "path")
        if listed.where("folder").isEmpty():
            return reduce(DataFrame.unionByName, levels)
