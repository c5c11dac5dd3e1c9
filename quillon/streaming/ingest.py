"""New recordings of a folder, decoded, flagged and appended to a dataset's steps.

A file is a whole episode, so its flags follow within its rows' task: no state, watermark
or shuffle is needed, and the file source's log makes each file count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources import npy

FILES = "path string, modificationTime timestamp, length long, content binary"


def flagged(files: DataFrame, demo: bool = True) -> DataFrame:
    """Steps with position and flags of a table or stream of path and content."""
    return npy.decoded(files, [c for c in npy.ALL if c != "n_steps"], demo)


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, pattern: str = "*.npy", demo: bool = True) -> StreamingQuery:
    """Handle all files that are there and not yet handled, then stop."""
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", pattern).load(folder)
    return flagged(files, demo).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
