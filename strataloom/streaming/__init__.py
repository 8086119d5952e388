"""Tiles that keep arriving: the missing-only rule as a stream over a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

FILES = "path string, modificationTime timestamp, length long, content binary"


def watch_tiles(spark: SparkSession, folder: str, checkpoint: str, handle: Callable[[DataFrame, int], None], per_batch: int = 64, pattern: str = "*.tif") -> StreamingQuery:
    """Hand each new file (path, content) of a folder to `handle` once, `per_batch` at a time, until none is left.

    The stream's checkpoint remembers the files that are done, so a later run takes up
    only what is missing. Files must be renamed into the folder when they are whole.
    """
    files = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_batch).load(folder)
    stream = files.select("path", "content").writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()
