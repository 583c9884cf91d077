"""Run the pipeline on each micro-batch of new line files (Structured Streaming)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

LINES = "file_id string, page int, y double, x double, text string, line_ord long"


def line_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Lines from the Parquet files that arrive in ``folder``. A file_id's lines must arrive together."""
    return spark.readStream.schema(LINES).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def watch(lines: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Call ``handle(batch, batch_id)`` for each batch; it must be idempotent for a batch_id, as a batch may come again.

    ``once`` handles what is there and ends.
    """
    writer = lines.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
