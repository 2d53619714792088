"""Incremental reading of page files: new pages become lines once, a page that comes again replaces nothing.

The batch operators stay as they are; a stream's micro-batches go through them and are appended, so a restart from the
checkpoint goes on where it was. State is bounded: repeats are recognised within the watermark only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.layout import build_lines
from ..sources.pages import PAGE_SCHEMA


def page_stream(spark: SparkSession, path: str, delay: str = "1 day", files_per_batch: int = 1000) -> DataFrame:
    """Pages below path/<book_id>/p*.json as they come; the folder names the book, a page seen within `delay` is dropped."""
    files = spark.readStream.schema(PAGE_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", True)
    pages = files.json(path).select(F.element_at(F.split("_metadata.file_path", "/"), -2).alias("book_id"), F.col("_metadata.file_modification_time").alias("arrived"), "*")
    return pages.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["book_id", "page"])


def ingest_lines(pages: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends the lines of new pages to the Parquet table `out`, all that is there now; a batch is written whole, under
    its number, so a batch that is tried again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        build_lines(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
