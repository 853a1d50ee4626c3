"""Structured Streaming around the batch operators: telemetry in windows, and source files as they arrive.

The reference resolves files in batches and has no windows; these are extensions, made of the same functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import telemetry
from ..schemas import EVENT


def event_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Telemetry events of the JSON-lines files of a folder, with event_time; malformed lines are skipped."""
    reader = spark.readStream.schema(EVENT).option("mode", "DROPMALFORMED")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(folder).withColumn("event_time", F.timestamp_seconds("ts"))


def windowed_latency(events: DataFrame, window: str = "1 hour", late: str = "1 hour", by: str = "stage") -> DataFrame:
    """Stats of the duration for one record in windows of event time; a record counted once within the lateness."""
    timed = events.withWatermark("event_time", late).dropDuplicatesWithinWatermark(["record_id", "stage", "ts"])
    records = F.coalesce(F.nullif(F.col("extra.record_count"), F.lit(0)), F.lit(1))
    per_record = F.col("duration_ms") / records
    grouped = timed.where(F.col("duration_ms").isNotNull() & ~F.col("stage").isin(*telemetry.NOT_STAGES)).groupBy(F.window("event_time", window), F.col(by))
    return grouped.agg(*telemetry.stat_columns(per_record)).select("window.start", "window.end", by, *telemetry.STATS)


def file_stream(spark: SparkSession, folder: str, pattern: str = "*", max_files: int = 1000) -> DataFrame:
    """Source files as they arrive, at most so many a trigger: the rate is that and the trigger's interval."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).load(folder)


def ingest(files: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Run the batch functions on each micro-batch; without an interval, on what is there, and stop."""
    writer = files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
