"""File-arrival stream: a landing directory of match files drives the pipeline.

``readStream.format("binaryFile")`` lists new files per micro-batch; each micro-batch is
handed to ``foreachBatch``, which runs the same ingest + incremental build as a batch
run. The stream's own checkpoint remembers which *paths* it has seen; a file rewritten
in place is not re-read by the stream, so corrected files must land under a new path
(the batch ``ingest`` still de-duplicates by content hash, so replays are harmless).
Run with ``trigger(availableNow=True)`` for scheduled catch-up, or a processing-time
trigger for continuous landing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crease.plans import pipeline

BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def landing_stream(spark: SparkSession, directory: str, glob: str = "*.json",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (spark.readStream.format("binaryFile").schema(BINARY_FILE)
              .option("pathGlobFilter", glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(directory)


def start(wh: pipeline.Warehouse, directory: str, checkpoint: str,
          available_now: bool = True, max_files_per_trigger: int | None = None,
          refresh_seeds: bool = False) -> StreamingQuery:
    """Start the landing -> warehouse stream. Each micro-batch = one pipeline run."""
    stream = landing_stream(wh.spark, directory, max_files_per_trigger=max_files_per_trigger)
    return start_stream(wh, stream, checkpoint, available_now, refresh_seeds)


def start_stream(wh: pipeline.Warehouse, arrivals: DataFrame, checkpoint: str, available_now: bool = True,
                 refresh_seeds: bool = False) -> StreamingQuery:
    """The same for any stream of (path, content) rows."""

    def run_batch(files: DataFrame, batch_id: int) -> None:  # noqa: ARG001
        # a replayed batch finds its files registered; build takes in what the feed still holds
        pipeline.run(wh, files.select("path", "content"), seeds=refresh_seeds)

    writer = arrivals.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
