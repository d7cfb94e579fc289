"""Running file streams to their end, and tables that micro-batches write safely.

A micro-batch may be replayed after a failure. Each one therefore writes its own folder, named
by the batch and overwritten on replay; readers merge the folders, the later batch winning.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from wattline.sources.tables import child_names, first_per_key

BATCH = "batch_id"


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None):
    """Files below ``path`` as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


PROGRESS = (
    "run_id string, batch_id long, input_rows long, input_rows_per_s double, processed_rows_per_s double, took_ms long, watermark string"
)
#: Progress events that are written together; the last ones when the query ends.
EVENTS = 50


class ProgressLog(StreamingQueryListener):
    """Appends every progress event of one query to a table; the query itself remembers the last hundred only."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name
        self.run_id, self.rows, self.ended = None, [], threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run_id = str(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if str(p.runId) != self.run_id:
            return
        took = (p.durationMs or {}).get("triggerExecution")
        self.rows.append(
            (self.run_id, int(p.batchId), int(p.numInputRows), float(p.inputRowsPerSecond or 0.0),
             float(p.processedRowsPerSecond or 0.0), int(took) if took is not None else None,
             dict(p.eventTime or {}).get("watermark"))
        )
        if len(self.rows) >= EVENTS:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.flush()
            self.ended.set()

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)


def run_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    progress_path: str | None = None,
) -> StreamingQuery:
    """Call ``handle`` for each micro-batch; stop at the end of the data unless ``every`` is given.

    With ``progress_path`` a row for each batch is kept there, see ``progress``."""
    spark, log = stream.sparkSession, None
    writer = stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", checkpoint)
    if progress_path:
        log = ProgressLog(spark, progress_path, f"batches-{uuid.uuid4().hex}")
        spark.streams.addListener(log)
        writer = writer.queryName(log.name)
    if every:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        if log:
            log.ended.wait(60)  # events come a little later than the query's end
            spark.streams.removeListener(log)
    return query


def write_batch(batch: DataFrame, path: str, batch_id: int, partition_by: list[str] = ()) -> None:
    batch.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{BATCH}={batch_id}")


def batch_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(transform(batch) if transform else batch, path, batch_id)

    return handle


def read_batches(spark: SparkSession, path: str) -> DataFrame | None:
    """All batches with their ``batch_id``; None before the first."""
    if not any(n.startswith(f"{BATCH}=") for n in child_names(spark, path)):
        return None
    return spark.read.option("basePath", path).parquet(path).withColumn(BATCH, F.col(BATCH).cast("long"))


def read_latest(spark: SparkSession, path: str, keys: list[str], order: list[Column] = ()) -> DataFrame | None:
    """One row per key: that of the latest batch."""
    rows = read_batches(spark, path)
    return None if rows is None else latest_rows(rows, keys, order)


def latest_rows(batches: DataFrame, keys: list[str], order: list[Column] = ()) -> DataFrame:
    return first_per_key(batches, keys, [F.col(BATCH), *order], last=True).drop(BATCH)


def progress(spark: SparkSession, path: str) -> DataFrame:
    """Per finished micro-batch: input rows, rates, duration and the newest event time seen. All batches that ran
    with ``progress_path``, also those of earlier runs."""
    return spark.read.schema(PROGRESS).parquet(path)
