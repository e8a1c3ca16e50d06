"""Incremental capture as a Structured Streaming query.

New candidate files arrive in a folder; each micro-batch is captured against the
landed batches (:func:`vacanta.operators.capture.capture_batch`) inside
``foreachBatch``. The micro-batch id is the batch id of the landed folder, and the
stream's checkpoint records which files made up each micro-batch, so a restart
after a failure replays the same files under the same id and overwrites only that
folder: the landed table ends up as if every batch ran exactly once.

``Trigger.AvailableNow`` processes everything present and stops, which is the
scheduled (daily) form; the same query runs continuously with a processing-time
trigger.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.capture import capture_batch
from ..session import checkpoint_dir


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def capture_stream(spark: SparkSession, source_dir: str, schema: StructType, landed_root: str,
                   keys: Sequence[str], order_by: Callable[[], Sequence[Column]],
                   keep: Callable[[], Column] | None = None, stream_checkpoint: str | None = None,
                   file_format: str = "parquet", max_files_per_trigger: int | None = None,
                   available_now: bool = True, prepare: Callable[[DataFrame], DataFrame] | None = None,
                   state_path: str | None = None) -> StreamingQuery:
    """Start the capture stream; ``order_by``/``keep`` are factories (columns are
    built per micro-batch), ``prepare`` derives columns (e.g. the key) per batch,
    ``state_path`` names a compact seen-key copy (``capture.compact_state``, run between
    triggers by its own schedule) to read instead of the full history."""
    checkpoint_dir(spark)
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare is not None else batch
        capture_batch(batch.sparkSession, rows, landed_root, str(batch_id), keys, order_by(),
                      keep() if keep is not None else None, state_path=state_path)

    writer = stream.writeStream.foreachBatch(per_batch).option(
        "checkpointLocation", stream_checkpoint or landed_root.rstrip("/") + "_stream_checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def capture_stream_state(spark: SparkSession, source_dir: str, schema: StructType, sink_dir: str,
                         keys: Sequence[str], keep: Callable[[], Column] | None = None,
                         prepare: Callable[[DataFrame], DataFrame] | None = None,
                         stream_checkpoint: str | None = None, file_format: str = "parquet",
                         max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Capture with Spark's state store: kept rows, ``dropDuplicates(keys)`` (the seen
    keys live in the streaming state, so a trigger costs the size of its micro-batch,
    not of the whole history), written by the exactly-once file sink.

    Each key is emitted once over the life of the stream. Within one micro-batch the
    row kept for a new key is not ordered; use :func:`capture_stream` when the
    survivor must be the first by position. All keys stay in the state, so it is kept in
    RocksDB (on disk, with changelog checkpoints) unless the session names a provider."""
    checkpoint_dir(spark)
    provider = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(provider).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(provider, ROCKSDB)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(source_dir)
    if prepare is not None:
        rows = prepare(rows)
    if keep is not None:
        rows = rows.filter(keep())
    writer = (rows.dropDuplicates(list(keys)).writeStream.format("parquet")
              .option("path", sink_dir)
              .option("checkpointLocation", stream_checkpoint or sink_dir.rstrip("/") + "_stream_checkpoint")
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
