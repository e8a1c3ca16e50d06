"""Capture as a keyed stateful stream with a defined survivor and state that expires.

Each key has one value in the streaming state: the time of its captured row. Rows of a known key are dropped; of a
new key's rows in a micro-batch the first by position is emitted, whatever the order of files and tasks. A trigger
costs its micro-batch, not the history.

State ends with the recency rule. The watermark trails the newest event by ``max_age``, so rows that are older than
that are dropped as late (recency would reject them), and an event-time timer on a key's row clears its state when
the watermark passes it: the key could only come back in rows that are too old. Rows without a time are never late,
and their keys never expire.

A hot key's rows are thinned to one per Arrow batch before the shuffle. The session's time zone is UTC
(``plans.daily.prepared`` sets it): times without a zone are read in it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions import vocab as V
from ..session import checkpoint_dir, ship_code
from .capture import ROCKSDB

EPOCH, MICROS = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc), "_micros"


def first_rows(rows: pd.DataFrame, keys: Sequence[str], position: Sequence[str]) -> pd.DataFrame:
    """The first row of each key by position (nulls first)."""
    return rows.sort_values(list(position), na_position="first", kind="stable").drop_duplicates(list(keys))


def _place(row: Row, position: Sequence[str]) -> tuple:
    """A row's place among those of its key (nulls first)."""
    return tuple((False, None) if v is None or v != v else (True, v) for v in (row[c] for c in position))


class FirstArrival(StatefulProcessor):
    """Rows come as rows, not as a frame for each key: a key has few, and a frame costs more than its state."""

    def __init__(self, position: Sequence[str], time: str, columns: Sequence[str]):
        self.position, self.columns, self.row = list(position), [MICROS if c == time else c for c in columns], Row(*columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("at", T.TimestampType())]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.seen.exists():
            for _ in rows:  # the stream of a group is read to its end
                pass
            return
        first = min(rows, key=lambda row: _place(row, self.position))
        micros = first[MICROS]
        if micros is None:
            self.seen.update((None,))
        else:
            self.seen.update((EPOCH + dt.timedelta(microseconds=micros),))
            self.handle.registerTimer(micros // 1000)
        yield self.row(*[first[c] for c in self.columns])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def capture_stream_keyed(spark: SparkSession, source_dir: str, schema: T.StructType, sink_dir: str, keys: Sequence[str], position: Sequence[str], time: str,
                         keep: Callable[[], Column] | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None, max_age: str = f"{V.MAX_JOB_AGE_DAYS} days",
                         stream_checkpoint: str | None = None, file_format: str = "parquet", max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Starts the stream: kept rows of new keys, each key's first by the columns ``position``, into an exactly-once
    Parquet sink. Rows with a null key part aren't captured (``capture.null_key_rejects``)."""
    checkpoint_dir(spark)
    ship_code(spark)
    provider = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(provider) != ROCKSDB:  # the only store with timers and several states
        spark.conf.set(provider, ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(source_dir)
    rows = prepare(rows) if prepare is not None else rows
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    rows = rows if keep is None else rows.filter(keep())
    kind = rows.schema[time].dataType
    rows = rows.withColumn(time, F.col(time).cast("timestamp"))  # watermarks are on instants
    names, order = list(keys), list(position)

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield first_rows(batch, names, order)

    firsts = rows.mapInPandas(thin, rows.schema).withWatermark(time, max_age).withColumn(MICROS, F.unix_micros(time))
    # the time goes through Python as a number, whatever the time zone
    made = T.StructType([T.StructField(time, T.LongType()) if f.name == time else f for f in rows.schema])
    order = [MICROS if c == time else c for c in order]
    out = firsts.groupBy(*names).transformWithState(FirstArrival(order, time, rows.columns), made, "append", "EventTime").withColumn(time, F.timestamp_micros(time).cast(kind))
    writer = out.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", stream_checkpoint or sink_dir.rstrip("/") + "_stream_checkpoint").outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
