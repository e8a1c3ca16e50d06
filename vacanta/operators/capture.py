"""Incremental capture against seen keys, and the batch summary.

Semantics (per run): drop candidates whose key is already in the state, keep the
rows that pass the run's filters (recency, relevance), keep the first arrival of
each key, append the new rows as one batch, and extend the state with their keys.
Only kept keys enter the state, so a rejected key is looked at again next run.

The landed batches are the state: the seen keys are the key column of all earlier
batches (``batch_id=<id>`` folders). A batch is written by overwriting only its
own folder, so replaying a batch id — a retried
task, a re-run, or a ``foreachBatch`` replay after a failure — gives the same
folders. A compact copy of the keys (:mod:`.seen_state`) can be read in their place; it names the
batches that it covers, and the others are read from their folders.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import seen_state
from .dedup import first_arrival


def capture_new(candidates: DataFrame, seen: DataFrame | Sequence[DataFrame] | None, keys: Sequence[str],
                order_by: Sequence[Column | str], keep: Column | None = None) -> DataFrame:
    """New rows of one run: filters, then first arrival per key, then the anti-join
    against the seen keys. Rows with a null key part have no identity that a later run could
    recognise: they aren't captured (see :func:`null_key_rejects`).

    De-duplicating before the anti-join is equivalent (a seen key drops all its
    rows either way) and sends at most one row per key into the join shuffle, so a
    key holding a third of a run costs one row there. The state side is only the
    key columns; AQE turns the join into a broadcast when the state turns out small
    and splits skewed partitions otherwise. ``seen`` may be several frames (the runs of a compact
    state, whose buckets are joined without moving them)."""
    return without_seen(_first_kept(candidates, keys, list(order_by), keep), seen, keys)


def without_seen(rows: DataFrame, seen: DataFrame | Sequence[DataFrame] | None, keys: Sequence[str]) -> DataFrame:
    """``rows`` whose key is in none of the ``seen`` frames."""
    for frame in [] if seen is None else [seen.select(*keys).distinct()] if isinstance(seen, DataFrame) else seen:
        rows = rows.join(frame.select(*keys), list(keys), "left_anti")
    return rows


def null_key_rejects(candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The candidates that capture leaves out for a null key part, all of them."""
    return candidates.filter(_any_null(keys))


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def first_capture_history(candidates: DataFrame, keys: Sequence[str], batch_col: str,
                          position: Sequence[Column | str], keep: Column | None = None) -> DataFrame:
    """All runs at once: the rows each batch would capture when runs are replayed in
    ``batch_col`` order with only kept keys entering the state. Equal to the first
    kept occurrence of each key, ordered by batch then position."""
    return _first_kept(candidates, keys, [F.col(batch_col)] + list(position), keep)


def _first_kept(rows: DataFrame, keys: Sequence[str], order_by: list, keep: Column | None) -> DataFrame:
    """First arrival per key among the rows that pass ``keep`` and have all key parts.

    Only kept rows can win, so the filter comes first: rejected rows are neither sorted nor
    shuffled, and its parts reach the scan where they can. Callers whose ``keep`` reads
    derived text columns hand in rows that are written already."""
    rows = rows.filter(~_any_null(keys))
    return first_arrival(rows if keep is None else rows.filter(keep), keys, order_by)


def batch_summary(new_rows: DataFrame, run_ts: Column, group_col: str = "source",
                  internship: Column | None = None, domains: Sequence[str] = (),
                  country: Column | None = None) -> DataFrame:
    """Per-source summary of a landed batch: counts, internships, run keys."""
    intern = internship if internship is not None else F.lit(False)
    return (new_rows.groupBy(group_col)
            .agg(F.count(F.lit(1)).alias("new_records_count"),
                 F.count_if(F.coalesce(intern, F.lit(False))).alias("internships_count"))
            .select(F.col(group_col).alias("source"),
                    (country if country is not None else F.lit(None).cast("string")).alias("country"),
                    F.lit("bronze_delta").alias("pipeline_stage"),
                    run_ts.alias("ingestion_timestamp_utc"),
                    F.date_format(run_ts, "yyyy-MM-dd").alias("run_date"),
                    F.date_format(run_ts, "HHmmss").alias("run_time"),
                    "new_records_count", "internships_count",
                    F.array(*[F.lit(d) for d in domains]).cast("array<string>").alias("domains_covered")))


# ---------------------------------------------------------------------------
# landed batches as state
# ---------------------------------------------------------------------------

def _read(spark: SparkSession, path: str) -> DataFrame | None:
    """Parquet at ``path`` with ``batch_id`` as text, or None where nothing was ever written.
    Any other failure (a broken file, no permission) is raised: an unreadable state isn't an
    empty one."""
    try:
        schema = spark.read.parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    fields = [T.StructField(f.name, T.StringType() if f.name == "batch_id" else f.dataType, f.nullable) for f in schema]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def seen_keys(spark: SparkSession, root: str, keys: Sequence[str], exclude_batch: str | None = None,
              state_path: str | None = None) -> DataFrame | list[DataFrame] | None:
    """Key columns of all landed batches under ``root`` (optionally without one batch id).

    With ``state_path`` (a state kept by :func:`compact_state`), several frames: its runs, and the
    batches that it doesn't cover, read from their own folders."""
    state = seen_state.open_state(spark, state_path) if state_path else None
    if state is None:
        landed = _read(spark, root)
        if landed is None:
            return None
        if exclude_batch is not None:
            landed = landed.filter(F.col("batch_id") != F.lit(exclude_batch))  # partition pruning
        return landed.select(*keys)
    # of a replayed batch that is covered: keys it landed first may be captured again
    frames = [f.select(*keys) for f in state.rows(exclude_batch)]
    newer = seen_state.read_landed(spark, root, [i for i in seen_state.uncovered_ids(spark, root, state) if i != exclude_batch])
    return frames if newer is None else [*frames, newer.select(*keys)]


def read_seen_state(spark: SparkSession, path: str, source: str, keys_field: str = "seen_ids") -> DataFrame:
    """Seen keys from a state object of the original capture jobs
    (``{updated_at, total_seen, seen_ids | seen_urls}``, one pretty-printed JSON
    document per file), as ``(source, key)`` rows — to start capture from the state
    a previous deployment left behind. A missing object gives an empty state."""
    schema = f"updated_at string, total_seen long, {keys_field} array<string>"
    empty = spark.createDataFrame([], "source string, key string")
    try:
        doc = spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty
    return doc.select(F.lit(source).alias("source"), F.explode_outer(keys_field).alias("key")).filter(
        F.col("key").isNotNull())


def compact_state(spark: SparkSession, root: str, keys: Sequence[str], out_path: str,
                  run_ts: Column | None = None, buckets: int | None = None, fanout: int = seen_state.FANOUT) -> DataFrame | None:
    """Takes the batches landed since the last compaction into the compact state at ``out_path``
    (:mod:`.seen_state`); returns its keys, one row each with the batch that first landed it. The landed
    batches stay the source of truth, and a compaction killed anywhere leaves the state as it was."""
    state = seen_state.compact(spark, root, keys, out_path, run_ts, buckets, fanout)
    return state.table() if state else None


def land_batch(new_rows: DataFrame, root: str, batch_id: str) -> None:
    """Write one batch into ``root/batch_id=<id>``; only that folder is replaced. An empty
    batch leaves an empty folder, also where an earlier run of this batch had rows."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
        raise ValueError(f"batch id {batch_id!r}: only letters, digits and _.- can name its folder")
    new_rows.write.mode("overwrite").parquet(f"{root.rstrip('/')}/batch_id={batch_id}")


def capture_batch(spark: SparkSession, candidates: DataFrame, root: str, batch_id: str,
                  keys: Sequence[str], order_by: Sequence[Column | str], keep: Column | None = None,
                  state_path: str | None = None) -> DataFrame:
    """One run: capture against the landed batches (or a compact state copy plus the
    batches after it), land the new rows, return them as read back from the landed folder.

    The state is read from the other batches' folders, so the run never reads what it replaces."""
    seen = seen_keys(spark, root, keys, exclude_batch=batch_id, state_path=state_path)
    land_batch(capture_new(candidates, seen, keys, order_by, keep), root, batch_id)
    return _read(spark, root).filter(F.col("batch_id") == F.lit(batch_id))
