"""The seen keys as a versioned, bucketed, incrementally merged table.

The landed batches stay the source of truth; this is the copy that capture reads instead of the whole
history. It is a set of runs. A run holds the keys of some batches (one row per key, with the batch that
first landed it) as files bucketed and sorted by the key, and the ids of those batches. Compaction writes
one run from the batches that no run covers, and where ``fanout`` runs of a level have gathered,
merges them into one run of the next level: a key is rewritten once per level, so the
cost of a compaction follows the new batches, not the history. The anti-join with the candidates reads
the buckets of each run without an exchange; only the candidates move.

Runs are immutable and a version is published by one atomic rename (:mod:`..sources.versions`): a
compaction that is killed anywhere leaves the former version, whose uncovered batches are read from their
own folders, so no key is ever unseen.

Of a key that several batches landed (a replayed batch), the least batch id by text is kept."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import versions as V
from ..sources.buckets import read_bucketed, write_bucketed

#: Runs of one level that are merged into the next.
FANOUT = 4


@dataclass
class SeenState:
    """A published version of the state: its runs (folders, newest last) and what they cover."""

    spark: SparkSession
    root: str
    manifest: V.Manifest

    @property
    def keys(self) -> list[str]:
        return [f.name for f in self.schema][:-2]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self.manifest.content["schema"])

    @property
    def runs(self) -> list[dict]:
        return self.manifest.content["runs"]

    def run_rows(self, run: dict) -> DataFrame:
        return read_bucketed(self.spark, f"{run['folder']}/keys", self.schema, self.keys, self.manifest.content["buckets"])

    def rows(self, exclude_batch: str | None = None) -> list[DataFrame]:
        """A frame per run: keys, first_batch_id, updated_at. With ``exclude_batch``, without the keys that it landed first."""
        frames = [self.run_rows(r) for r in self.runs]
        return frames if exclude_batch is None else [f.filter(F.col("first_batch_id") != F.lit(exclude_batch)) for f in frames]

    def table(self) -> DataFrame:
        """All keys, one row each: runs may share a key that a replayed batch landed again.

        The files are read as plain ones: a union of bucketed scans claims their partitioning, but
        concatenates them when it runs on column batches (Spark 4.1), so an aggregate above it would
        not see a key's rows together."""
        files = self.spark.read.schema(self.schema).parquet(*[f"{r['folder']}/keys" for r in self.runs])
        return files.groupBy(*self.keys).agg(F.min("first_batch_id").alias("first_batch_id"), F.max("updated_at").alias("updated_at"))

    def covered(self) -> DataFrame:
        return self.spark.read.schema("batch_id string").parquet(*[f"{r['folder']}/batches" for r in self.runs])


def open_state(spark: SparkSession, path: str) -> SeenState | None:
    manifest = V.read_manifest(spark, path)
    return SeenState(spark, path, manifest) if manifest else None


def landed_ids(spark: SparkSession, landed_root: str) -> list[str]:
    """Ids of the landed batches, by their folders' names (no file is opened)."""
    return [n.removeprefix("batch_id=") for n in V.list_folder(spark, landed_root) if n.startswith("batch_id=")]


def uncovered_ids(spark: SparkSession, landed_root: str, state: SeenState | None) -> list[str]:
    """The batches landed since the last compaction: as many as its schedule lets gather."""
    ids = landed_ids(spark, landed_root)
    if state is None or not ids:
        return ids
    listed = spark.createDataFrame([(i,) for i in ids], "batch_id string")
    return sorted(r["batch_id"] for r in listed.join(state.covered(), "batch_id", "left_anti").collect())


def read_landed(spark: SparkSession, landed_root: str, ids: Sequence[str]) -> DataFrame | None:
    """Rows of the given batches, read from their own folders only; ``batch_id`` as text. A batch
    without rows has no file to read."""
    root = landed_root.rstrip("/")
    folders = [f"{root}/batch_id={i}" for i in ids if any(n.endswith(".parquet") for n in V.list_folder(spark, f"{root}/batch_id={i}"))]
    if not folders:
        return None
    schema = spark.read.option("basePath", root).parquet(*folders).schema
    fields = [T.StructField(f.name, T.StringType() if f.name == "batch_id" else f.dataType, f.nullable) for f in schema]
    return spark.read.schema(T.StructType(fields)).option("basePath", root).parquet(*folders)


def write_run(rows: DataFrame, ids: DataFrame, folder: str, keys: Sequence[str], buckets: int) -> None:
    write_bucketed(rows, f"{folder}/keys", keys, buckets)
    ids.coalesce(1).write.parquet(f"{folder}/batches")


def compact(spark: SparkSession, landed_root: str, keys: Sequence[str], path: str, run_ts: Column | None = None,
            buckets: int | None = None, fanout: int = FANOUT) -> SeenState | None:
    """Takes the batches that no run covers into the state and publishes the result. None where no batch was ever landed.

    ``buckets``, fixed by the first compaction, are the files of a run: the key bytes to come over some 128 MB,
    and no fewer than ``spark.sql.shuffle.partitions`` (the default): the planner moves a side with
    fewer partitions than that."""
    state = open_state(spark, path)
    base = state.manifest if state else None
    ids = uncovered_ids(spark, landed_root, state)
    if not ids:
        return state
    if state is not None:
        if state.keys != list(keys):
            raise ValueError(f"{path} holds keys {state.keys}, not {list(keys)}")
        buckets = base.content["buckets"]
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    new = read_landed(spark, landed_root, ids)
    stamp = run_ts if run_ts is not None else F.current_timestamp()
    if new is None:  # batches without rows: covered all the same, once there is a state to say so
        if state is None:
            return None
        rows = spark.createDataFrame([], state.schema)
    else:
        rows = new.groupBy(*keys).agg(F.min("batch_id").alias("first_batch_id")).withColumn("updated_at", stamp)
    folder = V.stage_folder(path, base)
    write_run(rows, spark.createDataFrame([(i,) for i in ids], "batch_id string"), folder, keys, buckets)
    schema = state.schema if state else T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    content = {"schema": schema.jsonValue(), "buckets": buckets, "runs": [*(state.runs if state else []), {"folder": folder, "level": 0}]}
    content["runs"] = _merge_levels(SeenState(spark, path, V.Manifest(0, content)), base, fanout)
    return SeenState(spark, path, V.publish(spark, path, base, content))


def _merge_levels(staged: SeenState, base: V.Manifest | None, fanout: int) -> list[dict]:
    runs, level = list(staged.runs), 0
    while any(r["level"] >= level for r in runs):
        same = [r for r in runs if r["level"] == level]
        if len(same) >= fanout:
            part = SeenState(staged.spark, staged.root, V.Manifest(0, staged.manifest.content | {"runs": same}))
            folder = V.stage_folder(staged.root, base)
            write_run(part.table(), part.covered(), folder, staged.keys, staged.manifest.content["buckets"])
            runs = [r for r in runs if r["level"] > level] + [{"folder": folder, "level": level + 1}] + [r for r in runs if r["level"] < level]
        level += 1
    return runs
