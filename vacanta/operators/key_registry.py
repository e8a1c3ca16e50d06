"""Surrogate keys that members keep from run to run.

A registry is a versioned table (:mod:`..sources.versions`) of members and their keys. A run brings its members;
those without a key get the numbers after the last one given, in key order, by range partitions
(:func:`.keys.dense_key`: no single task sees all of them). Known members are only joined, never renumbered,
so facts written earlier keep their meaning. The new rows and the next free number are published together: a run that
dies before leaves the registry as it was, and the next run gives the same numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import versions as V
from .keys import dense_key

#: Folders of rows that a registry gathers before they are written as one.
FOLDERS = 32


def read(spark: SparkSession, root: str) -> DataFrame | None:
    """The published members and keys, None where nothing was registered."""
    manifest = V.read_manifest(spark, root)
    return _rows(spark, manifest) if manifest else None


def _rows(spark: SparkSession, manifest: V.Manifest) -> DataFrame:
    return spark.read.schema(T.StructType.fromJson(manifest.content["schema"])).parquet(*manifest.content["folders"])


def extend(members: DataFrame, root: str, keys: Sequence[str], name: str) -> DataFrame:
    """Registers the key tuples of ``members`` (null is a value like others) and returns the registry:
    ``keys`` and ``name``, a number from 1 on."""
    spark = members.sparkSession
    base = V.read_manifest(spark, root)
    fresh = members.select(*keys).distinct()
    if base is not None:
        known = _rows(spark, base).select(*[F.col(k).alias(f"_{k}") for k in keys])
        fresh = fresh.join(known, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left_anti")
    first = base.content["next"] if base else 1
    numbered = dense_key(fresh, keys, name, distinct=False).select(*keys, (F.col(name) + (first - 1)).alias(name))
    folder = V.stage_folder(root, base)
    numbered.write.parquet(folder)
    added = spark.read.schema(numbered.schema).parquet(folder).count()
    if base is not None and not added:
        return _rows(spark, base)
    content = {"schema": numbered.schema.jsonValue(), "folders": [*(base.content["folders"] if base else []), folder], "next": first + added}
    if len(content["folders"]) >= FOLDERS:
        one = V.stage_folder(root, base)
        _rows(spark, V.Manifest(0, content)).write.parquet(one)
        content["folders"] = [one]
    return _rows(spark, V.publish(spark, root, base, content))
