"""Bucketed Parquet folders without a catalog's memory.

Spark plans a scan of bucketed files without an exchange below a join or an aggregate on the bucket
columns, but knows buckets only from catalog tables. A folder is therefore written, and later read,
through a catalog entry that lives as long as the call; the data frame keeps the plan."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """``df`` as ``buckets`` sorted files by the hash of ``keys``."""
    spark, name = df.sparkSession, f"vacanta_{uuid.uuid4().hex}"
    try:
        (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
           .option("path", path).saveAsTable(name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay: the table has its own path


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    name = f"vacanta_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    listed = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({listed}) SORTED BY ({listed}) INTO {buckets} BUCKETS LOCATION '{path}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
