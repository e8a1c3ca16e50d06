"""Readers of the supplied parquet tables and of layer folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str, tasks: int | None = None) -> DataFrame:
    """A text-bearing table (documents, pages, conversations).

    Its splits follow the files' row groups. ``tasks`` (or the session setting
    ``vacanta.scan.tasks``) asks for a round-robin redistribution over so many tasks, for
    inputs known to come as one row group; it is never decided from the data's size."""
    df = table(spark, sf_dir, name)
    tasks = tasks or int(spark.conf.get("vacanta.scan.tasks", "0"))
    return df.repartition(tasks) if tasks else df
