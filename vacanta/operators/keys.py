"""Deterministic dense surrogate keys.

``dense_key`` numbers the distinct key tuples 1..n in key order — the same numbers as
``row_number() over (order by keys)`` — without bringing them into one task: the tuples
are range-partitioned and sorted inside partitions, each row gets its partition and
its position there, the result is checkpointed (range bounds come from sampling;
both later passes must see the same partitions, also after an executor loss), rows are
counted per partition, and a running sum over one row per partition gives each
partition's offset. That table is bounded by the partition count, so it is broadcast.

The key of a tuple does not depend on how the input was partitioned, nor the method on
the number of tuples.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id keeps the row position in the lower 33 bits


def dense_key(df: DataFrame, keys: Sequence[str], name: str, num_partitions: int | None = None,
              distinct: bool = True) -> DataFrame:
    """``df`` with ``name``. With ``distinct=True`` the key tuples of ``df`` are made
    distinct first; otherwise they must already be unique in ``df`` (other columns are kept)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    order = [F.col(k).asc_nulls_first() for k in keys]
    rows = df.select(*keys).distinct() if distinct else df
    ranged = rows.repartitionByRange(num_partitions, *order) if num_partitions else rows.repartitionByRange(*order)
    ranked = (ranged.sortWithinPartitions(*order)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id())
                    .checkpoint(eager=True))
    per_part = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_part.select("_pid", F.coalesce(before, F.lit(0)).alias("_offset"))
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _POS_BITS)
    return (ranked.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, F.col("_offset") + pos + F.lit(1))
                  .drop("_pid", "_mid", "_offset"))
