"""Helpers shared by the operators: columns, written intermediates, Arrow batches."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, ship_code

#: Bytes of text that one task works on at a time.
CHUNK_BYTES = 4 << 20
#: Bits of a bitmap of keys, as a power of two.
BITMAP = 27


def whole_row() -> Column:
    """All columns of the input as one struct, ``row``: they pass through an operator
    untouched and cannot clash with its own."""
    return F.struct("*").alias("row")


def text_bytes(docs: DataFrame, *keep: str | Column) -> DataFrame:
    """``keep`` columns and the whole text as UTF-8 bytes (null: empty)."""
    ship_code(docs.sparkSession)
    return docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def crc_residue(col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: the empty text, residue 0)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read again.

    Cuts the lineage: a lost executor re-reads files instead of repeating the work."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch holding about ``limit`` bytes in ``column`` (one row at least)."""
    col = batch.column(column)
    if batch.num_rows <= 1 or col.nbytes <= limit:
        if batch.num_rows:
            yield batch
        return
    start = size = 0
    lengths = pc.binary_length(col).to_pylist()
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    yield batch.slice(start)


def release() -> None:
    """Hands free memory back when a task is done: the worker lives on within its executor, and what Arrow
    and the C library keep for later adds up over the workers of a stage."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def map_chunks(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], dict], carry: str | None = "doc_id", limit: int = CHUNK_BYTES,
               sized: str = "text", after: Callable[[], None] | None = None) -> DataFrame:
    """``mapInArrow`` over slices of bounded bytes in the column ``sized``. The column ``carry`` is passed on; ``fn``
    gives the columns of ``schema`` as lists or arrays, a row for each row of the slice. ``after`` runs in the task
    when its rows are done, before free memory is handed back: what a worker keeps for later tasks counts against
    the executor meanwhile."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    made = StructType.fromDDL(schema)
    arrow = to_arrow_schema(made)
    kept = [df.schema[carry]] if carry else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part in chunks(batch, sized, limit):
                    new = fn(part)
                    cols = [new[f.name] if isinstance(new[f.name], pa.Array) else pa.array(new[f.name], f.type) for f in arrow]
                    yield pa.RecordBatch.from_arrays([part.column(f.name) for f in kept] + cols, names=[f.name for f in kept] + arrow.names)
        finally:
            if after:
                after()
            release()

    return df.mapInArrow(run, StructType(kept + made.fields))


def broadcast_value(df: DataFrame, value):
    """A Spark broadcast variable for data whose size the caller has bounded."""
    return df.sparkSession.sparkContext.broadcast(value)


def bitmap(keys: DataFrame) -> np.ndarray:
    """A bit for the leading bits of each key of the column ``key``."""
    rows = keys.groupBy(F.shiftrightunsigned("key", 64 - BITMAP + 6).alias("at")).agg(F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(key, {64 - BITMAP}) & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(1 << (BITMAP - 6), np.int64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint64)


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (unsigned) may be among the bitmap's, whose size is a power of two."""
    slot = keys >> np.uint64(64 - (len(bits) << 6).bit_length() + 1)
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
