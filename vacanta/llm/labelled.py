"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_residue, stored

#: Rows whose crc32(id) leaves this remainder by 5 are held out.
FOLDS, HELD_OUT = 5, 0


def held_out(col: str = "doc_id"):
    return crc_residue(col, FOLDS) == HELD_OUT


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, max_bytes: int) -> list[tuple[int, str, int]]:
    """About ``rows`` (doc_id, text, label) of the training fold, ``max_bytes`` of text in all, of any length each.

    The share that is taken follows from the number of labels and a hash of the id, so the
    sample doesn't depend on partitions. Of several labels of a document the greatest holds, and of several texts
    under one id one (of the least hash) stands for it, so a repeated id brings no more than another. Texts are taken in
    the order of the ids' hashes; one that doesn't fit into the bytes left is passed over. Null labels and ids and
    null texts are left out of the fit (never of the scoring)."""
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    total = known.count()
    if not total:
        return []
    share = min(1.0, rows / total)
    order = F.xxhash64("doc_id", F.lit(17))
    picked = F.broadcast(known.filter(F.pmod(order, F.lit(1_000_000)) < F.lit(int(share * 1_000_000))))  # about ``rows`` narrow rows
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    found = stored(texts.join(picked, "doc_id").groupBy("doc_id", "label").agg(one).select("doc_id", "label", "one.text"), f"{label}-sample")
    taken, left = [], max_bytes
    for r in sorted(found.select("doc_id", order.alias("at"), F.octet_length("text").alias("n")).collect(), key=lambda r: (r["at"], r["doc_id"])):
        if r["n"] <= left:
            taken.append((r["doc_id"],))
            left -= r["n"]
    chosen = F.broadcast(docs.sparkSession.createDataFrame(taken, T.StructType([found.schema["doc_id"]])))  # at most as many as picked
    return sorted((r["doc_id"], r["text"], r["label"]) for r in found.join(chosen, "doc_id").collect())
