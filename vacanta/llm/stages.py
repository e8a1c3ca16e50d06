"""Stages of the corpus pipeline: each applies one operator's decisions to its documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import dense_key
from ..sources.tables import table
from .common import stored, whole_row


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the divergence rule rejects go."""
    from .divergence import judge, references

    return judge(docs, references(docs), carry=whole_row()).filter("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicates by shingles of five words (``op6_superminhash`` has four by its contract). One
    document of each group stays, the one of the smallest id; of rows equal in id and text one stays.

    Rows whose id doesn't name their text (no id, or an id that other texts have, too) are told apart by id and
    text and numbered after all other ids, so they take part in the groups like any other row."""
    from .superminhash import NearRules, near_groups

    texts = docs.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b"))
    shared = stored(texts.filter("doc_id is not null and a <> b").select("doc_id"), "shared-ids")
    plain = docs.filter("doc_id is not null").join(shared, "doc_id", "left_anti").select(docs.columns)
    odd = docs.filter("doc_id is null").unionByName(docs.join(shared, "doc_id", "left_semi").select(docs.columns))
    odd = odd.select(whole_row(), F.col("doc_id").alias("of"), F.sha2(F.concat(F.when(F.col("text").isNull(), "0").otherwise("1"), F.coalesce("text", F.lit(""))), 256).alias("digest"))
    last = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0)).alias("last")).first()["last"]
    named = dense_key(odd.select("of", "digest"), ["of", "digest"], "number").withColumnRenamed("of", "its")
    odd = odd.join(named, odd.of.eqNullSafe(F.col("its")) & (odd.digest == named.digest)).select("row", (F.col("number") + last).alias("node"))
    odd = stored(odd.dropDuplicates(["node"]), "odd-rows")
    groups = near_groups(plain.select("doc_id", "text").unionByName(odd.select(F.col("node").alias("doc_id"), "row.text")), NearRules(words=5))
    kept = stored(groups.filter("kept").select("doc_id").distinct(), "near-kept")
    out = plain.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns)
    return out.unionByName(odd.join(kept, odd.node == kept.doc_id, "left_semi").select("row.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item is found go."""
    from .seed_align import without_matches

    return without_matches(docs, table(spark, sf_dir, "benchmark"))


REDACTED = "[secret]"


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span found is replaced in the text (n_chars follows); documents without any stay as they are."""
    from .secrets_crf import CrfRules, fit, scan, training_sequences

    rules = CrfRules()
    made = scan(docs, fit(training_sequences(docs, rules), rules), rules, carry=whole_row(), redact=REDACTED)
    changed = {"text": F.coalesce("redacted", "row.text"), "n_chars": F.coalesce(F.length("redacted"), "row.n_chars").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return made.select(*[changed[c].alias(c) if changed.get(c) is not None else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and digests of every document left; the decoded bytes equal its text."""
    import public_tokenizers

    from .byte_bpe import encode_decode

    return encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
