"""Training-data pipeline over ``documents``: quality rules, near-duplicate removal,
benchmark decontamination, secret redaction, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all
but the last return the columns of ``documents``. ``run`` writes each stage's rows into
the shared checkpoint folder and reads them again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vacanta.llm import stages
from vacanta.llm.common import stored
from vacanta.sources.tables import table

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("near_dedup", stages.near_dedup),
    ("decontaminate", stages.decontaminate),
    ("redact_secrets", stages.redact_secrets),
    ("byte_bpe", stages.byte_bpe),
]

#: The stages hold trained and hashed steps that SQL cannot express. tests/llm plants copies, near copies,
#: leaks, short and repeating texts and secrets and holds the rows left against those planted cases, and each
#: operator against a brute-force version of its own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
