"""Bronze (canonical rows) -> silver: derive attributes, de-duplicate, add partition columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import rules as R
from ..functions import tagging as T
from ..functions import vocab as V
from ..operators.dedup import dedupe_postings

SILVER_COLUMNS = [
    "job_fingerprint", "source", "source_job_id", "job_title_clean", "company_name",
    "location_country", "location_city", "publication_date", "contract_type", "is_internship",
    "internship_category", "duration_months", "duration_bracket", "is_remunerated", "work_mode",
    "primary_domain", "matched_domains", "matched_roles", "ingested_at", "year", "month",
]


def derive_attributes(unified: DataFrame, run_ts=None, rules: R.SilverRules = R.DEFAULT_RULES) -> DataFrame:
    """Text-derived attributes of canonical rows.

    The text the rules read is ``title + description + contract``; every rule is a
    native expression, so the whole derivation is one codegen'd projection. The
    word lists come from ``rules`` (data, replaceable)."""
    low = F.lower(R.corpus(F.col("raw_title"), F.col("raw_description"), F.col("raw_contract")))
    vocab = rules.vocabulary()
    df = unified.withColumn("_low", low)
    # one regex pass collects every rule word of the text; rules test that array
    df = df.withColumn("_found", R.word_index(F.col("_low"), vocab))
    w = R.Words(F.col("_low"), F.col("_found"), vocab)
    intern = R.is_internship(w, F.lower(F.col("raw_contract")), rules)
    df = (df.withColumn("is_internship", intern)
            .withColumn("duration_months", R.duration_months(F.col("_low"))))
    return (df.select(
                "*",
                R.contract_type(w, F.col("is_internship"), rules).alias("contract_type"),
                R.duration_bracket(F.col("duration_months")).alias("duration_bracket"),
                R.internship_category(F.col("is_internship"), F.col("duration_months"), w, rules)
                .alias("internship_category"),
                R.remuneration(w, rules.paid, rules.unpaid, rules).alias("is_remunerated"),
                R.work_mode(w, rules.hybrid, rules.full_remote, rules.remote, rules).alias("work_mode"),
                F.lower(F.col("raw_title")).alias("job_title_clean"),
                C.fingerprint(F.col("raw_title"), F.col("company_name"), F.col("location_city"))
                .alias("job_fingerprint"),
                T.primary_domain(F.col("matched_domains")).alias("primary_domain"),
                C.run_timestamp(run_ts).alias("ingested_at"))
            .drop("_low", "_found"))


def build_silver(unified: DataFrame, run_ts=None, default_year: int = V.DEFAULT_YEAR,
                 default_month: int = V.DEFAULT_MONTH, rules: R.SilverRules = R.DEFAULT_RULES) -> DataFrame:
    """The silver table: one row per fingerprint, 21 columns."""
    enriched = derive_attributes(unified, run_ts, rules)
    survivors = dedupe_postings(enriched)
    year, month = C.partition_parts(F.col("publication_date"), default_year, default_month)
    return survivors.select(*[c for c in SILVER_COLUMNS if c not in ("year", "month")], year, month)
