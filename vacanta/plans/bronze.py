"""Bronze batches landed from the postings view, in the source record shapes.

Capture-time work happens here, as at ingestion: keyword tagging over
``title + description`` and the per-source ``analytics_metadata``. API-shaped
records and page-shaped records are written as two envelope batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import tagging as T
from ..functions import vocab as V
from ..sources.batches import write_envelopes
from . import postings as P

API_SOURCE = V.SOURCES[0]


def tagged_raw_postings(documents: DataFrame) -> DataFrame:
    return tag_postings(P.raw_postings(documents))


def tag_postings(raw: DataFrame) -> DataFrame:
    """Capture-time work on raw postings: keyword tags and the per-source attributes."""
    # one pass of the capture text finds the taxonomy keywords and the rule words
    vocab = R.RULE_VOCABULARY + T.keywords_in_order(V.TAXONOMY)
    indexed, w = R.with_words(raw, T.capture_text(["raw_title", "raw_description"]), vocabulary=vocab)
    tagged = T.tag_keywords(indexed, ["raw_title", "raw_description"], words=w)
    return (tagged.withColumn("analytics_metadata",
                              R.ingest_attributes_by_source(w, F.col("source"), F.col("raw_contract")))
                  .drop("_low", "_low_found"))


#: Columns of tagged postings that the API record holds under its own field names.
_READ = {"source", "source_job_id", "raw_title", "raw_description", "raw_contract", "company", "location_country", "city", "created",
         "matched_domains", "matched_roles", "analytics_metadata"}


def api_records(tagged: DataFrame) -> DataFrame:
    """API postings as records. Further columns of the candidates are passed through as fields of
    their own: the landed record keeps what the source sent, also where silver doesn't read it."""
    rows = tagged.filter(F.col("source") == API_SOURCE)
    fields = [
        F.col("source_job_id").alias("id"),
        F.col("raw_title").alias("title"),
        F.col("raw_description").alias("description"),
        F.col("created").alias("created"),
        F.col("raw_contract").alias("contract_type"),
        F.struct(F.col("company").alias("display_name")).alias("company"),
        F.struct(F.array("location_country").alias("area"), F.col("city").alias("display_name")).alias("location"),
        "matched_domains", "matched_roles", "analytics_metadata",
    ]
    own = {"id", "title", "description", "contract_type", "location"}
    passed = [F.col(f"`{c}`") for c in tagged.columns if c not in _READ and c not in own]
    return rows.select("source", F.struct(*fields, *passed).alias("record"),
                       F.col("analytics_metadata.is_internship").alias("is_internship"))


def page_records(tagged: DataFrame) -> DataFrame:
    rows = tagged.filter(F.col("source") != API_SOURCE)
    return rows.select(
        "source",
        F.struct(
            F.col("source").alias("source"),
            F.col("source_job_id").alias("job_url"),
            F.col("raw_title").alias("title"),
            F.col("company").alias("company"),
            F.col("raw_description").alias("summary"),
            F.col("raw_contract").alias("raw_metadata"),
            F.col("city").alias("location_city"),
            F.lit(V.MOROCCO).alias("country"),
            F.col("created").alias("scraped_at"),
            "matched_domains", "matched_roles", "analytics_metadata",
        ).alias("record"),
        F.col("analytics_metadata.is_internship").alias("is_internship"))


def land_bronze(documents: DataFrame, root: str, run_ts: Column, chunk_rows: int = 1000) -> None:
    land_tagged(tagged_raw_postings(documents), root, run_ts, chunk_rows)


def land_tagged(tagged: DataFrame, root: str, run_ts: Column, chunk_rows: int = 1000) -> None:
    """Both record shapes as envelopes. Rows without a source belong to no folder and aren't
    landed (see ``capture.null_key_rejects``)."""
    write_envelopes(api_records(tagged), root, run_ts, chunk_rows, country=F.lit("fr"))
    write_envelopes(page_records(tagged), root, run_ts, chunk_rows)
