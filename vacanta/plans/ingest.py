"""Incremental capture of all sources, end to end: candidates -> bronze envelopes -> seen keys.

Per run and source: keys captured before are dropped, API postings must be recent, the
capture text is tagged, API postings need a domain and page postings a domain or an
internship, the first arrival of a key is kept, the kept records are landed as
envelopes, and only their keys enter the state. A run is replayed under its own id with
the same result: its envelope folders and its part of the state are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import vocab as V
from ..operators import capture
from ..session import scratch_table
from . import bronze as B

KEYS = ["source", "source_job_id"]


def relevant(source: Column, domains: Column, internship: Column) -> Column:
    """API postings need a domain; page postings a domain or an internship."""
    page = F.coalesce(source != F.lit(B.API_SOURCE), F.lit(False))
    return C.relevant(domains, page & F.coalesce(internship, F.lit(False)))


def capture_run(spark: SparkSession, candidates: DataFrame, bronze_root: str, state_root: str, run_id: str,
                run_ts: Column, as_of, position: list[Column], chunk_rows: int = 1000,
                state_path: str | None = None) -> DataFrame:
    """Captures raw postings of any sources; returns the captured rows (tagged).

    Cheap conditions come first: seen keys and age are decided before any text is tagged,
    and tagged rows are written once before relevance and first arrival read them."""
    seen = capture.seen_keys(spark, state_root, KEYS, exclude_batch=run_id, state_path=state_path)
    fresh = candidates.filter(F.col("source").isNotNull() & F.col("source_job_id").isNotNull())
    fresh = fresh.filter((F.col("source") != F.lit(B.API_SOURCE)) | C.recent(C.parse_wall_clock(F.col("created")), as_of))
    fresh = capture.without_seen(fresh, seen, KEYS)
    tagged = scratch_table(B.tag_postings(fresh), "tagged")
    keep = relevant(F.col("source"), F.col("matched_domains"), F.col("analytics_metadata.is_internship"))
    kept = scratch_table(capture.capture_new(tagged, None, KEYS, position, keep), "captured")
    B.land_tagged(kept, bronze_root, run_ts, chunk_rows)
    capture.land_batch(kept.select(*KEYS), state_root, run_id)
    return kept


def capture_day(spark: SparkSession, candidates: DataFrame, bronze_root: str, state_root: str, run_id: str, run_ts) -> DataFrame:
    """One scheduled capture: against the compact state, which then takes this run in. Of equal keys the
    posting that is first by its own columns is kept, whatever the order of the files."""
    compact = f"{state_root.rstrip('/')}/compact"
    landed = f"{state_root.rstrip('/')}/landed"
    order = [F.col(c).asc_nulls_last() for c in ("created", "raw_title", "raw_description", "company")]
    kept = capture_run(spark, candidates, bronze_root, landed, run_id, C.as_timestamp(run_ts), run_ts, order, state_path=compact)
    capture.compact_state(spark, landed, KEYS, compact, C.as_timestamp(run_ts))
    return kept


def rejected(candidates: DataFrame) -> DataFrame:
    """Candidates without a source or an id: they can't be recognised again and aren't captured."""
    return capture.null_key_rejects(candidates, KEYS)


assert V.SOURCES[0] == B.API_SOURCE
