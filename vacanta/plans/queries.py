"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the
whole supplied tables. Column names match the DuckDB oracle (:mod:`.oracle_queries`)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import rules as R
from ..functions import tagging as T
from ..functions import vocab as V
from ..operators import capture, cards, keyword_join, mapping, quality, star
from ..operators.dedup import first_arrival
from ..session import checkpoint_dir, scratch_path, scratch_table
from ..sources.batches import read_batches
from ..sources.tables import table, text_table
from . import bronze as B
from . import daily, ingest
from . import postings as P
from . import silver as S
from .oracle import AS_OF, CAPTURE_AS_OF, EVENTS_AS_OF, EVENTS_CUTOFF, EVENTS_CUTS, EVENTS_FUTURE_AS_OF, ORDERS_AS_OF, RUN_TS


def _postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.postings(text_table(spark, sf_dir, "documents"))


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.derive_attributes(_postings(spark, sf_dir), RUN_TS)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.build_silver(_postings(spark, sf_dir), RUN_TS)


def _joined(c):
    return F.array_join(F.col(c), "|")


# --- C1, C14, P6 -------------------------------------------------------------

def tag_keywords(spark, sf_dir):
    p = _postings(spark, sf_dir)
    return p.select("doc_id",
                    _joined("matched_domains").alias("domains"),
                    _joined("matched_roles").alias("roles"),
                    F.size("matched_roles").alias("n_roles"),
                    T.primary_domain(F.col("matched_domains")).alias("primary_domain"))


def tag_by_table(spark, sf_dir):
    """The same tags through the taxonomy as a table, joined with the texts' token n-grams."""
    raw = P.raw_postings(text_table(spark, sf_dir, "documents"))
    tags = keyword_join.tag_by_table(raw, T.taxonomy_table(spark), "doc_id", T.capture_text(["raw_title", "raw_description"]))
    return tags.select("doc_id", _joined("matched_domains").alias("domains"), _joined("matched_roles").alias("roles"),
                       F.size("matched_roles").alias("n_roles"), T.primary_domain(F.col("matched_domains")).alias("primary_domain"))


LARGE_TAXONOMY = 100_000


def tag_large_taxonomy(spark, sf_dir):
    """Tags by a taxonomy of up to 100,000 keywords: words and word pairs of the documents, the first by their
    digest, whose first character is the domain. Per document the number of keywords, their digest and the domains."""
    docs = text_table(spark, sf_dir, "documents")
    low = docs.select(F.lower("text").alias("low"))
    words = low.select(F.explode(F.regexp_extract_all("low", F.lit(r"(?U)\w+"), F.lit(0))).alias("keyword"))
    pairs = low.select(F.explode(F.regexp_extract_all("low", F.lit(r"(?U)(?=\b(\w+ \w+)\b)"), F.lit(1))).alias("keyword"))
    listed = words.unionByName(pairs).distinct().withColumn("digest", F.md5(F.col("keyword").cast("binary"))).orderBy("digest").limit(LARGE_TAXONOMY)
    taxonomy = scratch_table(listed.select(F.conv(F.substring("digest", 1, 1), 16, 10).cast("int").alias("domain_rank"), F.substring("digest", 1, 1).alias("domain"), F.col("digest").alias("keyword_rank"), "keyword"), "taxonomy")
    tags = keyword_join.tag_by_table(docs, taxonomy, "doc_id", F.col("text"))
    return tags.select("doc_id", F.size("matched_roles").alias("n_roles"), F.sha2(F.array_join("matched_roles", "|"), 256).alias("roles_sha256"), _joined("matched_domains").alias("domains"))


# --- P8-P10 ------------------------------------------------------------------

def fingerprint(spark, sf_dir):
    e = _enriched(spark, sf_dir)
    return e.select("doc_id", "job_fingerprint", "job_title_clean")


# --- C2, C3, C7, C8 ----------------------------------------------------------

def internship_flag(spark, sf_dir):
    return _enriched(spark, sf_dir).select("doc_id", "is_internship")


def contract_type(spark, sf_dir):
    return _enriched(spark, sf_dir).select("doc_id", "contract_type")


def remuneration(spark, sf_dir):
    return _enriched(spark, sf_dir).select("doc_id", "is_remunerated")


def work_mode(spark, sf_dir):
    return _enriched(spark, sf_dir).select("doc_id", "work_mode")


# --- C4-C6 -------------------------------------------------------------------

def duration_months(spark, sf_dir):
    return _enriched(spark, sf_dir).select("doc_id", "duration_months")


def duration_bracket(spark, sf_dir):
    return _enriched(spark, sf_dir).select("doc_id", "duration_bracket")


def internship_category(spark, sf_dir):
    return _enriched(spark, sf_dir).select("doc_id", "internship_category")


# --- D-1 and the silver table ------------------------------------------------

def dedup_postings(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return s.select("job_fingerprint", "source", "source_job_id", "publication_date")


def silver_table(spark, sf_dir):
    s = _silver(spark, sf_dir)
    cols = [c for c in S.SILVER_COLUMNS if c not in ("matched_domains", "matched_roles")]
    return s.select(*cols, _joined("matched_domains").alias("matched_domains"),
                    _joined("matched_roles").alias("matched_roles"))


# --- G1-G5 -------------------------------------------------------------------

def dim_company(spark, sf_dir):
    return star.dim_company(_silver(spark, sf_dir))


def dim_location(spark, sf_dir):
    return star.dim_location(_silver(spark, sf_dir))


def dim_taxonomy(spark, sf_dir):
    return star.dim_taxonomy(_silver(spark, sf_dir))


def _silver_table(spark, sf_dir):
    """Silver as a materialised table (as the gold job reads it): one evaluation of
    the text rules, lineage cut in the shared checkpoint folder."""
    checkpoint_dir(spark)
    return _silver(spark, sf_dir).checkpoint(eager=True)


def _gold(spark, sf_dir, *names):
    return star.build_gold(_silver_table(spark, sf_dir), names)


def fact_postings(spark, sf_dir):
    return _gold(spark, sf_dir, "fact_job_postings")["fact_job_postings"]


def fact_internships(spark, sf_dir):
    return _gold(spark, sf_dir, "fact_internships_pfe")["fact_internships_pfe"]


def layer_summary(spark, sf_dir):
    g = _gold(spark, sf_dir, "dim_company", "dim_location", "fact_job_postings", "fact_internships_pfe")
    return star.layer_summary({k: g[k] for k in ("dim_company", "dim_location", "fact_job_postings",
                                                 "fact_internships_pfe")})


# --- Q1-Q6, U2 -----------------------------------------------------------------

def quality_report(spark, sf_dir):
    """The gate reads the materialised silver table (as in the daily run), so the
    aggregate pass and the domain check share one evaluation of the text rules."""
    return quality.run_checks(_silver_table(spark, sf_dir), AS_OF)


def duplicate_keys(spark, sf_dir):
    """Offending keys of the enriched rows before de-duplication."""
    return quality.duplicate_keys(_enriched(spark, sf_dir))


def invalid_domains(spark, sf_dir):
    """Primary domains of the silver table outside the allow-list (null-safe)."""
    return quality.invalid_domains(_silver_table(spark, sf_dir), quality.allowed_domains(spark))


# --- C9-C12 ------------------------------------------------------------------

def _ingest(spark, sf_dir):
    raw = P.raw_postings(text_table(spark, sf_dir, "documents"))
    raw, w = R.with_words(raw, _capture_text())
    return raw.select("doc_id", "source", "raw_title", "raw_description",
                      R.ingest_attributes_by_source(w, F.col("source"), F.col("raw_contract")).alias("m"))


def _capture_text():
    return F.lower(F.concat_ws(" ", F.coalesce("raw_title", F.lit("")), F.coalesce("raw_description", F.lit(""))))


def ingest_attributes(spark, sf_dir):
    return _ingest(spark, sf_dir).select(
        "doc_id", "source", "m.is_internship", "m.internship_type", "m.is_remunerated", "m.work_mode")


def duration_text(spark, sf_dir):
    return _ingest(spark, sf_dir).select("doc_id", F.col("m.internship_duration").alias("internship_duration"))


# --- C13 -----------------------------------------------------------------------

def _card_text(spark, sf_dir):
    raw = P.raw_postings(text_table(spark, sf_dir, "documents"))
    return raw.select("doc_id", F.concat_ws(" ", "raw_title", "raw_description").alias("t"))


def city_from_text(spark, sf_dir):
    return _card_text(spark, sf_dir).select("doc_id", R.first_listed(F.col("t")).alias("location_city"))


def company_from_text(spark, sf_dir):
    return _card_text(spark, sf_dir).select("doc_id", R.company_from_text(F.col("t")).alias("company"))


# --- F1, F6, P11-P13 -------------------------------------------------------------

def _order_dates(spark, sf_dir):
    """Order dates as capture-time text in several ISO shapes, some malformed."""
    o = table(spark, sf_dir, "orders")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    r = F.col("o_orderkey") % 11
    text = (F.when(r == 0, F.lit(None).cast("string"))
             .when(r == 1, F.lit("n/a"))
             .when(r == 2, F.concat(stamp, F.lit("Z")))
             .when(r == 3, F.concat(stamp, F.lit(".250+02:00")))
             .when(r == 4, F.concat(stamp, F.lit("-05:00")))
             .otherwise(stamp))
    return o.select("o_orderkey", text.alias("created"))


def recency_filter(spark, sf_dir):
    d = _order_dates(spark, sf_dir)
    ts = C.parse_wall_clock(F.col("created"))
    return d.filter(C.recent(ts, ORDERS_AS_OF)).select("o_orderkey", "created")


def partition_counts(spark, sf_dir):
    d = _order_dates(spark, sf_dir)
    year, month = C.partition_parts(C.parse_timestamp(F.col("created")))
    return d.select(year, month).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows"))


def future_dates(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(
        F.count_if(C.in_future(F.col("ts"), EVENTS_FUTURE_AS_OF)).alias("n_future"),
        F.count(F.lit(1)).alias("n_rows"))


# --- F2, F3 --------------------------------------------------------------------

def relevance_filter(spark, sf_dir):
    p, w = R.with_words(_postings(spark, sf_dir), _capture_text())
    intern = R.ingest_internship_by_source(w, F.col("source"), F.col("raw_contract"))
    # any matched keyword implies a domain; testing the roles array keeps the pushed-down
    # filter from inlining the per-domain expressions
    return p.filter(ingest.relevant(F.col("source"), F.col("matched_roles"), intern)).select(
        "doc_id", "source")


# --- D-3, J3, S8, U3 -------------------------------------------------------------

def _event_keys(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.withColumn("capture_key", _event_key_col())


def _event_key_col():
    bucket = (F.get_json_object("props", "$.k").try_cast("int") % 7).cast("string")
    return F.concat_ws(":", F.col("event_type"), F.col("user_id").cast("string"), bucket)


def _event_keep():
    return C.recent(F.col("ts"), EVENTS_AS_OF) & (F.col("event_type") != F.lit("error"))


def incremental_capture(spark, sf_dir):
    """Today's candidates (events from the cut-off on) against the keys seen before."""
    e = _event_keys(spark, sf_dir)
    seen = e.filter((F.col("ts") < F.lit(EVENTS_CUTOFF).cast("timestamp")) & _event_keep()).select("capture_key")  # kept keys only
    cand = e.filter(F.col("ts") >= F.lit(EVENTS_CUTOFF).cast("timestamp"))
    new = capture.capture_new(cand, seen, ["capture_key"], [F.col("ts"), F.col("event_id")], keep=_event_keep())
    return new.select("capture_key", "event_id", "user_id", "event_type", "ts")


def capture_history(spark, sf_dir):
    """Daily runs replayed at once: rows captured per day."""
    e = _event_keys(spark, sf_dir).withColumn("run_date", F.to_date("ts"))
    first = capture.first_capture_history(e, ["capture_key"], "run_date", [F.col("ts"), F.col("event_id")],
                                          keep=_event_keep())
    return first.groupBy("run_date").agg(F.count(F.lit(1)).alias("new_records_count"))


def batch_summary(spark, sf_dir):
    """One capture run over the postings view (empty state), summarised per source."""
    p, w = R.with_words(_postings(spark, sf_dir), _capture_text())
    p = p.withColumn("m", R.ingest_attributes_by_source(w, F.col("source"), F.col("raw_contract")))
    p = scratch_table(p.select("doc_id", "source", "source_job_id", "matched_domains", "m"), "batch")
    keep = ingest.relevant(F.col("source"), F.col("matched_domains"), F.col("m.is_internship"))
    new = capture.capture_new(p, None, ["source", "source_job_id"], [F.col("doc_id")], keep=keep)
    s = capture.batch_summary(new, C.as_timestamp(RUN_TS), internship=F.col("m.is_internship"),
                              domains=list(V.TAXONOMY),
                              country=F.when(F.col("source") == F.lit(V.SOURCES[0]), F.lit("fr"))
                              .otherwise(F.lit(V.MOROCCO)))
    return s.select("source", "country", "pipeline_stage", "run_date", "run_time", "new_records_count",
                    "internships_count", F.size("domains_covered").alias("n_domains_covered"))


# --- P1-P5, S2, U1: canonical mapping of two differently shaped tables -----------

def canonical_union(spark, sf_dir):
    docs = text_table(spark, sf_dir, "documents")
    convs = text_table(spark, sf_dir, "conversations")
    api = docs.select(F.struct(
        F.col("doc_id").alias("id"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("text").alias("description"),
        P.publication_text(F.col("doc_id")).alias("created"),
        F.when(F.col("doc_id") % 5 == 0, F.lit(None)).otherwise(F.col("source")).alias("contract_type"),
        F.struct(F.when(F.col("n_chars") % 20 == 0, F.lit(None)).otherwise(F.col("lang")).alias("display_name"))
        .alias("company"),
        F.struct(F.when(F.col("doc_id") % 9 == 0, F.array().cast("array<string>"))
                  .otherwise(F.array(F.upper("lang"))).alias("area"),
                 F.when(F.col("doc_id") % 6 == 0, F.lit(None)).otherwise(F.col("source")).alias("display_name"))
        .alias("location"),
        F.array().cast("array<string>").alias("matched_domains"),
        F.array().cast("array<string>").alias("matched_roles")).alias("r"))
    page = convs.select(F.struct(
        F.concat_ws("/", F.lit("conv"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("job_url"),
        F.col("role").alias("title"),
        F.when(F.col("turn") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("C"), F.col("conv_id").cast("string")))
        .alias("company"),
        F.col("text").alias("summary"),
        F.when(F.col("turn") % 4 == 0, F.lit(None)).otherwise(F.col("role")).alias("raw_metadata"),
        F.when(F.col("conv_id") % 2 == 0, F.lit(None)).otherwise(F.lit("Rabat")).alias("location_city"),
        F.lit(None).cast("string").alias("scraped_at"),
        F.array().cast("array<string>").alias("matched_domains"),
        F.array().cast("array<string>").alias("matched_roles")).alias("r"))
    mapped = mapping.union_sources([
        mapping.map_to_canonical(api, mapping.api_spec("documents_api")),
        mapping.map_to_canonical(page, mapping.page_spec("conversations_page", city_field=True)),
        mapping.map_to_canonical(page, mapping.page_spec("conversations_flat", city_field=False)),
    ])
    return mapped.drop("matched_domains", "matched_roles")


# --- S1-S9, X4: landed bronze batches read back into silver ------------------------

def bronze_silver(spark, sf_dir):
    root = scratch_path(spark, "bronze")
    B.land_bronze(text_table(spark, sf_dir, "documents"), root, C.as_timestamp(RUN_TS), chunk_rows=100)
    unified, _rejects, _skipped = read_batches(spark, root)
    s = S.build_silver(unified, RUN_TS)
    cols = [c for c in S.SILVER_COLUMNS if c not in ("matched_domains", "matched_roles")]
    return s.select(*cols, _joined("matched_domains").alias("matched_domains"),
                    _joined("matched_roles").alias("matched_roles"))


def bronze_envelopes(spark, sf_dir):
    """Envelope metadata of the landed batches, summed per source."""
    root = scratch_path(spark, "bronze")
    B.land_bronze(text_table(spark, sf_dir, "documents"), root, C.as_timestamp(RUN_TS), chunk_rows=100)
    from ..sources.batches import RECORD_SCHEMAS, read_envelopes, source_path
    parts = [read_envelopes(spark, source_path(root, name), schema).select("metadata")
             for name, schema in RECORD_SCHEMAS.items()]
    env = mapping.union_sources(parts)
    return env.groupBy(F.col("metadata.source").alias("source")).agg(
        F.sum("metadata.new_records_count").alias("new_records_count"),
        F.sum("metadata.internships_count").alias("internships_count"))


# --- G1, G2, G4 on the order tables: the same dimension builders over other postings --

def _order_postings(spark, sf_dir):
    """Orders as postings: the customer is the company, nation/region the location."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = (c.join(n, c.c_nationkey == n.n_nationkey)            # nation and region are
            .join(r, n.n_regionkey == r.r_regionkey))             # tiny: AQE broadcasts them
    return (o.join(geo, o.o_custkey == geo.c_custkey, "left")
             .select(F.sha2(F.col("o_orderkey").cast("string"), 256).alias("job_fingerprint"),
                     F.coalesce("c_name", F.lit(V.UNSPECIFIED)).alias("company_name"),
                     F.coalesce("r_name", F.lit(V.UNSPECIFIED)).alias("location_country"),
                     F.coalesce("n_name", F.lit(V.UNSPECIFIED)).alias("location_city"),
                     F.col("o_orderkey").cast("string").alias("source_job_id"),
                     F.col("o_orderdate").cast("timestamp").alias("publication_date"),
                     (F.col("o_orderstatus") == F.lit("O")).alias("is_internship")))


def dim_company_orders(spark, sf_dir):
    return star.dim_company(_order_postings(spark, sf_dir))


def dim_location_geo(spark, sf_dir):
    return star.dim_location(_order_postings(spark, sf_dir))


def fact_orders(spark, sf_dir):
    """Order facts keyed by the two dimensions; the postings are joined once."""
    p = scratch_table(_order_postings(spark, sf_dir), "order-postings")
    return (star.with_keys(p, star.dim_company(p), star.dim_location(p))
             .select(F.col("source_job_id").alias("o_orderkey"), "company_id", "location_id",
                     F.to_date("publication_date").alias("publication_date"), "is_internship"))


# --- S10, P17, P18, F7, C13: cards of the stored pages ------------------------------

# The supplied pages list their links as ``nav li`` items; the third source's card
# rules (title of at least 5 characters, summary = first 500 characters of the card
# text, company and city parsed from the text) are applied to them.
NAV_CARDS = cards.CardSpec(card="nav li")


def page_cards(spark, sf_dir):
    pages = text_table(spark, sf_dir, "pages")
    raw = cards.extract_cards(pages, NAV_CARDS)
    c = cards.card_fields(raw, min_title=V.MIN_TITLE_CHARS, summary_chars=V.SUMMARY_CHARS)
    text = F.concat_ws(" ", "title", "card_text")
    firsts = first_arrival(c, ["job_url"], [F.col("page_id"), F.col("card_pos")])  # D-2 within the run
    return firsts.select("page_id", "card_pos", "job_url", "title", "summary",
                         R.company_from_text(text).alias("company"),
                         R.first_listed(text).alias("location_city"))


# --- D-3 on a stream: file source + foreachBatch against the landed batches ---------

def stream_capture(spark, sf_dir):
    """Events arrive in two deliveries (before and from the cut-off); after each the capture
    stream runs (AvailableNow) against the landed batches, the second time through the
    compacted state of the first. Every key with a kept event is captured once, and the
    surviving row is the first by position."""
    from ..streaming.capture import capture_stream

    src, landed, state = (scratch_path(spark, f"events-{n}") for n in ("incoming", "landed", "state"))
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit(EVENTS_CUTOFF).cast("timestamp")
    for part in (early, ~F.coalesce(early, F.lit(False))):
        events.filter(part).write.mode("append").parquet(src)
        capture_stream(spark, src, events.schema, landed, ["capture_key"],
                       order_by=lambda: [F.col("ts"), F.col("event_id")], keep=_event_keep,
                       prepare=lambda b: b.withColumn("capture_key", _event_key_col()),
                       state_path=state).awaitTermination()
        capture.compact_state(spark, landed, ["capture_key"], state)
    return spark.read.parquet(landed).select("capture_key", "event_id", "user_id", "event_type", "ts")


def capture_versioned_state(spark, sf_dir):
    """Three deliveries of events (by the middles of the spans before and after the cut-off), each captured
    against the versioned state. The compaction after the second one dies when its files are written and not yet
    published; the third capture finds the second batch's keys all the same, and the next compaction takes both.
    Every captured row with its batch, and the batch that the state holds for its key."""
    from ..operators import seen_state
    from ..sources import versions

    landed, state = scratch_path(spark, "versioned-landed"), scratch_path(spark, "versioned-state")
    events, at = _event_keys(spark, sf_dir), F.col("ts")
    cuts = [F.lit(c).cast("timestamp") for c in EVENTS_CUTS]
    deliveries = [F.coalesce(at < cuts[0], F.lit(True)), (at >= cuts[0]) & (at < cuts[1]), at >= cuts[1]]
    for k, part in enumerate(deliveries, 1):
        capture.capture_batch(spark, events.filter(part), landed, str(k), ["capture_key"], [F.col("ts"), F.col("event_id")], keep=_event_keep(), state_path=state)
        if k == 2:  # a compaction up to the publish
            base = seen_state.open_state(spark, state)
            rows = seen_state.read_landed(spark, landed, ["2"]).groupBy("capture_key").agg(F.min("batch_id").alias("first_batch_id")).withColumn("updated_at", F.current_timestamp())
            seen_state.write_run(rows, spark.createDataFrame([("2",)], "batch_id string"), versions.stage_folder(state, base.manifest), ["capture_key"], base.manifest.content["buckets"])
        else:
            capture.compact_state(spark, landed, ["capture_key"], state)
    kept = seen_state.open_state(spark, state).table().select("capture_key", "first_batch_id")
    rows = seen_state.read_landed(spark, landed, ["1", "2", "3"])
    return rows.join(kept, "capture_key", "full").select("capture_key", "event_id", "ts", "batch_id", "first_batch_id")


def stream_capture_state(spark, sf_dir):
    """The same stream captured with the streaming state store (dropDuplicates on the
    key) into an exactly-once parquet sink."""
    from ..streaming.capture import capture_stream_state

    src = scratch_path(spark, "events-incoming")
    events = table(spark, sf_dir, "events")
    events.write.partitionBy("event_type").parquet(src)
    sink = scratch_path(spark, "events-captured")
    q = capture_stream_state(spark, src, events.schema, sink, ["capture_key"], keep=_event_keep,
                             prepare=lambda b: b.withColumn("capture_key", _event_key_col()),
                             max_files_per_trigger=2)
    q.awaitTermination()
    return spark.read.parquet(sink).select("capture_key")


def stream_capture_keyed(spark, sf_dir):
    """The stream of ``stream_capture`` with keyed state: two deliveries, their files in no order; every key's
    first row by position, kept in state that the recency rule's watermark ends."""
    from ..streaming.keyed import capture_stream_keyed

    src, sink = scratch_path(spark, "events-shuffled"), scratch_path(spark, "events-keyed")
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit(EVENTS_CUTOFF).cast("timestamp")
    for part in (early, ~F.coalesce(early, F.lit(False))):
        events.filter(part).repartition(4, F.xxhash64("event_id")).write.mode("append").parquet(src)
        capture_stream_keyed(spark, src, events.schema, sink, ["capture_key"], ["ts", "event_id"], "ts", keep=_event_keep,
                             prepare=lambda b: b.withColumn("capture_key", _event_key_col())).awaitTermination()
    return spark.read.parquet(sink).select("capture_key", "event_id", "user_id", "event_type", "ts")


# --- X4-X6: the gated daily composition over written layers ------------------------

def daily_layers(spark, sf_dir):
    """Bronze landing, silver written partitioned, quality gate on the written table,
    gold only when the gate passes. Returns the gate report, plus one row per
    written gold table when it passed."""
    root = scratch_path(spark, "lake")
    B.land_bronze(text_table(spark, sf_dir, "documents"), root + "/bronze", C.as_timestamp(RUN_TS))
    daily.silver_layer(spark, root + "/bronze", root + "/silver", RUN_TS)
    report = quality.run_checks(spark.read.parquet(root + "/silver"), AS_OF)
    try:
        quality.gate(report)
    except quality.QualityGateError:
        return report
    summary = daily.gold_layer(spark, root + "/silver", root + "/gold")
    return report.unionByName(summary.select(F.concat(F.lit("gold:"), "table").alias("check"),
                                             F.lit("info").alias("severity"), F.col("rows").alias("observed"),
                                             F.lit(True).alias("passed")))


# --- D-3, X6: capture per source over two deliveries, bronze, silver -----------------

def daily_capture(spark, sf_dir):
    """Two days of capture over the documents: first those with an even id, then all of
    them (what was captured on the first day is seen); silver is built from the landed
    envelopes of both days."""
    root = scratch_path(spark, "capture")
    raw = P.raw_postings(text_table(spark, sf_dir, "documents"))
    even = F.col("doc_id") % 2 == 0
    for k, day in enumerate((raw.filter(even), raw)):
        ts = C.as_timestamp(RUN_TS) + F.expr(f"INTERVAL {k} DAYS")
        ingest.capture_run(spark, day, root + "/bronze", root + "/state", f"day{k}", ts, CAPTURE_AS_OF, [F.col("doc_id")], chunk_rows=100)
    unified, _rejects, _skipped = read_batches(spark, root + "/bronze")
    s = S.build_silver(unified, RUN_TS)
    cols = [c for c in S.SILVER_COLUMNS if c not in ("matched_domains", "matched_roles")]
    return s.select(*cols, _joined("matched_domains").alias("matched_domains"), _joined("matched_roles").alias("matched_roles"))


# --- X2: rules of one's own ------------------------------------------------------------------

def registered_rules(spark, sf_dir):
    """Silver's labels with registered rules among the built-in ones: a contract type by words before CDI, one by a
    predicate before FREELANCE, a work mode before all others."""
    rules = R.register_rules("contract_type", [("INTERIM", ["permanent", "contract"])], before="CDI")
    rules = R.register_rules("contract_type", [("PONCTUEL", lambda t: t.low.contains("été") | t.low.contains("8 weeks"))], rules, before="FREELANCE")
    rules = R.register_rules("work_mode", [("TELETRAVAIL", ["télétravail", "télétravail total"])], rules, before="FULL_REMOTE")
    return S.derive_attributes(_postings(spark, sf_dir), RUN_TS, rules).select("doc_id", "contract_type", "work_mode", "internship_category")


# --- S1, 1.4: fields that the declared schema doesn't have ------------------------------------

def passed_through_fields(spark, sf_dir):
    """API postings landed in two runs with fields of their own, one as a number and then as text, one nested:
    the undeclared fields as read back, counted by type, with the sum of their numbers."""
    root = scratch_path(spark, "bronze-fields")
    raw = P.raw_postings(text_table(spark, sf_dir, "documents"))
    early, late = raw.filter(F.col("doc_id") % 3 == 0), raw.filter(F.col("doc_id") % 3 != 0)
    late = late.withColumns({"reach": F.struct((F.col("doc_id") % 7).alias("score"), F.col("source").alias("via")), "doc_id": F.col("doc_id").cast("string")})
    for k, rows in enumerate((early, late)):
        B.land_tagged(B.tag_postings(rows), root, C.as_timestamp(RUN_TS) + F.expr(f"INTERVAL {k} DAYS"), chunk_rows=100)
    from ..sources import batches

    fields = batches.undeclared_fields(batches.read_envelopes(spark, batches.source_path(root, B.API_SOURCE), batches.API_RECORD), batches.API_RECORD)
    number = F.coalesce(F.try_variant_get("value", "$", "bigint"), F.try_variant_get("value", "$.score", "bigint"))
    sums = fields.groupBy("field", F.schema_of_variant("value").alias("type")).agg(F.sum(number).alias("total"))
    return batches.field_drift(fields).join(sums, ["field", "type"]).select("field", "type", "n", "total")


# --- X4, D-1, X6, Q6: silver by increments, audited before it is public ---------------------

def _deliveries(spark, sf_dir, parts, raw=None):
    """A lake whose bronze gets the documents in ``parts`` deliveries by id, a day apart; ``land(k)`` lands one."""
    root = scratch_path(spark, "lake-versions")
    raw = P.raw_postings(text_table(spark, sf_dir, "documents")) if raw is None else raw

    def land(k, rows=None):
        ts = C.as_timestamp(RUN_TS) + F.expr(f"INTERVAL {k} DAYS")
        B.land_tagged(B.tag_postings((raw if rows is None else rows).filter(F.col("doc_id") % parts == k)), root + "/bronze", ts, chunk_rows=100)

    return root, raw, land


def _publish(spark, root):
    """A version without its gate (the supplied postings have null ids, which the gate blocks)."""
    from ..sources import versions
    from . import incremental

    staged = incremental.stage(spark, root + "/bronze", root + "/silver", RUN_TS)
    versions.publish(spark, root + "/silver", staged.base, staged.content)
    return staged


def incremental_silver(spark, sf_dir):
    """Three deliveries; after each, silver takes the new bronze run in. Equal to a rebuild from all bronze."""
    from . import incremental

    root, _, land = _deliveries(spark, sf_dir, 3)
    for k in range(3):
        land(k)
        _publish(spark, root)
    s = incremental.read_silver(spark, root + "/silver")
    cols = [c for c in S.SILVER_COLUMNS if c not in ("matched_domains", "matched_roles")]
    return s.select(*cols, _joined("matched_domains").alias("matched_domains"), _joined("matched_roles").alias("matched_roles"))


def incremental_audit(spark, sf_dir):
    """The gate's report of a version, added up from numbers that three runs kept by partition."""
    from . import incremental

    root, _, land = _deliveries(spark, sf_dir, 3)
    for k in range(2):
        land(k)
        _publish(spark, root)
    land(2)
    staged = incremental.stage(spark, root + "/bronze", root + "/silver", RUN_TS)
    return incremental.audit(spark, root + "/silver", staged, AS_OF)


def publish_after_audit(spark, sf_dir):
    """Write, audit, publish: complete postings are published; a delivery with null ids is staged and
    blocked, and readers keep the version before; landed again with ids, it is published. What readers see
    after each step, and the null keys that the step's audit found."""
    from ..sources import versions
    from . import incremental

    root, raw, land = _deliveries(spark, sf_dir, 2)
    fixed = raw.withColumn("source_job_id", F.coalesce("source_job_id", F.concat(F.lit("made-"), F.col("doc_id").cast("string"))))
    out = []
    for step, (k, rows) in enumerate([(0, fixed), (1, raw), (1, fixed)], 1):
        land(k, rows)
        staged = incremental.stage(spark, root + "/bronze", root + "/silver", RUN_TS)
        report = incremental.audit(spark, root + "/silver", staged, AS_OF)
        try:
            incremental.increment(spark, root + "/bronze", root + "/silver", AS_OF, RUN_TS, staged=staged, report=report)
            published = True
        except quality.QualityGateError:
            published = False
        version = versions.read_manifest(spark, root + "/silver").version
        seen = incremental.read_silver(spark, root + "/silver", version).agg(F.count(F.lit(1)).alias("rows_visible"))
        nulls = report.filter("check = 'key_completeness'").select(F.col("observed").alias("null_keys"))
        out.append(seen.join(F.broadcast(nulls)).select(F.lit(step).alias("step"), F.lit(published).alias("published"), F.lit(version).alias("version"), "rows_visible", "null_keys"))  # one row each
    return mapping.union_sources(out)


# --- P21, G1-G3: keys that members keep ---------------------------------------------------------

def registered_keys(spark, sf_dir):
    """The three dimensions of two days: the first day's postings (even ids), then all. Members of the first day
    keep their keys, new ones get the numbers after the last."""
    root, silver = scratch_path(spark, "registries"), scratch_table(_postings(spark, sf_dir), "posted")
    derived = S.derive_attributes(silver, RUN_TS)
    out = []
    for day, rows in enumerate((derived.filter(F.col("doc_id") % 2 == 0), derived), 1):
        d = star.registered_dimensions(rows, root)
        for name, key, label in (("dim_company", "company_id", F.col("company_name")), ("dim_location", "location_id", F.concat_ws("|", "location_country", "location_city")),
                                 ("dim_taxonomy", "taxonomy_id", F.concat_ws("|", "domain", "role_keyword"))):
            postings = F.col("total_jobs_posted") if name == "dim_company" else F.lit(None).cast("long")
            out.append(d[name].select(F.lit(day).alias("day"), F.lit(name).alias("dimension"), F.col(key).alias("id"), label.alias("member"), postings.alias("postings")))
    return mapping.union_sources(out)


# --- X5, S6, G6: the gate passes and gold is written and read back --------------------

def daily_layers_pass(spark, sf_dir):
    """The daily run over postings whose ids are complete: the gate passes, gold is written,
    and the facts are read back with the names that their keys stand for."""
    root = scratch_path(spark, "lake-pass")
    raw = P.raw_postings(text_table(spark, sf_dir, "documents"))
    raw = raw.withColumn("source_job_id", F.coalesce("source_job_id", F.concat(F.lit("made-"), F.col("doc_id").cast("string"))))
    daily.run_daily(spark, root + "/bronze", root + "/silver", root + "/gold", RUN_TS, AS_OF,
                    ingest=lambda bronze: B.land_tagged(B.tag_postings(raw), bronze, C.as_timestamp(RUN_TS)), required=list(V.SOURCES))
    read = lambda name: spark.read.parquet(f"{root}/gold/{name}")
    facts = read("fact_job_postings").join(read("dim_company"), "company_id", "left").join(read("dim_location"), "location_id", "left")
    interns = read("fact_internships_pfe").select("job_fingerprint", "internship_category", "duration_months", "duration_bracket")
    return facts.join(interns, "job_fingerprint", "left").select(
        "job_fingerprint", "source", "job_url", "job_title", "company_id", "company_name", "total_jobs_posted", "location_id", "location_country",
        "location_city", "is_morocco", "publication_date", "contract_type", "work_mode", "is_internship", "is_remunerated", "primary_domain",
        "internship_category", "duration_months", "duration_bracket", "year", "month")


# --- Q4, U2, A6 with findings -------------------------------------------------------

def invalid_domains_narrow(spark, sf_dir):
    """The domain check against a narrower allow-list: the domains outside it, each with the
    check's own verdict."""
    silver, allowed = _silver_table(spark, sf_dir), quality.allowed_domains(spark, V.ALLOWED_DOMAINS[::2])
    verdict = quality.run_checks(silver, AS_OF, allowed=allowed).filter("check = 'domain_validity'").select("observed", "passed")
    return quality.invalid_domains(silver, allowed).join(F.broadcast(verdict))  # one row


# --- S10, P17, P18, F7: the three page sources, pages projected from whole documents -----

def _card_pages(spark, sf_dir):
    raw = P.raw_postings(text_table(spark, sf_dir, "documents"))
    safe = lambda c: F.replace(F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    href = F.when(F.col("doc_id") % 10 == 3, F.lit("http://[bad")).otherwise(F.concat(F.lit("{path}"), F.col("doc_id").cast("string")))
    return raw.select("doc_id", href.alias("href"), *[safe(c).alias(c) for c in ("raw_title", "raw_description", "raw_contract", "company", "city")])


def _cards(spark, sf_dir, source, path, html):
    p = _card_pages(spark, sf_dir).withColumn("href", F.replace("href", F.lit("{path}"), F.lit(path)))
    pages = p.select(F.col("doc_id").alias("page_id"), F.lit("https://jobs.example/list?page=1").alias("url"),
                     F.concat(*[F.col(x[1:-1]) if x.startswith("{") else F.lit(x) for x in re.split(r"(\{\w+\})", html) if x]).alias("html"))
    return cards.extract_cards(pages, cards.SOURCE_CARD_SPECS[source])


def cards_source_a(spark, sf_dir):
    """First page source: title link, company, info items, snippet; a card without a link and a
    card with an impossible one are dropped; the unclosed items end where the next begins."""
    raw = _cards(spark, sf_dir, "rekrute_scraper", "/offre/", "<html><body><ul><li class='post-id'><h2>no link</h2><li class='post-id'><h2><a class='titreJob' href='{href}'>{raw_title}</a></h2>"
                 "<div class='holder'><div class='text-holder'><p>{company}</div><div class='info'><ul><li>{raw_contract}<li>{city}</ul><div class='text'>{raw_description}</div></div></div></ul>")
    c = cards.card_fields(raw, snippet_summary=True)
    return c.select("page_id", "card_pos", "job_url", "title", "company", "summary", "raw_metadata")


def cards_source_b(spark, sf_dir):
    """Second page source: the offer link and the recruiter link of a card."""
    raw = _cards(spark, sf_dir, "emploima_scraper", "/offre-emploi-maroc/", "<div class='card-job'><a href='/recruteur/1'>{company}</a><h3><a href='{href}'>{raw_title}</a></h3><p>{raw_description}</div>"
                 "<div class='card-job'><a href='/other/2'>elsewhere</a></div>")
    c = cards.card_fields(raw, metadata="kw=data")
    return c.select("page_id", "card_pos", "job_url", "title", "company", "summary", "raw_metadata")


def cards_source_c(spark, sf_dir):
    """Third page source: URL guard, title of at least 5 characters, summary of 500 characters
    beside the whole card text, company and city parsed from the text."""
    raw = _cards(spark, sf_dir, "dreamjob_scraper", "/emploi/", "<article><a href='{href}'>{raw_title}</a><p>{raw_description}</article><article><a href='/blog/1'>Not a job</a></article>")
    c = cards.card_fields(raw, min_title=V.MIN_TITLE_CHARS, summary_chars=V.SUMMARY_CHARS)
    text = F.concat_ws(" ", "title", "card_text")
    return c.select("page_id", "card_pos", "job_url", "title", "summary", F.length("card_text").alias("card_chars"), F.sha2("card_text", 256).alias("card_sha256"),
                    R.company_from_text(text).alias("company"), R.first_listed(text).alias("location_city"))


QUERIES = {
    "daily_capture": daily_capture,
    "daily_layers_pass": daily_layers_pass,
    "invalid_domains_narrow": invalid_domains_narrow,
    "cards_source_a": cards_source_a,
    "cards_source_b": cards_source_b,
    "cards_source_c": cards_source_c,
    "tag_keywords": tag_keywords,
    "fingerprint": fingerprint,
    "internship_flag": internship_flag,
    "contract_type": contract_type,
    "remuneration": remuneration,
    "work_mode": work_mode,
    "duration_months": duration_months,
    "duration_bracket": duration_bracket,
    "internship_category": internship_category,
    "dedup_postings": dedup_postings,
    "silver_table": silver_table,
    "dim_company": dim_company,
    "dim_location": dim_location,
    "dim_taxonomy": dim_taxonomy,
    "fact_postings": fact_postings,
    "fact_internships": fact_internships,
    "layer_summary": layer_summary,
    "quality_report": quality_report,
    "duplicate_keys": duplicate_keys,
    "invalid_domains": invalid_domains,
    "ingest_attributes": ingest_attributes,
    "duration_text": duration_text,
    "city_from_text": city_from_text,
    "company_from_text": company_from_text,
    "recency_filter": recency_filter,
    "partition_counts": partition_counts,
    "future_dates": future_dates,
    "relevance_filter": relevance_filter,
    "incremental_capture": incremental_capture,
    "capture_history": capture_history,
    "batch_summary": batch_summary,
    "canonical_union": canonical_union,
    "bronze_silver": bronze_silver,
    "bronze_envelopes": bronze_envelopes,
    "page_cards": page_cards,
    "stream_capture": stream_capture,
    "stream_capture_keyed": stream_capture_keyed,
    "capture_versioned_state": capture_versioned_state,
    "tag_by_table": tag_by_table,
    "registered_rules": registered_rules,
    "passed_through_fields": passed_through_fields,
    "tag_large_taxonomy": tag_large_taxonomy,
    "incremental_silver": incremental_silver,
    "incremental_audit": incremental_audit,
    "publish_after_audit": publish_after_audit,
    "registered_keys": registered_keys,
    "stream_capture_state": stream_capture_state,
    "daily_layers": daily_layers,
    "dim_company_orders": dim_company_orders,
    "dim_location_geo": dim_location_geo,
    "fact_orders": fact_orders,
}
