"""DuckDB SQL per registered query (same keys and column names as :mod:`.queries`)."""

from __future__ import annotations

from ..functions import vocab as V
from .oracle import (AS_OF, CAPTURE_AS_OF, EVENTS_AS_OF, EVENTS_CUTOFF, EVENTS_CUTS, EVENTS_FUTURE_AS_OF, ORDERS_AS_OF, RUN_TS, city_sql,
                     company_sql, ingest_cte, parse_ts, parse_wall_clock, postings_cte, publication_text_sql, q, has, strip_sql, W,
                     recent, with_enriched, with_postings, with_silver)


def _attr(col: str) -> str:
    return with_enriched(f"SELECT doc_id, {col} FROM enriched")


SQL = {
    "tag_keywords": with_postings("""
SELECT doc_id, array_to_string(matched_domains, '|') AS domains, array_to_string(matched_roles, '|') AS roles,
  CAST(len(matched_roles) AS INTEGER) AS n_roles, coalesce(matched_domains[1], 'NON_CLASSE') AS primary_domain
FROM postings"""),
    "fingerprint": _attr("job_fingerprint, job_title_clean"),
    "internship_flag": _attr("is_internship"),
    "contract_type": _attr("contract_type"),
    "remuneration": _attr("is_remunerated"),
    "work_mode": _attr("work_mode"),
    "duration_months": _attr("duration_months"),
    "duration_bracket": _attr("duration_bracket"),
    "internship_category": _attr("internship_category"),
    "dedup_postings": with_silver("SELECT job_fingerprint, source, source_job_id, publication_date FROM silver"),
    "silver_table": with_silver("""
SELECT job_fingerprint, source, source_job_id, job_title_clean, company_name, location_country, location_city,
  publication_date, contract_type, is_internship, internship_category, duration_months, duration_bracket,
  is_remunerated, work_mode, primary_domain, ingested_at, year, month,
  array_to_string(matched_domains, '|') AS matched_domains, array_to_string(matched_roles, '|') AS matched_roles
FROM silver"""),
    "dim_company": with_silver("""
SELECT CAST(row_number() OVER (ORDER BY company_name NULLS FIRST) AS BIGINT) AS company_id, company_name,
  total_jobs_posted
FROM (SELECT company_name, count(job_fingerprint) AS total_jobs_posted FROM silver GROUP BY company_name)"""),
    "dim_location": with_silver("""
SELECT CAST(row_number() OVER (ORDER BY location_country NULLS FIRST, location_city NULLS FIRST) AS BIGINT)
    AS location_id,
  location_country, location_city, coalesce(location_country = 'Maroc', false) AS is_morocco
FROM (SELECT DISTINCT location_country, location_city FROM silver)"""),
    "dim_taxonomy": with_silver("""
SELECT CAST(row_number() OVER (ORDER BY domain NULLS FIRST, role_keyword NULLS FIRST) AS BIGINT) AS taxonomy_id,
  domain, role_keyword
FROM (SELECT DISTINCT domain, coalesce(role_keyword, 'Generaliste') AS role_keyword
      FROM (SELECT primary_domain AS domain, unnest(CASE WHEN len(matched_roles) = 0 OR matched_roles IS NULL
                   THEN [NULL] ELSE matched_roles END) AS role_keyword FROM silver))"""),
}

# ---------------------------------------------------------------------------
# the rest of the inventory
# ---------------------------------------------------------------------------


_DIMS = """
dimc AS (SELECT row_number() OVER (ORDER BY company_name NULLS FIRST) AS company_id, company_name
         FROM (SELECT DISTINCT company_name FROM silver)),
diml AS (SELECT row_number() OVER (ORDER BY location_country NULLS FIRST, location_city NULLS FIRST) AS location_id,
                location_country, location_city
         FROM (SELECT DISTINCT location_country, location_city FROM silver))
"""


SQL["fact_postings"] = with_silver(f"""
, {_DIMS.strip()}
SELECT s.job_fingerprint, s.source, s.source_job_id AS job_url, s.job_title_clean AS job_title,
  CAST(c.company_id AS BIGINT) AS company_id, CAST(l.location_id AS BIGINT) AS location_id,
  CAST(s.publication_date AS DATE) AS publication_date, s.contract_type, s.work_mode, s.is_internship,
  s.is_remunerated, s.primary_domain, s.year, s.month
FROM silver s LEFT JOIN dimc c ON s.company_name = c.company_name
  LEFT JOIN diml l ON s.location_country = l.location_country AND s.location_city = l.location_city""")

SQL["fact_internships"] = with_silver(f"""
, {_DIMS.strip()}
SELECT s.job_fingerprint, s.source, s.source_job_id AS job_url, s.job_title_clean AS job_title,
  CAST(c.company_id AS BIGINT) AS company_id, CAST(l.location_id AS BIGINT) AS location_id,
  CAST(s.publication_date AS DATE) AS publication_date, s.internship_category, s.duration_months,
  s.duration_bracket, s.is_remunerated, s.work_mode, s.primary_domain, s.year, s.month
FROM silver s LEFT JOIN dimc c ON s.company_name = c.company_name
  LEFT JOIN diml l ON s.location_country = l.location_country AND s.location_city = l.location_city
WHERE s.is_internship""")

SQL["layer_summary"] = with_silver("""
SELECT 'dim_company' AS "table", CAST(count(DISTINCT company_name) AS BIGINT) AS "rows" FROM silver
UNION ALL SELECT 'dim_location', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT location_country, location_city FROM silver)
UNION ALL SELECT 'fact_job_postings', CAST(count(*) AS BIGINT) FROM silver
UNION ALL SELECT 'fact_internships_pfe', CAST(count(*) AS BIGINT) FROM silver WHERE is_internship""")

_ALLOWED = "(" + ", ".join(q(d) for d in V.ALLOWED_DOMAINS) + ")"

SQL["quality_report"] = with_silver(f"""
, stats AS (
  SELECT CAST(count(*) AS BIGINT) AS total,
    CAST(count(*) FILTER (WHERE job_fingerprint IS NULL OR source_job_id IS NULL) AS BIGINT) AS null_keys,
    CAST(count(DISTINCT job_fingerprint) + coalesce(max(CASE WHEN job_fingerprint IS NULL THEN 1 ELSE 0 END), 0)
         AS BIGINT) AS distinct_keys,
    CAST(count(*) FILTER (WHERE publication_date > CAST(DATE '{AS_OF}' AS TIMESTAMP)) AS BIGINT) AS future_dates
  FROM silver),
bad AS (SELECT CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT primary_domain FROM silver)
        WHERE primary_domain IS NULL OR primary_domain NOT IN {_ALLOWED})
SELECT 'non_empty' AS "check", 'critical' AS severity, total AS observed, total > 0 AS passed FROM stats
UNION ALL SELECT 'key_completeness', 'critical', null_keys, null_keys = 0 FROM stats
UNION ALL SELECT 'key_uniqueness', 'critical', total - distinct_keys, total - distinct_keys = 0 FROM stats
UNION ALL SELECT 'domain_validity', 'critical', n, n = 0 FROM bad
UNION ALL SELECT 'future_dates', 'warning', future_dates, future_dates = 0 FROM stats""")

SQL["duplicate_keys"] = with_enriched("""
SELECT job_fingerprint, CAST(count(*) AS BIGINT) AS n_rows FROM enriched GROUP BY job_fingerprint HAVING count(*) > 1""")

SQL["invalid_domains"] = with_silver(f"""
SELECT domain FROM (SELECT DISTINCT primary_domain AS domain FROM silver)
WHERE domain IS NULL OR domain NOT IN {_ALLOWED}""")

SQL["ingest_attributes"] = "WITH " + postings_cte() + "," + ingest_cte() + """
SELECT doc_id, source, internship_type <> 'CDI_OR_OTHER' AS is_internship, internship_type,
  ingest_pay AS is_remunerated, ingest_mode AS work_mode FROM ingest"""

SQL["duration_text"] = "WITH " + postings_cte() + "," + ingest_cte() + """
SELECT doc_id, internship_duration FROM ingest"""

SQL["city_from_text"] = with_postings(f"""
SELECT doc_id, {city_sql("concat_ws(' ', raw_title, raw_description)")} AS location_city FROM raw_postings""")

SQL["company_from_text"] = with_postings(f"""
SELECT doc_id, {company_sql("concat_ws(' ', raw_title, raw_description)")} AS company FROM raw_postings""")

_ORDER_DATES = """
order_dates AS (
  SELECT o_orderkey, CASE o_orderkey % 11
      WHEN 0 THEN NULL WHEN 1 THEN 'n/a'
      WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || 'Z'
      WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.250+02:00'
      WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '-05:00'
      ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS created
  FROM orders)"""

SQL["recency_filter"] = f"""WITH {_ORDER_DATES}
SELECT o_orderkey, created FROM order_dates WHERE {recent(parse_wall_clock('created'), ORDERS_AS_OF)}"""

SQL["partition_counts"] = f"""WITH {_ORDER_DATES}
SELECT CAST(coalesce(year(ts), {V.DEFAULT_YEAR}) AS INTEGER) AS year,
  CAST(coalesce(month(ts), {V.DEFAULT_MONTH}) AS INTEGER) AS month, CAST(count(*) AS BIGINT) AS n_rows
FROM (SELECT {parse_ts('created')} AS ts FROM order_dates) GROUP BY ALL"""

SQL["future_dates"] = f"""
SELECT event_type, CAST(count(*) FILTER (WHERE ts > CAST(DATE '{EVENTS_FUTURE_AS_OF}' AS TIMESTAMP)) AS BIGINT) AS n_future,
  CAST(count(*) AS BIGINT) AS n_rows
FROM events GROUP BY event_type"""

_RELEVANT = (f"CASE WHEN source = {q(V.SOURCES[0])} THEN len(matched_domains) > 0 "
             f"ELSE len(matched_domains) > 0 OR internship_type <> 'CDI_OR_OTHER' END")

SQL["relevance_filter"] = "WITH " + postings_cte() + "," + ingest_cte("postings") + f"""
SELECT doc_id, source FROM ingest WHERE {_RELEVANT}"""

_EVENTS = f"""
e AS (SELECT *, concat_ws(':', event_type, CAST(user_id AS VARCHAR),
                  CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 AS VARCHAR)) AS capture_key FROM events),
kept AS (SELECT * FROM e WHERE {recent('ts', EVENTS_AS_OF)} AND event_type <> 'error')"""

SQL["incremental_capture"] = f"""WITH {_EVENTS},
seen AS (SELECT DISTINCT capture_key FROM kept WHERE ts < TIMESTAMP '{EVENTS_CUTOFF}'),
firsts AS (SELECT *, row_number() OVER (PARTITION BY capture_key ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS rn
           FROM kept WHERE ts >= TIMESTAMP '{EVENTS_CUTOFF}')
SELECT capture_key, event_id, user_id, event_type, ts FROM firsts
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM seen WHERE seen.capture_key = firsts.capture_key)"""

SQL["capture_history"] = f"""WITH {_EVENTS},
firsts AS (SELECT *, row_number() OVER (PARTITION BY capture_key
             ORDER BY CAST(ts AS DATE) NULLS FIRST, ts NULLS FIRST, event_id NULLS FIRST) AS rn FROM kept)
SELECT CAST(ts AS DATE) AS run_date, CAST(count(*) AS BIGINT) AS new_records_count FROM firsts WHERE rn = 1 GROUP BY 1"""

SQL["batch_summary"] = "WITH " + postings_cte() + "," + ingest_cte("postings") + f""",
firsts AS (SELECT *, row_number() OVER (PARTITION BY source, source_job_id ORDER BY doc_id) AS rn
           FROM ingest WHERE {_RELEVANT} AND source IS NOT NULL AND source_job_id IS NOT NULL)
SELECT source, CASE WHEN source = {q(V.SOURCES[0])} THEN 'fr' ELSE {q(V.MOROCCO)} END AS country,
  'bronze_delta' AS pipeline_stage, strftime(TIMESTAMP '{RUN_TS}', '%Y-%m-%d') AS run_date,
  strftime(TIMESTAMP '{RUN_TS}', '%H%M%S') AS run_time, CAST(count(*) AS BIGINT) AS new_records_count,
  CAST(count(*) FILTER (WHERE internship_type <> 'CDI_OR_OTHER') AS BIGINT) AS internships_count,
  CAST({len(V.TAXONOMY)} AS INTEGER) AS n_domains_covered
FROM firsts WHERE rn = 1 GROUP BY source"""

SQL["canonical_union"] = f"""
SELECT 'documents_api' AS source, CAST(doc_id AS VARCHAR) AS source_job_id, split_part(text, chr(10), 1) AS raw_title,
  coalesce(CASE WHEN n_chars % 20 = 0 THEN NULL ELSE lang END, {q(V.UNSPECIFIED)}) AS company_name,
  coalesce(CASE WHEN doc_id % 9 = 0 THEN NULL ELSE upper(lang) END, {q(V.API_DEFAULT_COUNTRY)}) AS location_country,
  coalesce(CASE WHEN doc_id % 6 = 0 THEN NULL ELSE source END, {q(V.UNSPECIFIED)}) AS location_city,
  {parse_ts(publication_text_sql())} AS publication_date,
  coalesce(text, '') AS raw_description,
  coalesce(CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source END, '') AS raw_contract
FROM documents
UNION ALL
SELECT 'conversations_page', concat_ws('/', 'conv', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR)), role,
  coalesce(CASE WHEN turn % 3 = 0 THEN NULL ELSE 'C' || CAST(conv_id AS VARCHAR) END, {q(V.UNSPECIFIED)}),
  {q(V.MOROCCO)}, coalesce(CASE WHEN conv_id % 2 = 0 THEN NULL ELSE 'Rabat' END, {q(V.MOROCCO)}),
  CAST(NULL AS TIMESTAMP),
  concat_ws(' ', coalesce(text, ''), coalesce(CASE WHEN turn % 4 = 0 THEN NULL ELSE role END, '')),
  coalesce(CASE WHEN turn % 4 = 0 THEN NULL ELSE role END, '')
FROM conversations
UNION ALL
SELECT 'conversations_flat', concat_ws('/', 'conv', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR)), role,
  coalesce(CASE WHEN turn % 3 = 0 THEN NULL ELSE 'C' || CAST(conv_id AS VARCHAR) END, {q(V.UNSPECIFIED)}),
  {q(V.MOROCCO)}, {q(V.MOROCCO)},
  CAST(NULL AS TIMESTAMP),
  concat_ws(' ', coalesce(text, ''), coalesce(CASE WHEN turn % 4 = 0 THEN NULL ELSE role END, '')),
  coalesce(CASE WHEN turn % 4 = 0 THEN NULL ELSE role END, '')
FROM conversations"""

_CANON = f"""
canon AS (
  SELECT doc_id, source, source_job_id, raw_title,
    coalesce(company, {q(V.UNSPECIFIED)}) AS company_name,
    CASE WHEN source = {q(V.SOURCES[0])} THEN coalesce(location_country, {q(V.API_DEFAULT_COUNTRY)})
         ELSE {q(V.MOROCCO)} END AS location_country,
    CASE WHEN source = {q(V.SOURCES[0])} THEN coalesce(city, {q(V.UNSPECIFIED)})
         WHEN source = {q(V.SOURCES[1])} THEN {q(V.MOROCCO)}
         ELSE coalesce(city, {q(V.MOROCCO)}) END AS location_city,
    {parse_ts('created')} AS publication_date,
    CASE WHEN source = {q(V.SOURCES[0])} THEN coalesce(raw_description, '')
         ELSE concat_ws(' ', coalesce(raw_description, ''), coalesce(raw_contract, '')) END AS raw_description,
    coalesce(raw_contract, '') AS raw_contract,
    domains AS matched_domains, roles AS matched_roles
  FROM tagged
),"""

SQL["bronze_silver"] = with_silver("""
SELECT job_fingerprint, source, source_job_id, job_title_clean, company_name, location_country, location_city,
  publication_date, contract_type, is_internship, internship_category, duration_months, duration_bracket,
  is_remunerated, work_mode, primary_domain, ingested_at, year, month,
  array_to_string(matched_domains, '|') AS matched_domains, array_to_string(matched_roles, '|') AS matched_roles
FROM silver""", extra=_CANON, src="canon")

SQL["bronze_envelopes"] = "WITH " + postings_cte() + "," + ingest_cte() + """
SELECT source, CAST(count(*) AS BIGINT) AS new_records_count,
  CAST(count(*) FILTER (WHERE internship_type <> 'CDI_OR_OTHER') AS BIGINT) AS internships_count
FROM ingest GROUP BY source"""


SQL["page_cards"] = f"""
WITH anchors AS (
  SELECT page_id, url, unnest(l) AS a, generate_subscripts(l, 1) AS i
  FROM (SELECT page_id, url, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>') AS l FROM pages)),
cards AS (
  SELECT page_id, CAST(i - 1 AS INTEGER) AS card_pos,
    regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) || regexp_extract(a, 'href="([^"]*)"', 1) AS job_url,
    trim(regexp_extract(a, '>([^<]*)</a>', 1)) AS title,
    trim(regexp_extract(a, '>([^<]*)</a>', 1)) AS card_text
  FROM anchors),
kept AS (SELECT * FROM cards WHERE length(title) >= 5),
firsts AS (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY page_id, card_pos) AS rn FROM kept)
SELECT page_id, card_pos, job_url, title, substr(card_text, 1, 500) AS summary,
  {company_sql("concat_ws(' ', title, card_text)")} AS company,
  {city_sql("concat_ws(' ', title, card_text)")} AS location_city
FROM firsts WHERE rn = 1"""

SQL["stream_capture"] = f"""WITH {_EVENTS},
firsts AS (SELECT *, row_number() OVER (PARTITION BY capture_key ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS rn FROM kept)
SELECT capture_key, event_id, user_id, event_type, ts FROM firsts WHERE rn = 1"""

SQL["capture_versioned_state"] = f"""WITH {_EVENTS},
dealt AS (SELECT *, CASE WHEN ts >= TIMESTAMP '{EVENTS_CUTS[1]}' THEN '3' WHEN ts >= TIMESTAMP '{EVENTS_CUTS[0]}' THEN '2' ELSE '1' END AS batch_id FROM kept),
firsts AS (SELECT *, row_number() OVER (PARTITION BY capture_key ORDER BY batch_id, ts NULLS FIRST, event_id NULLS FIRST) AS rn FROM dealt)
SELECT capture_key, event_id, ts, batch_id, batch_id AS first_batch_id FROM firsts WHERE rn = 1"""

SQL["stream_capture_state"] = f"""WITH {_EVENTS}
SELECT DISTINCT capture_key FROM kept"""

SQL["daily_layers"] = with_silver(f"""
, stats AS (
  SELECT CAST(count(*) AS BIGINT) AS total,
    CAST(count(*) FILTER (WHERE job_fingerprint IS NULL OR source_job_id IS NULL) AS BIGINT) AS null_keys,
    CAST(count(DISTINCT job_fingerprint) + coalesce(max(CASE WHEN job_fingerprint IS NULL THEN 1 ELSE 0 END), 0)
         AS BIGINT) AS distinct_keys,
    CAST(count(*) FILTER (WHERE publication_date > CAST(DATE '{AS_OF}' AS TIMESTAMP)) AS BIGINT) AS future_dates
  FROM silver),
bad AS (SELECT CAST(count(*) AS BIGINT) AS n FROM (SELECT DISTINCT primary_domain FROM silver)
        WHERE primary_domain IS NULL OR primary_domain NOT IN {_ALLOWED})
SELECT 'non_empty' AS "check", 'critical' AS severity, total AS observed, total > 0 AS passed FROM stats
UNION ALL SELECT 'key_completeness', 'critical', null_keys, null_keys = 0 FROM stats
UNION ALL SELECT 'key_uniqueness', 'critical', total - distinct_keys, total - distinct_keys = 0 FROM stats
UNION ALL SELECT 'domain_validity', 'critical', n, n = 0 FROM bad
UNION ALL SELECT 'future_dates', 'warning', future_dates, future_dates = 0 FROM stats""", extra=_CANON, src="canon")

_ORDER_POSTINGS = f"""
op AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS source_job_id,
    coalesce(c.c_name, {q(V.UNSPECIFIED)}) AS company_name,
    coalesce(r.r_name, {q(V.UNSPECIFIED)}) AS location_country,
    coalesce(n.n_name, {q(V.UNSPECIFIED)}) AS location_city,
    CAST(o.o_orderdate AS DATE) AS publication_date, o.o_orderstatus = 'O' AS is_internship
  FROM orders o LEFT JOIN (customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                           JOIN region r ON n.n_regionkey = r.r_regionkey) ON o.o_custkey = c.c_custkey),
dc AS (SELECT CAST(row_number() OVER (ORDER BY company_name NULLS FIRST) AS BIGINT) AS company_id, company_name,
              total_jobs_posted
       FROM (SELECT company_name, CAST(count(*) AS BIGINT) AS total_jobs_posted FROM op GROUP BY company_name)),
dl AS (SELECT CAST(row_number() OVER (ORDER BY location_country NULLS FIRST, location_city NULLS FIRST) AS BIGINT)
              AS location_id, location_country, location_city,
              coalesce(location_country = {q(V.MOROCCO)}, false) AS is_morocco
       FROM (SELECT DISTINCT location_country, location_city FROM op))"""

SQL["dim_company_orders"] = f"WITH {_ORDER_POSTINGS}\nSELECT company_id, company_name, total_jobs_posted FROM dc"
SQL["dim_location_geo"] = f"WITH {_ORDER_POSTINGS}\nSELECT location_id, location_country, location_city, is_morocco FROM dl"
SQL["fact_orders"] = f"""WITH {_ORDER_POSTINGS}
SELECT op.source_job_id AS o_orderkey, dc.company_id, dl.location_id, op.publication_date, op.is_internship
FROM op LEFT JOIN dc ON op.company_name = dc.company_name
  LEFT JOIN dl ON op.location_country = dl.location_country AND op.location_city = dl.location_city"""



_SILVER_OUT = SQL["bronze_silver"][SQL["bronze_silver"].rindex("\nSELECT job_fingerprint"):]
_CAPTURED = _CANON.replace("FROM tagged\n", f"""FROM ingest
  WHERE source_job_id IS NOT NULL AND (source <> {q(V.SOURCES[0])} OR {recent(parse_wall_clock('created'), CAPTURE_AS_OF)})
    AND (len(domains) > 0 OR (source <> {q(V.SOURCES[0])} AND internship_type <> 'CDI_OR_OTHER'))
""")
SQL["daily_capture"] = with_silver(_SILVER_OUT, extra=ingest_cte("tagged") + "," + _CAPTURED, src="canon")

_COMPLETE = _CANON.replace("SELECT doc_id, source, source_job_id, raw_title,", "SELECT doc_id, source, coalesce(source_job_id, 'made-' || doc_id) AS source_job_id, raw_title,")
SQL["daily_layers_pass"] = with_silver(f"""
, dimc AS (SELECT row_number() OVER (ORDER BY company_name NULLS FIRST) AS company_id, company_name, total_jobs_posted
           FROM (SELECT company_name, CAST(count(*) AS BIGINT) AS total_jobs_posted FROM silver GROUP BY company_name)),
diml AS (SELECT row_number() OVER (ORDER BY location_country NULLS FIRST, location_city NULLS FIRST) AS location_id,
                location_country, location_city
         FROM (SELECT DISTINCT location_country, location_city FROM silver))
SELECT s.job_fingerprint, s.source, s.source_job_id AS job_url, s.job_title_clean AS job_title,
  CAST(c.company_id AS BIGINT) AS company_id, s.company_name, c.total_jobs_posted, CAST(l.location_id AS BIGINT) AS location_id,
  s.location_country, s.location_city, coalesce(s.location_country = {q(V.MOROCCO)}, false) AS is_morocco,
  CAST(s.publication_date AS DATE) AS publication_date, s.contract_type, s.work_mode, s.is_internship, s.is_remunerated,
  s.primary_domain, CASE WHEN s.is_internship THEN s.internship_category END AS internship_category,
  CASE WHEN s.is_internship THEN s.duration_months END AS duration_months,
  CASE WHEN s.is_internship THEN s.duration_bracket END AS duration_bracket, s.year, s.month
FROM silver s JOIN dimc c ON s.company_name = c.company_name
  JOIN diml l ON s.location_country = l.location_country AND s.location_city = l.location_city""", extra=_COMPLETE, src="canon")

_NARROW = "(" + ", ".join(q(d) for d in V.ALLOWED_DOMAINS[::2]) + ")"
SQL["invalid_domains_narrow"] = with_silver(f"""
, bad AS (SELECT domain FROM (SELECT DISTINCT primary_domain AS domain FROM silver) WHERE domain IS NULL OR domain NOT IN {_NARROW})
SELECT domain, (SELECT CAST(count(*) AS BIGINT) FROM bad) AS observed, (SELECT count(*) FROM bad) = 0 AS passed FROM bad""")


def _card_sql(path: str, body: str) -> str:
    t = {c: strip_sql(f"coalesce({c}, '')") for c in ("raw_title", "raw_description", "raw_contract", "company", "city")}
    url = f"'https://jobs.example{path}' || doc_id"
    return with_postings("SELECT doc_id AS page_id, " + body.format(url=url, **t) + " FROM raw_postings WHERE doc_id % 10 <> 3")


def _pieces(*names: str) -> str:
    return "array_to_string(list_filter([" + ", ".join("{" + n + "}" for n in names) + "], lambda x: x <> ''), ' ')"


SQL["cards_source_a"] = _card_sql("/offre/", """CAST(1 AS INTEGER) AS card_pos, {url} AS job_url, {raw_title} AS title, {company} AS company,
  {raw_description} AS summary, {raw_contract} || ' | ' || {city} AS raw_metadata""")
SQL["cards_source_b"] = _card_sql("/offre-emploi-maroc/", f"""CAST(0 AS INTEGER) AS card_pos, {{url}} AS job_url, {{raw_title}} AS title, nullif({{company}}, '') AS company,
  {_pieces('company', 'raw_title', 'raw_description')} AS summary, 'kw=data' AS raw_metadata""")
_CARD_C = _card_sql("/emploi/", f"{{url}} AS job_url, {{raw_title}} AS title, {_pieces('raw_title', 'raw_description')} AS card_text")
SQL["cards_source_c"] = f"""
SELECT page_id, CAST(0 AS INTEGER) AS card_pos, job_url, title, substr(card_text, 1, 500) AS summary, CAST(length(card_text) AS INTEGER) AS card_chars,
  sha256(card_text) AS card_sha256, {company_sql("concat_ws(' ', title, card_text)")} AS company, {city_sql("concat_ws(' ', title, card_text)")} AS location_city
FROM ({_CARD_C}) WHERE length(title) >= 5"""

SQL["incremental_silver"] = SQL["bronze_silver"]
SQL["incremental_audit"] = SQL["daily_layers"]

_HALF_COMPLETE = _CANON.replace("SELECT doc_id, source, source_job_id, raw_title,", "SELECT doc_id, source, CASE WHEN doc_id % 2 = 0 THEN coalesce(source_job_id, 'made-' || doc_id) ELSE source_job_id END AS source_job_id, raw_title,")
SQL["publish_after_audit"] = with_silver("""
, n AS (SELECT count(DISTINCT job_fingerprint) AS everything, count(DISTINCT job_fingerprint) FILTER (WHERE doc_id % 2 = 0) AS first FROM enriched),
b AS (SELECT count(*) FILTER (WHERE source_job_id IS NULL) AS nulls FROM silver)
SELECT 1 AS step, true AS published, 1 AS version, first AS rows_visible, 0 AS null_keys FROM n
UNION ALL SELECT 2, false, 1, first, nulls FROM n, b UNION ALL SELECT 3, true, 2, everything, 0 FROM n""", extra=_HALF_COMPLETE, src="canon")


def _registered(dimension: str, member: str, source: str, order: str, postings: str = "CAST(NULL AS BIGINT)") -> str:
    """Two days of a dimension over ``source`` (member columns and ``early``): first the early members in order, then the others."""
    return f"""SELECT d AS day, '{dimension}' AS dimension, CAST(id AS BIGINT) AS id, {member} AS member, {postings} AS postings FROM (
  SELECT *, row_number() OVER (ORDER BY early DESC, {order}) AS id FROM ({source})) m, (VALUES (1), (2)) days(d) WHERE early OR d = 2"""


SQL["registered_keys"] = with_enriched("\nUNION ALL\n".join([
    _registered("dim_company", "company_name", "SELECT company_name, bool_or(doc_id % 2 = 0) AS early, count(*) AS n, count(*) FILTER (WHERE doc_id % 2 = 0) AS n1 FROM enriched GROUP BY company_name",
                "company_name NULLS FIRST", "CAST(CASE WHEN d = 1 THEN n1 ELSE n END AS BIGINT)"),
    _registered("dim_location", "concat_ws('|', location_country, location_city)", "SELECT location_country, location_city, bool_or(doc_id % 2 = 0) AS early FROM enriched GROUP BY ALL",
                "location_country NULLS FIRST, location_city NULLS FIRST"),
    _registered("dim_taxonomy", "concat_ws('|', domain, role_keyword)", """SELECT domain, coalesce(role_keyword, 'Generaliste') AS role_keyword, bool_or(doc_id % 2 = 0) AS early
      FROM (SELECT doc_id, primary_domain AS domain, unnest(CASE WHEN len(matched_roles) = 0 OR matched_roles IS NULL THEN [NULL] ELSE matched_roles END) AS role_keyword FROM enriched) GROUP BY ALL""",
                "domain NULLS FIRST, role_keyword NULLS FIRST")]))

SQL["tag_by_table"] = SQL["tag_keywords"]
SQL["tag_large_taxonomy"] = f"""
WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[{W}]+') AS w, regexp_extract_all(lower(text), '[{W}]+([^{W}]*)', 1) AS g FROM documents),
grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(w) AS keyword FROM t
  UNION SELECT doc_id, unnest(list_transform(list_filter(range(1, len(w)), lambda i: g[i] = ' '), lambda i: w[i] || ' ' || w[i + 1])) FROM t),
taxonomy AS MATERIALIZED (SELECT keyword, md5(keyword) AS digest FROM (SELECT DISTINCT keyword FROM grams) ORDER BY digest LIMIT 100000),
hits AS (SELECT doc_id, keyword, digest FROM grams JOIN taxonomy USING (keyword)),
tags AS (SELECT doc_id, count(*) AS n, string_agg(keyword, '|' ORDER BY digest) AS roles, string_agg(DISTINCT substr(digest, 1, 1), '|' ORDER BY substr(digest, 1, 1)) AS domains FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n_roles, sha256(coalesce(roles, '')) AS roles_sha256, coalesce(domains, '') AS domains FROM documents LEFT JOIN tags USING (doc_id)"""


def _with_own_rules(sql: str) -> str:
    """The labels' CASE lists with the rules of ``registered_rules`` before the labels that they stand before."""
    own = [(f"WHEN {has('low', V.CDI_WORDS)} THEN 'CDI'", f"WHEN {has('low', ['permanent', 'contract'])} THEN 'INTERIM' "),
           (f"WHEN {has('low', V.FREELANCE_WORDS)} THEN 'FREELANCE'", "WHEN contains(low, 'été') OR contains(low, '8 weeks') THEN 'PONCTUEL' "),
           (f"WHEN {has('low', V.FULL_REMOTE_WORDS)} THEN 'FULL_REMOTE'", f"WHEN {has('low', ['télétravail', 'télétravail total'])} THEN 'TELETRAVAIL' ")]
    for at, rule in own:
        assert at in sql
        sql = sql.replace(at, rule + at)
    return sql


SQL["registered_rules"] = _with_own_rules(with_enriched("SELECT doc_id, contract_type, work_mode, internship_category FROM enriched"))

SQL["passed_through_fields"] = """
SELECT 'doc_id' AS field, CASE WHEN doc_id % 3 = 0 THEN 'BIGINT' ELSE 'STRING' END AS type, CAST(count(*) AS BIGINT) AS n, CAST(sum(doc_id) AS BIGINT) AS total
FROM documents WHERE doc_id % 4 = 0 GROUP BY ALL
UNION ALL SELECT 'reach', 'OBJECT<score: BIGINT, via: STRING>', CAST(count(*) AS BIGINT), CAST(sum(doc_id % 7) AS BIGINT) FROM documents WHERE doc_id % 4 = 0 AND doc_id % 3 <> 0"""

SQL["stream_capture_keyed"] = SQL["stream_capture"]
