"""DuckDB SQL for the correctness gate, written independently of the Spark plans.

DuckDB's regex engine (RE2) has an ASCII-only ``\\b`` and ASCII ``\\d``/``\\s``,
so word boundaries are spelled out with Unicode classes:
``\\b(w)\\b`` becomes ``(?:^|[^W])(?:w)(?:[^W]|$)`` with ``W`` the word
characters. The vocabularies come from :mod:`vacanta.functions.vocab` and the
fixture phrases from :mod:`vacanta.plans.postings`; the rule logic is re-stated
here in SQL.
"""

from __future__ import annotations

from ..functions import vocab as V
from . import postings as P

W = r"\p{L}\p{M}\p{Nd}\p{Pc}"
S = r"[\s\x{0B}\x{85}\p{Z}]"
D = r"\p{Nd}"

RUN_TS = "2026-10-01 02:00:00"
AS_OF = "2024-12-01"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def rx_escape(w: str) -> str:
    return "".join("\\" + c if c in "\\.^$|?*+()[]{}" else c for c in w)


def alt(words) -> str:
    return "(?:" + "|".join(rx_escape(w) for w in words) + ")"


def bounded(words) -> str:
    return f"(?:^|[^{W}]){alt(words)}(?:[^{W}]|$)"


def has(text: str, words) -> str:
    return f"regexp_matches({text}, {q(bounded(words))})"


def parse_ts(s: str) -> str:
    """ISO text to a UTC timestamp: an explicit offset or Z is applied, text without
    one is read as UTC (independent of the DuckDB session time zone)."""
    return (f"CASE WHEN regexp_matches({s}, '(Z|[+-][0-9]{{2}}:[0-9]{{2}})$') "
            f"THEN CAST(timezone('UTC', TRY_CAST({s} AS TIMESTAMPTZ)) AS TIMESTAMP) "
            f"ELSE TRY_CAST({s} AS TIMESTAMP) END")


def parse_wall_clock(s: str) -> str:
    head = f"replace(split_part({s}, '.', 1), 'Z', '')"
    return f"TRY_CAST(regexp_replace({head}, '[+-][0-9]{{2}}:[0-9]{{2}}$', '') AS TIMESTAMP)"


def recent(ts: str, as_of: str, days: int = 60) -> str:
    return (f"({ts} IS NULL OR floor((epoch_us(TIMESTAMP '{as_of}') - epoch_us({ts})) / 86400000000.0) <= {days})")


def pick(values, index_sql: str) -> str:
    return f"{lst(values)}[({index_sql}) + 1]"


# ---------------------------------------------------------------------------
# postings view
# ---------------------------------------------------------------------------

def publication_text_sql() -> str:
    stamp = ("strftime(DATE '2024-01-01' + CAST(doc_id % 400 AS INTEGER), '%Y-%m-%d') || 'T' || "
             "printf('%02d:%02d:00', doc_id % 24, doc_id % 60)")
    return (f"CASE WHEN doc_id % 37 = {P.DATE_NULL} THEN NULL "
            f"WHEN doc_id % 37 = {P.DATE_BAD} THEN 'bientôt' "
            f"WHEN doc_id % 37 = {P.DATE_IMPOSSIBLE} THEN '2024-02-30T10:00:00Z' "
            f"ELSE {stamp} || CASE doc_id % 3 WHEN 0 THEN 'Z' WHEN 1 THEN '.123456+00:00' ELSE '+01:00' END END")


def keywords() -> list[str]:
    seen: dict[str, None] = {}
    for ws in V.TAXONOMY.values():
        for w in ws:
            seen.setdefault(w, None)
    return list(seen)


def postings_cte() -> str:
    country = "CASE lang " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in P.COUNTRY_BY_LANG.items()) + " END"
    norm = (f"' ' || regexp_replace(lower(concat_ws(' ', coalesce(raw_title, ''), coalesce(raw_description, ''))), "
            f"'[^{W} ]', ' ' || chr(1) || ' ', 'g') || ' '")
    domain_hits = ", ".join(
        f"CASE WHEN list_has_any(roles, {lst(ws)}) THEN {q(d)} END" for d, ws in V.TAXONOMY.items())
    return f"""
raw_postings AS (
  SELECT doc_id,
    {pick(V.SOURCES, 'doc_id % 4')} AS source,
    CASE WHEN doc_id % 50 = 7 THEN NULL ELSE CAST(doc_id AS VARCHAR) END AS source_job_id,
    {pick(P.TITLE_PHRASES, 'n_chars % 8')} || ' - ' || split_part(text, chr(10), 1) AS raw_title,
    CASE WHEN n_chars % 20 = 0 THEN NULL
         ELSE 'Entreprise ' || upper(lang) || ' ' || CAST(n_chars % 20 AS VARCHAR) END AS company,
    coalesce({country}, {q(V.API_DEFAULT_COUNTRY)}) AS location_country,
    CASE WHEN n_chars % 14 = {P.CITY_NONE} THEN NULL ELSE {pick(V.TEXT_CITIES, 'n_chars % 14')} END AS city,
    {publication_text_sql()} AS created,
    concat_ws(' ', text, {pick(P.DESCRIPTION_PHRASES, 'doc_id % 24')}) AS raw_description,
    {pick(P.CONTRACT_PHRASES, 'doc_id % 7')} AS raw_contract
  FROM documents
),
normed AS (
  SELECT *, {norm} AS norm FROM raw_postings
),
roled AS (
  SELECT *, list_filter({lst(keywords())}, lambda k: contains(norm, ' ' || k || ' ')) AS roles FROM normed
),
tagged AS (
  SELECT *, list_filter([{domain_hits}], lambda x: x IS NOT NULL) AS domains FROM roled
),
postings AS (
  SELECT doc_id, source, source_job_id, raw_title,
    coalesce(company, {q(V.UNSPECIFIED)}) AS company_name,
    location_country,
    coalesce(city, {q(V.UNSPECIFIED)}) AS location_city,
    {parse_ts('created')} AS publication_date,
    created, raw_description, raw_contract,
    domains AS matched_domains,
    roles AS matched_roles
  FROM tagged
)"""


# ---------------------------------------------------------------------------
# silver rules
# ---------------------------------------------------------------------------

WEEKS = rf"(?:^|[^{W}])({D}+){S}*{alt(V.WEEK_UNITS)}(?:[^{W}]|$)"
RANGE = rf"({D}+){S}*{alt(V.RANGE_SEPARATORS)}{S}*({D}+){S}*{alt(V.MONTH_UNITS)}"
SINGLE = rf"(?:^|[^{W}])([1-9]|1[0-2]){S}*{alt(V.MONTH_UNITS)}(?:[^{W}]|$)"
DURATION_TEXT = rf"({D}+){S}*(?:à|-)?{S}*({D}+)?{S}*{alt(V.INGEST_MONTH_UNITS)}"


def group_int(text: str, pattern: str, g: int, typ: str = "INTEGER") -> str:
    return f"TRY_CAST(nullif(regexp_extract({text}, {q(pattern)}, {g}), '') AS {typ})"


def duration_sql(low: str) -> str:
    weeks = group_int(low, WEEKS, 1, "BIGINT")
    return (f"coalesce(CASE WHEN {weeks} IS NOT NULL THEN CAST(greatest(1, round_even({weeks} / 4.0, 0)) AS INTEGER) END, "
            f"{group_int(low, RANGE, 2)}, {group_int(low, SINGLE, 1)})")


def bracket_sql(m: str) -> str:
    b = V.DURATION_BRACKETS
    return (f"CASE WHEN {m} IS NULL THEN {q(b[0])} WHEN {m} < 2 THEN {q(b[1])} WHEN {m} <= 3 THEN {q(b[2])} "
            f"WHEN {m} <= 6 THEN {q(b[3])} ELSE {q(b[4])} END")


def category_sql(intern: str, m: str, low: str) -> str:
    return (f"CASE WHEN NOT coalesce({intern}, false) THEN NULL "
            f"WHEN {has(low, V.PFE_WORDS)} THEN 'PFE' "
            f"WHEN {has(low, V.CATEGORY_ALTERNANCE_WORDS)} THEN 'ALTERNANCE' "
            f"WHEN coalesce({m} = 1, false) OR {has(low, V.INITIATION_WORDS)} THEN 'STAGE_INITIATION' "
            f"WHEN coalesce({m} IN (2, 3), false) OR {has(low, V.APPLICATION_WORDS)} THEN 'STAGE_APPLICATION' "
            f"WHEN coalesce({m} >= 4, false) THEN 'PFE' ELSE 'STAGE_NON_SPECIFIE' END")


def work_mode_sql(low: str, hybrid=V.HYBRID_WORDS) -> str:
    return (f"CASE WHEN {has(low, V.FULL_REMOTE_WORDS)} THEN 'FULL_REMOTE' "
            f"WHEN {has(low, hybrid)} THEN 'HYBRID' "
            f"WHEN {has(low, V.REMOTE_WORDS)} THEN 'REMOTE_POSSIBLE' ELSE 'SUR_SITE' END")


def pay_sql(low: str, paid=V.PAID_WORDS) -> str:
    return (f"CASE WHEN {has(low, paid)} THEN true "
            f"WHEN {has(low, V.UNPAID_WORDS)} THEN false ELSE NULL END")


def enriched_cte(src: str = "postings") -> str:
    """Derived attributes (before de-duplication)."""
    return f"""
lowered AS (
  SELECT *, lower(concat_ws(' ', raw_title, raw_description, raw_contract)) AS low FROM {src}
),
flagged AS (
  SELECT *,
    coalesce({has('low', V.INTERNSHIP_WORDS)} OR {has('lower(raw_contract)', V.INTERNSHIP_CONTRACT_WORDS)}, false)
      AS is_internship,
    {duration_sql('low')} AS duration_months
  FROM lowered
),
enriched AS (
  SELECT *,
    CASE WHEN {has('low', V.ALTERNANCE_CONTRACT_WORDS)} THEN 'ALTERNANCE'
         WHEN is_internship THEN 'STAGE'
         WHEN {has('low', V.CDI_WORDS)} THEN 'CDI'
         WHEN {has('low', V.CDD_WORDS)} THEN 'CDD'
         WHEN {has('low', V.FREELANCE_WORDS)} THEN 'FREELANCE'
         ELSE 'NON_SPECIFIE' END AS contract_type,
    {bracket_sql('duration_months')} AS duration_bracket,
    {category_sql('is_internship', 'duration_months', 'low')} AS internship_category,
    {pay_sql('low')} AS is_remunerated,
    {work_mode_sql('low')} AS work_mode,
    lower(raw_title) AS job_title_clean,
    sha256(concat_ws('||', lower(raw_title), lower(company_name), lower(location_city))) AS job_fingerprint,
    coalesce(matched_domains[1], {q(V.UNCLASSIFIED_DOMAIN)}) AS primary_domain,
    TIMESTAMP '{RUN_TS}' AS ingested_at
  FROM flagged
)"""


def silver_cte() -> str:
    return f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY job_fingerprint
      ORDER BY publication_date DESC NULLS LAST, source ASC NULLS LAST, source_job_id ASC NULLS LAST) AS rn
  FROM enriched
),
silver AS (
  SELECT job_fingerprint, source, source_job_id, job_title_clean, company_name, location_country,
    location_city, publication_date, contract_type, is_internship, internship_category, duration_months,
    duration_bracket, is_remunerated, work_mode, primary_domain, matched_domains, matched_roles, ingested_at,
    CAST(coalesce(year(publication_date), {V.DEFAULT_YEAR}) AS INTEGER) AS year,
    CAST(coalesce(month(publication_date), {V.DEFAULT_MONTH}) AS INTEGER) AS month
  FROM ranked WHERE rn = 1
)"""


def with_silver(body: str, extra: str = "", src: str = "postings") -> str:
    return "WITH " + postings_cte() + "," + extra + enriched_cte(src) + "," + silver_cte() + "\n" + body


def with_postings(body: str) -> str:
    return "WITH " + postings_cte() + "\n" + body


def with_enriched(body: str) -> str:
    return "WITH " + postings_cte() + "," + enriched_cte() + "\n" + body

ORDERS_AS_OF = "1998-08-01 00:00:00"
EVENTS_AS_OF = "2024-03-10"
EVENTS_CUTOFF = "2024-01-20 00:00:00"
#: Deliveries of ``capture_versioned_state``: before the first, up to the second, from it on.
EVENTS_CUTS = ("2024-01-15 00:00:00", "2024-01-22 00:00:00")


# ---------------------------------------------------------------------------
# ingest-time rules
# ---------------------------------------------------------------------------

INGEST = {
    "api": dict(pfe=V.INGEST_PFE_WORDS_API, stage=V.INGEST_STAGE_WORDS_API, alt=V.INGEST_ALTERNANCE_WORDS_API,
                paid=V.INGEST_PAID_WORDS_API, hybrid=V.INGEST_HYBRID_WORDS_API, contract=True),
    "page_a": dict(pfe=V.INGEST_PFE_WORDS_API, stage=V.INGEST_STAGE_WORDS_PAGES, alt=V.INGEST_ALTERNANCE_WORDS_PAGES,
                   paid=V.INGEST_PAID_WORDS_PAGES, hybrid=V.HYBRID_WORDS, contract=False),
    "page_b": dict(pfe=V.INGEST_PFE_WORDS_PAGES, stage=V.INGEST_STAGE_WORDS_PAGES, alt=V.INGEST_ALTERNANCE_WORDS_PAGES,
                   paid=V.INGEST_PAID_WORDS_PAGES, hybrid=V.HYBRID_WORDS, contract=False),
}
INGEST["page_c"] = INGEST["page_b"]
SOURCE_PRESET = dict(zip(V.SOURCES, ["api", "page_a", "page_b", "page_c"]))


def _per_source(fn) -> str:
    return "CASE source " + " ".join(f"WHEN {q(src)} THEN {fn(INGEST[p])}" for src, p in SOURCE_PRESET.items()) + " END"


def ingest_type_sql(low: str, contract: str) -> str:
    def one(p):
        stage = has(low, p["stage"])
        if p["contract"]:
            stage = f"({stage} OR coalesce(contains(lower({contract}), 'intern'), false))"
        return (f"CASE WHEN {has(low, p['pfe'])} THEN 'STAGE_PFE' WHEN {stage} THEN 'STAGE' "
                f"WHEN {has(low, p['alt'])} THEN 'ALTERNANCE' ELSE 'CDI_OR_OTHER' END")
    return _per_source(one)


def ingest_pay_sql(low: str) -> str:
    return _per_source(lambda p: pay_sql(low, p["paid"]))


def ingest_mode_sql(low: str) -> str:
    return _per_source(lambda p: work_mode_sql(low, p["hybrid"]))


def ingest_cte(src: str = "raw_postings") -> str:
    low = "lower(concat_ws(' ', coalesce(raw_title, ''), coalesce(raw_description, '')))"
    return f"""
ingest_low AS (SELECT *, {low} AS ilow FROM {src}),
ingest AS (
  SELECT *, {ingest_type_sql('ilow', 'raw_contract')} AS internship_type,
    {ingest_pay_sql('ilow')} AS ingest_pay,
    {ingest_mode_sql('ilow')} AS ingest_mode,
    nullif(regexp_extract(ilow, {q(DURATION_TEXT)}, 0), '') AS internship_duration
  FROM ingest_low
)"""


# ---------------------------------------------------------------------------
# facts parsed out of free text
# ---------------------------------------------------------------------------

def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{S}+|{S}+$', '', 'g')"


COMPANY = (r"(?i)" + alt(V.COMPANY_VERBS) + S + r"+(?:chez" + S + r"+)?([A-Za-z0-9\s\x{0B}\x{85}\p{Z}&]+?)"
           r"(?:" + "|".join(S + "+" + w for w in V.COMPANY_STOPS) + "|" + S + r"*-|" + S + r"*:|$)")


def company_sql(t: str) -> str:
    name = strip_sql(f"regexp_extract({strip_sql(t)}, {q(COMPANY)}, 1)")
    return f"CASE WHEN length({name}) > 2 AND length({name}) < 40 THEN {name} ELSE {q(V.UNSPECIFIED)} END"


def city_sql(t: str) -> str:
    whens = " ".join(
        f"WHEN regexp_matches({t}, {q('(?i)(?:^|[^' + W + '])' + rx_escape(c) + '(?:[^' + W + ']|$)')}) THEN {q(c)}"
        for c in V.TEXT_CITIES)
    return f"CASE {whens} ELSE {q(V.MOROCCO)} END"
EVENTS_FUTURE_AS_OF = "2024-01-15"
CAPTURE_AS_OF = "2024-08-01"
