"""A canonical ``postings`` view projected from the ``documents`` test table.

The supplied prose contains none of the domain vocabulary, so every document is
turned into one posting by column arithmetic: the whole document text becomes the
description, and job phrases (roles, durations, pay, work mode, contract words)
are attached by residues of ``doc_id`` / ``n_chars`` so that every branch of every
rule is exercised. Every document row is used; nothing is filtered or cut.

The phrases below are test-fixture vocabulary of this library (not values of the
original pipeline). The DuckDB oracle builds the same view from the same lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import tagging as T
from ..functions import vocab as V

# Title phrase by n_chars % 8 (several domains, one keyword in two domains, one without any).
TITLE_PHRASES = [
    "Senior Data Engineer (Spark, Kafka)",
    "Data Analyst Power BI / Tableau",
    "Machine Learning Engineer - NLP Engineer",
    "Stagiaire Data Scientist",
    "Generative AI Research Scientist",
    "Comptable confirmé",
    "Head of Data & Cloud Platform Engineer",
    "BI Developer, dbt and Airflow",
]

# Description phrase by doc_id % 24: durations, pay, work mode, category and contract words.
DESCRIPTION_PHRASES = [
    "Stage PFE de 6 mois, rémunéré, télétravail partiel.",
    "Internship of 10 weeks, unpaid, full remote.",
    "Alternance 12 mois, contrat pro, hybride.",
    "Stage d'été de 2 mois, gratification, remote.",
    "CDI, 100% télétravail, salaire attractif.",
    "CDD 18 mois, bénévole.",
    "Stage de 4 à 6 mois, non rémunéré.",
    "Freelance mission 3-5 months, stipend.",
    "Stage d'observation 1 mois.",
    "Durée indéterminée, sur site.",
    "Contrat à durée déterminée, 24 weeks.",
    "stage technique 2-3 months hybrid",
    "Summer internship 8 weeks, indemnité",
    "Projet de fin d'études, 5 mois",
    "apprentissage 0-0 mois",
    "1 week initiation découverte",
    "pré-embauche 6-month télétravail total",
    "end-of-study master thesis, 7 months, 100% remote",
    "",
    "Indépendant, remote partiel, data-engineer, data  engineer",
    "work-study apprenticeship 12-month",
    "Recrutement chez Atlas Digital à Casablanca - stage 3 mois",
    "ACME recrute Data Engineer pour Rabat : 6 mois, salary",
    "Salé ou Kénitra : intern, application web, 15 semaines, fin d'etude",
]

# Contract text by doc_id % 7.
CONTRACT_PHRASES = ["Stage", "Permanent", "Contract", "Internship", "", "CDI", "Freelance"]

# Country by language; city by n_chars % 14 (13 names and one missing).
COUNTRY_BY_LANG = {"fr": "Maroc", "en": "France", "de": "Deutschland", "es": "España"}
CITY_NONE = 13

# Publication text: doc_id % 37 == 5 -> null, == 11 -> malformed, == 17 -> impossible day.
DATE_NULL, DATE_BAD, DATE_IMPOSSIBLE = 5, 11, 17


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def publication_text(doc_id: Column) -> Column:
    day = F.date_add(F.lit("2024-01-01").cast("date"), (doc_id % 400).cast("int"))
    clock = F.format_string("%02d:%02d:00", (doc_id % 24).cast("int"), (doc_id % 60).cast("int"))
    stamp = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T"), clock)
    fmt = doc_id % 3
    iso = (F.when(fmt == 0, F.concat(stamp, F.lit("Z")))
            .when(fmt == 1, F.concat(stamp, F.lit(".123456+00:00")))
            .otherwise(F.concat(stamp, F.lit("+01:00"))))
    r = doc_id % 37
    return (F.when(r == DATE_NULL, F.lit(None).cast("string"))
             .when(r == DATE_BAD, F.lit("bientôt"))
             .when(r == DATE_IMPOSSIBLE, F.lit("2024-02-30T10:00:00Z"))
             .otherwise(iso))


def raw_postings(documents: DataFrame) -> DataFrame:
    """Canonical columns before tagging; ``created`` is the unparsed date text."""
    d = documents
    lang_country = F.coalesce(_country(F.col("lang")), F.lit(V.API_DEFAULT_COUNTRY))
    city_idx = F.col("n_chars") % 14
    return d.select(
        F.col("doc_id"),
        _pick(V.SOURCES, F.col("doc_id") % 4).alias("source"),
        F.when(F.col("doc_id") % 50 == 7, F.lit(None).cast("string"))
         .otherwise(F.col("doc_id").cast("string")).alias("source_job_id"),
        F.concat(_pick(TITLE_PHRASES, F.col("n_chars") % 8), F.lit(" - "),
                 F.split_part(F.col("text"), F.lit("\n"), F.lit(1))).alias("raw_title"),
        F.when(F.col("n_chars") % 20 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Entreprise "), F.upper(F.col("lang")), F.lit(" "),
                             (F.col("n_chars") % 20).cast("string"))).alias("company"),
        lang_country.alias("location_country"),
        F.when(city_idx == CITY_NONE, F.lit(None).cast("string"))
         .otherwise(_pick(V.TEXT_CITIES, city_idx)).alias("city"),
        publication_text(F.col("doc_id")).alias("created"),
        F.concat_ws(" ", F.col("text"), _pick(DESCRIPTION_PHRASES, F.col("doc_id") % 24)).alias("raw_description"),
        _pick(CONTRACT_PHRASES, F.col("doc_id") % 7).alias("raw_contract"),
    )


def _country(lang: Column) -> Column:
    expr = None
    for k, v in COUNTRY_BY_LANG.items():
        expr = F.when(lang == k, F.lit(v)) if expr is None else expr.when(lang == k, F.lit(v))
    return expr


def postings(documents: DataFrame, taxonomy=V.TAXONOMY) -> DataFrame:
    """Canonical (unified) rows as the silver job receives them, tagged at capture
    time over ``title + description``."""
    raw = raw_postings(documents)
    tagged = T.tag_keywords(raw, ["raw_title", "raw_description"], taxonomy)
    return tagged.select(
        "doc_id", "source", "source_job_id", "raw_title",
        F.coalesce(F.col("company"), F.lit(V.UNSPECIFIED)).alias("company_name"),
        "location_country",
        F.coalesce(F.col("city"), F.lit(V.UNSPECIFIED)).alias("location_city"),
        C.parse_timestamp(F.col("created")).alias("publication_date"),
        F.col("created"),
        "raw_description", "raw_contract", "matched_domains", "matched_roles",
    )
