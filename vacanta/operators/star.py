"""Star schema: dimensions with dense keys, facts joined to them, and a layer summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as V
from . import key_registry
from .keys import dense_key


def dim_company(silver: DataFrame) -> DataFrame:
    counts = silver.groupBy("company_name").agg(F.count("job_fingerprint").alias("total_jobs_posted"))
    keyed = dense_key(counts, ["company_name"], "company_id", distinct=False)
    return keyed.select("company_id", "company_name", "total_jobs_posted")


def dim_location(silver: DataFrame, home_country: str = V.MOROCCO) -> DataFrame:
    keyed = dense_key(silver, ["location_country", "location_city"], "location_id")
    return keyed.select(
        "location_id", "location_country", "location_city",
        F.coalesce(F.col("location_country") == F.lit(home_country), F.lit(False)).alias("is_morocco"))


def dim_taxonomy(silver: DataFrame, default_role: str = V.DEFAULT_ROLE) -> DataFrame:
    """Distinct (primary domain, role) pairs; a posting without roles gives one pair
    with the default role. Roles are paired with the posting's primary domain."""
    pairs = (silver.select(F.col("primary_domain").alias("domain"),
                           F.explode_outer("matched_roles").alias("role_keyword"))
                   .withColumn("role_keyword", F.coalesce("role_keyword", F.lit(default_role))))
    return dense_key(pairs, ["domain", "role_keyword"], "taxonomy_id").select("taxonomy_id", "domain", "role_keyword")


def with_keys(silver: DataFrame, companies: DataFrame, locations: DataFrame) -> DataFrame:
    """``silver`` with the dimensions' keys. No broadcast hint: the dimensions' real sizes are
    known to the adaptive planner, which broadcasts small ones and splits skewed partitions of
    the fact side (placeholder companies and cities are hot) otherwise."""
    return (silver.join(companies.select("company_name", "company_id"), "company_name", "left")
                  .join(locations.select("location_country", "location_city", "location_id"),
                        ["location_country", "location_city"], "left"))


def fact_job_postings(silver: DataFrame, companies: DataFrame, locations: DataFrame) -> DataFrame:
    return with_keys(silver, companies, locations).select(
        "job_fingerprint", "source",
        F.col("source_job_id").alias("job_url"),
        F.col("job_title_clean").alias("job_title"),
        "company_id", "location_id",
        F.to_date("publication_date").alias("publication_date"),
        "contract_type", "work_mode", "is_internship", "is_remunerated", "primary_domain",
        "year", "month")


def fact_internships(silver: DataFrame, companies: DataFrame, locations: DataFrame) -> DataFrame:
    """Internship data mart; the filter runs before the joins (and reaches the scan)."""
    interns = silver.filter(F.col("is_internship"))
    return with_keys(interns, companies, locations).select(
        "job_fingerprint", "source",
        F.col("source_job_id").alias("job_url"),
        F.col("job_title_clean").alias("job_title"),
        "company_id", "location_id",
        F.to_date("publication_date").alias("publication_date"),
        "internship_category", "duration_months", "duration_bracket", "is_remunerated",
        "work_mode", "primary_domain", "year", "month")


DIMENSIONS = ("dim_company", "dim_location", "dim_taxonomy")


def registered_dimensions(silver: DataFrame, root: str, home_country: str = V.MOROCCO, default_role: str = V.DEFAULT_ROLE) -> dict[str, DataFrame]:
    """The three dimensions with the keys that the registries under ``root`` hold, extended by the
    members seen for the first time. Members that silver no longer has stay, with no postings."""
    counts = silver.groupBy("company_name").agg(F.count("job_fingerprint").alias("total_jobs_posted"))
    companies = key_registry.extend(counts, f"{root}/company", ["company_name"], "company_id")
    named = counts.withColumnRenamed("company_name", "_name")
    companies = companies.join(named, F.col("company_name").eqNullSafe(F.col("_name")), "left").select(
        "company_id", "company_name", F.coalesce("total_jobs_posted", F.lit(0)).alias("total_jobs_posted"))
    places = key_registry.extend(silver, f"{root}/location", ["location_country", "location_city"], "location_id")
    places = places.select("location_id", "location_country", "location_city", F.coalesce(F.col("location_country") == F.lit(home_country), F.lit(False)).alias("is_morocco"))
    pairs = silver.select(F.col("primary_domain").alias("domain"), F.explode_outer("matched_roles").alias("role_keyword"))
    pairs = pairs.withColumn("role_keyword", F.coalesce("role_keyword", F.lit(default_role)))
    roles = key_registry.extend(pairs, f"{root}/taxonomy", ["domain", "role_keyword"], "taxonomy_id").select("taxonomy_id", "domain", "role_keyword")
    return {"dim_company": companies, "dim_location": places, "dim_taxonomy": roles}


GOLD = ("dim_company", "dim_location", "dim_taxonomy", "fact_job_postings", "fact_internships_pfe")


def build_gold(silver: DataFrame, names=GOLD) -> dict[str, DataFrame]:
    """The tables in ``names``; dimensions that none of them needs aren't built."""
    facts = {"fact_job_postings": fact_job_postings, "fact_internships_pfe": fact_internships}
    need = lambda dim: dim in names or any(f in names for f in facts)
    companies = dim_company(silver) if need("dim_company") else None
    locations = dim_location(silver) if need("dim_location") else None
    out = {"dim_company": companies, "dim_location": locations}
    if "dim_taxonomy" in names:
        out["dim_taxonomy"] = dim_taxonomy(silver)
    out |= {name: make(silver, companies, locations) for name, make in facts.items() if name in names}
    return {name: out[name] for name in names}


def layer_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: (table, rows). Counts are computed by Spark, unioned, and
    returned as a DataFrame rather than printed."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
