"""Mapping of differently shaped source records to one canonical schema, and n-ary union.

A mapping spec is an ordered list of canonical column expressions over the
unnested record struct ``r``; mapping is one ``select`` per source and the union
is a fold of ``unionByName`` (strict: every source yields the same columns).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import vocab as V

CANONICAL_COLUMNS = ["source", "source_job_id", "raw_title", "company_name", "location_country",
                     "location_city", "publication_date", "raw_description", "raw_contract",
                     "matched_domains", "matched_roles"]

Spec = Callable[[], list[Column]]


def _r(path: str) -> Column:
    return F.col(f"r.{path}")


def api_spec(source: str = "adzuna_api", default_country: str = V.API_DEFAULT_COUNTRY) -> Spec:
    """API records: nested company/location, numeric or text id, ISO ``created``."""
    def spec() -> list[Column]:
        return [
            F.lit(source).alias("source"),
            _r("id").cast("string").alias("source_job_id"),
            _r("title").alias("raw_title"),
            F.coalesce(_r("company.display_name"), F.lit(V.UNSPECIFIED)).alias("company_name"),
            F.coalesce(C.first_or_null(_r("location.area")), F.lit(default_country)).alias("location_country"),
            F.coalesce(_r("location.display_name"), F.lit(V.UNSPECIFIED)).alias("location_city"),
            C.parse_timestamp(_r("created")).alias("publication_date"),
            F.coalesce(_r("description"), F.lit("")).alias("raw_description"),
            F.coalesce(_r("contract_type"), F.lit("")).alias("raw_contract"),
            _r("matched_domains").alias("matched_domains"),
            _r("matched_roles").alias("matched_roles"),
        ]
    return spec


def page_spec(source: str, city_field: bool, country: str = V.MOROCCO) -> Spec:
    """Page records: flat fields; the description is summary + metadata and the
    metadata doubles as contract text. Sources without a city field get the
    country literal as city."""
    def spec() -> list[Column]:
        city = F.coalesce(_r("location_city"), F.lit(country)) if city_field else F.lit(country)
        meta = F.coalesce(_r("raw_metadata"), F.lit(""))
        return [
            F.lit(source).alias("source"),
            _r("job_url").alias("source_job_id"),
            _r("title").alias("raw_title"),
            F.coalesce(_r("company"), F.lit(V.UNSPECIFIED)).alias("company_name"),
            F.lit(country).alias("location_country"),
            city.alias("location_city"),
            C.parse_timestamp(_r("scraped_at")).alias("publication_date"),
            F.concat_ws(" ", F.coalesce(_r("summary"), F.lit("")), meta).alias("raw_description"),
            meta.alias("raw_contract"),
            _r("matched_domains").alias("matched_domains"),
            _r("matched_roles").alias("matched_roles"),
        ]
    return spec


# source name -> (folder under the bronze root, spec)
DEFAULT_SPECS: dict[str, Spec] = {
    "adzuna_api": api_spec("adzuna_api"),
    "rekrute_scraper": page_spec("rekrute_scraper", city_field=False),
    "emploima_scraper": page_spec("emploima_scraper", city_field=True),
    "dreamjob_scraper": page_spec("dreamjob_scraper", city_field=True),
}


def unnest_records(envelopes: DataFrame) -> DataFrame:
    """One row ``r`` per element of ``records``; null or empty arrays give no rows."""
    return envelopes.select(F.explode("records").alias("r"))


def map_to_canonical(records: DataFrame, spec: Spec) -> DataFrame:
    """``records`` has a struct column ``r``; returns the canonical columns."""
    return records.select(*spec())


def union_sources(dfs: Sequence[DataFrame]) -> DataFrame:
    if not dfs:
        raise ValueError("no source could be loaded")
    return reduce(DataFrame.unionByName, dfs)
