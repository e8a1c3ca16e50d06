"""Multi-label keyword tagging (text x taxonomy) in one regex pass, without a join.

A keyword matches when it occurs in the lower-cased text with a word boundary on
both sides (``\\bdata engineer\\b``); overlapping keywords all count, a longer
keyword does not hide a shorter one. All keywords are found together by the
word index of :mod:`vacanta.functions.rules`: a zero-width look-ahead at every
word boundary captures the longest keyword starting there (the alternation is a
character trie, so non-matching positions are rejected after a few character
comparisons). Keywords that are word-prefixes of a found longer keyword are
implied. ``array_intersect`` with the taxonomy-ordered keyword literal yields the
roles in taxonomy order; a domain is present when its keyword list overlaps.

Everything is a built-in expression in one projection: no shuffle, no Python,
no higher-order function, small generated code.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules as R
from . import vocab as V

_KEYWORD_SHAPE = re.compile(r"^[^\s]+( [^\s]+)*$")


def keywords_in_order(taxonomy: dict[str, list[str]]) -> list[str]:
    """Distinct keywords, first occurrence order."""
    seen: dict[str, None] = {}
    for words in taxonomy.values():
        for w in words:
            seen.setdefault(w, None)
    return list(seen)


def check_taxonomy(taxonomy: dict[str, list[str]]) -> None:
    bad = [w for w in keywords_in_order(taxonomy) if not _KEYWORD_SHAPE.match(w) or w != w.lower()]
    if bad:
        raise ValueError(f"keywords must be lower-case words separated by single blanks: {bad[:5]}")


def _lit_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def implied_by_longer(keywords: list[str], vocabulary: list[str]) -> dict[str, list[str]]:
    out = {}
    for k in keywords:
        longer = R.with_implying([k], vocabulary)[1:]
        if longer:
            out[k] = longer
    return out


def matched_roles(words: R.Words, taxonomy: dict[str, list[str]] = V.TAXONOMY) -> Column:
    """array<string> of keywords found, in taxonomy order, each once."""
    kws = keywords_in_order(taxonomy)
    found = words.found
    for short, longer in implied_by_longer(kws, words.vocabulary).items():
        found = F.array_union(found, F.when(F.arrays_overlap(found, _lit_array(longer)), _lit_array([short]))
                              .otherwise(F.array().cast("array<string>")))
    return F.array_intersect(_lit_array(kws), found)


def matched_domains(roles: Column, taxonomy: dict[str, list[str]] = V.TAXONOMY) -> Column:
    """array<string> of domains with at least one matched keyword, in taxonomy order."""
    parts = [F.when(F.arrays_overlap(roles, _lit_array(words)), F.lit(domain)) for domain, words in taxonomy.items()]
    joined = F.concat_ws(R.SEP, *parts)
    return F.when(joined == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(joined, R.SEP))


def primary_domain(domains: Column, default: str = V.UNCLASSIFIED_DOMAIN) -> Column:
    """First domain, or ``default`` for a null or empty array (``F.get`` is null-safe)."""
    return F.coalesce(F.get(domains, 0), F.lit(default))


def capture_text(text_cols: list[str]) -> Column:
    """Lower-cased blank-joined text of the columns (nulls as empty strings)."""
    return F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in text_cols]))


def tag_keywords(df: DataFrame, text_cols: list[str], taxonomy: dict[str, list[str]] = V.TAXONOMY,
                 roles_col: str = "matched_roles", domains_col: str = "matched_domains",
                 words: R.Words | None = None) -> DataFrame:
    """Add ``matched_roles`` and ``matched_domains`` computed over the blank-joined
    ``text_cols`` (title first, as at capture time). Pass ``words`` to reuse a word
    index that already covers the taxonomy keywords (one text pass for tags and rules)."""
    check_taxonomy(taxonomy)
    kws = keywords_in_order(taxonomy)
    own = words is None or not all(k in words.vocabulary for k in kws)
    if own:
        df, words = R.with_words(df, capture_text(text_cols), name="_tag", vocabulary=kws)
    out = df.withColumn(roles_col, matched_roles(words, taxonomy))
    out = out.withColumn(domains_col, matched_domains(F.col(roles_col), taxonomy))
    return out.drop("_tag", "_tag_found") if own else out


def taxonomy_table(spark, taxonomy: dict[str, list[str]] = V.TAXONOMY):
    """The taxonomy as a table ``(domain_rank, domain, keyword_rank, keyword)``."""
    rows = [(d_rank, domain, k_rank, kw)
            for d_rank, (domain, words) in enumerate(taxonomy.items(), start=1)
            for k_rank, kw in enumerate(words, start=1)]
    return spark.createDataFrame(rows, "domain_rank int, domain string, keyword_rank int, keyword string")


def taxonomy_from_table(df: DataFrame) -> dict[str, list[str]]:
    """Ordered ``{domain: [keywords]}`` from a taxonomy table. The taxonomy is a setting of
    the job (it becomes one regex and literal arrays), not data that grows with the input."""
    out: dict[str, list[str]] = {}
    for r in df.orderBy("domain_rank", "keyword_rank").collect():
        out.setdefault(r["domain"], []).append(r["keyword"])
    return out
