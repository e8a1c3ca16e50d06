"""Keyword tagging against a taxonomy table of any size.

:mod:`..functions.tagging` compiles a taxonomy into the plan (one regular expression, literal arrays), which suits a
few hundred keywords. Here the taxonomy stays a table. A keyword is a run of word tokens with what stands between
them, so a text's keywords are among its token n-grams. A text's words meet the distinct words that keywords begin with; only at
those places the n-grams of the lengths in question are made, and joined with the keywords by equality. A word meets
one such word and an n-gram one keyword at most, so no frequent word multiplies rows, and a text's finds are
gathered as a set before they move. No part of the taxonomy reaches the driver but the lengths and a count.

Semantics as ``tagging.tag_keywords``: lower-cased text, word boundaries on both sides, overlaps all count, keywords
in taxonomy order (domain_rank, keyword_rank of the first entry), domains in theirs. Keywords must begin and end with
a word character; :func:`unusable_keywords` lists those that don't. A null text has no keywords; ids name the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"(?U)\w+"
WORD_AND_GAP = r"(?U)\w+(\W*)"
#: Words that keywords begin with, up to which they go to every task.
BROADCAST_WORDS = 500_000
USABLE = r"(?U)^\w(.*\w)?$"


def unusable_keywords(taxonomy: DataFrame) -> DataFrame:
    """Entries that can't match: null, or without a word character at either end."""
    return taxonomy.filter(~F.coalesce(F.col("keyword").rlike("(?s)" + USABLE), F.lit(False)))


def keyword_index(taxonomy: DataFrame) -> DataFrame:
    """(keyword, n_tokens, place, domains): each distinct keyword with its number of word tokens, its first
    entry's (domain_rank, keyword_rank), and its domains as (domain_rank, domain)."""
    usable = taxonomy.filter(F.col("keyword").rlike("(?s)" + USABLE)).withColumn("keyword", F.lower("keyword"))
    return usable.groupBy("keyword").agg(
        F.min(F.struct("domain_rank", "keyword_rank")).alias("place"), F.collect_set(F.struct("domain_rank", "domain")).alias("domains"),
    ).withColumn("n_tokens", F.regexp_count("keyword", F.lit(WORD)))


def starts(index: DataFrame) -> DataFrame:
    """(word, lengths): the words that keywords begin with, each once, and the keywords' numbers of tokens."""
    return index.groupBy(F.regexp_extract("keyword", WORD, 0).alias("word")).agg(F.collect_set("n_tokens").alias("lengths"))


def _gram(n: int) -> Column:
    """The n-gram at a place, as it stands in the text; null where the text ends before it."""
    word = lambda k: F.get("_words", F.col("_at") + k)
    gap = lambda k: F.get("_gaps", F.col("_at") + k)
    return F.concat(*[x for k in range(n - 1) for x in (word(k), gap(k))], word(n - 1))


def _grams(lengths: list[int]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("n"), _gram(n).alias("gram")) for n in lengths]) if lengths else F.array().cast("array<struct<n:int,gram:string>>")


def tag_by_table(texts: DataFrame, taxonomy: DataFrame, id_col: str, text: Column) -> DataFrame:
    """``id_col``, ``matched_roles`` and ``matched_domains`` (arrays in taxonomy order) of every row of ``texts``."""
    index = keyword_index(taxonomy)
    lengths = sorted(r["n_tokens"] for r in index.select("n_tokens").distinct().collect())
    low = texts.select(F.col(id_col).alias("_id"), F.lower(text).alias("_low"))
    split = low.select("_id", F.regexp_extract_all("_low", F.lit(WORD), F.lit(0)).alias("_words"), F.regexp_extract_all("_low", F.lit(WORD_AND_GAP), F.lit(1)).alias("_gaps"))
    places = split.select("_id", "_words", "_gaps", F.posexplode_outer("_words").alias("_at", "word"))  # outer: else the words are made twice, once for an inferred filter
    first = starts(index)
    if first.count() <= BROADCAST_WORDS:
        begun = places.join(F.broadcast(first), "word")
    else:  # moved by its word, a place takes the n-grams along that may begin there, never its text's words
        begun = places.select("_id", "word", _grams(lengths).alias("_grams")).join(first, "word")
    grams = _grams(lengths) if "_grams" not in begun.columns else F.col("_grams")
    tried = begun.select("_id", "lengths", F.inline(grams)).filter(F.array_contains("lengths", F.col("n")) & F.col("gram").isNotNull()).select("_id", F.col("gram").alias("keyword"))
    found = tried.join(index.select("keyword", "place", "domains"), "keyword")
    tags = found.groupBy("_id").agg(F.sort_array(F.collect_set(F.struct("place", "keyword"))).alias("roles"), F.array_distinct(F.flatten(F.collect_set("domains"))).alias("domains"))
    none = F.array().cast("array<string>")
    return low.select(F.col("_id").alias(id_col)).join(tags, F.col(id_col) == F.col("_id"), "left").select(
        id_col, F.coalesce(F.transform("roles", lambda r: r["keyword"]), none).alias("matched_roles"),
        F.coalesce(F.transform(F.sort_array("domains"), lambda d: d["domain"]), none).alias("matched_domains"))
