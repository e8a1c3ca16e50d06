"""The taxonomy as a table: against the compiled one and against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vacanta.functions import tagging as T
from vacanta.functions import vocab as V
from vacanta.operators import keyword_join
from vacanta.operators.keyword_join import tag_by_table, unusable_keywords

ENTRIES = "domain_rank int, domain string, keyword_rank int, keyword string"


def tags(spark, texts, entries):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumn("keyword", F.lit("clash")).withColumn("domain", F.lit("clash"))
    out = tag_by_table(df, spark.createDataFrame(entries, ENTRIES), "id", F.col("text"))
    assert out.columns == ["id", "matched_roles", "matched_domains"]
    return [(r.matched_roles, r.matched_domains) for r in out.orderBy("id").collect()]


def brute(texts, entries):
    out = []
    for t in texts:
        hit = {e[3].lower() for e in entries if t is not None and re.search(r"\b" + re.escape(e[3].lower()) + r"\b", t.lower())}
        order = sorted((e for e in entries if e[3].lower() in hit), key=lambda e: e[:3:2])
        out.append((list(dict.fromkeys(e[3].lower() for e in order)), list(dict.fromkeys(e[1] for e in sorted(order)))))
    return out


def test_random_texts_and_taxonomies(spark):
    rnd = random.Random(4)
    piece = ["data", "engineer", "a", "b", "é", "ci", "cd", "x_1", "42"]
    gap = [" ", " ", " ", "/", ".", "  ", "\n", "-"]
    make = lambda n: "".join(rnd.choice(piece) + rnd.choice(gap) for _ in range(n - 1)) + rnd.choice(piece)
    words = sorted({make(rnd.randint(1, 4)) for _ in range(120)})
    entries = [(1 + k % 5, f"D{1 + k % 5}", k, w.upper() if k % 7 == 0 else w) for k, w in enumerate(words)] + [(9, "D9", 1, words[0])]
    texts = [rnd.choice(["", " ", "/", "«"]) + make(rnd.randint(1, 30)) + rnd.choice(["", ".", " "]) for _ in range(150)] + [None, "", " . ", "DATA Engineer"]
    assert tags(spark, texts, entries) == brute(texts, entries)


def test_equal_to_the_compiled_taxonomy(spark):
    rnd = random.Random(6)
    kws = T.keywords_in_order(V.TAXONOMY)
    texts = [" ".join(rnd.choice(kws) if rnd.random() < 0.3 else rnd.choice(["une", "data", "the", "and-", "(lead)"]) for _ in range(25)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    plain = T.tag_keywords(df, ["text"]).orderBy("id").collect()
    joined = tag_by_table(df, T.taxonomy_table(spark), "id", F.col("text")).orderBy("id").collect()
    assert [(r.matched_roles, r.matched_domains) for r in plain] == [(r.matched_roles, r.matched_domains) for r in joined]
    assert sum(len(r.matched_roles) for r in joined) > 60


def test_keywords_that_can_not_match_are_listed(spark):
    entries = [(1, "D", 1, "c++"), (1, "D", 2, ".net"), (1, "D", 3, None), (1, "D", 4, ""), (1, "D", 5, "c"), (1, "D", 6, "node.js")]
    bad = [r.keyword for r in unusable_keywords(spark.createDataFrame(entries, ENTRIES)).orderBy("keyword_rank").collect()]
    assert bad == ["c++", ".net", None, ""]
    assert tags(spark, ["we use c++ and node.js", "nodejs"], entries) == [(["c", "node.js"], ["D"]), ([], [])]


@pytest.mark.parametrize("entries", [[], [(1, "D", 1, "+")]])
def test_empty_taxonomy_and_empty_table(spark, entries):
    assert tags(spark, ["a b", None], entries) == [([], []), ([], [])]
    none = spark.createDataFrame([], "id int, text string")
    assert tag_by_table(none, spark.createDataFrame([(1, "D", 1, "a")], ENTRIES), "id", F.col("text")).count() == 0


def test_one_long_text_and_a_keyword_in_every_row(spark):
    texts = ["hot word " * 5000 + "rare"] + ["hot word"] * 3000
    got = tags(spark, texts, [(1, "D", 1, "hot word"), (2, "E", 1, "word hot"), (3, "G", 1, "rare")])
    assert got[0] == (["hot word", "word hot", "rare"], ["D", "E", "G"]) and set(map(str, got[1:])) == {str((["hot word"], ["D"]))}


@pytest.mark.parametrize("limit", [0, 500_000])
def test_first_words_of_any_number(spark, monkeypatch, limit):
    """Broadcast or moved by the word; only lengths that keywords with that first word have make n-grams."""
    monkeypatch.setattr(keyword_join, "BROADCAST_WORDS", limit)
    entries = [(1, "D", 1, "data"), (1, "D", 2, "Data lake"), (2, "E", 1, "big data lake"), (2, "E", 2, "lake/data"), (3, "F", 1, "data")]
    texts = ["a big data lake/data", "data  lake", "lake data", "big data", "", None, "big", "big-data lake. data lake"]
    assert tags(spark, texts, entries) == brute(texts, entries)
    index = keyword_join.keyword_index(spark.createDataFrame(entries, ENTRIES))
    assert {r.word: sorted(r.lengths) for r in keyword_join.starts(index).collect()} == {"data": [1, 2], "big": [3], "lake": [2]}
