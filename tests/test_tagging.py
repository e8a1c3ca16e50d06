import random
import re

from pyspark.sql import functions as F

from vacanta.functions import tagging as T
from vacanta.functions import vocab as V


def _python_tags(text):
    c = text.lower()
    roles, domains = [], []
    for d, kws in V.TAXONOMY.items():
        for k in kws:
            if re.search(r"\b" + re.escape(k) + r"\b", c):
                if d not in domains:
                    domains.append(d)
                if k not in roles:
                    roles.append(k)
    order = T.keywords_in_order(V.TAXONOMY)
    return sorted(roles, key=order.index), domains


def _tag(spark, texts):
    df = spark.createDataFrame([(i, t, "") for i, t in enumerate(texts)], "i int, title string, d string")
    out = T.tag_keywords(df, ["title", "d"]).select("i", "matched_roles", "matched_domains")
    return [(list(r[1]), list(r[2])) for r in sorted(out.collect())]


EDGES = [
    "Big Data Engineer",                       # keyword inside a longer one: both count
    "data-engineer and data\tengineer",        # hyphen and tab do not join words
    "data  engineer",                          # two blanks
    "dbt at start and ends with spark",
    "generative ai research scientist",        # keyword in two domains
    "data engineeré and édata engineer",       # accent next to a keyword
    "head of data engineering",                # prefix keyword at the same start
    "Head of Data, ML Engineer.",
    "",
]


def test_tagging_edges(spark):
    got = _tag(spark, EDGES)
    for text, (roles, domains) in zip(EDGES, got):
        exp_roles, exp_domains = _python_tags(text + " ")
        assert roles == exp_roles, text
        assert domains == exp_domains, text


def test_tagging_random_property(spark):
    rnd = random.Random(11)
    kws = T.keywords_in_order(V.TAXONOMY)
    glue = [" ", "  ", "-", ", ", "é", "x", "\n", " data ", " ai "]
    texts = ["".join(rnd.choice(kws + glue) + rnd.choice(glue) for _ in range(rnd.randint(0, 10)))
             for _ in range(400)]
    got = _tag(spark, texts)
    for text, (roles, domains) in zip(texts, got):
        assert (roles, domains) == _python_tags(text + " "), text


def test_primary_domain_null_safe(spark):
    df = spark.createDataFrame([(None,), ([],), (["DATA_SCIENCE", "AI_RESEARCH"],)], "d array<string>")
    got = [r[0] for r in df.select(T.primary_domain(F.col("d"))).collect()]
    assert got == ["NON_CLASSE", "NON_CLASSE", "DATA_SCIENCE"]


def test_taxonomy_table_roundtrip(spark):
    t = T.taxonomy_table(spark)
    assert t.count() == sum(len(v) for v in V.TAXONOMY.values())
    assert T.taxonomy_from_table(t) == V.TAXONOMY
