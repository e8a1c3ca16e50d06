"""Rule tables: one case per branch plus the traps, and a property check against
an independent evaluation with Python's ``re`` (the semantics the rules define)."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vacanta.functions import rules as R
from vacanta.functions import vocab as V


def _eval(spark, texts, fn, indexed=False):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    low = F.lower(F.col("t"))
    if indexed:
        df, w = R.with_words(df, low)
        col = fn(w)
    else:
        col = fn(low)
    return [r[1] for r in sorted(df.select("i", col.alias("v")).collect())]


DURATIONS = [
    ("24 weeks", 6), ("10 weeks", 2), ("6 semaines", 2), ("1 week", 1), ("4 à 6 mois", 6),
    ("2-3 months", 3), ("6-month", 6), ("12 mois", 12), ("18 mois", None), ("0-0 mois", 0),
    ("", None), (None, None), ("stage de 3 mois", 3), ("3 to 5 months", 5), ("13 months", None),
    ("x12-3 months", 3), ("2 weekly", None),
]


@pytest.mark.parametrize("text,expected", DURATIONS)
def test_duration_months(spark, text, expected):
    assert _eval(spark, [text], R.duration_months) == [expected]


def test_duration_bracket(spark):
    df = spark.createDataFrame([(m,) for m in [None, 0, 1, 2, 3, 4, 6, 7]], "m int")
    got = [r[0] for r in df.select(R.duration_bracket(F.col("m"))).collect()]
    b = V.DURATION_BRACKETS
    assert got == [b[0], b[1], b[1], b[2], b[2], b[3], b[3], b[4]]


@pytest.mark.parametrize("indexed", [False, True])
def test_remuneration_order(spark, indexed):
    texts = ["stage rémunéré", "stage non rémunéré", "unpaid internship", "rien", "gratification"]
    assert _eval(spark, texts, R.remuneration, indexed) == [True, True, False, None, True]


@pytest.mark.parametrize("indexed", [False, True])
def test_work_mode(spark, indexed):
    texts = ["full remote", "100% télétravail", "hybride", "télétravail partiel", "remote possible", "", "sur site"]
    assert _eval(spark, texts, R.work_mode, indexed) == [
        "FULL_REMOTE", "FULL_REMOTE", "HYBRID", "HYBRID", "REMOTE_POSSIBLE", "SUR_SITE", "SUR_SITE"]


@pytest.mark.parametrize("indexed", [False, True])
def test_contract_type(spark, indexed):
    texts = ["alternance", "stage data", "cdi", "durée indéterminée", "cdd", "durée déterminée", "freelance",
             "indépendant", "autre"]
    def fn(w):
        return R.contract_type(w, R.is_internship(w, F.lit("")))
    assert _eval(spark, texts, fn, indexed) == [
        "ALTERNANCE", "STAGE", "CDI", "CDI", "CDD", "CDD", "FREELANCE", "FREELANCE", "NON_SPECIFIE"]


@pytest.mark.parametrize("indexed", [False, True])
def test_internship_category(spark, indexed):
    rows = [(False, None, "pfe"), (True, None, "projet pfe"), (True, None, "alternance"), (True, 1, "x"),
            (True, None, "découverte"), (True, 3, "x"), (True, None, "stage d'été"), (True, 5, "x"),
            (True, 0, "x"), (True, None, "x")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, b boolean, m int, t string")
    low = F.lower(F.col("t"))
    if indexed:
        df, w = R.with_words(df, low)
    else:
        w = low
    got = [r[1] for r in sorted(df.select("i", R.internship_category(F.col("b"), F.col("m"), w)).collect())]
    assert got == [None, "PFE", "ALTERNANCE", "STAGE_INITIATION", "STAGE_INITIATION", "STAGE_APPLICATION",
                   "STAGE_APPLICATION", "PFE", "STAGE_NON_SPECIFIE", "STAGE_NON_SPECIFIE"]


def _python_has(words, text):
    return re.search(r"\b(" + "|".join(re.escape(w) for w in words) + r")\b", text) is not None


PIECES = (V.PAID_WORDS + V.UNPAID_WORDS + V.FULL_REMOTE_WORDS + V.HYBRID_WORDS + V.REMOTE_WORDS
          + V.PFE_WORDS + V.APPLICATION_WORDS + ["x", "é", "-", "'", " ", "  ", "\t", ".", "interne", "stages",
                                                 "non", "d'", "ab", "1", "%"])


def test_word_index_equals_regex_semantics(spark):
    """One-pass word index == one regex per rule == Python re, on random strings."""
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(PIECES) + rnd.choice(["", " ", "-", ",", "é"]) for _ in range(rnd.randint(0, 12)))
             for _ in range(600)]
    lists = [V.PAID_WORDS, V.UNPAID_WORDS, V.FULL_REMOTE_WORDS, V.HYBRID_WORDS, V.REMOTE_WORDS, V.PFE_WORDS,
             V.APPLICATION_WORDS, V.INTERNSHIP_WORDS]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    df, w = R.with_words(df, F.lower(F.col("t")))
    cols = []
    for j, words in enumerate(lists):
        cols += [R.has_words(w, words).alias(f"ix{j}"), R.has_words(F.col("_low"), words).alias(f"rx{j}")]
    rows = sorted(df.select("i", *cols).collect())
    for r in rows:
        t = texts[r["i"]].lower()
        for j, words in enumerate(lists):
            expected = _python_has(words, t)
            assert r[f"ix{j}"] == expected, (t, words)
            assert r[f"rx{j}"] == expected, (t, words)


def test_duration_property(spark):
    rnd = random.Random(3)
    pieces = ["1", "2", "6", "10", "12", "18", " ", "à", "-", "to", "mois", "months", "month", "-month", "weeks",
              "semaine", "x", "é", "  "]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 8))) for _ in range(500)]

    # (pattern, group, to_months) tried in order; the first pattern found decides
    steps = [
        (r"\b(\d+)\s*(?:semaines|semaine|weeks|week|-week)\b", 1, lambda n: max(1, round(n / 4))),
        (r"(\d+)\s*(?:à|-|to)\s*(\d+)\s*(?:mois|months|month|-month)", 2, lambda n: n),
        (r"\b([1-9]|1[0-2])\s*(?:mois|months|month|-month)\b", 1, lambda n: n),
    ]

    def python_duration(c):
        for pattern, group, to_months in steps:
            hit = re.search(pattern, c)
            if hit:
                return to_months(int(hit.group(group)))
        return None

    got = _eval(spark, texts, R.duration_months)
    assert got == [python_duration(t.lower()) if t else None for t in texts]


def test_city_and_company_from_text(spark):
    texts = ["Offre à casablanca et Rabat", "RABAT puis Fès", "rien", "Atlas recrute chez Acme Corp à Tanger",
             "recrutement AB - x", "Recrute Data Engineer pour Oujda"]
    cities = _eval(spark, texts, lambda c: R.first_listed(F.col("t")))
    assert cities == ["Casablanca", "Rabat", "Maroc", "Tanger", "Maroc", "Oujda"]
    companies = _eval(spark, texts, lambda c: R.company_from_text(F.col("t")))
    assert companies == ["Non spécifié", "Non spécifié", "Non spécifié", "Acme Corp", "Non spécifié", "Data"]  # " En" of "Engineer" ends the name (case-insensitive)


def test_ingest_presets_differ(spark):
    texts = ["un fin d'études", "intern", "contrat pro", "salary ok", "remote partiel"]
    df = spark.createDataFrame([(i, t, s) for i, t in enumerate(texts) for s in ["adzuna_api", "rekrute_scraper",
                                                                                 "emploima_scraper"]],
                               "i int, t string, source string")
    df, w = R.with_words(df, F.lower(F.col("t")))
    m = R.ingest_attributes_by_source(w, F.col("source"), F.lit(""))
    got = {(r.i, r.source): (r.m.internship_type, r.m.is_remunerated, r.m.work_mode)
           for r in df.select("i", "source", m.alias("m")).collect()}
    assert got[(0, "adzuna_api")][0] == "CDI_OR_OTHER"          # API and page A lack "fin d'études"
    assert got[(0, "rekrute_scraper")][0] == "CDI_OR_OTHER"
    assert got[(0, "emploima_scraper")][0] == "STAGE_PFE"
    assert got[(1, "adzuna_api")][0] == "STAGE" and got[(1, "rekrute_scraper")][0] == "CDI_OR_OTHER"
    assert got[(2, "adzuna_api")][0] == "ALTERNANCE" and got[(2, "emploima_scraper")][0] == "CDI_OR_OTHER"
    assert got[(3, "adzuna_api")][1] is True and got[(3, "rekrute_scraper")][1] is None
    assert got[(4, "adzuna_api")][2] == "HYBRID" and got[(4, "rekrute_scraper")][2] == "REMOTE_POSSIBLE"


def test_fingerprint_variants(spark):
    from vacanta.functions import columns as C

    rows = [("Data Engineer", "Acme", "Rabat"), ("DATA ENGINEER", "acme", "RABAT"), ("Data Engineer ", "Acme", "Rabat"),
            (None, "Acme", "Rabat")]
    df = spark.createDataFrame(rows, "t string, c string, l string")
    fps = [r[0] for r in df.select(C.fingerprint(F.col("t"), F.col("c"), F.col("l"))).collect()]
    assert fps[0] == fps[1]                    # case-only variants share a key
    assert fps[0] != fps[2]                    # no trimming: a trailing blank differs
    import hashlib
    assert fps[3] == hashlib.sha256("acme||rabat".encode()).hexdigest()   # a null part leaves no slot


def test_recency_edges(spark):
    from vacanta.functions import columns as C

    texts = ["2024-01-01T00:00:00Z", "2023-12-31T23:59:59Z", "2023-12-31T00:00:00Z", None, "not a date",
             "2024-01-01T10:00:00+05:00", "2024-03-05T00:00:00", "2024-01-01T00:00:00.5+02:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    ts = C.parse_wall_clock(F.col("t"))
    got = [r[1] for r in sorted(df.select("i", C.recent(ts, "2024-03-01 00:00:00", 60)).collect())]
    # 60 whole days kept, 61 dropped; null and malformed kept; offsets overwritten (wall clock); future kept
    assert got == [True, True, False, True, True, True, True, True]
    wall = [r[1] for r in sorted(df.select("i", ts.cast("string")).collect())]
    assert wall[5] == "2024-01-01 10:00:00" and wall[7] == "2024-01-01 00:00:00"


def test_contract_boundary_trap(spark):
    got = _eval(spark, ["durée indéterminée", "durée déterminée"], lambda c: R.has_words(c, V.CDD_WORDS))
    assert got == [False, True]
    got = _eval(spark, ["durée indéterminée", "durée déterminée"], lambda w: R.has_words(w, V.CDD_WORDS), True)
    assert got == [False, True]


def test_rules_are_replaceable_data(spark):
    import dataclasses

    from vacanta.plans import silver as S

    rows = [("Data role", "salary and télétravail flexible", "CDI")]
    df = spark.createDataFrame(rows, "raw_title string, raw_description string, raw_contract string")
    df = df.withColumn("company_name", F.lit("x")).withColumn("location_city", F.lit("y")).withColumn(
        "matched_domains", F.array().cast("array<string>"))
    base = S.derive_attributes(df, "2026-10-01 00:00:00").first()
    assert base.is_remunerated is None and base.work_mode == "REMOTE_POSSIBLE"
    custom = dataclasses.replace(R.DEFAULT_RULES, paid=R.DEFAULT_RULES.paid + ("salary",),
                                 hybrid=("télétravail flexible",))
    got = S.derive_attributes(df, "2026-10-01 00:00:00", custom).first()
    assert got.is_remunerated is True and got.work_mode == "HYBRID"


def test_registered_rules(spark):
    from vacanta.plans import silver as S

    rows = [(0, "CDI poste"), (1, "mission longue en CDI"), (2, "mission"), (3, "zone franche"), (4, "stage mission"), (5, None)]
    df = spark.createDataFrame(rows, "i int, raw_description string").selectExpr(
        "i", "raw_description", "'t' raw_title", "cast(null as string) raw_contract", "'c' company_name", "'x' location_city", "array('D') matched_domains", "array('r') matched_roles")
    labels = lambda rules: [r.contract_type for r in S.derive_attributes(df, "2024-01-01 00:00:00", rules).orderBy("i").collect()]
    assert labels(R.DEFAULT_RULES) == ["CDI", "CDI", "NON_SPECIFIE", "NON_SPECIFIE", "STAGE", "NON_SPECIFIE"]
    before = R.register_rules("contract_type", [("MISSION", ["mission"])], before="CDI")
    assert labels(before) == ["CDI", "MISSION", "MISSION", "NON_SPECIFIE", "STAGE", "NON_SPECIFIE"]
    after = R.register_rules("contract_type", [("MISSION", ["mission"]), ("ZONE", lambda t: t.low.contains("franche"))])
    assert labels(after) == ["CDI", "CDI", "MISSION", "ZONE", "STAGE", "NON_SPECIFIE"]
    both = R.register_rules("contract_type", [("FIRST", ["mission"])], after, before="MISSION")
    assert labels(both) == ["CDI", "CDI", "FIRST", "ZONE", "STAGE", "NON_SPECIFIE"]
    assert labels(R.DEFAULT_RULES)[2] == "NON_SPECIFIE"  # nothing is registered behind a job's back
    listed = [(r.position, r.label, r.registered) for r in R.rules_table(spark, both).filter("attribute = 'contract_type'").orderBy("position").collect()]
    assert listed == [(1, "ALTERNANCE", False), (2, "STAGE", False), (3, "CDI", False), (4, "CDD", False), (5, "FREELANCE", False), (6, "FIRST", True), (7, "MISSION", True), (8, "ZONE", True)]
    for bad in (lambda: R.register_rules("no_such", []), lambda: R.register_rules("work_mode", [("X", [])]), lambda: R.register_rules("work_mode", [("X", ["Upper"])])):
        with pytest.raises(ValueError):
            bad()
    with pytest.raises(ValueError):
        labels(R.register_rules("contract_type", [("X", ["x"])], before="NOWHERE"))
