import numpy as np
import pytest
from pyspark.sql import functions as F

from vacanta.llm import compression, toxicity
from vacanta.llm.labelled import held_out, training_sample

from .conftest import LABELS

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")


def accuracy(rows, labels, column):
    known = {r["doc_id"]: r[column] for r in labels.collect()}
    own = [r["predicted"] == known[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in known]
    return sum(own) / len(own), len(own)


def test_held_out_accuracy(tables):
    docs, labels = tables
    for made, column, least in ((toxicity.toxic_documents(docs, labels), "toxic", 0.92), (compression.quality_documents(docs, labels), "quality", 0.92)):
        rows = made.collect()
        share, n = accuracy(rows, labels, column)
        assert len(rows) == docs.count() and n > 50 and share >= least
        assert all(0 <= r["score"] <= 1 for r in rows)


def test_sample_is_bounded_and_leaves_the_held_out_fold(tables):
    docs, labels = tables
    sample = training_sample(docs, labels, "toxic", 10 ** 6, 10 ** 6)
    held = {r["doc_id"] for r in docs.filter(held_out()).collect()}
    assert sample and not held & {d for d, _, _ in sample}
    assert sample == training_sample(docs.repartition(5), labels.repartition(3), "toxic", 10 ** 6, 10 ** 6)
    assert 20 < len(training_sample(docs, labels, "toxic", 80, 10 ** 6)) < 160


def test_sentences_are_located():
    rng = np.random.default_rng(0)
    words = [f"w{k}" for k in range(80)]
    sample = []
    for k in range(400):
        lines = [" ".join(rng.choice(words, 8)) for _ in range(5)]
        if k % 4 == 0:
            lines[int(rng.integers(5))] += " vilething"
        sample.append((k, ". ".join(lines) + ".", int(k % 4 == 0)))
    model = toxicity.train(sample)
    text = "w1 w2 w3. you vilething here! w4 w5"
    z = np.array([sum(model["weights"].get(f, 0) for w in s for f in toxicity.features(w, (4, 5, 6))) + model["bias"] for s in toxicity.sentences(text)])
    found = toxicity.located(text, z)
    assert [text[s:e].strip() for s, e, _ in found] == ["you vilething here"] and found[0][2] > 0.5


def test_edges(spark, edge, none, tables):
    docs, labels = tables
    more = spark.createDataFrame([(5, None, None), (None, 1, 1), (6, 1, 1), (6, 0, 0), (999_999, 1, 0)], LABELS)
    for made in (lambda d, l: toxicity.toxic_documents(d, l), lambda d, l: compression.quality_documents(d, l)):
        assert made(edge, more).count() == edge.count()
        assert made(none, more).count() == 0
        empty = made(edge, more.filter("false")).collect()
        assert len({r["score"] for r in empty}) == 1 or len(empty) == edge.count()
        learned = made(edge.select("doc_id", "text").unionByName(docs.select("doc_id", (F.col("text")).alias("text"))), labels).filter("doc_id = 1").collect()
        assert learned and all(0 <= r["score"] <= 1 for r in learned)


def brute_noisy_or(z, least):
    p = 1 / (1 + np.exp(-np.array(z)))
    weak = [x for x in p if x < least]
    return 1 - np.prod([1 - x for x in p if x >= least]) * (1 - max(weak, default=0))


def test_noisy_or_equals_its_definition():
    rng = np.random.default_rng(5)
    docs = [rng.normal(-3, 3, n) for n in (1, 2, 7, 400)] + [np.full(20_000, -7.0), np.array([-7.0, 2.0])]
    got = toxicity.noisy_or(np.concatenate(docs), np.cumsum([0, *map(len, docs)]), 0.05)
    assert np.allclose(got, [brute_noisy_or(z, 0.05) for z in docs])
    assert got[-2] < 0.01 and got[-1] > 0.8


def test_long_clean_texts_stay_clean(spark):
    rng = np.random.default_rng(0)
    words = [f"w{k}" for k in range(80)]
    line = lambda: " ".join(rng.choice(words, 8))
    sample = [(k, ". ".join([line() for _ in range(5)] + ["vilething"] * (k % 4 == 0)), int(k % 4 == 0)) for k in range(400)]
    clean = ". ".join(line() for _ in range(10_000))
    docs = spark.createDataFrame([(0, clean), (1, clean + ". you vilething"), (2, ". ".join(["!"] * 10_000))], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.train(sample)).collect()}
    assert [rows[k]["predicted"] for k in range(3)] == [0, 1, 0]
    assert [len(rows[k]["offending"]) for k in range(3)] == [0, 1, 0]


def test_pieces_are_spread_and_balanced_whatever_the_order():
    rules = compression.CompressionRules(piece_bytes=10, text_pieces=4)
    assert compression.lent_pieces([b"".join(b"%09d " % k for k in range(100))], rules) == [[b"%09d " % k for k in (0, 25, 50, 75)]]
    assert compression.lent_pieces([b"", b"abc"], rules) == [[b""], [b"abc"]]
    good, bad = [b"good text %d" % k * 9 for k in range(100)], [b"bad %d" % k for k in range(10)]
    first = compression.balanced(good, bad, rules)
    assert first == compression.balanced(good[::-1], bad[::-1], rules) and list(map(len, first)) == [20, 10]
    assert list(map(len, compression.balanced(bad, good, rules))) == [10, 20]


def test_sample_is_bounded_by_bytes_not_by_length(spark):
    docs = spark.createDataFrame([(k, "x" * (50_000 if k % 10 == 0 else 10)) for k in range(200)], "doc_id long, text string")
    labels = docs.select("doc_id", F.lit(1).alias("toxic"))
    all_of_it = training_sample(docs, labels, "toxic", 1000, 10 ** 8)
    assert len(all_of_it) == labels.filter(~held_out()).count() and max(len(t) for _, t, _ in all_of_it) == 50_000
    some = training_sample(docs, labels, "toxic", 1000, 200_000)
    assert 100_000 < sum(len(t) for _, t, _ in some) <= 200_000
    assert some == training_sample(docs.repartition(7), labels, "toxic", 1000, 200_000)


def test_calibration_is_monotone():
    x = np.array([0.0, 1, 2, 3, 4, 5, 6, 7])
    knots, values = compression.isotonic(x, np.array([0, 0, 1, 0, 1, 1, 0, 1.0]))
    assert knots == sorted(knots) and values == sorted(values) and 0 < values[0] < values[-1] < 1


def test_a_repeated_id_brings_one_text(spark):
    from pyspark.sql import functions as F

    docs = spark.range(4000).select(F.when(F.col("id") < 3000, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id").distinct().select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    sample = training_sample(docs, labels, "toxic", 10_000, 10 ** 6)
    ids = [r[0] for r in sample]
    assert len(ids) == len(set(ids)) == labels.filter(~held_out()).count()
    assert sample == training_sample(docs.repartition(5), labels, "toxic", 10_000, 10 ** 6)
    assert len(training_sample(docs, labels, "toxic", 100, 10 ** 6)) < 200
