import random
import re

from pyspark.sql import functions as F

from vacanta.llm.divergence import DivergenceRules, judge, partial_counts, references, repeated_words

SPACE = "\x20\x09-\x0D"


def brute(text):
    text = text or ""
    words = re.findall(f"[^{SPACE}]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    many = {w for w in windows if windows.count(w) > 1} if len(windows) < 3000 else {w for w, n in __import__("collections").Counter(windows).items() if n > 1}
    covered = {i + j for i, w in enumerate(windows) if w in many for j in range(8)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(f"[^{SPACE}]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n


def test_base_figures(edge, sample):
    for docs in (edge, sample):
        want = sorted((r["doc_id"] or -1, *brute(r["text"])) for r in docs.select("doc_id", "text").collect())
        rows = judge(docs, references(docs)).collect()
        assert sorted((-1 if r["doc_id"] is None else r["doc_id"], *[r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]) for r in rows) == [(-1 if w[0] == -1 else w[0], *w[1:]) for w in want] or \
            sorted((r["doc_id"] or -1, *[r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]) for r in rows) == want
        assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_windows_do_not_cross_texts():
    words = [b"a b c d e f g h".split(), b"a b c d e f g h".split(), b"a b c d e f g h a b c d e f g h".split(), []]
    assert repeated_words(words).tolist() == [0, 0, 16, 0]


def test_junk_goes_and_prose_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in judge(docs, references(docs)).collect() if r["doc_id"] in labels and not r["base_failed"]]
    good = [r["kept"] for r in rows if labels[r["doc_id"]]]
    bad = [r["kept"] for r in rows if not labels[r["doc_id"]]]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.15


def test_no_reference(none, edge):
    assert references(none) == {} and judge(none, {}).count() == 0
    rows = judge(edge, {}).collect()
    assert all(r["kept"] != r["base_failed"] and r["nearest"] is None for r in rows)


def test_references_do_not_depend_on_partitions(sample):
    assert references(sample.repartition(7)) == references(sample.coalesce(1))
    assert set(references(sample, DivergenceRules(common_words=3))["en"][1]) >= {b"the"}


def made_texts(lang, n, size, seed):
    rng = random.Random(seed)
    vocabulary = [f"{lang}{k}" for k in range(400)]
    return [" ".join(rng.choices(vocabulary, [1 / (k + 1) for k in range(400)], k=size)) for _ in range(n)]


def test_small_languages_are_not_held_against_others(spark):
    rows = [("en", t) for t in made_texts("the", 600, 400, 1)] + [("xy", t) for t in made_texts("qu", 15, 60, 2)]
    docs = spark.createDataFrame([(k, t, g) for k, (g, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(4)
    refs = references(docs)
    assert set(refs) == {"en"} and set(references(docs, DivergenceRules(reference_words=500))) == {"en", "xy"}
    kept = judge(docs, refs).filter("kept").count()
    assert kept == 615
    # a stated language with a reference is still held against it
    assert judge(docs.withColumn("lang", F.lit("en")).filter("doc_id >= 600"), refs).filter("kept").count() == 0


def test_copies_count_once(spark):
    rows = [(k, t, "en") for k, t in enumerate(made_texts("the", 100, 400, 1))]
    hot = made_texts("hot", 1, 25, 3)[0]
    once, often = (spark.createDataFrame(rows + [(1000 + k, hot, "en") for k in range(n)], "doc_id long, text string, lang string").repartition(5) for n in (1, 3000))
    assert references(once) == references(often)


def test_counting_takes_one_python_worker_a_task(sample):
    """Each Python node of a stage is a worker of its own, with batches of its own, in every running task."""
    plan = partial_counts(sample)._jdf.queryExecution().executedPlan().toString().split("initial plan")[-1]
    nodes = [line.strip(" :+-*").split("(")[0].split(" ")[0] for line in plan.splitlines() if "InArrow" in line or "Exchange" in line]
    assert nodes.count("MapInArrow") == 3 and not any(a == b == "MapInArrow" for a, b in zip(nodes[1:], nodes[2:]))
