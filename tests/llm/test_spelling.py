import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vacanta.llm import spelling as S


def brute_words(rows):
    out = Counter()
    for doc_id, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words, near=one_edit):
    forms, out = {}, []
    links = {w: [v for v in words if v != w and near(w, v)] for w in words}
    for w, n in words.items():
        best = min(links[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(links[w]), words.get(forms[w])))
    return sorted(out)


def got(spark, words):
    df = spark.createDataFrame(list(words.items()), "word string, n long").withColumn("rank", F.lit("clash"))
    return sorted(map(tuple, S.variants(df).collect()))


@pytest.fixture()
def many_ranges(spark):
    """Small tables stay in as many ranges as there are shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("alphabet,low,high,n,seed", [("ab", 5, 9, 300, 1), ("abcé", 5, 7, 400, 2), ("aÿÀ", 5, 6, 300, 3), ("abcdefgh", 5, 6, 600, 4)])
def test_equals_brute_force(spark, many_ranges, alphabet, low, high, n, seed):
    rnd = random.Random(seed)
    words = {"".join(rnd.choice(alphabet) for _ in range(rnd.randint(low, high))): rnd.choice((3, 3, 4, 6, 7, 12, 30, 100)) for _ in range(n)}
    assert got(spark, words) == brute(words)


def test_runs_of_letters_and_chains(spark, many_ranges):
    words = {"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaaa": 24, "aaaaaaaaa": 24, "baaaa": 3, "aabaa": 48, "zzzzz": 5} | {"q" * k: 3 * 2 ** (k - 10) for k in range(10, 30)}
    assert got(spark, words) == brute(words)


def test_long_words(spark, many_ranges):
    a = "abcdefghij" * 3000
    words = {a: 3, a[:15_000] + a[15_001:]: 9, a[:-1] + "z": 40, a + "a": 4, "x" + a[1:]: 80, "short": 3}
    assert got(spark, words) == brute(words)


def test_ranges_share_nodes(spark):
    rnd = random.Random(5)
    words = sorted({"common" + "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 6))) for _ in range(90)})
    for cuts in ((), (1,), (10, 11, 12), (30, 60), tuple(range(1, len(words), 3))):
        parts = [p for i, j in zip((0, *cuts), (*cuts, len(words))) if (p := words[i:j])]
        ends = S.Boundaries({3 * k: p[-1] for k, p in enumerate(parts)})
        at, prefixes = {}, {}
        for k, p in enumerate(parts):
            numbers = S.RangeNumbers(3 * k, ends)
            for w in p:
                path = numbers.number(w)
                assert len(path) == len(w) + 1
                for d, node in enumerate(path):
                    assert at.setdefault(node, w[:d]) == w[:d] and prefixes.setdefault(w[:d], node) == node


def test_words_of_texts(spark, edge, sample):
    for docs in (edge, sample):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        assert dict(map(tuple, S.spelled_words(docs).collect())) == brute_words(rows)


def test_slips(spark):
    hit = [k for k in range(3000) if zlib.crc32(f"{k}:{'y' * 5000}".encode()) % 97 == 0]
    rows = [(k, "Übermütig wordings, WORDINGS aaaaa×aaaaaa abcd " + "y" * 5000) for k in [*hit, *hit, *range(200), *[None] * 30]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = brute_words(rows)
    assert dict(map(tuple, S.spelled_words(docs).collect())) == words and any(len(w) == 4999 for w in words)
    assert sorted(map(tuple, S.variants(S.spelled_words(docs)).collect())) == brute(words)


def test_empty_table(spark, none):
    assert S.variants(S.spelled_words(none)).count() == 0
