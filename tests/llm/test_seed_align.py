import random

import numpy as np

from vacanta.llm.seed_align import AlignRules, align, contaminated, item_blocks, without_matches

from .conftest import ITEMS


def smith_waterman(item, text, r=AlignRules()):
    h, best = np.zeros((len(item) + 1, len(text) + 1), int), 0
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (r.match if a == b else r.mismatch), h[i - 1, j] + r.gap, h[i, j - 1] + r.gap)
            best = max(best, h[i, j])
    return best


def test_alignment_equals_the_table():
    rng = np.random.default_rng(0)
    for _ in range(200):
        item, text = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 14))
        score, used, end = align(item, text, AlignRules())
        assert score == smith_waterman(item, text)
        back = align(item[:used][::-1], text[:end][::-1], AlignRules())
        assert back[0] == score


def corpus():
    rng = random.Random(1)
    vocabulary = [f"term{k}" for k in range(3000)] + ["the", "of", "and"] * 400
    noise = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(noise(30 + k))) for k in range(8)] + [(50, None), (51, ""), (52, "the of"), (None, "x1 x2 x3 x4 x5 x6 x7 x8 x9")]
    docs, want = [], set()
    for d in range(200):
        words = noise(120)
        if d % 5 == 0:
            item, copy = items[d % 8], items[d % 8][1].split()
            if d % 10 == 0:  # edited: words replaced, dropped, added
                for e in range(0, len(copy), 6):
                    copy[e] = "edited"
                del copy[10]
                copy.insert(20, "added")
            words[40:40] = [w.upper() for w in copy]
            want.add((d, item[0]))
        docs.append((d, " ".join(words)))
    docs += [(900, "x1 x2 x3 x4 x5 x6 x7 x8 x9"), (901, None), (902, ""), (None, items[3][1]), (903, " ".join(noise(30_000)) + " " + items[2][1])] + [(904, items[1][1])] * 2
    want |= {(900, None), (None, 3), (903, 2), (904, 1)}
    return docs, items, want


def test_copies_are_found_and_clean_texts_left(spark):
    docs, items, want = corpus()
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, ITEMS)
    rows = contaminated(docs.repartition(5), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows if r["item_id"] != 52} == want
    assert sum(r["doc_id"] == 904 for r in rows) == 2
    at = {r["doc_id"]: r for r in rows}
    assert at[5]["similarity"] == 1.0 and (at[5]["start_word"], at[5]["end_word"]) == (40, 40 + 30 + 5)
    blocks = AlignRules(block_bytes=300)
    assert len(list(item_blocks(items, blocks))) > 3
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items, blocks).collect() if r["item_id"] != 52} == want


def test_edges(spark, edge, none):
    items = spark.createDataFrame([(1, "quick brown rabbits never appear in these short rows at all")], ITEMS)
    assert contaminated(edge, items).count() == 0 and contaminated(none, items).count() == 0
    assert contaminated(edge, items.filter("false")).count() == 0
    left = without_matches(edge, items)
    assert left.columns == edge.columns and left.count() == edge.count()


def test_edited_copies_of_an_item_that_fills_the_corpus_are_found(spark):
    rng = random.Random(3)
    item = [f"leak{k}" for k in range(15)]
    rows = [(k, " ".join(item)) for k in range(200)] + [(1000 + k, " ".join(f"w{rng.randrange(3000)}" for _ in range(60))) for k in range(200)]
    for at in range(15):  # a change at each place, so also inside any single seed
        rows.append((5000 + at, " ".join(item[:at] + ["edited"] + item[at + 1:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"] for r in contaminated(docs, spark.createDataFrame([(1, " ".join(item))], ITEMS)).collect()}
    assert found == {d for d, _ in rows if d < 1000 or d >= 5000}
