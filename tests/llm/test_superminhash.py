import random
from itertools import combinations

import numpy as np
import pytest

from vacanta.llm.superminhash import NearRules, band_keys, near_groups, shingles, super_min_hash, words_of
from vacanta.llm.components import components, joined_components


def brute(rows):
    """doc_id, n_shingles, component by all pairs."""
    sets = []
    for _, text in rows:
        w = words_of((text or "").encode())
        sets.append({tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    out = []
    for k, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        first = min(ids) if ids else None
        out.append((-1 if doc is None else doc, len(sets[k]), -1 if first is None else first, doc == first))
    return sorted(out)


def found(docs, rules=NearRules()):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_shingles"], -1 if r["component_id"] is None else r["component_id"], r["kept"]) for r in near_groups(docs, rules).collect())


def test_estimate_and_blocks():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2 ** 63, 500).astype(np.uint64))
    for j in (0.8, 0.5):
        n = int(len(a) * 2 * j / (1 + j))
        others = [np.unique(np.concatenate([rng.permutation(a)[:n], rng.integers(0, 2 ** 63, len(a) - n).astype(np.uint64)])) for _ in range(60)]
        sig = super_min_hash([a] + others, 160)
        same = (sig[1:] == sig[0]).mean(1)
        assert abs(same.mean() - j) < 0.03 and same.std() < 0.045
    assert (super_min_hash([a], 160, block=37) == super_min_hash([a], 160)).all()
    tiny = super_min_hash([a[:1], a[:0]], 160)
    assert len(set((tiny[0] >> np.uint64(32)).tolist())) == 160  # one element fills every slot, a round each
    assert (band_keys(sig, 32, 5).shape) == (61, 32)


def test_shingles():
    assert len(shingles(words_of(b"A b c d e"), 4)) == 2 and len(shingles([], 4)) == 0
    assert (shingles(words_of(b"A B"), 4) == shingles(words_of(b"a\tb"), 4)).all()
    assert not set(shingles(words_of(b"a b c"), 4).tolist()) & set(shingles(words_of(b"a b c c"), 4).tolist())


def near_copies(n=60, seed=5):
    """A family whose members are each close to the base and mostly not to each other, chains, and singles."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(200)]
    rows = [(1000, " ".join(base))]
    for k in range(n):
        words = list(base)
        for _ in range(rng.randint(1, 4)):
            words[rng.randrange(200)] = f"e{k}{rng.randrange(99)}"
        rows.append((k, " ".join(words)))
    for k in range(n):  # edits out of a common pool: some far from the base are close to each other
        words = list(base)
        for e in rng.sample(range(14), rng.randint(1, 11)):
            words[e * 14] = f"pool{e}"
        rows.append((300 + k, " ".join(words)))
    chain = [f"c{k}" for k in range(300)]
    for k in range(12):
        chain[k * 5] = f"d{k}"
        rows.append((500 + k, " ".join(chain)))
    return rows + [(700 + k, " ".join(rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(50))) for k in range(20)]


def test_groups_equal_all_pairs(spark):
    for seed in (5, 6):
        rows = near_copies(seed=seed)
        assert len({r[2] for r in brute(rows)}) < len(rows) - 30
        assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_no_hub_is_good_for_all(spark):
    rng, rows = random.Random(9), []
    base = [f"w{k}" for k in range(150)]
    for k in range(150):  # no copy of the base itself; similarities around the limit
        words = list(base)
        for e in rng.sample(range(150), rng.randint(2, 7)):
            words[e] = f"x{k}y{e}" if rng.random() < 0.5 else f"x{e}"
        rows.append((k, " ".join(words)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_edges(spark, edge, none):
    assert found(edge) == brute([(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()])
    assert near_groups(none).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(k, k + 1) for k in range(1000, 1200)] + [(2000, 2000 + k) for k in range(1, 300)]
    parent = {x: x for l in links for x in l}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame([l for l in links if l[0] != l[1]], "a long, b long").repartition(6)).collect()}
    for x in got:
        assert got[x] == find(x)
    assert set(got) >= {x for x in parent if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    links = [l for l in links if l[0] != l[1]]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long").repartition(4)
    got = {r["node"]: r["root"] for r in joined_components(components(frame(links[::2])), frame(links[1::2])).collect()}
    assert all(got.get(x, x) == find(x) for x in parent)
