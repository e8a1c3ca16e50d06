import hashlib

import pytest
from pyspark.sql import functions as F

from vacanta.llm import merkle as M

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, bump=0):
    doc_id, text, lang, source, n = row
    n = None if n is None else n + bump
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)])


def brute(rows, altered):
    """Every row by the rules, one after the other: (doc_id, leaf, subroot, root, proof, folded, verified)."""
    def way(hashes, i, own):
        met, n = [], len(hashes)
        while n > 1:
            if i ^ 1 < n:
                s = hashes[i ^ 1]
                met.append(s)
                own = sha(s, own) if i & 1 else sha(own, s)
            else:
                own = sha(own)
            hashes, i, n = [sha(*hashes[k:k + 2]) for k in range(0, n, 2)], i // 2, (n + 1) // 2
        return met, own

    top = lambda hashes: way(hashes, 0, hashes[0])[1]
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    subs = [top([leaf(r) for r in trees[x]]) for x in langs]
    root, out = top(subs), []
    for k, x in enumerate(langs):
        hashes = [leaf(r) for r in trees[x]]
        for i, r in enumerate(trees[x]):
            met, own = way(hashes, i, leaf(r, 1) if altered(r) else leaf(r))
            more, own = way(subs, k, own)
            out.append((r[0], leaf(r), subs[k], root, sha(*met, *more), own, own == root))
    return sorted(out, key=repr)


def climbed(spark, rows, stride, hit=lambda r: r[0] is not None and r[0] % 3 == 0):
    docs = rows if not isinstance(rows, list) else spark.createDataFrame(rows, DOCS)
    altered = F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1)
    return sorted((tuple(r) for r in M.climb(M.build(M.doc_leaves(docs, altered), stride)).collect()), key=repr)


ROWS = [(k, f"text {k} é" * (k % 5), ("en", "de", None, "zü", "en")[k % 5], "s", k if k % 4 else None) for k in range(137)]
EDGE = [(None, "x", "en", None, 1), (None, "x", "en", None, 1), (5, None, None, None, None), (6, "", "", "", 0), (6, "", "", "", 0), (6, "y", "", "", 0), (7, "z" * 300_000, "only", "s", 3), (9, "1:a", "2:b", "-", 9)]


@pytest.mark.parametrize("rows,stride", [(ROWS, 1), (ROWS, 2), (ROWS, 10), (EDGE, 1), (EDGE, 10), (ROWS[:1], 3), ([ROWS[0]] * 9, 2), (ROWS + EDGE, 3)])
def test_climb_equals_brute_force(spark, rows, stride):
    assert climbed(spark, rows, stride) == brute(rows, lambda r: r[0] is not None and r[0] % 3 == 0 and r[4] is not None)


def test_one_language_holds_nearly_all_rows(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 4990, "en").otherwise("fr").alias("lang"), F.lit("s").alias("source"), F.col("id").alias("n_chars"))
    rows = [(k, "t", "en" if k < 4990 else "fr", "s", k) for k in range(5000)]
    for name in ("hash", "tree", "idx", "leaf", "steps", "place", "n"):
        docs = docs.withColumn(name, F.lit("clash"))
    assert climbed(spark, docs, 4) == brute(rows, lambda r: r[0] % 3 == 0)


def test_limit_on_recursion_is_restored(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    climbed(spark, ROWS[:10], 2)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


def test_node_rows_are_linked(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    m = M.build(M.doc_leaves(docs), 2)
    nodes = m.leaves.unionByName(m.upper)
    up = nodes.filter("up_tree is not null").select(F.col("up_tree").alias("tree"), F.col("up_level").alias("level"), F.col("up_idx").alias("idx"))
    assert up.join(nodes, ["tree", "level", "idx"], "left_anti").isEmpty()
    assert nodes.filter("up_tree is null").count() <= 4 and m.subroots.count() == 4
    assert nodes.groupBy("tree", "level", "idx").count().filter("count > 1").isEmpty()


def test_empty_table(spark, none):
    assert M.climb(M.build(M.doc_leaves(none))).count() == 0
