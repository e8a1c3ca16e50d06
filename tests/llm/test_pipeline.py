import random

import corpus_pipeline
from vacanta.llm.queries import QUERIES, SQL

from .conftest import DOCS, ITEMS, PROSE


def test_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontaminate", "redact_secrets", "byte_bpe"]


def test_stages_take_effect(spark, tmp_dir):
    import hashlib

    import public_tokenizers as P
    import tiktoken
    from vacanta.llm.byte_bpe import read_ranks

    rng = random.Random(2)
    words = PROSE.split()
    prose = lambda n, tag: " ".join(rng.choice(words) + (f" {tag}{rng.randrange(10 ** 6)}x" if k % 4 == 0 else "") for k in range(n))
    item = prose(30, "item")
    texts = {k: prose(150, "a") for k in range(1, 30)}
    texts[40] = texts[7]  # copy
    texts[41] = texts[8] + " tail"  # near copy
    texts[42] = prose(20, "b") + " " + item + " " + prose(20, "c")  # leak
    texts[43] = "too short"
    texts[44] = "again and again " * 40  # repeats
    secret = "0123456789abcdef" * 3
    texts[45] = prose(50, "d") + f' token = "{secret}" end'
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts.items()] + [(46, None, None, None, None)], DOCS)
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, item)], ITEMS).write.parquet(f"{tmp_dir}/benchmark.parquet")
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, tmp_dir).collect()}
    gone = {40, 41, 42, 43, 44, 46}
    assert set(rows) == set(texts) - gone
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    for k, r in rows.items():
        text = texts[k] if k != 45 else texts[k].replace(f'token = "{secret}', "[secret]")
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["n_tokens"] == len(lib.encode_ordinary(text))


def test_edges(spark, edge, none, tmp_dir):
    spark.createDataFrame([(1, "nothing of this occurs in any of the rows")], ITEMS).write.parquet(f"{tmp_dir}/benchmark.parquet")
    for docs in (none, edge):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, tmp_dir)
            assert out.columns == docs.columns, name
            out.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, tmp_dir).count() == docs.count()


def test_near_duplicates_are_told_by_five_words(spark):
    from vacanta.llm.stages import near_dedup

    words = [f"w{k}" for k in range(200)]
    edited = lambda n: " ".join(f"x{k}" if k % 30 == 20 and k < 30 * n else w for k, w in enumerate(words))
    docs = spark.createDataFrame([(1, " ".join(words), "en", "s", 0), (2, edited(5), "en", "s", 0), (3, edited(2), "en", "s", 0)], DOCS)
    # five edits: 0.816 of the shingles of four words, 0.774 of those of five; two edits: 0.90
    assert {r["doc_id"] for r in near_dedup(spark, docs.filter("doc_id < 3"), "").collect()} == {1, 2}
    assert {r["doc_id"] for r in near_dedup(spark, docs.filter("doc_id <> 2"), "").collect()} == {1}


def test_near_duplicates_of_rows_without_a_name(spark):
    """Rows with null or repeated ids are grouped like others: no two rows left are near."""
    from vacanta.llm.stages import near_dedup

    rng = random.Random(8)
    base = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(120)) for _ in range(6)]
    near = lambda t, k: " ".join(f"x{k}" if i == 10 * k % 120 else w for i, w in enumerate(t.split()))
    rows = [(1, base[0]), (1, near(base[0], 1)), (None, base[0]), (None, near(base[0], 2)), (2, near(base[0], 1)), (None, None), (None, None), (None, "")]
    rows += [(rng.choice([None, 5, 6, 7, 8, 20 + k]), near(base[k % 6], rng.randrange(3))) for k in range(60)]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], DOCS)
    kept = [(r["doc_id"], r["text"]) for r in near_dedup(spark, docs, "").collect()]
    shingles = lambda t: {tuple((t or "").split()[i:i + 5]) for i in range(len((t or "").split()) - 4)}
    sets = [shingles(t) for _, t in kept]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert not a or not b or 100 * len(a & b) < 80 * len(a | b)
    assert all(any(s and 100 * len(s & shingles(t)) >= 80 * len(s | shingles(t)) for s in sets) for _, t in rows if shingles(t))
    assert sorted(map(repr, (r for r in kept if not shingles(r[1])))) == ["(None, '')", "(None, None)"]
    assert set(kept) <= set(rows) and 2 in [k for k, t in kept if t == near(base[0], 1)] + [2]
