import random
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from vacanta.llm.token_files import Expander, GrammarRules, LibraryCoder, compress, read_document, read_token_files, write_token_files

FILE = P.path("byte_bpe_50k.json")


def test_grammar_round_trip_and_spans():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 5, 400, 3000):
        for kinds in (1, 2, 5, 70_000):
            ids = rng.integers(0, kinds, n).astype(np.uint32)
            s, pairs, lengths = compress(ids, kinds, GrammarRules(min_count=2, max_expansion=9))
            e = Expander(kinds, pairs, lengths)
            assert (e.expand(s) == ids).all() and len(s) <= n
            assert not len(lengths) or lengths.max() <= 9
            for at in (0, n // 3, n):
                assert (e.span(s, at, n - at) == ids[at:]).all()


def test_repeats_become_short():
    ids = np.tile(np.arange(50, dtype=np.uint32), 400)
    s, pairs, _ = compress(ids, 50)
    assert len(s) < len(ids) * 0.7 and len(pairs)


def test_coder_equals_the_library():
    t = Tokenizer.from_file(FILE)  # as it is: an added token inside a text is one id
    assert len(t.encode("a <|endoftext|> b", add_special_tokens=False).ids) == 4
    texts = ["a  b   c \n d\n\n e\t\tf  ", "don't we'll 'Sſ", "՘abc ₏12 ᲊ q", "日本語 𠀀", "<|endoftext|> a", "a\n \nfoo", "", " ", "x <|endoftext|>"] * 2
    rng = random.Random(4)
    parts = [" ", "\n", "a", "é", "'s", "1", "՘", "😀", "\u3000", "\u00a0", "-", "  ", " x", "\t", "\x1c", " word", "z" * 70, "日本", " 日"]
    texts += ["".join(rng.choice(parts) for _ in range(12)) for _ in range(2000)]
    coder = LibraryCoder(FILE, bits=6, limit=900)
    for at in range(0, len(texts), 100):
        ids, counts = coder.encode([t.encode() for t in texts[at:at + 100]])
        for text, own in zip(texts[at:], np.split(ids, np.cumsum(counts)[:-1])):
            assert own.tolist() == t.encode(text, add_special_tokens=False).ids, text
    assert coder.encode([]) [0].tolist() == [] and coder.encode([b"\xff x", b""])[1].tolist()[1] == 0


def check(spark, docs, folder, **kw):
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    write_token_files(docs, FILE, folder, **kw)
    blocks = spark.read.parquet(folder)
    rows = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in read_token_files(blocks).collect()))
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(t.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4")
        texts.setdefault(r["doc_id"], []).append((len(ids), zlib.crc32(ids.tobytes())))
    start, order = 0, []
    for s, doc, n, crc in rows:
        assert s == start
        start += n
        order.append(-1 if doc is None else doc)
        texts[doc].remove((n, crc))
    assert not any(texts.values()) and order == sorted(order)
    return blocks


def test_files(spark, edge, none, sample, tmp_dir):
    check(spark, edge, tmp_dir + "/edge")
    blocks = check(spark, sample, tmp_dir + "/sample", rules=GrammarRules(block_ids=5000, min_count=4))
    assert blocks.count() > 5
    row = blocks.orderBy("shard", "block").first().asDict()
    n = np.frombuffer(row["doc_lengths"], "<u4")
    docs = np.frombuffer(row["doc_ids"], "<i8")
    t = Tokenizer.from_file(FILE)
    text = sample.filter(sample.doc_id == int(docs[2])).first()["text"]
    assert read_document(row, 2).tolist() == t.encode(text, add_special_tokens=False).ids + [0] and len(read_document(row, 2)) == n[2]
    write_token_files(none, FILE, tmp_dir + "/none")
    assert read_token_files(spark.read.parquet(tmp_dir + "/none")).count() == 0
