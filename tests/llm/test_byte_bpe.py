import hashlib
import random

import public_tokenizers as P
import tiktoken

from vacanta.llm.byte_bpe import ByteBpe, encode_decode, read_ranks, unlike_letters

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(RANKS), special_tokens={})


def test_equals_the_library_on_spaces_and_scripts():
    rng, lib = random.Random(3), library()
    parts = [" ", "\n", "a", "é", "'s", "1", "՘", "😀", "　", "-", "  ", " x", "\t", "\x1c", "▁", "Ᲊ"]
    texts = ["".join(rng.choice(parts) for _ in range(12)) for _ in range(3000)]
    texts += ["", " ", "  ", "a\n \nfoo", "a\n ", "A" * 3000, "日本語 テキスト 𠀀"] + [chr(rng.randrange(0x20, 0xD7FF)) * 3 for _ in range(500)]
    coder = ByteBpe(read_ranks(RANKS), P.PATTERN, unlike_letters(), bits=8, limit=2000)
    made = [ids for at in range(0, len(texts), 100) for ids in coder.encode([t.encode() for t in texts[at:at + 100]])]
    assert len(made) == len(texts)
    for text, ids in zip(texts, made):
        assert ids == lib.encode_ordinary(text), text
        assert coder.decode(ids) == text.encode()


def test_query_rows(edge, none, sample):
    lib = library()
    for docs in (edge, sample):
        texts = docs.select("doc_id", "text").collect()
        rows = encode_decode(docs, RANKS, P.PATTERN).collect()
        want = sorted((r["doc_id"] or -1, len(ids := lib.encode_ordinary(r["text"] or "")), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in texts)
        assert sorted((r[0] or -1, *r[1:]) for r in rows) == want
    assert encode_decode(none, RANKS, P.PATTERN).count() == 0
