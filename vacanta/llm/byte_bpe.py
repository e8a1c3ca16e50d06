"""Byte-level BPE through a sentencepiece model built from a rank file.

The model is serialised directly from the vocabulary: every token's bytes are written
as one character each (256 fixed characters), the piece's score is its negative rank,
the normaliser is the identity. Nothing is trained. Pre-tokens of the pattern are
encoded by it; ids are decoded by the inverse byte mapping.

Edge cases: a null text is an empty one; an empty text has no ids and decodes to no
bytes; texts with repeated blanks are cut by the pattern as a whole; a null or
repeated doc_id keeps its row.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import broadcast_value, map_chunks, text_bytes
from .part_table import PartTable, whole_utf8

#: First of the 256 consecutive characters (CJK ideographs) that stand for the bytes 0 to 255.
BYTE_BASE = 0x4E00
#: A byte that UTF-8 never uses.
SEPARATOR = b"\xff"
#: A character that is neither letter, number nor space in any Unicode version.
NEUTRAL = 0xE000


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: one base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def mapped(token: bytes) -> str:
    """One character per byte."""
    return "".join(chr(BYTE_BASE + b) for b in token)


def unmapped(piece: str) -> bytes:
    """Inverse of :func:`mapped`."""
    return bytes(ord(c) - BYTE_BASE for c in piece)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model with piece id = rank order; the unknown piece comes last."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        model.pieces.add(piece=mapped(token), score=-float(rank))
    model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.trainer_spec.unk_id = len(ranks)
    for name in ("bos_id", "eos_id", "pad_id"):
        setattr(model.trainer_spec, name, -1)
    model.normalizer_spec.name = "identity"
    for name in ("add_dummy_prefix", "remove_extra_whitespaces", "escape_whitespaces"):
        setattr(model.normalizer_spec, name, False)
    return model.SerializeToString()


def unlike_letters() -> str:
    """Characters that the installed regex library calls letters or numbers and the rank
    library's older Unicode tables do not (found by asking the latter, none assumed)."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    found = set()
    for cls in (r"\p{L}", r"\p{N}"):
        ids = tiktoken.Encoding("class", pat_str=cls, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        found |= set(regex.findall(cls, every)) - set(bytes(ids).decode())
    return "".join(sorted(found))


class ByteBpe:
    """Encoder and decoder for one rank file and pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, unlike: str = "", **table):
        import sentencepiece

        self.pattern = regex.compile(pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
        self.order = [r for _, r in sorted((r, r) for r in ranks.values())]
        #: id -> bytes, read back from the model's pieces
        self.bytes_of = {r: unmapped(self.model.id_to_piece(i)) for i, r in enumerate(self.order)}
        self.first_unlike = ord(min(unlike, default="\0"))
        self.unlike = str.maketrans({c: NEUTRAL for c in unlike})
        self.dense = self.order == list(range(len(ranks)))
        self.rank_of = {mapped(t): r for t, r in ranks.items()}
        self.names = {r: str(r) for r in self.order}
        self.sized = {"bits": 20, "limit": 1 << 22} | table  # what one task's texts need: it is released with the task
        self.release()

    def release(self) -> None:
        """Forgets the encoded parts; the vocabulary stays."""
        self.table = PartTable(self.encode_parts, **self.sized)
        pa.default_memory_pool().release_unused()

    def pre_tokens(self, text: str) -> list[str]:
        if text.isascii() or not self.unlike or np.frombuffer(text.encode("utf-32-le"), "<u4").max() < self.first_unlike:
            return self.pattern.findall(text)
        seen = text.translate(self.unlike)
        if seen == text:
            return self.pattern.findall(text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(seen)]

    def pieces(self, parts: list[str]) -> tuple[list[str], list[int]]:
        """Pre-tokens of all parts in a row, and how many each part has.

        Parts that begin with a blank and a non-blank are cut together: a cut always falls there."""
        flat, counts = [], []
        for blank, group in groupby(parts, lambda p: len(p) > 1 and p[0] == " " and not p[1].isspace()):
            if blank:
                group = list(group)
                found = self.pre_tokens("".join(group))
                ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
                upto = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, group), np.int64, len(group))), side="right")
                flat += found
                counts += np.diff(upto, prepend=0).tolist()
            else:
                for part in group:
                    found = self.pre_tokens(part)
                    flat += found
                    counts.append(len(found))
        return flat, counts

    def encode_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts in a row, and how many each has. Each pre-token on its own: a token of
        the vocabulary as it is, else merged by the model."""
        flat, counts = self.pieces([p.decode() for p in parts])
        wide = np.frombuffer(SEPARATOR.join([x.encode() for x in flat]), np.uint8).astype("<u2") + np.uint16(BYTE_BASE)
        written = wide.tobytes().decode("utf-16-le").split(chr(BYTE_BASE + SEPARATOR[0]))
        known = list(map(self.rank_of.get, written))
        merged = iter(self.model.encode([x for x, r in zip(written, known) if r is None], num_threads=1))
        each = [[r] if r is not None else self.ranked(next(merged)) for r in known]
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        ids = np.fromiter(chain.from_iterable(each), np.uint32, int(sizes.sum()))
        upto = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))]
        return ids, np.diff(upto)

    def ranked(self, ids: list[int]) -> list[int]:
        return ids if self.dense else [self.order[i] for i in ids]

    def encode(self, texts: list[bytes]) -> list[list[int]]:
        """Ids of every text; equal parts are encoded once and kept. Bytes that aren't UTF-8 are replaced."""
        ids, counts = self.table.encode_texts(whole_utf8(texts))
        return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(2)
def _coder(path: str, pattern: str, unlike: str) -> ByteBpe:
    return ByteBpe(read_ranks(path), pattern, unlike)


def encode_decode(docs: DataFrame, rank_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """One row per document: n_tokens, digest of the ids, digest of the decoded bytes, and
    with ``keep_ids`` the ids themselves.

    ``rank_path`` is read on the workers (a vocabulary installed with the library)."""
    unlike = broadcast_value(docs, unlike_letters())
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"

    def code(batch):
        coder = _coder(rank_path, pattern, unlike.value)
        kept = coder.encode(batch.column("text").to_pylist())
        n = [len(ids) for ids in kept]
        ids_hash = [hashlib.sha256(",".join(map(coder.names.__getitem__, ids)).encode()).hexdigest() for ids in kept]
        text_hash = [hashlib.sha256(coder.decode(ids)).hexdigest() for ids in kept]
        out = {"n_tokens": n, "ids_sha256": ids_hash, "decoded_sha256": text_hash}
        return out | ({"ids": kept} if keep_ids else {})

    def release():
        _coder(rank_path, pattern, unlike.value).release()

    return map_chunks(text_bytes(docs, "doc_id"), schema + (", ids array<int>" if keep_ids else ""), code, limit=1 << 20, after=release)
