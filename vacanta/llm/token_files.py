"""Token-id files compressed by a grammar.

Documents are dealt out in doc_id order, encoded, and packed into blocks of about
``block_ids`` ids. Each block is rewritten by Re-Pair: rounds replace the most frequent id
pairs by nonterminals until no pair is frequent enough. A block stores its rules, the
length to which each rule expands, the rewritten symbols and the documents' lengths, so
any document can be decoded alone: the running sum of expansion lengths finds its first symbol.

File format: Parquet, a row per block; the byte columns are little-endian arrays
(``rules`` pairs of uint32, ``rule_lengths`` uint32, ``symbols`` uint16 or uint32 by
``symbol_bytes``, ``doc_ids`` int64 with ``no_id`` marking nulls, ``doc_lengths`` uint32).
Rule r is the symbol ``first_rule`` + r and refers to earlier symbols only.

Edge cases: a null or empty text is the end id alone; ties of doc_id stand in order
of their texts' hashes; rows without doc_id come first; an empty table makes no block.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, text_bytes
from .part_table import SAFE, PartTable, runs_of, whole_utf8

BLOCKS = ("shard int, block int, n_ids long, first_rule int, symbol_bytes int, rules binary, rule_lengths binary, symbols binary, "
          "doc_ids binary, no_id binary, doc_lengths binary")


@dataclass(frozen=True)
class GrammarRules:
    block_ids: int = 1 << 20  #: ids per block, about; a longer document has a block of its own
    min_count: int = 24  #: a pair seen less often in the block isn't replaced
    per_round: int = 2048  #: most frequent pairs taken in a round
    rounds: int = 10
    max_expansion: int = 256  #: ids that one rule may stand for
    table_bits: int = 16


# ----------------------------------------------------------------- grammar

def pair_keys(s: np.ndarray) -> tuple[np.ndarray, int]:
    """Every neighbouring pair as one number, and the bits of its second symbol."""
    if int(s.max()) < 1 << 16:
        return (s[:-1] << np.uint32(16)) | s[1:], 16
    return (s[:-1].astype(np.uint64) << np.uint64(32)) | s[1:], 32


def frequent(keys: np.ndarray, least: int, most: int) -> np.ndarray:
    """The most frequent keys, most frequent first."""
    keys = np.sort(keys)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    counts = np.diff(np.append(starts, len(keys)))
    at = np.flatnonzero(counts >= least)
    return keys[starts[at[np.lexsort((keys[starts[at]], -counts[at]))][:most]]]


def slots_of(keys: np.ndarray, bits: int) -> np.ndarray:
    odd = 0x9E3779B1 if keys.dtype == np.uint32 else 0x9E3779B97F4A7C15
    return (keys * keys.dtype.type(odd)) >> keys.dtype.type(8 * keys.itemsize - bits)


def chosen(pos: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of overlapping occurrences those that rank before both neighbours; in a run of one pair every other one."""
    n = len(pos)
    beside = np.concatenate(([False], pos[1:] - pos[:-1] == 1))
    same = beside & np.concatenate(([False], rank[1:] == rank[:-1]))
    index = np.arange(n)
    even = (index - np.maximum.accumulate(np.where(same, 0, index))) % 2 == 0
    before = np.concatenate(([0], rank[:-1]))
    left = ~beside | np.where(same, even, rank < before)
    right = ~np.append(beside[1:], False) | np.append(same[1:], False) | (rank < np.append(rank[1:], 0))
    return left & right


def compress(ids: np.ndarray, first_rule: int, rules: GrammarRules = GrammarRules()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules as pairs, expansion lengths) of one block."""
    s = ids.astype(np.uint32)
    pairs, lengths = np.zeros((0, 2), np.uint32), np.zeros(0, np.int64)
    room = max((1 << 16) - first_rule, 0) or (1 << 31)
    for _ in range(rules.rounds):
        take = min(rules.per_round, room - len(pairs))
        if len(s) < 2 or take <= 0:
            break
        keys, bits = pair_keys(s)
        found = frequent(keys, rules.min_count, take)
        a, b = (found >> found.dtype.type(bits)).astype(np.int64), (found & found.dtype.type((1 << bits) - 1)).astype(np.int64)
        size = np.concatenate((np.ones(first_rule, np.int64), lengths))
        fits = size[a] + size[b] <= rules.max_expansion
        # a slot of the lookup table holds one pair; of two that meet the more frequent one is taken now
        _, first = np.unique(np.where(fits, slots_of(found, rules.table_bits).astype(np.int64), -1), return_index=True)
        taken = np.sort(first[fits[first]])
        if not len(taken):
            break
        a, b, found = a[taken], b[taken], found[taken]
        table, own = np.full(1 << rules.table_bits, -1, np.int32), np.zeros(1 << rules.table_bits, found.dtype)
        slots = slots_of(found, rules.table_bits)
        table[slots], own[slots] = np.arange(len(found)), found
        slots = slots_of(keys, rules.table_bits).astype(np.intp)
        pos = np.flatnonzero(own.take(slots, mode="wrap") == keys)
        rank = table[slots[pos]]
        if (rank < 0).any():  # the pair written 0 meets empty slots
            pos, rank = pos[rank >= 0], rank[rank >= 0]
        sel = chosen(pos, rank)
        pos, rank = pos[sel], rank[sel]
        s[pos] = first_rule + len(pairs) + rank
        keep = np.ones(len(s), bool)
        keep[pos + 1] = False
        s = s.take(np.flatnonzero(keep))
        pairs = np.concatenate((pairs, np.stack((a, b), 1).astype(np.uint32)))
        lengths = np.concatenate((lengths, size[a] + size[b]))
    return s, pairs, lengths


class Expander:
    """Decodes symbols of one block."""

    def __init__(self, first_rule: int, pairs: np.ndarray, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        flat = pairs.astype(np.uint32).reshape(-1)
        while len(rule := np.flatnonzero(flat >= first_rule)):  # all rules at once, a level of nesting at a time
            n = np.ones(len(flat), np.int64)
            n[rule] = 2
            at = (np.cumsum(n) - n)[rule]
            inner = pairs[flat[rule].astype(np.int64) - first_rule]
            flat = np.repeat(flat, n)
            flat[at], flat[at + 1] = inner[:, 0], inner[:, 1]
        # of every symbol, where its ids begin and how many they are: first the ids themselves, then the rules' expansions
        self.flat = np.concatenate((np.arange(first_rule, dtype=np.uint32), flat))
        self.starts = np.concatenate((np.arange(first_rule), first_rule + np.cumsum(self.lengths) - self.lengths)).astype(np.int32)
        self.widths = np.concatenate((np.ones(first_rule, np.int32), self.lengths.astype(np.int32)))

    def expand(self, s: np.ndarray) -> np.ndarray:
        return runs_of(self.flat, self.starts[s], self.widths[s])

    def span(self, s: np.ndarray, start: int, count: int) -> np.ndarray:
        """``count`` ids from ``start`` on, expanding only the symbols that hold them."""
        ends = np.cumsum(self.widths[s], dtype=np.int64)
        lo, hi = np.searchsorted(ends, start, "right"), np.searchsorted(ends, start + count, "left")
        skip = start - (int(ends[lo - 1]) if lo else 0)
        return self.expand(s[lo:hi + 1])[skip:skip + count]


# ----------------------------------------------------------------- encoding

class LibraryCoder:
    """Encodes texts with a file of the tokenizers library; repeated parts are encoded once.

    New parts are encoded joined together (each begins where the library's own pattern cuts)
    and told apart by the bytes that each id stands for. Texts that hold an added token of the file (the library
    finds those before it cuts) are encoded whole, by themselves."""

    def __init__(self, path: str, **table):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = sorted(t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values())
        self.added = re.compile(b"|".join(map(re.escape, added))) if added else None
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.width = np.zeros(self.size, np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token)  # the byte alphabet writes a byte as a character
        self.table = PartTable(self.encode_parts, **table)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def encode_parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts in a row, and how many each has."""
        joinable = np.array([len(p) > 1 and p[0] == 32 and bool(SAFE[p[1]]) for p in parts])
        counts, flat = np.zeros(len(parts), np.int64), []
        order = np.concatenate((np.flatnonzero(~joinable), np.flatnonzero(joinable)))
        alone = len(parts) - int(joinable.sum())
        for k in order[:alone].tolist():
            flat.append(self.whole(parts[k].decode()))
            counts[k] = len(flat[-1])
        for at in range(alone, len(parts), 20_000):
            group = order[at:at + 20_000]
            joined = [parts[k] for k in group.tolist()]
            ids = self.whole(b"".join(joined).decode())
            upto = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined))), "right")
            counts[group] = np.diff(upto, prepend=0)
            flat.append(ids)
        ids = np.concatenate(flat)
        place = np.empty(len(parts), np.int64)
        place[order] = np.cumsum(counts[order]) - counts[order]
        return runs_of(ids, place, counts), counts

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has. Bytes that aren't UTF-8 are replaced."""
        texts = whole_utf8(texts)
        odd = [k for k, raw in enumerate(texts) if self.added and self.added.search(raw)]
        if not odd:
            return self.table.encode_texts(texts)
        apart = {k: self.whole(texts[k].decode()) for k in odd}
        ids, counts = self.table.encode_texts([b"" if k in apart else raw for k, raw in enumerate(texts)])
        pieces = np.split(ids, np.cumsum(counts)[:-1])
        for k, own in apart.items():
            pieces[k], counts[k] = own, len(own)
        return np.concatenate(pieces), counts


@lru_cache(2)
def _coder(path: str) -> LibraryCoder:
    return LibraryCoder(path)


# ----------------------------------------------------------------- files

def write_token_files(docs: DataFrame, tokenizer_path: str, out: str, end_id: int = 0, rules: GrammarRules = GrammarRules()) -> None:
    """Writes all documents, in ascending doc_id order over the blocks, to the folder ``out``."""
    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    rows = text_bytes(ordered, "doc_id", F.spark_partition_id().alias("shard"))

    def pack(shard: int, block: int, coder: LibraryCoder, ids: list, docs_: list, sizes: list) -> pa.RecordBatch:
        flat = np.concatenate(ids)
        symbols, pairs, expansions = compress(flat, coder.size, rules)
        width = 2 if coder.size + len(pairs) <= 1 << 16 else 4
        row = [shard, block, len(flat), coder.size, width, pairs.astype("<u4").tobytes(), expansions.astype("<u4").tobytes(), symbols.astype(f"<u{width}").tobytes(),
               np.array([d or 0 for d in docs_], "<i8").tobytes(), np.array([d is None for d in docs_], np.uint8).tobytes(), np.array(sizes, "<u4").tobytes()]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32()] + [pa.binary()] * 6
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=[c.split()[0] for c in BLOCKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, block, ids, held, lengths, n, shard = _coder(tokenizer_path), 0, [], [], [], 0, 0
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for part in chunks(batch):
                shard = part.column("shard")[0].as_py()
                flat, counts = coder.encode(part.column("text").to_pylist())
                for doc, upto, size in zip(part.column("doc_id").to_pylist(), np.cumsum(counts).tolist(), counts.tolist()):
                    if ids and n + size >= rules.block_ids:
                        yield pack(shard, block, coder, ids, held, lengths)
                        block, ids, held, lengths, n = block + 1, [], [], [], 0
                    ids += [flat[upto - size:upto], end]
                    held.append(doc)
                    lengths.append(size + 1)
                    n += size + 1
        if ids:
            yield pack(shard, block, coder, ids, held, lengths)

    rows.mapInArrow(run, BLOCKS).write.option("compression", "zstd").parquet(out)


def block_starts(blocks: DataFrame) -> DataFrame:
    """(shard, block, start): the number of ids in all blocks before. Shards are summed
    first, so the only unpartitioned window runs over one row per shard."""
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    inner = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    places = blocks.select("shard", "block", "n_ids").withColumn("inner", F.coalesce(inner, F.lit(0))).join(shards, "shard")
    return places.select("shard", "block", (F.col("base") + F.col("inner")).alias("block_start"))


def read_token_files(blocks: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32. Blocks are decoded
    where they are read; only a narrow row per document meets the blocks' starts."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                s = np.frombuffer(r["symbols"], f"<u{r['symbol_bytes']}")
                ids = Expander(r["first_rule"], np.frombuffer(r["rules"], "<u4").reshape(-1, 2), np.frombuffer(r["rule_lengths"], "<u4")).expand(s).astype("<u4")
                n = np.frombuffer(r["doc_lengths"], "<u4").astype(np.int64)
                ends = np.cumsum(n)
                crc = [zlib.crc32(ids[e - k:e]) for e, k in zip(ends.tolist(), n.tolist())]
                doc = pa.array(np.frombuffer(r["doc_ids"], "<i8"), mask=np.frombuffer(r["no_id"], np.uint8).astype(bool))
                place = [pa.array(np.full(len(n), r[c], np.int32)) for c in ("shard", "block")]
                yield pa.RecordBatch.from_arrays([doc, *place, pa.array(ends - n), pa.array(n), pa.array(crc, pa.int64())], names=["doc_id", "shard", "block", "inside", "n_tokens", "ids_crc32"])

    rows = blocks.mapInArrow(run, "doc_id long, shard int, block int, inside long, n_tokens long, ids_crc32 long")
    placed = rows.join(block_starts(blocks), ["shard", "block"])
    return placed.select("doc_id", (F.col("block_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def read_document(row: dict, k: int) -> np.ndarray:
    """Ids of the k-th document of one block row, without expanding the others."""
    s = np.frombuffer(row["symbols"], f"<u{row['symbol_bytes']}")
    n = np.frombuffer(row["doc_lengths"], "<u4").astype(np.int64)
    maker = Expander(row["first_rule"], np.frombuffer(row["rules"], "<u4").reshape(-1, 2), np.frombuffer(row["rule_lengths"], "<u4"))
    return maker.span(s, int(n[:k].sum()), int(n[k]))
