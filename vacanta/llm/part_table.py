"""A table of encoded text parts, looked up for whole chunks of text at once.

A chunk's bytes are cut in front of every blank that a non-blank follows; the patterns of
the byte-level tokenizers cut there whatever stands around. Each part of up to 64 bytes
gets a 64-bit key from its bytes, whose first bits name its only place in the table; parts
that aren't there are encoded by the library, all together, and take their places.
Longer parts are encoded each time. What the table holds never changes a result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from .superminhash import mix

#: Bytes that may follow a blank at a cut: no space, no control, no first byte of a space beyond ASCII.
SAFE = np.ones(256, bool)
SAFE[:33] = SAFE[127:192] = False
SAFE[[0xC2, 0xE1, 0xE2, 0xE3]] = False
KEY_BYTES = 64


class PartTable:
    """Keys by place, with the start and number of each part's ids. ``encode`` gives the ids of a
    list of parts in a row, and how many each has; ``limit`` bounds the ids kept."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], bits: int = 22, limit: int = 1 << 24):
        self.encode, self.limit, self.shift = encode, limit, np.uint64(64 - bits)
        self.keys, self.starts, self.counts = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def keep(self, ids: np.ndarray) -> int:
        """Stores ids and returns where."""
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids[:self.used], np.zeros(max(len(self.ids), len(ids)), np.uint32)))
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def encode_texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        if self.used > self.limit:  # a full store is emptied, and the places with it
            self.keys[:], self.used = 0, 0
        raw = b"".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        starts, ends = cuts(raw, sizes)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        short = np.flatnonzero(ends - starts <= KEY_BYTES)
        keys = part_keys(raw, starts[short], ends[short])
        slots = (keys >> self.shift).astype(np.int64)
        source, counts = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int32)
        source[short], counts[short] = self.starts[slots], self.counts[slots]  # of parts that aren't there: overwritten
        new = np.flatnonzero(self.keys[slots] != keys)
        if len(new):
            distinct, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
            made, n = self.encode([raw[a:b] for a, b in zip(starts[short[new[first]]].tolist(), ends[short[new[first]]].tolist())])
            at = self.keep(made) + np.cumsum(n) - n
            source[short[new]], counts[short[new]] = at[back], n[back]
            own = (distinct >> self.shift).astype(np.int64)
            self.keys[own], self.starts[own], self.counts[own] = distinct, at, n
        long = np.flatnonzero(ends - starts > KEY_BYTES)
        if len(long):
            made, n = self.encode([raw[a:b] for a, b in zip(starts[long].tolist(), ends[long].tolist())])
            source[long], counts[long] = self.keep(made) + np.cumsum(n) - n, n
        upto = np.append(0, np.cumsum(counts, dtype=np.int64))[np.searchsorted(starts, np.append(0, np.cumsum(sizes)))]
        return runs_of(self.ids, source, counts), np.diff(upto)


def whole_utf8(texts: list[bytes]) -> list[bytes]:
    """The texts with bytes that aren't UTF-8 replaced."""
    out = []
    for raw in texts:
        if not raw.isascii():
            try:
                raw.decode()
            except UnicodeDecodeError:
                raw = raw.decode("utf-8", "replace").encode()
        out.append(raw)
    return out


def runs_of(ids: np.ndarray, source: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` that begin at ``source``, one after the other."""
    ends = np.cumsum(counts, dtype=np.int64)
    places = np.repeat(source - (ends - counts), counts)
    places += np.arange(len(places))
    return ids.take(places)


def cuts(raw: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts of texts that follow each other in ``raw``."""
    data = np.frombuffer(raw, np.uint8)
    blanks = np.flatnonzero(data[:-1] == 32) if len(data) else np.zeros(0, np.int64)
    blanks = blanks[SAFE[data[blanks + 1]]]
    edges = np.cumsum(sizes)
    closing = np.zeros(len(data) + 1, bool)
    closing[edges] = True
    blanks = blanks[~closing[blanks + 1]]  # a blank that closes its text isn't followed by the next one's bytes
    starts = np.sort(np.concatenate((blanks, (edges - sizes)[sizes > 0])))
    starts = starts[np.concatenate((starts[:1] >= 0, starts[1:] != starts[:-1]))]
    return starts, np.append(starts[1:], len(data))


def part_keys(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit keys of byte ranges of at most 64 bytes."""
    padded = raw + b"\0" * 8
    words = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))  # eight bytes from every place on
    left = ends - starts
    out = mix(left.astype(np.uint64) + np.uint64(0x51ED270B))
    open_ = np.arange(len(starts))
    for at in range(0, KEY_BYTES, 8):
        open_ = open_[left[open_] > at]
        if not len(open_):
            break
        rest = np.minimum(left[open_] - at, 8)
        value = words[starts[open_] + at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * rest.astype(np.uint64)))
        out[open_] = mix(out[open_] * np.uint64(0x9E3779B97F4A7C15) + value)
    return out | np.uint64(1)  # an empty place holds 0
