"""Secrets by patterns and a linear-chain conditional random field.

Patterns find assignments, access keys and long hexadecimal strings. The field adds what
they miss: every line is a sequence of tokens (runs of letters and digits) that Viterbi tags
begin, inside or outside of a secret. Features: shape and word of the token, the words and
the marks around it, the file. A token that outside tags beat whatever its neighbours are
tagged splits its line, and the stretches between such tokens are decoded on their own: the
tags are those of the whole line. The field is trained on lines of a bounded sample with the
patterns' finds as tags (conditional likelihood, forward-backward), so it generalises their
shapes and contexts.

Spans are half-open, in code points. Edge cases: null and empty texts have no spans (the
digest of nothing); a find of the field that meets a pattern's, or has under ``least_chars``
letters and digits, is dropped; without any tagged token the field adds nothing; repeated
rows and null ids get a row each and are one text of the sample.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from array import array
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_value, map_chunks, stored, text_bytes

# The base patterns and their least lengths, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 8, 16, 32
KINDS = ("assign", "access", "hex", "crf")
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")

OUT, BEGIN, IN = 0, 1, 2
TOKEN = re.compile(rb"[A-Za-z0-9]+")
ITEM = re.compile(rb"[A-Za-z0-9]+|[^A-Za-z0-9]+")
HEX_TABLE = bytes(104 if c in b"0123456789abcdef" else 32 for c in range(256))


#: Bytes of text that a task works on at a time: its tokens as objects take many times that.
SLICE = 1 << 20
#: Places of the words whose features count for a token, and of the marks beside it.
WORDS, MARKS = {"w": 0, "w-1": -1, "w-2": -2, "w-3": -3, "w+1": 1, "w+2": 2}, {"g-1": 0, "g+1": 1}


@dataclass(frozen=True)
class CrfRules:
    least_chars: int = 8  #: letters and digits of a find of the field
    sample_rows: int = 20_000  #: bound of the documents whose lines the field is trained on
    sample_bytes: int = 1 << 19  #: bound of those lines' tokens together
    plain_lines: int = 64  #: one in so many lines without a find is trained on, and counts so many times
    line_tokens: int = 100  #: longer lines are trained on in pieces of so many tokens
    rounds: int = 40
    rate: float = 0.2
    ridge: float = 1e-3
    min_count: int = 2  #: tokens of the sample that have a feature
    table_rows: int = 400_000  #: words whose weights a task remembers


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the patterns' finds, by start, then kind."""
    found = []
    low = raw.lower()
    if any(w.encode() in low for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if b"AKIA" in raw:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    if b"h" * HEX_CHARS in raw.translate(HEX_TABLE):
        found += [(m.start(), m.end(), 2) for m in HEX.finditer(text) if len(m[0]) >= HEX_CHARS]
    return sorted(found, key=lambda s: (s[0], s[2]))


@lru_cache(1 << 16)
def half_bits(n: int, counts: tuple[int, ...]) -> int:
    """Entropy of a token of ``n`` characters, in half bits rounded down."""
    return int(-sum(k / n * math.log2(k / n) for k in counts) * 2)


def shape(token: bytes) -> tuple:
    """Length, digits, capitals, entropy, whether hexadecimal, first characters where it has capitals."""
    n = len(token)
    digits, upper = n - len(token.translate(None, b"0123456789")), n - len(token.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return n, digits, upper, half_bits(n, tuple(sorted(map(token.count, set(token))))), not token.translate(None, b"0123456789abcdefABCDEF"), token[:2] if upper else b"-"


def shape_features(key: tuple) -> list[str]:
    n, digits, upper, entropy, hexadecimal, first = key
    size = min(int(math.log2(n) * 2), 14)
    mix = "".join(c for c, k in (("d", digits), ("A", upper), ("a", n - digits - upper)) if k)
    return ["bias", f"size={size}", f"mix={mix}", f"mix={mix},size={size}", f"digits={digits * 4 // n}", f"entropy={entropy}", f"hex={hexadecimal}", f"first={first.decode('ascii')}"]


def file_features(raw: bytes) -> list[str]:
    n = max(len(raw), 1)
    return [f"file.size={len(raw).bit_length() // 3}", f"file.assign={min(3, 400 * (raw.count(b'=') + raw.count(b':')) // n)}", f"file.brace={min(2, 400 * (raw.count(b'{') + raw.count(b';')) // n)}"]


def word_features(token: bytes, role: str) -> list[str]:
    """Features that a token gives to the one at the place that ``role`` names (w: itself)."""
    name = f"{role}={token[:24].decode('ascii').lower()}"
    return [name] if role != "w" else [name, *shape_features(shape(token))] if token else []


def mark_features(gap: bytes, role: str) -> list[str]:
    """What lies between two tokens of a line; a line's border is like no mark."""
    if b"\n" in gap:
        return [f"{role}="]
    return [f"{role}={(gap if len(gap) <= 6 else gap[:3] + gap[-3:]).decode('latin-1')}", f"{role}:assigns={b'=' in gap or b':' in gap}"]


def tagged(raw: bytes, rules: CrfRules = CrfRules()) -> list[dict]:
    """Training sequences of one text: its lines' tokens, the marks around them (one more), tags by the
    patterns (an assignment's value only), the file's features and a weight."""
    text = raw.decode("utf-8", "replace")
    to_byte = (lambda k: k) if raw.isascii() else (lambda k: len(text[:k].encode()))
    values = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    values += [(s, e) for s, e, kind in base_spans(text, raw) if kind]
    spans = sorted({(to_byte(s), to_byte(e)) for s, e in values})
    starts, out, file, base = [s for s, _ in spans], [], file_features(raw), 0
    for line in raw.split(b"\n"):
        items = ITEM.findall(b"\n" + line + b"\n") if line else []
        tokens, gaps = items[1::2], items[::2]
        at = base - 1 + np.cumsum([0, *map(len, items)])
        base += len(line) + 1
        inside = [owner(spans, starts, int(s), int(e)) for s, e in zip(at[1:-1:2], at[2::2])]
        for k in range(0, len(tokens), rules.line_tokens):
            part, hits = tokens[k:k + rules.line_tokens], inside[k:k + rules.line_tokens]
            plain = not any(h is not None for h in hits)
            if plain and zlib.crc32(b" ".join(part)) % rules.plain_lines:
                continue
            tags = [OUT if h is None else IN if t and hits[t - 1] == h else BEGIN for t, h in enumerate(hits)]
            out.append({"tokens": part, "gaps": gaps[k:k + len(part) + 1], "tags": tags, "file": file, "weight": rules.plain_lines if plain else 1})
    return out


def owner(spans: list[tuple[int, int]], starts: list[int], s: int, e: int) -> int | None:
    """The find that holds a token."""
    k = bisect_right(starts, s) - 1
    return k if k >= 0 and e <= spans[k][1] else None


def broken(sequence: dict) -> dict | None:
    """The sequence with its finds of one token broken into pieces by blanks, as they are when read aloud or
    wrapped; None without any."""
    tokens, gaps, tags = [], [sequence["gaps"][0]], []
    for token, tag, gap in zip(sequence["tokens"], sequence["tags"], sequence["gaps"][1:]):
        size = max(3, len(token) // 4) if tag == BEGIN and len(token) >= ASSIGN_CHARS else len(token)
        pieces = [token[k:k + size] for k in range(0, len(token), size)]
        tokens += pieces
        tags += [tag] + [IN] * (len(pieces) - 1)
        gaps += [b" "] * (len(pieces) - 1) + [gap]
    return sequence | {"tokens": tokens, "gaps": gaps, "tags": tags} if len(tokens) > len(sequence["tokens"]) else None


# ----------------------------------------------------------------- the field

#: Inside only follows begin or inside.
BARRED = np.zeros((3, 3))
BARRED[OUT, IN] = -1e4


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def marginals(emission: np.ndarray, trans: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token and transition marginals of equally long sequences (n, length, 3) that begin and
    end beside an outside token; transitions include those of both borders and count by the
    sequences' weights."""
    n, length, _ = emission.shape
    weight = np.ones(n) if weight is None else weight
    alpha, beta = np.zeros_like(emission), np.zeros_like(emission)
    alpha[:, 0] = trans[OUT] + emission[:, 0]
    for t in range(1, length):
        alpha[:, t] = log_sum(alpha[:, t - 1, :, None] + trans, 1) + emission[:, t]
    beta[:, -1] = trans[:, OUT]
    for t in range(length - 2, -1, -1):
        beta[:, t] = log_sum(trans + (emission[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
    z = log_sum(alpha[:, -1] + beta[:, -1], 1)
    token = np.exp(alpha + beta - z[:, None, None])
    pair = np.zeros((3, 3))
    pair[OUT] += weight @ token[:, 0]
    pair[:, OUT] += weight @ token[:, -1]
    for t in range(1, length):
        pair += np.tensordot(weight, np.exp(alpha[:, t - 1, :, None] + trans + (emission[:, t] + beta[:, t])[:, None, :] - z[:, None, None]), 1)
    return token, pair, z


def viterbi(emission: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best tags of equally long sequences (n, length, 3)."""
    n, length, _ = emission.shape
    best, back = trans[OUT] + emission[:, 0], np.zeros((n, length, 3), np.int64)
    for t in range(1, length):
        step = best[:, :, None] + trans
        back[:, t] = step.argmax(1)
        best = step.max(1) + emission[:, t]
    tags = np.zeros((n, length), np.int64)
    tags[:, -1] = (best + trans[:, OUT]).argmax(1)
    for t in range(length - 1, 0, -1):
        tags[:, t - 1] = back[np.arange(n), t, tags[:, t]]
    return tags


class Slots:
    """For every token of the training sequences, which distinct word or mark stands at each place, and the
    features of those."""

    def __init__(self, sequences: list[dict], least: int):
        words, marks, files = {b"": 0}, {b"\n": 0}, {(): 0}
        self.at: dict[str, np.ndarray] = {}
        at = {role: array("i") for role in [*WORDS, *MARKS, "file"]}
        for q in sequences:
            n, alone = len(q["tokens"]), q.get("alone")
            own = [words.setdefault(t, len(words)) for t in q["tokens"]]
            between = [0] + [marks.setdefault(g, len(marks)) for g in q["gaps"][1:-1]] + [0]
            for role, shift in WORDS.items():
                at[role].extend([0] * n if alone and shift else [own[t + shift] if 0 <= t + shift < n else 0 for t in range(n)])
            for role, shift in MARKS.items():
                at[role].extend([0] * n if alone else between[shift:shift + n])
            at["file"].extend([files.setdefault(tuple(q["file"]), len(files))] * n)
        made = {role: [word_features(t, role) for t in words] for role in WORDS} | {role: [mark_features(g, role) for g in marks] for role in MARKS} | {"file": [list(f) for f in files]}
        seen: Counter = Counter()
        for role, features in made.items():
            self.at[role] = np.array(at[role])
            for n, fs in zip(np.bincount(self.at[role], minlength=len(features)).tolist(), features):
                for f in fs:
                    seen[f] += n
        self.index = {f: k for k, f in enumerate(sorted(f for f, n in seen.items() if n >= least))}
        self.of = {}
        for role, features in made.items():
            cols = [[self.index[f] for f in fs if f in self.index] for fs in features]
            self.of[role] = (np.array([c for cs in cols for c in cs], np.int64), np.repeat(np.arange(len(cols)), list(map(len, cols))), len(cols))

    def scores(self, w: np.ndarray) -> np.ndarray:
        return sum(np.stack([np.bincount(row, w[cols, k], n) for k in range(w.shape[1])], 1)[self.at[role]] for role, (cols, row, n) in self.of.items())

    def slope(self, rest: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.index), rest.shape[1]))
        for role, (cols, row, n) in self.of.items():
            for k in range(rest.shape[1]):
                out[:, k] += np.bincount(cols, np.bincount(self.at[role], rest[:, k], n)[row], len(self.index))
        return out


def fit(sequences: list[dict], rules: CrfRules = CrfRules()) -> dict | None:
    """Weights {feature: (begin, inside)} and transitions that maximise the conditional likelihood.

    Sequences of like lengths are computed together; shorter ones end in outside tokens, which change nothing."""
    if not any(t for q in sequences for t in q["tags"]):
        return None
    sequences = sequences + [b for q in sequences if (b := broken(q))]
    # every line is also taught without the words and marks around its tokens, so that shape can decide alone
    sequences = sorted((q | {"alone": alone} for q in sequences for alone in (False, True)), key=lambda q: len(q["tokens"]))
    slots = Slots(sequences, rules.min_count)
    sizes = np.array([len(q["tokens"]) for q in sequences])
    ends, total = np.cumsum(sizes), float(sum(q["weight"] for q in sequences))
    data, first = [], 0
    while first < len(sizes):
        last = int(np.searchsorted(sizes, max(8, sizes[first] * 3 // 2), "right"))
        own, length = sizes[first:last], int(sizes[last - 1])
        real = np.arange(length) < own[:, None]
        tags = np.zeros(real.shape, np.int64)
        tags[real] = [t for q in sequences[first:last] for t in q["tags"]]
        weight = np.array([float(q["weight"]) for q in sequences[first:last]])
        framed = np.pad(tags, ((0, 0), (1, 1)))
        pair = np.zeros((3, 3))
        np.add.at(pair, (framed[:, :-1], framed[:, 1:]), np.broadcast_to(weight[:, None], framed[:, 1:].shape))
        data.append((slice(int(ends[first] - sizes[first]), int(ends[last - 1])), real, np.eye(3)[tags], weight, pair))
        first = last
    w, trans = np.zeros((len(slots.index), 2)), np.zeros((3, 3))
    m = [np.zeros_like(w), np.zeros_like(trans)]
    v = [np.zeros_like(w), np.zeros_like(trans)]
    for step in range(1, rules.rounds + 1):
        scores, gt, rest = slots.scores(w), -rules.ridge * trans, np.zeros((int(ends[-1]), 2))
        for here, real, gold, weight, pair in data:
            emission = np.zeros((*real.shape, 3))
            emission[..., BEGIN:] = -1e4
            emission[real, BEGIN:] = scores[here]
            token, pairs, _ = marginals(emission, trans + BARRED, weight)
            rest[here] = ((gold - token) * (weight / total)[:, None, None])[real][:, BEGIN:]
            gt += (pair - pairs) / total
        gw = slots.slope(rest) - rules.ridge * w
        for k, (x, g) in enumerate(((w, gw), (trans, gt))):
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
            x += rules.rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return {"weights": {f: (float(w[k, 0]), float(w[k, 1])) for f, k in slots.index.items()}, "trans": (trans + BARRED).tolist()}


def training_sequences(docs: DataFrame, rules: CrfRules) -> list[dict]:
    """Tagged lines of about ``sample_rows`` documents, chosen by a hash of the text (equal texts are one),
    taken in the order of the hashes up to ``sample_bytes``."""
    total = docs.count()
    share = int(min(1.0, rules.sample_rows / max(total, 1)) * 1_000_000)
    key = F.xxhash64("text", F.lit(23))
    some = docs.filter(F.col("text").isNotNull() & (F.pmod(key, F.lit(1_000_000)) < share)).groupBy(key.alias("key")).agg(F.min("text").alias("text"))

    def run(part):
        return {"sequences": [tagged(raw, rules) for raw in part.column("text").to_pylist()]}

    made = map_chunks(text_bytes(some, "key"), "sequences array<struct<tokens:array<binary>,gaps:array<binary>,tags:array<int>,file:array<string>,weight:int>>", run, "key")
    lines = stored(made.select("key", F.posexplode("sequences").alias("line", "s")).select("key", "line", "s", F.aggregate("s.tokens", F.lit(0), lambda n, t: n + F.octet_length(t)).alias("bytes")), "secret-lines")
    cuts = lines.groupBy("key").agg(F.sum("bytes").alias("bytes")).orderBy("key").collect()  # a narrow row for each text of the sample
    taken, left = [], rules.sample_bytes
    for r in cuts:
        if r["bytes"] <= left:
            taken.append((r["key"],))
            left -= r["bytes"]
    chosen = F.broadcast(docs.sparkSession.createDataFrame(taken, "key long"))
    rows = lines.join(chosen, "key").select("key", "line", "s.*").collect()
    return [{"tokens": list(map(bytes, r["tokens"])), "gaps": list(map(bytes, r["gaps"])), "tags": r["tags"], "file": r["file"], "weight": r["weight"]}
            for r in sorted(rows, key=lambda r: (r["key"], r["line"]))]


class ScoreRows(dict):
    """word or mark -> its row of scores (begin and inside for each place), made on demand."""

    def __init__(self, model: dict, roles: dict, limit: int):
        super().__init__()
        self.weights, self.roles, self.limit = model["weights"], list(roles), limit
        self.table = np.zeros((1024, 2 * len(roles)), np.float32)
        self.breaks = np.zeros(1024, bool)

    def __missing__(self, key: bytes) -> int:
        row = self[key] = len(self)
        if row >= len(self.table):
            self.table, self.breaks = (np.concatenate([x, np.zeros_like(x)]) for x in (self.table, self.breaks))
        self.breaks[row] = b"\n" in key
        self.table[row] = self.scores(key)
        return row

    def scores(self, key: bytes):
        return [x for role in self.roles for x in self.total(mark_features(key, role))]

    def total(self, features: list[str]) -> tuple[float, float]:
        found = [self.weights.get(f, (0.0, 0.0)) for f in features]
        return sum(x for x, _ in found), sum(x for _, x in found)

    def rows(self, keys: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))


class WordRows(ScoreRows):
    """The rows of words: most are in no feature of the model, and many share a shape."""

    def __init__(self, model: dict, limit: int):
        super().__init__(model, WORDS, limit)
        self.known: dict[bytes, np.ndarray] = {}
        for f, w in self.weights.items():
            role, _, name = f.partition("=")
            if role in WORDS:
                k = 2 * self.roles.index(role)
                self.known.setdefault(name.encode(), np.zeros(2 * len(self.roles)))[k:k + 2] = w
        self.shapes: dict[tuple, np.ndarray] = {}

    def scores(self, key: bytes):
        if not key:
            return self.known.get(key, 0.0)
        kind = shape(key)
        own = self.shapes.get(kind)
        if own is None:
            if len(self.shapes) >= self.limit:
                self.shapes.clear()
            own = self.shapes[kind] = np.array([*self.total(shape_features(kind)), *[0.0] * (2 * len(self.roles) - 2)])
        near = self.known.get(key[:24].lower())
        return own if near is None else own + near


class Field:
    """The trained field with the scores of the words it has met."""

    def __init__(self, model: dict, rules: CrfRules):
        self.words, self.marks = WordRows(model, rules.table_rows), ScoreRows(model, MARKS, rules.table_rows)
        self.weights, self.trans, self.least = model["weights"], np.array(model["trans"]), rules.least_chars
        o, inner = self.trans[OUT], range(BEGIN, IN + 1)
        #: most that a tag other than outside can gain by its transitions; what follows it begins anew without it
        self.most = [max(self.trans[a, x] + self.trans[x, c] - self.trans[a, OUT] - o[BEGIN if c else OUT] for a in range(3) for c in range(3)) for x in inner]

    def scored(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """start, end, text, line and emission (outside, begin, inside) of every token."""
        items = ITEM.findall(b"\n" + b"\n".join(texts) + b"\n")
        own, between = self.words.rows(items[1::2]), self.marks.rows(items[::2])
        ends = np.cumsum(np.fromiter(map(len, items), np.int64, len(items))) - 1
        start, end = ends[:-1:2], ends[1::2]
        line = np.cumsum(self.marks.breaks[between])[:-1]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        first = np.cumsum(sizes) - sizes
        text = np.searchsorted(first, start, "right") - 1
        emission = np.zeros((len(own), 3))
        empty = self.words[b""]
        for k, shift in enumerate(WORDS.values()):
            there = np.full(len(own), empty)
            a, b = (slice(max(0, -shift), len(own) - max(0, shift)), slice(max(0, shift), len(own) + min(0, shift)))
            there[a] = np.where(line[a] == line[b], own[b], empty)
            emission[:, BEGIN:] += self.words.table[there, 2 * k:2 * k + 2]
        for k, shift in enumerate(MARKS.values()):
            emission[:, BEGIN:] += self.marks.table[between[shift:len(own) + shift], 2 * k:2 * k + 2]
        file = np.array([np.sum([self.weights.get(f, (0.0, 0.0)) for f in file_features(t)], 0) for t in texts])
        emission[:, BEGIN:] += file[text]
        return start - first[text], end - first[text], text, line, emission

    def tags(self, line: np.ndarray, emission: np.ndarray) -> np.ndarray:
        """Best tags of every line."""
        tags = np.zeros(len(line), np.int64)
        if not len(line):
            return tags
        follows = np.append(line[1:] == line[:-1], False)
        renewed = np.where(follows, np.append(np.maximum(0, emission[1:, IN] - emission[1:, BEGIN]), 0), 0)
        open_ = np.maximum(emission[:, BEGIN] + self.most[0], emission[:, IN] + self.most[1]) + renewed >= 0
        at = np.flatnonzero(open_)
        if not len(at):
            return tags
        new = np.append(True, (np.diff(at) > 1) | (line[at[1:]] != line[at[:-1]]))
        starts = at[new]
        sizes = np.diff(np.append(np.flatnonzero(new), len(at)))
        for length in np.unique(sizes).tolist():
            where = starts[sizes == length][:, None] + np.arange(length)
            tags[where] = viterbi(emission[where], self.trans)
        return tags

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int]]]:
        """Byte ranges tagged as secrets."""
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not texts:
            return out
        start, end, text, line, emission = self.scored(texts)
        tags = self.tags(line, emission)
        for k in np.flatnonzero(tags).tolist():
            own, (s, e) = out[text[k]], (int(start[k]), int(end[k]))
            if tags[k] == BEGIN:
                own.append((s, e))
            else:
                own[-1] = (own[-1][0], e)
        return [[(s, e) for s, e in own if sum(map(len, TOKEN.findall(raw[s:e]))) >= self.least] for raw, own in zip(texts, out)]


def all_spans(texts: list[bytes], field: Field | None) -> list[list[tuple[int, int, int]]]:
    """(start, end, kind) in code points: the patterns' finds and what the field adds."""
    found = []
    for raw, extra in zip(texts, field.spans(texts) if field else [[] for _ in texts]):
        text = raw.decode("utf-8", "replace")
        spans = base_spans(text, raw)
        for s, e in extra:
            if not raw.isascii():
                s, e = len(raw[:s].decode("utf-8", "replace")), len(raw[:e].decode("utf-8", "replace"))
            if not any(s < b and a < e for a, b, _ in spans if _ < 3):
                spans.append((s, e, 3))
        found.append(sorted(spans, key=lambda s: (s[0], s[2])))
    return found


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def scan(docs: DataFrame, model: dict | None, rules: CrfRules = CrfRules(), carry="doc_id", redact: str | None = None) -> DataFrame:
    """Per document: counts by kind, digest of the base spans, all spans; with ``redact``
    also the text with every span replaced by it (null where there is none)."""
    shared = broadcast_value(docs, model)
    holder: list[Field | None] = []
    schema = "n_assign long, n_access long, n_hex long, n_crf long, base_sha256 string, spans string" + (", redacted string" if redact is not None else "")

    def run(part):
        if not holder:
            holder.append(Field(shared.value, rules) if shared.value else None)
        texts = part.column("text").to_pylist()
        found = all_spans(texts, holder[0])
        out = {f"n_{kind}": [sum(s[2] == k for s in spans) for spans in found] for k, kind in enumerate(KINDS)}
        out["base_sha256"] = [hashlib.sha256(listed([s for s in spans if s[2] < 3]).encode()).hexdigest() for spans in found]
        out["spans"] = [listed(spans) for spans in found]
        if redact is not None:
            out["redacted"] = [replaced(raw.decode("utf-8", "replace"), spans, redact) if spans else None for raw, spans in zip(texts, found)]
        return out

    df = text_bytes(docs, carry)
    return map_chunks(df, schema, run, df.columns[0], limit=SLICE)


def replaced(text: str, spans: list[tuple[int, int, int]], by: str) -> str:
    out, at = [], 0
    for s, e, _ in spans:  # sorted by start; overlapping ones are replaced together
        if s >= at:
            out += [text[at:s], by]
        at = max(at, e)
    return "".join(out) + text[at:]


def find_secrets(docs: DataFrame, rules: CrfRules = CrfRules()) -> DataFrame:
    """Spans of all documents by a field trained on a sample of them."""
    return scan(docs, fit(training_sequences(docs, rules), rules), rules)
