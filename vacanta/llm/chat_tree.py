"""Chat formatting into prefix trees.

Conversations that share initial turns share them in the output. Conversations are first
reduced to distinct ones, then ordered by the chain digests of their turns: in this order
shared beginnings are neighbours, so each task emits its range depth-first with a stack,
and every turn under the same history is written once per pack. A pack is a bounded
stretch of text that stands alone; a pack that begins inside a tree repeats the open history.

A node (one turn) carries its interval in the pack's text, its parent, the position id of
its first character (positions count along the conversation, not along the pack), its loss
interval (assistant texts only) and the intervals it attends to (its ancestors', joined
where they touch; besides these a character attends to earlier ones of its own node). Units
are code points.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles a backslash is put
between ``<`` and ``|`` (after those that stand there already), so no control string occurs
in them, and taking one away restores them; roles also have line ends and backslashes written
as escapes.

Edge cases: null texts and roles are empty; turns with one number stand by role and text, repeated
rows are repeated turns; rows without conv_id form one conversation; an empty table has only what
the caller adds.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_code
from .common import stored

# The control strings of the template and the role under the loss.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

ESCAPED, UNESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<(\\*)\\\|")
TURN = re.compile(re.escape(TURN_START) + r"(.*?)\n(.*?)" + re.escape(TURN_END) + r"\n", re.DOTALL)
ROLE_ESCAPE = re.compile(r"\\(.)")

PACKS = ("pack long, text string, start array<int>, length array<int>, parent array<int>, position array<int>, loss array<struct<start:int,end:int>>, "
         "attends array<array<struct<start:int,end:int>>>, leaves array<struct<path:binary,node:int>>")


@dataclass(frozen=True)
class TreeRules:
    pack_chars: int = 1 << 20  #: a pack is closed when it is longer; one conversation always fits


def escape(text: str) -> str:
    return ESCAPED.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return UNESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return ROLE_ESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def whole_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns, path, order): the turns in order; path is the digest of all of them,
    order the chain of digests after each turn."""
    rows = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def run(batches):
        for batch in batches:
            orders = []
            for turns_ in batch.column("turns").to_pylist():
                chain, last = [], b""
                for t in turns_:
                    role, text = t["role"].encode(), t["text"].encode()
                    last = xxhash.xxh3_128_digest(last + len(role).to_bytes(8, "little") + role + text)
                    chain.append(last)
                orders.append(b"".join(chain))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("turns"), pa.array([o[-16:] for o in orders], pa.binary()), pa.array(orders, pa.binary())], names=["conv_id", "turns", "path", "order"])

    kind = grouped.schema["turns"].dataType.simpleString()
    return grouped.mapInArrow(run, f"conv_id {grouped.schema['conv_id'].dataType.simpleString()}, turns {kind}, path binary, order binary")


class Pack:
    """One pack under construction; paths must come in order."""

    def __init__(self):
        self.text, self.size, self.stack = [], 0, []  # stack: (digest, node)
        self.rows = {k: [] for k in ("start", "length", "parent", "position", "loss", "attends", "leaves")}

    def add(self, turns: list[dict], order: bytes) -> None:
        chain = [order[k:k + 16] for k in range(0, len(order), 16)]
        shared = 0
        while shared < min(len(chain), len(self.stack)) and self.stack[shared][0] == chain[shared]:
            shared += 1
        del self.stack[shared:]
        for turn, digest in zip(turns[shared:], chain[shared:]):
            self.stack.append((digest, self.node(turn, self.stack[-1][1] if self.stack else -1)))
        self.rows["leaves"].append({"path": chain[-1], "node": self.stack[-1][1]})

    def node(self, turn: dict, parent: int) -> int:
        r, head, body = self.rows, TURN_START + escape_role(turn["role"]) + "\n", escape(turn["text"])
        written = head + body + TURN_END + "\n"
        start = self.size
        loss = (start + len(head), start + len(head) + len(body)) if turn["role"] == LOSS_ROLE else (start, start)
        seen, position = [], 0
        if parent >= 0:
            end = r["start"][parent] + r["length"][parent]
            seen, position = [dict(x) for x in r["attends"][parent]], r["position"][parent] + r["length"][parent]
            if seen and seen[-1]["end"] == r["start"][parent]:
                seen[-1]["end"] = end
            else:
                seen.append({"start": r["start"][parent], "end": end})
        for k, v in (("start", start), ("length", len(written)), ("parent", parent), ("position", position), ("loss", {"start": loss[0], "end": loss[1]}), ("attends", seen)):
            r[k].append(v)
        self.text.append(written)
        self.size += len(written)
        return len(r["start"]) - 1

    def row(self, number: int) -> dict:
        return {"pack": number, "text": "".join(self.text)} | self.rows


def pack_trees(paths: DataFrame, rules: TreeRules = TreeRules()) -> DataFrame:
    """Packs of distinct conversations (turns, path, order)."""
    ordered = paths.select("turns", "order").repartitionByRange("order").sortWithinPartitions("order").withColumn("part", F.spark_partition_id())

    def run(batches):
        pack, number, last = Pack(), 0, 0
        for batch in batches:
            for turns, order, last in zip(batch.column("turns").to_pylist(), batch.column("order").to_pylist(), batch.column("part").to_pylist()):
                if pack.size >= rules.pack_chars:
                    yield made(pack.row((last << 32) + number))
                    pack, number = Pack(), number + 1
                pack.add(turns, order)
        if pack.size:
            yield made(pack.row((last << 32) + number))

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(PACKS))

    def made(row):
        return pa.RecordBatch.from_pylist([row], schema=schema)

    return ordered.mapInArrow(run, PACKS)


def conversation(row: dict, node: int) -> tuple[str, list[tuple[int, int]]]:
    """Formatted text of the conversation that ends at ``node``, read through the intervals that
    the node attends to, and its loss intervals in the pack's text."""
    text = row["text"]
    spans = [(x["start"], x["end"]) for x in row["attends"][node]] + [(row["start"][node], row["start"][node] + row["length"][node])]
    loss = []
    while node >= 0:
        loss.append((row["loss"][node]["start"], row["loss"][node]["end"]))
        node = row["parent"][node]
    return "".join(text[s:e] for s, e in spans), loss[::-1]


def read_packs(packs: DataFrame) -> DataFrame:
    """One row per distinct conversation: path, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row, out = batch.slice(k, 1).to_pylist()[0], []
                for leaf in row["leaves"]:
                    text, loss = conversation(row, leaf["node"])
                    turns = [(unescape_role(m[1]), unescape(m[2])) for m in TURN.finditer(text)]
                    under = "".join(unescape(row["text"][s:e]) for s, e in loss)
                    out.append((leaf["path"], len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(under), hashlib.sha256(under.encode()).hexdigest(), len(text)))
                kinds = (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["path", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return packs.mapInArrow(run, "path binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def formatted(turns: DataFrame, folder: str, rules: TreeRules = TreeRules()) -> DataFrame:
    """Writes the packs of all conversations to ``folder`` and returns what each conversation reads there."""
    ship_code(turns.sparkSession)
    whole = stored(whole_conversations(turns), "conversations")
    pack_trees(whole.select("path", "order", "turns").dropDuplicates(["path"]), rules).write.parquet(folder)
    back = read_packs(turns.sparkSession.read.parquet(folder))
    return whole.select("conv_id", "path").join(back, "path").drop("path")
