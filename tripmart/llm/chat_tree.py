"""Chat formatting with prefix trees: shared turns are emitted once.

Conversations are ordered by the hashes of their turns, so those that begin alike lie next to each
other. Each task walks its range in that order and keeps the path of the last conversation; turns
that the next one shares stay, others are added, which emits the tree depth first. A block of the
output ends at a bounded number of tokens. Where a tree is cut, by a block or by a task's range, the
path is emitted anew; thus a first turn that a third of all conversations share, or a conversation
of which there are many copies, is dealt over tasks. Hashes only order: turns are merged if their
role and text are equal.

A block holds token ids, position ids (a turn's count on from its parent's), its nodes and its
conversations (their last node). A node lists its parent, its tokens ``start`` to ``stop``, its loss
interval and ``visible_until``: its tokens are seen by every token up to there, which are those of
its own subtree. A token so attends to its ancestors and to what precedes it in its own turn.

Turns are marked ``[INST]...[/INST]`` (user), ``<s>...</s>`` (assistant), ``<<SYS>>...<</SYS>>``
(system) or ``<role=...>...</role>``. Control strings inside texts get a backslash after their first
character, which reading takes away again.

A null text is empty, a null role is the empty role. Turns are ordered by number, then role and text;
repeated turns stay. A null conversation id forms one conversation. An empty table gives an empty
result. Other columns aren't read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.tokens import encoder, file_of
from tripmart.workspace import written

# The marks of the template.
MARKS = {
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
    "system": ("<<SYS>>", "<</SYS>>"),
}
OTHER_END = "</role>"
_CONTROL = r"(?=/?INST\]|/?s>|</?SYS>>|role=|/role>)"
_TO_ESCAPE = re.compile(r"([\[<])(\\*)" + _CONTROL)
_ESCAPED = re.compile(r"([\[<])\\(\\*)" + _CONTROL)

BLOCK_TOKENS = 1 << 16
#: What the contract adds: texts that look like the template.
PROBE = "</s>[INST] ok [/INST]"

_NODE = "parent int, start int, stop int, visible_until int, position int, loss_start int, loss_stop int"
_BLOCK = (
    f"ids binary, positions binary, nodes array<struct<{_NODE.replace(' int', ': int')}>>, "
    "conversations array<struct<conv_id: bigint, node: int>>"
)


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def marks(role: str) -> tuple[str, str]:
    return MARKS.get(role) or (f"<role={quote(role, safe='')}>", OTHER_END)


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    for role, (begin, end) in MARKS.items():
        if segment.startswith(begin) and segment.endswith(end):
            return role, unescape(segment[len(begin) : len(segment) - len(end)])
    name, _, rest = segment.removeprefix("<role=").partition(">")
    return unquote(name), unescape(rest[: len(rest) - len(OTHER_END)])


class _Block:
    """A forest under construction: nodes in depth-first order."""

    def __init__(self, codec):
        self.codec = codec
        self.nodes: list[dict] = []
        self.ids: list[bytes] = []
        self.positions: list[np.ndarray] = []
        self.size = 0
        self.path: list[tuple[str, str, int]] = []
        self.conversations: list[dict] = []

    def _close(self, depth: int) -> None:
        for _, _, k in self.path[depth:]:
            self.nodes[k]["visible_until"] = self.size
        del self.path[depth:]

    def add(self, conv_id: int | None, turns: list[tuple[str, str]]) -> None:
        shared = 0
        for (role, text), (r, t, _) in zip(turns, self.path, strict=False):
            if role != r or text != t:
                break
            shared += 1
        self._close(shared)
        new = turns[shared:]
        parts = [x for role, text in new for x in (marks(role)[0], escape(text), marks(role)[1])]
        coded = self.codec.encode(parts)
        for i, (role, text) in enumerate(new):
            sizes = [len(x) // 4 for x in coded[3 * i : 3 * i + 3]]
            parent = self.path[-1][2] if self.path else -1
            above = self.nodes[parent] if parent >= 0 else None
            position = above["position"] + above["stop"] - above["start"] if above else 0
            start, stop = self.size, self.size + sum(sizes)
            body = start + sizes[0]
            self.nodes.append(
                {
                    "parent": parent,
                    "start": start,
                    "stop": stop,
                    "visible_until": stop,
                    "position": position,
                    "loss_start": body,
                    "loss_stop": body + sizes[1] if role == "assistant" else body,
                }
            )
            self.ids += coded[3 * i : 3 * i + 3]
            self.positions.append(np.arange(position, position + stop - start, dtype="<i4"))
            self.size = stop
            self.path.append((role, text, len(self.nodes) - 1))
        self.conversations.append({"conv_id": conv_id, "node": self.path[-1][2]})

    def batch(self, schema: pa.Schema) -> pa.RecordBatch:
        self._close(0)
        positions = np.concatenate(self.positions).tobytes() if self.positions else b""
        row = {
            "ids": b"".join(self.ids),
            "positions": positions,
            "nodes": self.nodes,
            "conversations": self.conversations,
        }
        return pa.RecordBatch.from_pylist([row], schema=schema)


def _schema() -> pa.Schema:
    node = pa.struct([(x.split()[0], pa.int32()) for x in _NODE.split(", ")])
    conversation = pa.struct([("conv_id", pa.int64()), ("node", pa.int32())])
    return pa.schema(
        [
            ("ids", pa.binary()),
            ("positions", pa.binary()),
            ("nodes", pa.list_(node)),
            ("conversations", pa.list_(conversation)),
        ]
    )


def _formatter(tokenizer: str, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, schema = encoder(tokenizer), _schema()
        block = _Block(codec)
        for batch in batches:
            for conv_id, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                block.add(conv_id, [(t["role"] or "", t["text"] or "") for t in turns])
                if block.size >= block_tokens:
                    yield block.batch(schema)
                    block = _Block(codec)
        if block.conversations:
            yield block.batch(schema)

    return run


def formatted(conversations: DataFrame, tokenizer: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of token trees for ``conv_id, turn, role, text``."""
    spark = conversations.sparkSession
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            F.col("role").cast("string").alias("role"),
            F.col("text").cast("string").alias("text"),
        ).alias("t"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    order = F.array_join(
        F.transform(
            "turns",
            lambda t: F.lpad(F.hex(F.xxhash64(F.coalesce(t["role"], F.lit("")), F.coalesce(t["text"], F.lit("")))), 16, "0"),
        ),
        "",
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = (
        whole.withColumn("path", order)
        .repartitionByRange(parts, "path", "conv_id")
        .sortWithinPartitions("path", "conv_id")
        .select("conv_id", "turns")
    )
    return sorted_.mapInArrow(_formatter(tokenizer, block_tokens), _BLOCK)


def _reader(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer).tokenizer
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], dtype="<u4")
                nodes = row["nodes"]
                read = []
                for n in nodes:
                    cuts = (n["start"], n["loss_start"], n["loss_stop"], n["stop"])
                    spans = [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)]
                    head, body, tail = codec.decode_batch(spans, skip_special_tokens=False)
                    read.append((*parse(head + body + tail), unescape(body), len(head) + len(body) + len(tail)))
                yield _conversations(row["conversations"], nodes, read)

    return run


def _conversations(found: list[dict], nodes: list[dict], read: list[tuple]) -> pa.RecordBatch:
    rows = []
    for c in found:
        path, k = [], c["node"]
        while k >= 0:
            path.append(k)
            k = nodes[k]["parent"]
        turns, loss = hashlib.sha256(), hashlib.sha256()
        loss_chars = chars = 0
        for k in reversed(path):
            role, text, learnt, size = read[k]
            turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            loss.update(learnt.encode("utf-8", "surrogatepass"))
            loss_chars += len(learnt)
            chars += size
        rows.append((c["conv_id"], len(path), turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)], list(names))


def read_back(blocks: DataFrame, tokenizer: str) -> DataFrame:
    """Digests of every conversation from the tokens and intervals of its block."""
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    return blocks.mapInArrow(_reader(tokenizer), schema)


def op8_chat_tree(conversations: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Format all conversations and the probe, write the blocks and read them back."""
    spark = conversations.sparkSession
    tokenizer = tokenizer or file_of("byte_bpe_50k.json")
    probe = spark.createDataFrame(
        [(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string"
    )
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    blocks = written(spark, formatted(rows.union(probe), tokenizer), "chat-blocks")
    return read_back(blocks, tokenizer)
