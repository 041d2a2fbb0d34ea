"""Chat formatting as prefix trees: initial turns that conversations share are emitted once."""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: The template. A turn is START role MIDDLE text END; no control string can occur inside role or text.
START, MIDDLE, END = "<|turn|>", "<|text|>", "<|end|>\n"
TURN = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>\n", re.S)
ASSISTANT = "assistant"
#: Tokens of a tree's sequence. A conversation that is longer is a sequence of its own.
SEQUENCE_TOKENS = 8192
#: Rows that the reader, and a batch for Python, hold at a time. A conversation may be long, a sequence takes 40 KB or more:
#: the thousands that are usual with short rows are hundreds of MB in each task, on both sides.
AT_ONCE = {"spark.sql.parquet.columnarReaderBatchSize": 64, "spark.sql.execution.arrow.maxRecordsPerBatch": 64}
#: Parts of turns that a worker holds encoded and decoded: the marks around texts, and the turns of the tree at hand.
HELD = 256


def escape(text: str) -> str:
    """``<|`` gets a backslash between, and backslashes that stand there one more."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation; anything between turns is an error."""
    turns, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"not a formatted conversation at {at}")
    return turns


@functools.cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(HELD)
def _encoded(path: str, text: str) -> list[int]:
    return _tokenizer(path).encode(text, add_special_tokens=False).ids


@functools.lru_cache(HELD)
def _decoded(path: str, ids: tuple[int, ...]) -> str:
    return _tokenizer(path).decode(ids, skip_special_tokens=False)


class Node:
    __slots__ = ("ids", "loss", "children", "leaves", "start", "end", "position", "parent", "seen")

    def __init__(self, ids, loss, parent):
        self.ids, self.loss, self.parent = ids, loss, parent
        self.children: dict[tuple[str, str], Node] = {}
        self.leaves: list[str] = []


class Tree:
    """Conversations with shared initial turns merged; the tokens of every node are held once."""

    def __init__(self, encode):
        self.root, self.size, self.encode = Node([], (0, 0), None), 0, encode

    def cost(self, turns: list[tuple[str, str]]) -> list[tuple]:
        """What a conversation would add: the node it leaves the tree at and its further turns, encoded."""
        node, k = self.root, 0
        while k < len(turns) and turns[k] in node.children:
            node, k = node.children[turns[k]], k + 1
        return [node, [(turn, *self.encode(*turn)) for turn in turns[k:]]]

    def add(self, name: str, node: Node, rest: list[tuple]) -> None:
        for turn, ids, loss in rest:
            node.children[turn] = node = Node(ids, loss, node)
            self.size += len(ids)
        node.leaves.append(name)

    def row(self, name: str) -> pa.RecordBatch:
        """The tree depth-first: ids, position ids, loss mask; for each node its place, parent, the end of its
        subtree and the intervals of ids that it attends to: its ancestors' and, up to the token, its own."""
        ids, positions, mask, nodes, attention, leaves = [], [], [], [], [], []
        size, stack = 0, [(self.root, -1, 0, [])]
        while stack:
            node, above, position, seen = stack.pop()
            if isinstance(above, tuple):  # all below it is out
                nodes[above[0]]["subtree_end"] = size
                continue
            number, start = len(nodes), size
            size += len(node.ids)
            ids.append(np.asarray(node.ids, np.int32))
            positions.append(np.arange(position, position + len(node.ids), dtype=np.int32))
            counted = np.zeros(len(node.ids), bool)
            counted[slice(*node.loss)] = True
            mask.append(counted)
            own = list(seen)
            if node.ids and own and own[-1][1] == start:
                own[-1] = (own[-1][0], size)
            elif node.ids:
                own.append((start, size))
            nodes.append({"parent": above, "start": start, "end": size, "position": position, "subtree_end": size})
            attention.append([{"start": a, "end": b} for a, b in own])
            leaves += [{"content": leaf, "node": number} for leaf in node.leaves]
            stack.append((node, (number,), 0, ()))
            for child in reversed(node.children.values()):
                stack.append((child, number, position + len(node.ids), own))
        one = lambda parts: pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), pa.array(np.concatenate(parts)))
        small = [pa.array([x], SEQUENCE.field(c).type) for c, x in (("nodes", nodes), ("attention", attention), ("leaves", leaves))]
        return pa.RecordBatch.from_arrays([pa.array([name]), one(ids), one(positions), one(mask), *small], schema=SEQUENCE)


INTERVAL = pa.struct([("start", pa.int32()), ("end", pa.int32())])
SEQUENCE = pa.schema([
    ("sequence_id", pa.string()), ("input_ids", pa.list_(pa.int32())), ("position_ids", pa.list_(pa.int32())),
    ("loss_mask", pa.list_(pa.bool_())),
    ("nodes", pa.list_(pa.struct([(n, pa.int32()) for n in ("parent", "start", "end", "position", "subtree_end")]))),
    ("attention", pa.list_(pa.list_(INTERVAL))),
    ("leaves", pa.list_(pa.struct([("content", pa.string()), ("node", pa.int32())])))])
SEQUENCE_SQL = (
    "sequence_id string, input_ids array<int>, position_ids array<int>, loss_mask array<boolean>, "
    "nodes array<struct<parent: int, start: int, end: int, position: int, subtree_end: int>>, "
    "attention array<array<struct<start: int, end: int>>>, leaves array<struct<content: string, node: int>>")


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, content, turns: one row per conversation, its (role, text) in the order of turn, role and text.
    ``content`` is a hash of them. A conversation is the unit that is formatted and hashed as a whole. Null roles and
    texts are empty, a null turn comes first, a null conv_id is a conversation; a row that repeats is a turn more."""
    empty = F.lit("")
    item = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), empty).alias("role"),
                    F.coalesce(F.col("text").cast("string"), empty).alias("text"))
    rows = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(item)).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    return rows.withColumn("content", F.md5(F.to_json("turns")))


def sequences(talks: DataFrame, tokenizer: str, tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """Prefix trees of the distinct contents of ``talks`` (content, turns), each as one token sequence.

    Equal conversations are one leaf. The others are sorted by the hashes of their turns, all of them, which
    brings those with shared turns side by side in depth-first order, and a task fills one tree after another
    up to ``tokens``. So conversations that begin alike, a third of the table say, lie in many sequences, each
    of which holds the shared turns once; no group is gathered. Within a sequence every turn's position
    ids go on from its parent's and the attention intervals cover just its ancestors. A turn is the unit of
    the tokenizer, a conversation that of the tree, however long. An empty table gives no sequences.
    """

    def encode(role: str, text: str) -> tuple[list[int], tuple[int, int]]:
        head, body, end = (_encoded(tokenizer, x) for x in (START + escape(role) + MIDDLE, escape(text), END))
        loss = (len(head), len(head) + len(body)) if role == ASSISTANT else (0, 0)
        return head + body + end, loss

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, first = Tree(encode), None
        for batch in batches:
            for content, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                turns = [(t["role"], t["text"]) for t in turns]
                node, rest = tree.cost(turns)
                if tree.size and tree.size + sum(len(r[1]) for r in rest) > tokens:
                    yield tree.row(first)
                    tree, first = Tree(encode), None
                    node, rest = tree.cost(turns)
                first = first or content
                tree.add(content, node, rest)
        if first:
            yield tree.row(first)

    order = F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"]))
    distinct = talks.select("content", "turns").dropDuplicates(["content"]).withColumn("_order", order)
    dealt = distinct.repartitionByRange("_order", "content").sortWithinPartitions("_order", "content")
    return dealt.select("content", "turns").mapInArrow(run, SEQUENCE_SQL)


def read_back(packed: DataFrame, tokenizer: str) -> DataFrame:
    """content, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of every conversation in the
    sequences, from its tokens: those of its last turn's ancestors, in order, and the loss mask over them."""

    def paths(ids: np.ndarray, mask: np.ndarray, row: dict) -> Iterator[tuple]:
        nodes = row["nodes"]
        texts: dict[int, tuple[str, str]] = {}

        def of(number: int) -> tuple[str, str]:
            if number not in texts:
                own = slice(nodes[number]["start"], nodes[number]["end"])
                tokens, counted = ids[own], mask[own]
                cuts = np.flatnonzero(np.diff(counted)) + 1  # what is under the mask and what isn't are decoded once each
                parts = [(_decoded(tokenizer, tuple(t.tolist())), c[0]) for t, c in zip(np.split(tokens, cuts), np.split(counted, cuts)) if len(t)]
                texts[number] = "".join(t for t, _ in parts), unescape("".join(t for t, c in parts if c))
            return texts[number]

        for leaf in row["leaves"]:
            chain, number = [], leaf["node"]
            while number >= 0:
                chain.append(of(number))
                number = nodes[number]["parent"]
            formatted = "".join(c[0] for c in reversed(chain))
            loss = "".join(c[1] for c in reversed(chain))
            turns = parse(formatted)
            told = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode())
            yield (leaf["content"], len(turns), told.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                   len(formatted))

    names = ["content", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                ids, mask = (one.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1))
                rows = list(paths(ids, mask, one.select(["nodes", "leaves"]).to_pylist()[0]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return packed.select("input_ids", "loss_mask", "nodes", "leaves").mapInArrow(
        run, "content string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
