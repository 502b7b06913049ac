"""Chat formatting with shared prefixes as a tree.

A turn is written ``<turn ROLE>TEXT</turn>`` and a line feed.  In texts a
backslash goes before each backslash and before ``<`` where ``turn`` or
``/turn`` follows; in roles before each of ``\\ < >``.  Both are undone by
taking away one backslash of each pair, so that a formatted conversation can be
read back.

Conversations are sorted by turn, then role, then text (nulls first; a null
role or text is empty, so that it may tie).  Equal conversations are one leaf.
Conversations that share their first turns share the nodes of these turns: a
tree is written depth-first, each node's characters and tokens once.  A token's
position id counts along its own path, and a node carries the token intervals
of its ancestors and of itself, which are all that its tokens attend to.

A row holds about ``LIMIT`` leaves at most.  A node with more below it is a row
of its own, and its children are dealt by hash into rows that name it: ``above``
lists the rows of the turns before, whose tokens are all attended to, and
``base`` is their number of tokens, from which position ids go on.  So every
shared turn is written once, and copies and common first turns never meet in
one task.  One conversation, being one training sequence, is held whole.  An
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florilege.llm.bpe import encoder
from florilege.llm.shared import materialize, materialize_table, redealt, release

LIMIT = 128
#: Characters of the trees that are tokenised together.
BATCH = 1 << 20
IN_TEXT, IN_ROLE = re.compile(r"\\|<(?=/?turn)"), re.compile(r"[\\<>]")
PAIR = re.compile(r"\\(.)", re.DOTALL)
TURN = re.compile(r"<turn ((?:[^\\>]|\\.)*)>((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.DOTALL)
LEARNED = "assistant"

TREE = (
    "tree string, above array<string>, base bigint, text string, ids array<int>, position_ids array<int>, "
    "nodes array<struct<parent:int,char_start:int,char_end:int,start:int,end:int,loss_start:int,loss_end:int,attend:array<struct<start:int,end:int>>>>, "
    "leaves array<struct<node:int,leaf:binary>>"
)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn as it is written, and where its text begins and ends."""
    head = "<turn " + IN_ROLE.sub(r"\\\g<0>", role) + ">"
    body = IN_TEXT.sub(r"\\\g<0>", text)
    return head + body + "</turn>\n", len(head), len(head) + len(body)


def unescape(text: str) -> str:
    return PAIR.sub(r"\1", text)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation; it must hold nothing else."""
    out, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        out.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return out


def conversations(turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """conv, path (hash of each prefix), roles, texts of each conversation."""
    own = turns.select(F.col(conv_col).alias("conv"), F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    own = own.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("t"))
    own = own.withColumn("t", F.concat(F.filter("t", lambda t: t["turn"].isNull()), F.filter("t", lambda t: t["turn"].isNotNull())))
    kind = turns.schema[conv_col].dataType.simpleString()

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for roles, texts in zip(b.column("roles").to_pylist(), b.column("texts").to_pylist()):
                path, last = [], b""
                for role, text in zip(roles, texts):
                    role_bytes = role.encode()
                    last = xxhash.xxh3_128_digest(last + len(role_bytes).to_bytes(8, "little") + role_bytes + text.encode())
                    path.append(last)
                out.append(path)
            yield pa.RecordBatch.from_arrays([b.column("conv"), pa.array(out, pa.list_(pa.binary())), b.column("roles"), b.column("texts")], names=["conv", "path", "roles", "texts"])

    flat = own.select("conv", F.col("t.role").alias("roles"), F.col("t.text").alias("texts"))
    return flat.mapInArrow(paths, f"conv {kind}, path array<binary>, roles array<string>, texts array<string>")


def _order(leaves: list[tuple[list[bytes], list[str], list[str]]]) -> tuple[list[tuple[bytes, int]], dict[bytes, tuple[str, str]]]:
    """Nodes (key, place of the parent) depth-first, and each node's turn; leaves come sorted by path."""
    children: dict[bytes | None, list[bytes]] = {None: []}
    turn: dict[bytes, tuple[str, str]] = {}
    for path, roles, texts in leaves:
        above = None
        for key, role, text in zip(path, roles, texts):
            if key not in turn:
                turn[key] = (role, text)
                children[key] = []
                children[above].append(key)
            above = key
    order: list[tuple[bytes, int]] = []
    stack = [(key, -1) for key in reversed(children[None])]
    while stack:
        key, parent = stack.pop()
        at = len(order)
        order.append((key, parent))
        stack += [(child, at) for child in reversed(children[key])]
    return order, turn


def _offsets(counts: list[int]) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())


def _rows(trees: list[tuple], encode) -> pa.RecordBatch:
    """Rows of ``TREE`` for trees of (name, above, base, leaves, their keys): all turns are tokenised together."""
    shaped = [_order(leaves) for _, _, _, leaves, _ in trees]
    written = [[format_turn(*turn[key]) for key, _ in order] for order, turn in shaped]
    ids, counts = encode([w for part in written for w, _, _ in part])
    fields: dict[str, list[int]] = {k: [] for k in NODE}
    spans: tuple[list[int], list[int], list[int]] = ([], [], [])  # how many of each node, starts, ends
    places, leaf_nodes, leaf_keys, n_leaves, n_tokens = [], [], [], [], []
    first = 0
    for (_, _, base, _, keys), (order, turn), own in zip(trees, shaped, written):
        chars = tokens = 0
        ends, attends, where = [], [], {}
        for at, ((key, parent), (w, a, b)) in enumerate(zip(order, own)):
            n = int(counts[first + at])
            learned = turn[key][0] == LEARNED
            attend = list(attends[parent]) if parent >= 0 else []
            if attend and attend[-1][1] == tokens:  # the first child stands right behind
                attend[-1] = (attend[-1][0], tokens + n)
            else:
                attend.append((tokens, tokens + n))
            attends.append(attend)
            spans[0].append(len(attend))
            spans[1].extend(x for x, _ in attend)
            spans[2].extend(y for _, y in attend)
            begin = ends[parent] if parent >= 0 else base
            ends.append(begin + n)
            places.append(np.arange(begin, begin + n))
            for name, value in zip(NODE, (parent, chars, chars + len(w), tokens, tokens + n, chars + a if learned else -1, chars + b if learned else -1)):
                fields[name].append(value)
            where[key] = at
            chars, tokens = chars + len(w), tokens + n
        first += len(order)
        n_tokens.append(tokens)
        keys = [k for k in keys if k is not None]
        n_leaves.append(len(keys))
        leaf_nodes += [where[k] for k in keys]
        leaf_keys += keys
    spread = pa.StructArray.from_arrays([pa.array(spans[1], pa.int32()), pa.array(spans[2], pa.int32())], fields=list(_span))
    nodes = pa.StructArray.from_arrays([*(pa.array(fields[k], pa.int32()) for k in NODE), pa.ListArray.from_arrays(_offsets(spans[0]), spread)], fields=list(_node))
    leaves = pa.StructArray.from_arrays([pa.array(leaf_nodes, pa.int32()), pa.array(leaf_keys, pa.binary())], fields=list(_leaf))
    position = np.concatenate(places) if places else np.zeros(0, np.int64)
    per_tree = _offsets(n_tokens)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([t[0] for t in trees]), pa.array([t[1] for t in trees], pa.list_(pa.string())), pa.array([t[2] for t in trees], pa.int64()), pa.array(["".join(w for w, _, _ in own) for own in written], pa.string()),
            pa.ListArray.from_arrays(per_tree, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(per_tree, pa.array(position, pa.int32())),
            pa.ListArray.from_arrays(_offsets([len(order) for order, _ in shaped]), nodes), pa.ListArray.from_arrays(_offsets(n_leaves), leaves),
        ],
        names=["tree", "above", "base", "text", "ids", "position_ids", "nodes", "leaves"],
    )


NODE = ("parent", "char_start", "char_end", "start", "end", "loss_start", "loss_end")
_span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_node = pa.struct([*((k, pa.int32()) for k in NODE), ("attend", pa.list_(_span))])
_leaf = pa.struct([("node", pa.int32()), ("leaf", pa.binary())])


def _trunk(distinct: DataFrame, large: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """node, above (keys), role, text, ends (whether a conversation ends here), n_tokens, before (tokens above) of each node that is a row of its own."""
    at = F.col("depth")
    turns = large.join(distinct, "leaf").select("node", F.slice("path", F.lit(1), at).alias("above"), F.get("c.roles", at).alias("role"), F.get("c.texts", at).alias("text"), "ends")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary, pattern)
        for b in batches:
            n = own.count([format_turn(*x)[0] for x in zip(b.column("role").to_pylist(), b.column("text").to_pylist())])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64())], names=[*b.schema.names, "n_tokens"])
        release()

    counted = materialize(turns.mapInArrow(count, "node binary, above array<binary>, role string, text string, ends boolean, n_tokens bigint"))
    parts = counted.select("node", F.explode("above").alias("part")).join(counted.select(F.col("node").alias("part"), "n_tokens"), "part")
    before = parts.groupBy("node").agg(F.sum("n_tokens").alias("before"))
    return materialize(counted.join(before, "node", "left").withColumn("before", F.coalesce("before", F.lit(0))))


def prefix_trees(convs: DataFrame, vocabulary: str, pattern: str, limit: int = LIMIT) -> DataFrame:
    """The rows (see ``TREE``) of the distinct conversations of ``convs``."""
    leaf = F.element_at("path", -1)
    distinct = convs.filter("size(path) > 0").groupBy(leaf.alias("leaf")).agg(F.first("path").alias("path"), F.first(F.struct("roles", "texts")).alias("c"))
    distinct = materialize(distinct)
    places = distinct.select("leaf", F.size("path").alias("turns"), F.posexplode("path").alias("depth", "node"))
    ends = F.col("depth") + 1 == F.col("turns")
    large = places.groupBy("node").agg(F.count("*").alias("n"), F.min("leaf").alias("leaf"), F.first("depth").alias("depth"), F.max(ends).alias("ends"))
    large = materialize(large.filter(F.col("n") > limit))
    trunk = _trunk(distinct, large, vocabulary, pattern)
    deepest = places.join(redealt(large.select("node", "n")), "node").groupBy("leaf").agg(F.max(F.struct("depth", "node", "n")).alias("d")).select("leaf", "d.*")
    deepest = deepest.join(redealt(trunk.select("node", (F.col("before") + F.col("n_tokens")).alias("base"))), "node")
    split = F.pmod(F.xxhash64(F.get("path", F.col("depth") + 1)), F.ceil(F.col("n") / limit))
    top = F.col("depth").isNull()
    name = F.when(top, F.hex(F.get("path", F.lit(0)))).otherwise(F.concat(F.hex("node"), F.lit("-"), split.cast("string")))
    from_ = F.coalesce(F.col("depth") + 2, F.lit(1))
    rest = lambda c: F.slice(c, from_, F.size(c)).alias(c.split(".")[-1])
    named = distinct.join(deepest, "leaf", "left").select(
        name.alias("tree"), F.slice("path", F.lit(1), from_ - 1).alias("above"), F.coalesce("base", F.lit(0)).alias("base"), rest("path"), rest("c.roles"), rest("c.texts"), "leaf"
    )
    alone = trunk.select(F.hex("node").alias("tree"), "above", F.col("before").alias("base"), F.array("node").alias("path"), F.array("role").alias("roles"), F.array("text").alias("texts"), F.when(F.col("ends"), F.col("node")).alias("leaf"))
    rows = named.filter("size(path) > 0").unionByName(alone).withColumn("above", F.transform("above", F.hex))
    rows = rows.repartition("tree").sortWithinPartitions("tree", "path")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary, pattern)
        held: list[tuple] = []
        size = 0
        for b in batches:
            for tree, above, base, path, roles, texts, key in zip(*(b.column(c).to_pylist() for c in ("tree", "above", "base", "path", "roles", "texts", "leaf"))):
                if not held or held[-1][0] != tree:
                    if size > BATCH:
                        yield _rows(held, own.encode)
                        held, size = [], 0
                    held.append((tree, above, base, [], []))
                held[-1][3].append((path, roles, texts))
                held[-1][4].append(key)
                size += sum(map(len, texts))
        if held:
            yield _rows(held, own.encode)
        release()

    return rows.mapInArrow(build, TREE)


class _Reader:
    """What has been read along a path: each turn adds to the digests of the turns before."""

    __slots__ = ("turns", "whole", "learned", "n_learned", "chars")

    def __init__(self, before: _Reader | None = None) -> None:
        self.turns, self.n_learned, self.chars = (before.turns, before.n_learned, before.chars) if before else (0, 0, 0)
        self.whole, self.learned = (before.whole.copy(), before.learned.copy()) if before else (hashlib.sha256(), hashlib.sha256())

    def read(self, text: str, loss_start: int, loss_end: int) -> _Reader:
        """One written node; ``text`` is its own."""
        for role, own in read_turns(text):
            self.turns += 1
            self.whole.update(f"{role}\n{own}\n".encode())
        if loss_start >= 0:
            learned = unescape(text[loss_start:loss_end])
            self.learned.update(learned.encode())
            self.n_learned += len(learned)
        self.chars += len(text)
        return self


def read_back(trees: DataFrame) -> DataFrame:
    """leaf, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each leaf, from the trees alone.

    A turn is read once in its row, depth-first, and the turns above a row once
    for the row.
    """
    last = F.element_at("above", -1)
    node = F.get("nodes", F.lit(0))
    alone = trees.select(F.col("tree").alias("part"), "text", node["loss_start"].alias("loss_start"), node["loss_end"].alias("loss_end"))
    chains = trees.filter("size(above) > 0").select(last.alias("last"), "above").dropDuplicates(["last"])
    chains = chains.select("last", F.posexplode("above").alias("depth", "part")).join(alone, "part")
    chains = chains.groupBy("last").agg(F.sort_array(F.collect_list(F.struct("depth", "text", "loss_start", "loss_end"))).alias("chain"))  # one path
    rows = trees.withColumn("last", F.try_element_at("above", F.lit(-1))).join(redealt(chains), "last", "left").select("text", "nodes", "leaves", "chain")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, nodes, leaves, chain in zip(*(b.column(c).to_pylist() for c in ("text", "nodes", "leaves", "chain"))):
                above = _Reader()
                for x in chain or ():
                    above.read(x["text"], x["loss_start"], x["loss_end"])
                done: list[_Reader] = []
                for n in nodes:
                    begin = n["char_start"]
                    own = _Reader(done[n["parent"]] if n["parent"] >= 0 else above)
                    done.append(own.read(text[begin : n["char_end"]], n["loss_start"] - begin if n["loss_start"] >= 0 else -1, n["loss_end"] - begin))
                for x in leaves:
                    r = done[x["node"]]
                    out.append((x["leaf"], r.turns, r.whole.hexdigest(), r.n_learned, r.learned.hexdigest(), r.chars))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
                names=["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    schema = "leaf binary, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return rows.mapInArrow(read, schema)


def format_conversations(turns: DataFrame, vocabulary: str, pattern: str, conv_col: str = "conv_id", limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """The trees, and the membership: conversation id, leaf."""
    convs = materialize(conversations(turns, conv_col))
    return prefix_trees(convs, vocabulary, pattern, limit), convs.select(F.col("conv").alias(conv_col), F.element_at("path", -1).alias("leaf"))


def digests(turns: DataFrame, vocabulary: str, pattern: str, conv_col: str = "conv_id", limit: int = LIMIT) -> DataFrame:
    """One row per conversation: its id and what ``read_back`` finds in its tree."""
    trees, members = format_conversations(turns, vocabulary, pattern, conv_col, limit)
    trees = materialize_table(trees.select("tree", "above", "text", "nodes", "leaves"))
    return members.join(redealt(read_back(trees)), "leaf").drop("leaf")
