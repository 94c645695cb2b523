"""Prefix trie of conversations from padded turn-id matrices.

Conversations are sequences of turns, and a node is a distinct sequence of first turns. Equal sequences are one class.
The classes are dealt by ranges of their sequences to shards, so that each node lies in one shard or along the two
borders of a shard. Inside a shard numpy builds matrices of turn numbers (one row a class, padded behind its end),
sorts their rows with ``lexsort``, marks in which columns a row differs from the one before, and accumulates these marks
with OR along the row: a mark is then the start of a node of that depth, and ``reduceat`` over the starts aggregates the
node's members. Long conversations are taken in blocks of columns: rows that go on after a block are sorted again
below the node they have reached.

Nodes on the paths of a shard's first and last sequence may go on in the next shard. They leave their shard as parts
and are put together afterwards; all others are final.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.shipping import ship_with_tasks
from tidemark.llm.common import stage

ship_with_tasks(__name__)

ID_BYTES = 16       # of a SHA-256 of role and text
COLUMNS = 16        # turns of a matrix block
SHARD_BYTES = 8 << 20  # of packed turns; the matrices of a shard take some eight times as much
ENDS_CHUNK = 4_096  # conversation ids of a chunk
SALTS = 16
NO_ENDS = hashlib.sha256(b"").hexdigest()
HEAD_TURNS = 3


# ------------------------------------------------------------------ turns and sequences

def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, id (32 hex digits of role and text) and words of every row with a conv_id; null role or text is empty."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The role's length keeps role and text apart.
    identity = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * ID_BYTES)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), identity.alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def _ordered(rows: DataFrame, *by: str) -> DataFrame:
    """Each conversation's turns as an array of (id, words): by turn, null first, then by id."""
    entry = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0).cast("long")).alias("turn"), "id", "words")
    listed = F.transform(F.array_sort(F.collect_list(entry)), lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words")))
    return rows.groupBy(*by).agg(listed.alias("turns"))


def _packed(rows: DataFrame) -> DataFrame:
    """conv_id, ids (16 bytes a turn, so that bytes sort as sequences do) and words of each turn."""
    ids = F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), ""))
    return rows.select("conv_id", ids.alias("ids"), F.transform("turns", lambda t: t["words"]).alias("words"))


def sequences(conversations: DataFrame) -> DataFrame:
    """Conversations as they are: conv_id, ids, words."""
    return _packed(_ordered(turns(conversations), "conv_id"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Conversations with shared beginnings: conv_id, ids, words.

    Conversation c begins with the first h turns of conversation c - c % 20 (all if fewer, none if absent), h being
    crc32 of c in decimal digits modulo 4, and goes on with its own turns after the first h. One shuffle, by c - c % 20.
    """
    rows = turns(conversations).withColumn("base", F.col("conv_id") - F.col("conv_id") % 20)
    own = _ordered(rows.repartition("base"), "base", "conv_id")
    heads = own.where("conv_id = base").select("base", F.slice("turns", 1, HEAD_TURNS).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int")
    none = F.array().cast("array<struct<id:string,words:bigint>>")
    tail = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    both = F.concat(F.slice(F.coalesce("head", none), F.lit(1), h), tail)
    return _packed(own.join(heads, "base", "left").select("conv_id", both.alias("turns")))


# ------------------------------------------------------------------ inside tasks: classes

def _ends(batches):
    """Chunks of conversation ids, sorted by class and id, to one row a class. Only a hash state is held."""
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    names = ["key", "conv_id", "n", "ends_sha256"]
    now, out = None, []

    def packed():
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], names=names)

    def closed():
        out.append((now[0], now[1], now[2], now[3].hexdigest()))

    for batch in batches:
        for key, first, n, text in zip(*[batch.column(c).to_pylist() for c in ("key", "first", "n", "text")]):
            if now is not None and key == now[0]:
                now[3].update(b",")
                now[2] += n
            else:
                if now is not None:
                    closed()
                now = [key, first, n, hashlib.sha256()]
            now[3].update(text.encode())
        if len(out) >= 10_000:
            yield packed()
            out.clear()
    if now is not None:
        closed()
    yield packed()


def classes(packed: DataFrame) -> DataFrame:
    """One row per distinct sequence: ids, words, conv_id (smallest member), n (members), ends_sha256 of the members' ids in
    ascending order, comma-joined.

    Ids meet in chunks of at most ``ENDS_CHUNK`` neighbouring numbers before they are shuffled; the hash of a class is
    sequential, so its chunks stream through one task, which holds one of them.
    """
    rows = stage(packed.withColumn("key", F.unhex(F.sha2("ids", 256))), "sequences")
    chunk = F.floor(F.col("conv_id") / F.lit(ENDS_CHUNK))
    chunks = rows.groupBy("key", chunk.alias("chunk")).agg(F.array_sort(F.collect_list("conv_id")).alias("held")).select(
        "key", F.get("held", F.lit(0)).alias("first"), F.size("held").cast("long").alias("n"),
        F.array_join(F.col("held").cast("array<string>"), ",").alias("text"))
    ended = chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(
        _ends, "key binary, conv_id long, n long, ends_sha256 string")
    return ended.join(rows.select("conv_id", "ids", "words"), "conv_id").select("conv_id", "ids", "words", "n", "ends_sha256")


# ------------------------------------------------------------------ inside tasks: one shard

def turn_numbers(packed: np.ndarray) -> np.ndarray:
    """Small whole numbers for the turn ids of a shard, equal where the 16 bytes are equal."""
    high, low = packed[0::2], packed[1::2]
    if not len(high):
        return np.zeros(0, np.int64)
    order = np.lexsort((low, high))
    new = np.ones(len(order), bool)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def shard_trie(numbers: np.ndarray, words: np.ndarray, bounds: np.ndarray, conv: np.ndarray, n: np.ndarray, width: int = COLUMNS):
    """All nodes of the given sequences, level by level.

    ``numbers`` and ``words`` hold the turns of all sequences behind each other, ``bounds`` where each begins. Returns a list
    of levels (depth 0 first), each a dict of arrays: parent (place in the level above), conv_id, n_convs, words (of the
    node's last turn), end (place of the sequence that ends there, -1 for none), row (place of one sequence that passes).
    """
    lengths = np.diff(bounds)
    rows = np.flatnonzero(lengths >= 0)
    root = {"parent": np.zeros(1, np.int64), "conv_id": np.array([conv.min()]), "n_convs": np.array([n.sum()]),
            "words": np.zeros(1, np.int64), "end": np.full(1, -1), "row": np.zeros(1, np.int64)}
    root["end"][:] = np.append(np.flatnonzero(lengths == 0), -1)[0]
    levels, at = [root], np.zeros(len(lengths), np.int64)  # at: the node of the last level that each row has reached
    first = 0
    while True:
        rows = rows[lengths[rows] > first]
        if not len(rows):
            return levels
        columns = first + np.arange(min(width, int(lengths[rows].max()) - first))
        held = columns < lengths[rows][:, None]
        place = np.where(held, bounds[rows][:, None] + columns, 0)
        matrix = np.where(held, numbers[place], -1)
        goes_on = lengths[rows] > first + len(columns)
        order = np.lexsort((goes_on, *matrix.T[::-1], at[rows]))
        rows, matrix, place = rows[order], matrix[order], place[order]
        changed = np.ones(matrix.shape, bool)
        changed[1:] = matrix[1:] != matrix[:-1]
        changed[1:, 0] |= at[rows][1:] != at[rows][:-1]
        np.logical_or.accumulate(changed, axis=1, out=changed)
        above = at[rows]
        for j in range(len(columns)):
            starts = np.flatnonzero(changed[:, j])
            real = matrix[starts, j] >= 0
            number = np.cumsum(real) - 1
            of_row = np.where(matrix[:, j] >= 0, number[np.cumsum(changed[:, j]) - 1], -1)
            begin = starts[real]
            # A class that ends here is the first row of its node: padding sorts first, as does what ends with the block.
            ends = lengths[rows[begin]] == first + j + 1
            levels.append({
                "parent": above[begin], "conv_id": np.minimum.reduceat(conv[rows], starts)[real],
                "n_convs": np.add.reduceat(n[rows], starts)[real], "words": words[place[begin, j]],
                "end": np.where(ends, rows[begin], -1), "row": rows[begin]})
            above = of_row
        at[rows] = above
        first += len(columns)


def subtree_sums(levels: list[dict], own: list[np.ndarray], inner: list[np.ndarray]) -> list[np.ndarray]:
    """Sums of ``own`` over each node's subtree, without the children that are not ``inner``. Children of a node lie side
    by side."""
    out = [values.copy() for values in own]
    for depth in range(len(levels) - 1, 0, -1):
        parent = levels[depth]["parent"]
        starts = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1])))
        out[depth - 1][parent[starts]] += np.add.reduceat(np.where(inner[depth], out[depth], 0), starts)
    return out


NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string, words long, key binary, parent_key binary")
_NODE_KINDS = [pa.int64()] * 7 + [pa.string(), pa.int64(), pa.binary(), pa.binary()]
_NODE_NAMES = [c.split(" ")[0] for c in NODE.split(", ")]


def path_keys(ids: bytes) -> list[bytes]:
    """A key of 32 bytes for every prefix of a sequence, the empty one first."""
    running, out = hashlib.sha256(), []
    out.append(running.digest())
    for k in range(0, len(ids), ID_BYTES):
        running.update(ids[k:k + ID_BYTES])
        out.append(running.digest())
    return out


def _nodes_of(table: pa.Table):
    """Nodes of one shard. ``key`` marks the nodes on the paths of its least and its greatest sequence: their sums leave
    out themselves and other such nodes, since both may go on in other shards. ``parent_key`` is their parent, and the
    parent of final nodes that hang on them."""
    ids = table.column("ids").combine_chunks().cast(pa.large_binary())
    sequences_ = ids.to_pylist()
    packed = np.frombuffer(b"".join(sequences_), np.uint64)
    lists = table.column("words").combine_chunks()
    words = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate(([0], np.cumsum([len(s) // ID_BYTES for s in sequences_]))).astype(np.int64)
    conv, n = (table.column(c).to_numpy().astype(np.int64) for c in ("conv_id", "n"))
    ends = table.column("ends_sha256").to_pylist()
    levels = shard_trie(turn_numbers(packed), words, bounds, conv, n)

    border = [{} for _ in levels]  # by depth: the nodes that may go on elsewhere, and their keys
    for row in {sequences_.index(min(sequences_)), sequences_.index(max(sequences_))}:
        keys = path_keys(sequences_[row])
        depth = len(keys) - 1
        node = int(np.flatnonzero(levels[depth]["end"] == row)[0])
        while depth >= 0:
            border[depth][node] = keys[depth]
            node, depth = int(levels[depth]["parent"][node]), depth - 1

    inner = [np.ones(len(level["parent"]), bool) for level in levels]
    for depth, nodes in enumerate(border):
        inner[depth][list(nodes)] = False
    children = [np.zeros(len(level["parent"]), np.int64) for level in levels]
    for depth in range(1, len(levels)):
        np.add.at(children[depth - 1], levels[depth]["parent"][inner[depth]], 1)
    # A border node hangs on border nodes only; what it is itself is known when its parts are together.
    own = [i & (c == 0) for i, c in zip(inner, children)], [np.where(i, (v["n_convs"] - 1) * v["words"], 0) for i, v in zip(inner, levels)]
    leaves, saved = (subtree_sums(levels, [x.astype(np.int64) for x in values], inner) for values in own)

    for depth, level in enumerate(levels):
        above = levels[depth - 1]["conv_id"][level["parent"]] if depth else np.zeros(1, np.int64)
        size = len(level["parent"])
        keys, parent_keys = np.full(size, None, object), np.full(size, None, object)
        for place, key in border[depth].items():
            keys[place] = key
        hanging = np.zeros(size, bool)
        for place, key in border[depth - 1].items() if depth else ():
            of_it = level["parent"] == place
            parent_keys[of_it] = key
            hanging |= of_it
        for a in range(0, size, 50_000):
            part = slice(a, a + 50_000)
            end = [ends[e] if e >= 0 else NO_ENDS for e in level["end"][part]]
            known = pa.array(above[part], pa.int64(), mask=hanging[part] | (depth == 0))
            count = len(end)
            yield pa.RecordBatch.from_arrays([
                pa.array(level["conv_id"][part]), pa.array(np.full(count, depth)), known, pa.array(level["n_convs"][part]),
                pa.array(children[depth][part]), pa.array(leaves[depth][part]), pa.array(saved[depth][part]),
                pa.array(end, pa.string()), pa.array(level["words"][part]), pa.array(list(keys[part]), pa.binary()),
                pa.array(list(parent_keys[part]), pa.binary())], names=_NODE_NAMES)


def _shard(batches):
    held = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
    if held:
        yield from _nodes_of(pa.concat_tables(held))


def _border_totals(batches):
    """Border nodes, each once, with what hangs on them: totals over the whole tree, deepest first."""
    held = [row for batch in batches for row in batch.to_pylist()]
    if not held:
        return
    rows = sorted(held, key=lambda r: -r["depth"])
    by_key = {r["key"]: r for r in rows}
    for r in rows:
        r["n_leaves"] += r["n_children"] == 0
        r["saved_tokens"] += (r["n_convs"] - 1) * r["words"]
        above = by_key.get(r["parent_key"])
        if above is not None:
            above["n_children"] += 1
            above["n_leaves"] += r["n_leaves"]
            above["saved_tokens"] += r["saved_tokens"]
            r["parent_conv_id"] = above["conv_id"]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[name] for r in rows], kind) for name, kind in zip(_NODE_NAMES, _NODE_KINDS)], names=_NODE_NAMES)


# ------------------------------------------------------------------ plan

RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(packed: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per node of the trie of the sequences ``packed`` (conv_id, ids, words; see :func:`sequences`): conv_id (the
    node's smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    ``saved_tokens`` adds over the subtree what a shared cache would save: each node's members but one, times the words of
    its last turn. Conversations without turns are members of the root alone. Rows without conv_id belong to no
    conversation and are left out; null role or text is empty; turns of one number are ordered by a digest of role and text,
    and repeated rows stay repeated turns. Very long texts are hashed whole. Other columns are ignored. Without any
    conversation there is no node.

    A conversation travels as one row of some 24 bytes a turn and must fit in a task. A shard holds about ``shard_bytes`` of
    such rows; equal sequences are one row before they are dealt. Two parts of a path a shard go through one task (at most
    two times shards times the longest conversation). To the driver go one number, the bytes of all sequences, and Spark's
    sample of sequences for the ranges.
    """
    distinct = stage(classes(packed), "classes")
    total = distinct.agg(F.sum(F.octet_length("ids") + 64)).first()[0]
    shards = max(1, -(-(total or 0) // shard_bytes))
    dealt = distinct.repartitionByRange(int(shards), "ids")
    nodes = stage(dealt.mapInArrow(_shard, NODE), "nodes")
    final = nodes.where("key is null")
    parts = nodes.where("key is not null").groupBy("key").agg(
        *[F.min(c).alias(c) for c in ("conv_id", "depth", "parent_key", "words", "parent_conv_id")],
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        # One shard at most holds the class that ends here; the others have the hash of no end.
        F.coalesce(F.max(F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256"))), F.lit(NO_ENDS)).alias("ends_sha256"))
    border = stage(parts.select(*_NODE_NAMES).repartition(1).mapInArrow(_border_totals, NODE), "border")
    # Many final nodes may hang on one border node, the root above all.
    named = border.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"),
                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salt = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int")
    hanging = final.where("parent_key is not null").withColumn("salt", salt).join(named, ["parent_key", "salt"]).withColumn(
        "parent_conv_id", F.col("found"))
    return final.where("parent_key is null").select(*RESULT).unionByName(hanging.select(*RESULT)).unionByName(
        border.select(*RESULT))
