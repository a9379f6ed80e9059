"""Prefix trie of conversations: what they share from their first turn on.

Turns become digests, and a conversation the string of its digests. Conversations are sorted into range
shards by that string and their id, so copies of one conversation, however many, spread over shards.
Each shard numbers its turns and builds a ternary search tree over the numbers, balanced by inserting
medians first. Only the nodes on the paths of a shard's first and last conversation can also lie in
other shards; they are merged by one walk along the shards in order, the others are final.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import small_batches, words_column
from contrail.scratch import materialise

DIGITS = 32  # hexadecimal digits of a turn's digest
ROOT = "0" * DIGITS
CHUNK = 4096  # ids in one row of a list that continues in other shards

NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
# ``kind`` 0: a final node. 1: final but for the parent, which is a border node: ``parent_key``.
# 2: a border node, whose numbers are those of the subtrees that no other shard has. 3: ids that end
# at the border node ``key``. ``place`` orders the rows of a shard for the walk.
_PARTS = f"{NODES}, kind int, shard long, place long, key string, parent_key string, words long, ids string"


def rebuilt(turns: DataFrame, period: int = 20) -> DataFrame:
    """``conv_id``, ``path`` (digests of its turns, joined) and ``words`` (of each turn) of every
    conversation: the first h turns of the conversation that opens its group of ``period`` ids, then
    its own turns after its first h; h is crc32 of the id, modulo 4."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The length keeps apart a role and a text that are divided at different places.
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn"),
        role.alias("role"),
        F.substring(F.sha2(whole, 256), 1, DIGITS).alias("digest"),
        F.size(words_column(text, lower=False)).alias("words"),
    )
    own = (
        turns.filter(F.col("conv_id").isNotNull())
        .groupBy(F.col("conv_id").cast("long").alias("conv_id"))
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select(
            "conv_id",
            F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("own"),
            (F.col("conv_id") - F.col("conv_id") % period).alias("opening"),
            (F.crc32(F.col("conv_id").cast("string")) % 4).cast("int").alias("h"),
        )
    )
    openings = own.filter(F.col("conv_id") == F.col("opening")).select("opening", F.slice("own", 1, 3).alias("head"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast("array<struct<digest:string,words:int>>"))
    rest = F.slice("own", F.col("h") + 1, F.size("own") + 1)
    return (
        own.join(openings, "opening", "left")
        .select("conv_id", F.concat(head, rest).alias("all"))
        .select("conv_id", F.array_join("all.digest", "").alias("path"), F.col("all.words").alias("words"))
    )


def medians(n: int) -> Iterator[int]:
    """0 to n-1, the middle of every range before its halves."""
    ranges = [(0, n)]
    while ranges:
        low, high = ranges.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            ranges += [(middle + 1, high), (low, middle)]


class TernaryTrie:
    """A ternary search tree over sequences of numbers. Node 0 is the root of the trie; every other
    node is a prefix, found from its parent's ``first`` child by ``lower`` and ``higher`` siblings."""

    def __init__(self) -> None:
        self.symbol, self.lower, self.higher, self.first = [-1], [-1], [-1], [-1]
        self.parent, self.depth = [-1], [0]

    def insert(self, symbols: list[int]) -> int:
        """The node of the whole sequence; nodes that are missing on the way are made."""
        node = 0
        for s in symbols:
            child = self.first[node]
            if child < 0:
                child = self.first[node] = self._new(s, node)
            else:
                while (at := self.symbol[child]) != s:
                    side = self.lower if s < at else self.higher
                    if side[child] < 0:
                        side[child] = self._new(s, node)
                    child = side[child]
            node = child
        return node

    def _new(self, symbol: int, parent: int) -> int:
        for column, value in (
            (self.symbol, symbol), (self.lower, -1), (self.higher, -1), (self.first, -1),
            (self.parent, parent), (self.depth, self.depth[parent] + 1),
        ):
            column.append(value)
        return len(self.symbol) - 1

    def in_order(self) -> Iterator[int]:
        """Nodes before their children, siblings in the order of their symbols; no recursion."""
        yield 0
        stack = [(self.first[0], False)]
        while stack:
            node, open_ = stack.pop()
            if node < 0:
                continue
            if open_:
                yield node
                stack.append((self.first[node], False))
            else:
                stack += [(self.higher[node], False), (node, True), (self.lower[node], False)]


def joined(ids) -> str:
    return ",".join(map(str, ids))


def _child_key(key: str, digest: str) -> str:
    return hashlib.sha256((key + digest).encode()).hexdigest()[:DIGITS]


def shard_parts(paths: list[str], words: list, ids: list[int], shard: int) -> list[tuple]:
    """The rows of one shard, whose conversations ascend by path and id: its nodes and, for nodes that
    other shards may have too, what they need to be merged."""
    # Equal paths are neighbours: one insertion for all of them.
    starts = [k for k in range(len(paths)) if k == 0 or paths[k] != paths[k - 1]] + [len(paths)]
    distinct = [[paths[k][i : i + DIGITS] for i in range(0, len(paths[k]), DIGITS)] for k in starts[:-1]]
    turns = sorted({d for path in distinct for d in path})
    number = {d: k for k, d in enumerate(turns)}
    size = [0] * len(turns)
    for k, path in zip(starts, distinct):
        for d, n in zip(path, words[k]):
            size[number[d]] = int(n)

    trie = TernaryTrie()
    ends = {}
    for k in medians(len(distinct)):
        ends[trie.insert([number[d] for d in distinct[k]])] = (starts[k], starts[k + 1])

    n = len(trie.symbol)
    members, least = [0] * n, [None] * n
    for node, (low, high) in ends.items():
        members[node], least[node] = high - low, ids[low]
    border = {}
    for path in (distinct[0], distinct[-1]):
        node = 0
        border[0] = ROOT
        for d in path:
            parent, node = node, _find(trie, node, number[d])
            border[node] = _child_key(border[parent], d)

    order = list(trie.in_order())
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    for node in reversed(order):
        own_words = size[trie.symbol[node]] if node else 0
        if node not in border:
            leaves[node] += children[node] == 0
            saved[node] += (members[node] - 1) * own_words
        if (parent := trie.parent[node]) < 0:
            continue
        members[parent] += members[node]
        if least[parent] is None or least[node] < least[parent]:
            least[parent] = least[node]
        if node not in border:
            children[parent] += 1
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]

    rows, place = [], 0
    empty = hashlib.sha256().hexdigest()
    for node in order:
        parent = trie.parent[node]
        low, high = ends.get(node, (0, 0))
        counts = (members[node], children[node], leaves[node], saved[node])
        if node in border:
            own_words = size[trie.symbol[node]] if node else 0
            rows.append((least[node], trie.depth[node], None, *counts, None, 2, shard, place,
                         border[node], border.get(parent), own_words, None))
            place += 1
            for k in range(low, high, CHUNK):
                rows.append((0, trie.depth[node], None, 0, 0, 0, 0, None, 3, shard, place,
                             border[node], None, 0, joined(ids[k : min(k + CHUNK, high)])))
                place += 1
        else:
            found = hashlib.sha256(joined(ids[low:high]).encode()).hexdigest() if high else empty
            held = border.get(parent)
            rows.append((least[node], trie.depth[node], None if held else least[parent], *counts, found,
                         1 if held else 0, shard, None, None, held, None, None))
    return rows


def _find(trie: TernaryTrie, node: int, symbol: int) -> int:
    child = trie.first[node]
    while trie.symbol[child] != symbol:
        child = (trie.lower if symbol < trie.symbol[child] else trie.higher)[child]
    return child


def _frames(rows: list[tuple], schema: str, size: int = 10_000) -> Iterator[pd.DataFrame]:
    names = [field.split()[0] for field in schema.split(", ")]
    kinds = {f.split()[0]: {"long": "Int64", "int": "Int32", "string": object}[f.split()[1]] for f in schema.split(", ")}
    for k in range(0, len(rows), size):
        yield pd.DataFrame(rows[k : k + size], columns=names, dtype=object).astype(kinds)


def _build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    paths, words, ids = [], [], []
    for batch in batches:
        paths += batch["path"].tolist()
        words += batch["words"].tolist()
        ids += batch["conv_id"].tolist()
    if ids:
        yield from _frames(shard_parts(paths, words, ids, TaskContext.get().partitionId()), _PARTS)


class _Open:
    """A border node that later shards may still add to."""

    def __init__(self, row) -> None:
        self.key, self.parent_key, self.depth, self.words = row.key, row.parent_key, row.depth, row.words
        self.least, self.members, self.children, self.leaves, self.saved = row.conv_id, 0, 0, 0, 0
        self.ends, self.any = hashlib.sha256(), False

    def add(self, row) -> None:
        self.least = min(self.least, row.conv_id)
        self.members += row.n_convs
        self.children += row.n_children
        self.leaves += row.n_leaves
        self.saved += row.saved_tokens

    def end(self, ids: str) -> None:
        self.ends.update(("," * self.any + ids).encode())
        self.any = True


_MERGED = f"{NODES}, key string, parent_key string"


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merges the border nodes. Rows come by shard, and within a shard parents before children in the
    order of the turns, so a node is complete when a row comes that does not lie under it."""
    path: list[_Open] = []
    done: list[tuple] = []

    def close() -> None:
        node = path.pop()
        node.leaves += node.children == 0
        node.saved += (node.members - 1) * node.words
        if path:
            above = path[-1]
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved
        done.append((node.least, node.depth, None, node.members, node.children, node.leaves, node.saved,
                     node.ends.hexdigest(), node.key, node.parent_key))

    for batch in batches:
        for row in batch.itertuples(index=False):
            depth = int(row.depth)
            # A node that a later shard goes on with stays open, and so does what lies under it.
            if not (len(path) > depth and path[depth].key == row.key):
                while len(path) > depth:
                    close()
                path.append(_Open(row))
            if row.kind == 3:
                path[depth].end(row.ids)
            else:
                path[depth].add(row)
        yield from _frames(done, _MERGED)
        done.clear()
    while path:
        close()
    yield from _frames(done, _MERGED)


def prefix_trie(
    turns: DataFrame, period: int = 20, shard_turns: int = 250_000, least_turns: int = 20_000
) -> DataFrame:
    """One row per distinct sequence of first turns, from the root (no turn) on: ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns, of any name, are not
    read. Turns go by ``turn``, null first; equal ones by role, then by the digest of the text, and
    repeated rows are turns each. A null role or text is empty. Rows without a conversation are left
    out. An empty table has no conversation and gives no rows, not even the root.

    Shards hold about ``shard_turns`` turns (fewer in a small table, but not under ``least_turns`` for
    the sake of parallel work). A shard needs memory for its own digests, 32 bytes a turn, never for
    texts; so does a conversation, however long its texts are. The walk over border nodes is one task
    that reads two paths a shard, and the ids that end on them as rows of up to ``CHUNK`` ids: SHA-256
    of one list can only be taken in order. It keeps one path in memory.
    """
    spark = turns.sparkSession
    small_batches(spark)
    sequences = materialise(rebuilt(turns, period), "sequences")
    total = sequences.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(-(-total // shard_turns), min(wanted, -(-total // least_turns)), 1)
    sorted_shards = sequences.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    parts = materialise(sorted_shards.mapInPandas(_build, _PARTS), "trie-parts", partition_by="kind")

    border = parts.filter("kind >= 2").drop("parent_conv_id", "ends_sha256")
    in_order = border.coalesce(1).sortWithinPartitions("shard", "place")
    merged = materialise(in_order.mapInPandas(_walk, _MERGED), "trie-border").drop("parent_conv_id")
    least = merged.select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    # The children of a border node, of which the root may have very many, are joined by shard.
    in_shard = parts.filter("kind = 2").select("shard", F.col("key").alias("parent_key"))
    above = in_shard.join(least, F.col("parent_key") == F.col("above")).drop("above")
    children = parts.filter("kind = 1").drop("parent_conv_id").join(above, ["shard", "parent_key"])
    on_border = merged.join(least, F.col("parent_key") == F.col("above"), "left")
    columns = [field.split()[0] for field in NODES.split(", ")]
    found = [nodes.select(columns) for nodes in (parts.filter("kind = 0"), children, on_border)]
    return found[0].unionByName(found[1]).unionByName(found[2])
