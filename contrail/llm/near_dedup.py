"""Near-duplicate documents by an LSH forest over MinHash signatures.

Documents with equal shingle sets are one class. The signatures of the classes are sorted in several
orders; neighbours with a long common prefix are candidates, and every link is confirmed on the full
shingle sets of both texts. What the neighbours leave apart in a large region is compared in full.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.llm.common import hashes, mixed, small_batches, words
from contrail.llm.components import components
from contrail.scratch import materialise

_VALUES = 128
_LABEL = 16


@dataclass(frozen=True)
class Settings:
    """``least``: common prefix that two neighbours must have. A region of the order that is larger
    than ``region`` is cut where its common prefixes are shortest. ``first``: links tried per class
    before those between different components; ``agree``: equal values of 16 that a pair needs.
    ``block_shingles``: about how many shingles a block of a large region has."""

    shingle: int = 5
    percent: int = 75
    trees: int = 21
    least: int = 3
    region: int = 16
    window: int = 4
    first: int = 6
    agree: int = 7
    block_pairs: int = 500
    block_shingles: int = 500_000


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``size`` words; of the whole text if shorter."""
    found = words(text)
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    codes, width = hashes(found, n), min(size, n)
    rolling = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        rolling = mixed(rolling * np.uint64(0x9E3779B97F4A7C15) + codes[k : n - width + 1 + k])
    return np.unique(rolling)


_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(0, 2**63, _VALUES, np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _RNG.integers(0, 2**63, _VALUES, np.uint64)


def signature(found: np.ndarray) -> np.ndarray:
    """16 bits of the least value of each of 128 hash functions."""
    least = np.full(_VALUES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(found), 512):
        values = found[a : a + 512, None] * _FACTORS + _TERMS
        least = np.minimum(least, values.min(0))
    return (mixed(least) & np.uint64(0xFFFF)).astype(">u2")


def fingerprint(found: np.ndarray) -> tuple[int, int]:
    """Two sums that tell sets apart, as signed 64-bit numbers."""
    if not len(found):
        return 0, 0
    sums = mixed(found).sum(dtype=np.uint64), mixed(found ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return tuple(int(s.view(np.int64)) for s in np.array(sums))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    places = np.searchsorted(a, b)
    places[places == len(a)] = 0
    both = int(np.count_nonzero(a[places] == b))
    return 100 * both >= percent * (len(a) + len(b) - both)


# Forest -----------------------------------------------------------------------------------------


def region_pairs(labels: np.ndarray, settings: Settings) -> np.ndarray:
    """Index pairs of rows of a sorted region, all of which share the least prefix. Small regions
    give all pairs. Large ones are cut where neighbours have least in common, and the neighbours at
    a cut are paired; rows with equal labels are paired with the next few. That joins most of a
    large region; :func:`remainder` compares what it leaves apart."""
    out, todo = [], [(0, len(labels))]
    equal = labels[1:] == labels[:-1]
    common = np.where(equal.all(1), _LABEL, (~equal).argmax(1)) if len(labels) > 1 else np.empty(0)
    while todo:
        a, z = todo.pop()
        if z - a <= settings.region:
            i, j = np.triu_indices(z - a, 1)
            out.append(np.stack([i + a, j + a]))
            continue
        inner = common[a : z - 1]
        depth = inner.min()
        if depth >= _LABEL:
            for step in range(1, settings.window + 1):
                i = np.arange(a, z - step)
                out.append(np.stack([i, i + step]))
            continue
        cuts = a + 1 + np.flatnonzero(inner == depth)
        out.append(np.stack([cuts - 1, cuts]))
        edges = [a, *cuts.tolist(), z]
        todo += list(zip(edges, edges[1:]))
    return np.concatenate(out, 1) if out else np.empty((2, 0), np.int64)


def orders(classes: DataFrame, settings: Settings) -> DataFrame:
    """A row per class and order: ``tree``, its ``label`` there, and the other columns of ``classes``."""
    step = _VALUES // settings.trees * 2  # bytes between the beginnings of two orders
    label = F.substring(F.concat("sig", "sig"), F.col("tree") * step + 1, F.lit(_LABEL * 2))
    trees = F.explode(F.sequence(F.lit(0), F.lit(settings.trees - 1))).alias("tree")
    return classes.select("*", trees).withColumn("label", label).drop("sig")


def _prefix(settings: Settings):
    return F.substring("label", 1, settings.least * 2).alias("prefix")


def forest_pairs(classes: DataFrame, settings: Settings) -> DataFrame:
    """Candidate pairs ``a`` < ``b`` of nodes, with ``near`` (neighbours in some order) and ``key``
    (a value that similar classes mostly share).

    The rows of all orders are dealt by ranges of tree and label, so that a region of any size is
    spread over as many tasks as it needs; a task reads its rows in order and holds one region, or
    a part of a very large one. Where a range ends inside a region, the other orders still join it.
    """
    rows = orders(classes.select("node", "n", F.substring("sig", 1, 2).alias("key"), "sig"), settings)
    rows = rows.select("tree", "label", "node", "n", "key")
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8)
    rows = rows.repartitionByRange(parts, "tree", "label", "node").sortWithinPartitions("tree", "label", "node")

    def pairs(tree, labels, nodes, sizes, keys) -> pd.DataFrame | None:
        found = []
        together = (labels[1:, : settings.least] == labels[:-1, : settings.least]).all(1)
        together &= tree[1:] == tree[:-1]
        edges = np.flatnonzero(np.concatenate([[True], ~together, [True]]))
        for a, z in zip(edges, edges[1:]):
            if z - a > 1:
                found.append(region_pairs(labels[a:z], settings) + a)
        if not found:
            return None
        i, j = np.concatenate(found, 1)
        small, large = np.minimum(sizes[i], sizes[j]), np.maximum(sizes[i], sizes[j])
        good = (labels[i] == labels[j]).sum(1) >= settings.agree
        good &= (100 * small >= settings.percent * large) & (nodes[i] != nodes[j])
        i, j = i[good], j[good]
        return pd.DataFrame(
            {
                "a": np.minimum(nodes[i], nodes[j]),
                "b": np.maximum(nodes[i], nodes[j]),
                "near": j - i == 1,
                "key": np.minimum(keys[i], keys[j]),
            }
        )

    def run(batches):
        held = None
        for batch in batches:
            if not len(batch):
                continue
            own = (
                batch["tree"].to_numpy(),
                np.frombuffer(b"".join(batch["label"]), ">u2").reshape(len(batch), _LABEL),
                batch["node"].to_numpy(),
                batch["n"].to_numpy(),
                np.frombuffer(b"".join(batch["key"]), ">u2").astype(np.int32),
            )
            held = own if held is None else tuple(np.concatenate(x) for x in zip(held, own))
            tree, labels = held[:2]
            apart = (labels[1:, : settings.least] != labels[:-1, : settings.least]).any(1)
            apart |= tree[1:] != tree[:-1]
            cut = int(np.flatnonzero(apart)[-1]) + 1 if apart.any() else 0
            if not cut and len(tree) > 8192:
                cut = len(tree) - settings.region  # a very large region goes on in parts
            if cut:
                if (out := pairs(*[x[:cut] for x in held])) is not None:
                    yield out
                held = tuple(x[cut:] for x in held)
        if held is not None and (out := pairs(*held)) is not None:
            yield out

    found = rows.mapInPandas(run, "a long, b long, near boolean, key int")
    return found.groupBy("a", "b").agg(F.max("near").alias("near"), F.min("key").alias("key"))


# Confirmation -----------------------------------------------------------------------------------


def confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``, ``key``) whose full shingle sets are similar enough.

    Pairs of one key form a block, or several by hash if they are many; a block gets the text of
    each class that it needs once.
    """
    per_key = pairs.groupBy("key").agg(F.ceil(F.count("*") / settings.block_pairs).alias("salts"))
    blocks = pairs.join(per_key, "key").withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")))
    blocks = materialise(blocks.select("a", "b", "key", "salt"), "blocks")
    needed = blocks.select(F.col("a").alias("node"), "key", "salt").union(
        blocks.select(F.col("b").alias("node"), "key", "salt")
    )
    needed = needed.distinct().join(classes.select("node", "rep"), "node")
    wanted = needed.select("rep", "node").distinct()
    texts = docs.join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id").select("node", "text")
    # A repeated id may have several texts; the right one is known by its fingerprint.
    places = needed.select("node", F.col("key").alias("at_key"), F.col("salt").alias("at_salt"))
    texts = texts.join(places, "node")

    def check(own: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        sets = {}
        for node, text in zip(given["node"], given["text"]):
            if node not in sets:
                found = shingles(text, settings.shingle)
                if fingerprint(found)[0] == node:
                    sets[node] = found
        good = [similar(sets[a], sets[b], settings.percent) for a, b in zip(own["a"], own["b"])]
        return own.loc[np.array(good, bool), ["a", "b"]]

    return (
        blocks.groupBy("key", "salt")
        .cogroup(texts.groupBy("at_key", "at_salt"))
        .applyInPandas(check, "a long, b long")
    )


# Remainder --------------------------------------------------------------------------------------


def links_between(sets: list[np.ndarray], labels: np.ndarray, component: np.ndarray, block: np.ndarray,
                  settings: Settings) -> list[tuple[int, int]]:
    """Index pairs of similar sets that join all components which similar pairs connect: pairs with
    enough equal label values and, if there are two blocks, with one set in each.

    A component is compared with all that is left, takes in what it meets, and goes on with that
    until nothing is left to meet; the fewer rows of both sides are gone through one by one."""
    if not sets:
        return []
    sizes, codes = np.array([len(s) for s in sets]), np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts, marked = np.cumsum(sizes) - sizes, np.zeros(codes.max() + 1, bool)
    component = np.unique(component, return_inverse=True)[1]
    order = np.argsort(component, kind="stable")
    members = np.split(order, np.flatnonzero(np.diff(component[order])) + 1)
    two, left, out = block.min() != block.max(), np.ones(len(sets), bool), []

    def met(i: int, others: np.ndarray) -> np.ndarray:
        least, most = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        fit = 100 * least >= settings.percent * most
        if two:
            fit &= block[others] != block[i]
        others = others[fit]
        others = others[(labels[others] == labels[i]).sum(1) >= settings.agree]
        if not len(others):
            return others
        own, given = codes[starts[i] : starts[i] + sizes[i]], sizes[others]
        first = np.cumsum(given) - given
        places = np.arange(given.sum()) + np.repeat(starts[others] - first, given)
        marked[own] = True
        both = np.add.reduceat(marked[codes[places]], first, dtype=np.int64)
        marked[own] = False
        return others[100 * both >= settings.percent * (sizes[i] + given - both)]

    def take(found: np.ndarray) -> list[int]:
        left[found] = False
        return found.tolist()

    for own in sorted(members, key=len):
        if not left[own[0]]:
            continue
        todo = take(own)
        while todo and left.any():
            rest = np.flatnonzero(left)
            if len(todo) > len(rest):
                now, todo = np.array(todo), []
                for j in rest.tolist():
                    if left[j] and len(hit := met(j, now)):
                        out.append((int(hit[0]), j))
                        todo += take(members[component[j]])
                continue
            i = todo.pop()
            for j in met(i, rest).tolist():
                if left[j]:
                    out.append((i, j))
                    todo += take(members[component[j]])
    return out


def remainder(classes: DataFrame, found: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """Links ``a``, ``b`` between the components ``found`` of all regions with more than ``region``
    rows, in which only some pairs were tried.

    The rows of a region that has several components are dealt to blocks of bounded size by hash, and
    every two blocks and every block alone are a group of their own, so a region of any size is
    compared in full, in as many tasks as it needs.
    """
    rows = classes.select("node", "rep", "n", "sig").join(found, "node", "left")
    rows = rows.withColumn("component", F.coalesce("component", "node"))
    rows = orders(rows, settings).withColumn("prefix", _prefix(settings))
    several = F.min("component") != F.max("component")
    regions = rows.groupBy("tree", "prefix").agg(
        F.ceil(F.sum("n") / settings.block_shingles).alias("blocks"), (several & (F.count("*") > settings.region)).alias("open")
    )
    regions = materialise(regions.filter("open").drop("open"), "regions")
    rows = rows.join(regions, ["tree", "prefix"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    rows = materialise(rows.select("tree", "prefix", "low", "high", "node", "rep", "component", "label", "block"), "open")
    wanted = rows.select("rep", "node").distinct()
    texts = docs.join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id").select("node", "text")

    def check(own: pd.DataFrame) -> pd.DataFrame:
        sets, places, seen = [], [], set()
        for k, (node, text) in enumerate(zip(own["node"], own["text"])):
            shingled = shingles(text, settings.shingle) if node not in seen else ()
            if len(shingled) and fingerprint(shingled)[0] == node:
                seen.add(node)
                sets.append(shingled)
                places.append(k)
        own = own.iloc[places]
        labels = np.frombuffer(b"".join(own["label"]), ">u2").reshape(-1, _LABEL)
        component, block = own["component"].to_numpy(), own["block"].to_numpy()
        nodes, pairs = own["node"].to_numpy(), links_between(sets, labels, component, block, settings)
        i, j = np.array(pairs, np.int64).reshape(-1, 2).T
        return pd.DataFrame({"a": np.minimum(nodes[i], nodes[j]), "b": np.maximum(nodes[i], nodes[j])})

    rows = rows.join(texts, "node").drop("rep")
    return rows.groupBy("tree", "prefix", "low", "high").applyInPandas(check, "a long, b long")


def groups(docs: DataFrame, carry: Sequence[str] = (), settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs`` (integer ``doc_id``, ``text``): ``doc_id``, the columns ``carry``,
    ``n`` (shingles), ``group`` (a number of the rows that links connect) and ``component_id`` (least
    id of the group). Rows without a shingle or an id have no group.

    Rows that repeat an id may have different texts; each row is judged by its own.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry)

    @F.pandas_udf("n long, node long, more long, sig binary")
    def signed(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            found = shingles(t, settings.shingle)
            rows.append((len(found), *fingerprint(found), signature(found).tobytes()))
        return pd.DataFrame(rows, columns=["n", "node", "more", "sig"])

    rows = docs.select("doc_id", *carry, signed("text").alias("signed")).select("doc_id", *carry, "signed.*")
    rows, docs = materialise(rows, "signed"), docs.select("doc_id", "text")
    linked = rows.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = linked.groupBy("node", "more", "n").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    classes = materialise(classes.drop("more"), "classes")
    pairs = materialise(forest_pairs(classes, settings), "pairs")

    # First a few links per class, in an order drawn by hash; then all between what is still apart.
    ends = pairs.filter("near").select(F.col("a").alias("node"), "a", "b").union(
        pairs.filter("near").select(F.col("b").alias("node"), "a", "b")
    )
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("a", "b", "node")))
    some = ends.withColumn("place", place).filter(F.col("place") <= settings.first)
    some = some.select("a", "b").distinct().join(pairs.select("a", "b", "key"), ["a", "b"])
    links = materialise(confirm(some, classes, docs, settings), "links")
    found = materialise(components(links), "components")

    tried = pairs.join(some.select("a", "b"), ["a", "b"], "left_anti")
    for end in ("a", "b"):
        own = found.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        tried = tried.join(own, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    tried = tried.filter(F.col("of_a") != F.col("of_b")).select("a", "b", "key")
    more = materialise(confirm(tried, classes, docs, settings), "links")
    links = links.union(more)
    if not more.isEmpty():
        found = materialise(components(links), "components")
    more = materialise(remainder(classes, found, docs, settings), "links")
    if not more.isEmpty():
        found = materialise(components(links.union(more)), "components")

    nodes = classes.join(found, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("component"))
    least = nodes.groupBy("component").agg(F.min("rep").alias("component_id"))
    nodes = nodes.join(least, "component").select("node", F.col("component").alias("group"), "component_id")
    alone = rows.filter((F.col("n") == 0) | F.col("doc_id").isNull())
    together = linked.join(nodes, "node").select("doc_id", *carry, "n", "group", "component_id")
    none = F.lit(None).cast("long").alias("group")
    return together.union(alone.select("doc_id", *carry, "n", none, F.col("doc_id").alias("component_id")))


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs`` (integer ``doc_id``, ``text``): ``doc_id``, ``n_shingles``,
    ``component_id`` (least id reachable) and ``kept`` (the id is that of its component).

    Null and empty texts, and those of white space alone, have no shingle and link with nothing. A
    row with a null id links with nothing either: its component is null and it is kept. Rows that
    repeat an id and a text are in one component, and all kept if one is. Other columns are ignored,
    whatever their names; an empty table gives an empty result. Very long texts cost memory in the
    task that makes or compares their shingles.
    """
    found = groups(docs.select("doc_id", "text"), settings=settings)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))
