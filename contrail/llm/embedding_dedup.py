"""Near-duplicate embeddings by lattice hashing: random projections, decoded to points of E8."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import mixed, small_batches
from contrail.llm.components import components
from contrail.scratch import materialise


@dataclass(frozen=True)
class Settings:
    """A cell of a table is a lattice point for each of ``parts`` projections to 8 dimensions, scaled
    by ``scale``. A vector lives in one cell of each table and visits ``probes`` neighbouring ones.
    Cells of more than ``block`` vectors are compared block by block."""

    cosine: float = 0.93
    tables: int = 10
    parts: int = 2
    scale: float = 0.42
    probes: int = 3
    block: int = 512
    batch: int = 8192
    seed: int = 8


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest point of the lattice E8 for each row, in half units: D8, or D8 moved by one half
    in every coordinate, whichever is closer."""

    def nearest_d8(y: np.ndarray) -> np.ndarray:
        z = np.rint(y)
        odd = np.flatnonzero(z.sum(1) % 2 != 0)
        error = y[odd] - z[odd]
        worst = np.abs(error).argmax(1)
        z[odd, worst] += np.where(error[np.arange(len(odd)), worst] >= 0, 1, -1)
        return z

    whole, half = nearest_d8(x), nearest_d8(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(1) < ((x - whole) ** 2).sum(1)
    return (2 * np.where(closer[:, None], half, whole)).astype(np.int64)


def e8_neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8, in half units."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((-2, 2), repeat=2):
            v = [0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [v for v in product((-1, 1), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out, np.int64)


def _coded(points: np.ndarray, salt: int) -> np.ndarray:
    h = np.full(len(points), salt, np.uint64)
    for k in range(points.shape[1]):
        h = mixed(h * np.uint64(31) + points[:, k].astype(np.uint64))
    return h


def cells(unit: np.ndarray, settings: Settings) -> np.ndarray:
    """Cells of unit vectors: rows x tables x (home, then the nearest other cells)."""
    dim, n = unit.shape[1], len(unit)
    rng = np.random.default_rng([settings.seed, dim])
    out = np.empty((n, settings.tables, 1 + settings.probes), np.uint64)
    around = e8_neighbours()
    at = np.arange(n)
    for t in range(settings.tables):
        homes, others, far = [], [], []
        for p in range(settings.parts):
            y = unit @ rng.standard_normal((dim, 8)) * settings.scale
            home = nearest_e8(y)
            # |y - (home + v)|^2 falls with y.v - home.v - |v|^2 / 2; all |v|^2 are equal.
            gain = 2 * y @ around.T - home @ around.T
            best = np.argpartition(-gain, settings.probes, 1)[:, : settings.probes]
            homes.append(_coded(home, t * 64 + p))
            others.append([_coded(home + around[best[:, k]], t * 64 + p) for k in range(settings.probes)])
            far.append(-gain[at[:, None], best])
        total = homes[0].copy()
        for h in homes[1:]:
            total = mixed(total ^ h * np.uint64(3))
        out[:, t, 0] = total
        # One projection moves at a time; of all such moves the nearest are taken.
        moves = []
        for p in range(settings.parts):
            for k in range(settings.probes):
                codes = [others[q][k] if q == p else homes[q] for q in range(settings.parts)]
                moved = codes[0].copy()
                for h in codes[1:]:
                    moved = mixed(moved ^ h * np.uint64(3))
                moves.append(moved)
        order = np.argsort(np.concatenate(far, 1), 1, kind="stable")[:, : settings.probes]
        out[:, t, 1:] = np.stack(moves, 1)[at[:, None], order]
    return out


def units(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def first_meeting(mine: np.ndarray, theirs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of vectors, the first table in which one visits or shares the other's home, and the
    home where they meet. A pair is counted there and nowhere else."""
    at_mine = (theirs == mine[:, :, :1]).any(2)
    at_theirs = (mine == theirs[:, :, :1]).any(2)
    table = (at_mine | at_theirs).argmax(1)
    rows = np.arange(len(mine))
    home = np.where(at_mine[rows, table], mine[rows, table, 0], theirs[rows, table, 0])
    return table, home


def _links(rows: pd.DataFrame, edges: list[int], settings: Settings) -> pd.DataFrame | None:
    """Links within each run of rows between two ``edges``, a block of a cell: per node the weight
    of those linked, and a root of what is linked here."""
    node, weight, home, block = (rows[c].to_numpy() for c in ("node", "weight", "home", "block"))
    across = rows["left"].to_numpy() != rows["right"].to_numpy()
    found = []
    for _, own in rows.groupby("dim", sort=False):
        x = np.zeros((len(rows), own["dim"].iat[0]))
        x[own.index] = units(own["embedding"].to_list())
        for a, z in zip(edges, edges[1:]):
            if z - a > 1 and rows["dim"].iat[a] == x.shape[1]:
                near = x[a:z] @ x[a:z].T >= settings.cosine
                i, j = np.nonzero(np.triu(near, 1))
                found.append((i + a, j + a))
    if not found:
        return None
    i, j = (np.concatenate(f) for f in zip(*found))
    good = (home[i] | home[j]) & ~(across[i] & (block[i] == block[j]))
    flip = node[i] > node[j]
    i, j = np.where(flip, j, i)[good], np.where(flip, i, j)[good]
    if not len(i):
        return None
    # Every pair counts where it meets first; the cells of those that are near are worked out again.
    used, first = np.unique(node, return_index=True)
    wanted = np.unique(np.concatenate([first[np.searchsorted(used, node[k])] for k in (i, j)]))
    codes = np.zeros((len(rows), settings.tables, 1 + settings.probes), np.uint64)
    for _, own in rows.iloc[wanted].groupby("dim", sort=False):
        codes[own.index] = cells(units(own["embedding"].to_list()), settings)
    code_of = first[np.searchsorted(used, node)]
    here = []
    for a in range(0, len(i), 65536):
        p, q = i[a : a + 65536], j[a : a + 65536]
        table, meeting = first_meeting(codes[code_of[p]], codes[code_of[q]])
        here.append((table == rows["table"].to_numpy()[p]) & (meeting.view(np.int64) == rows["cell"].to_numpy()[p]))
    here = np.concatenate(here)
    i, j = i[here], j[here]
    if not len(i):
        return None
    u, v = np.searchsorted(used, node[i]), np.searchsorted(used, node[j])
    links = np.bincount(u, weight[j], len(used)) + np.bincount(v, weight[i], len(used))
    root = used.copy()
    while True:
        least, before = np.minimum(root[u], root[v]), root.copy()
        np.minimum.at(root, u, least)
        np.minimum.at(root, v, least)
        if (root == before).all():
            break
    hit = links > 0
    return pd.DataFrame({"node": used[hit], "links": links[hit].astype(np.int64), "root": root[hit]})


def _edges(rows: pd.DataFrame, columns: list[str]) -> list[int]:
    change = np.zeros(max(len(rows) - 1, 0), bool)
    for c in columns:
        values = rows[c].to_numpy()
        change |= values[1:] != values[:-1]
    return [0, *(np.flatnonzero(change) + 1).tolist(), len(rows)]


def link_classes(classes: DataFrame, settings: Settings) -> DataFrame:
    """``node``, ``links`` and ``root`` for ``classes`` (``node``, ``label``, ``embedding``,
    ``weight``), several rows per node. No pair is emitted: a block gives a row per node."""
    spark = classes.sparkSession

    def spread(batches):
        for batch in batches:
            found = []
            for _, own in batch.groupby(batch["embedding"].map(len)):
                code = cells(units(own["embedding"].to_list()), settings)
                n, tables, visits = code.shape
                found.append(
                    pd.DataFrame(
                        {
                            "node": np.repeat(own["node"].to_numpy(), tables * visits),
                            "label": np.repeat(own["label"].to_numpy(), tables * visits),
                            "dim": own["embedding"].map(len).iat[0],
                            "table": np.tile(np.repeat(np.arange(tables), visits), n),
                            "cell": code.reshape(-1).view(np.int64),
                            "home": np.tile(np.arange(visits) == 0, n * tables),
                        }
                    )
                )
            if found:
                yield pd.concat(found)

    key = ["label", "dim", "table", "cell"]
    schema = "node long, label string, dim int, table int, cell long, home boolean"
    placed = classes.select("node", "label", "embedding").mapInPandas(spread, schema)
    # A neighbouring cell may be reached twice; it then counts once.
    placed = placed.groupBy("node", *key).agg(F.max("home").alias("home"))
    placed = materialise(placed, "cells")
    sizes = placed.groupBy(*key).agg(F.count("*").alias("rows"), F.count_if("home").alias("homes"))
    blocks = F.ceil(F.col("rows") / settings.block).cast("int")
    sizes = sizes.filter((F.col("rows") > 1) & (F.col("homes") > 0)).withColumn("blocks", blocks)
    placed = placed.join(sizes.select(*key, "blocks"), key)
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = placed.withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    placed = placed.select(
        *key, "node", "home", "block",
        F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
    )
    whole = [*key, "left", "right"]
    rows = placed.join(classes.select("node", "embedding", "weight"), "node")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    rows = rows.repartition(parts, *whole).sortWithinPartitions(*whole)

    def run(batches):
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if len(held) < settings.batch:
                continue
            edges = _edges(held, whole)
            if len(edges) > 2:  # the last block may go on in the next batch
                done = held.iloc[: edges[-2]]
                if (out := _links(done, edges[:-1], settings)) is not None:
                    yield out
                held = held.iloc[edges[-2] :].reset_index(drop=True)
        if held is not None and (out := _links(held, _edges(held, whole), settings)) is not None:
            yield out

    return rows.mapInPandas(run, "node long, links long, root long")


def near_duplicates(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``vectors`` (integer ``vec_id``, ``embedding``, ``label``): ``vec_id``,
    ``n_links``, ``component_id`` and ``kept``.

    Vectors of equal label and length are linked from the cosine of the settings on. Equal vectors
    are one class and compared once. Rows without a label or an id, and vectors that are null, zero
    or hold null or non-finite numbers, link with nothing; a null id is its own component (null) and
    kept. A repeated id counts as two vectors. Other columns are ignored.
    """
    small_batches(vectors.sparkSession, 2048)
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    usable &= ~F.coalesce(bad, F.lit(True)) & F.exists("embedding", lambda v: v != 0)
    usable = F.coalesce(usable, F.lit(False))
    able = rows.filter(usable).withColumn("node", F.xxhash64("label", "embedding"))
    classes = able.groupBy("node", "label", "embedding").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight")
    )
    classes = materialise(classes, "vectors")
    found = materialise(link_classes(classes, settings), "links")
    edges = found.select(F.col("node").alias("a"), F.col("root").alias("b")).distinct()
    groups = components(edges)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = classes.drop("embedding", "label").join(links, "node", "left").join(groups, "node", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "node"))
    least = nodes.groupBy("component").agg(F.min("rep").alias("component_id"))
    n_links = F.coalesce("links", F.lit(0)) + F.col("weight") - 1
    nodes = nodes.join(least, "component").select("node", "component_id", n_links.alias("n_links"))
    linked = able.select("vec_id", "node").join(nodes, "node").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~usable).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), (F.col("vec_id") + 0).alias("component_id")
    )
    out = linked.union(alone)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return out.withColumn("kept", kept)
