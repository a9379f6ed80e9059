"""Interaction of filters: what each one removes, alone and after others, in every order.

Five filters give a document a mask of five bits. All that an order of filters does to a part depends
on how many documents of the part have each of the 32 masks, so the table is reduced to these counts
by Spark and the orders are worked out from the counts alone.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MEASURES = ("n", "good", "toxic")

# The five characters between which words stand besides the space are \t to \r.
_WORD_ENDS = " \t\n\v\f\r"
_SPLIT = r"[\x20\x09-\x0D]+"

REPORT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)

# A selector of one axis of the tensor: documents that pass, that fail, or all of them.
PASS, FAIL, ALL = np.array([[1, 0], [0, 1], [1, 1]], np.int64)


def failures(text: Column) -> Column:
    """The bits of filters A to D (1, 2, 4, 8) that a text fails; the text is not null."""
    trimmed = F.btrim(text, F.lit(_WORD_ENDS))
    found = F.split(trimmed, _SPLIT)
    words = F.when(trimmed == "", F.lit(0)).otherwise(F.size(found))
    distinct = F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.array_distinct(found)))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    fails = [
        words < 100,
        100 * distinct.cast("long") < 80 * words.cast("long"),
        100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]
    return sum(f.cast("int") * 2**k for k, f in enumerate(fails))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask`` (0 to 31) and the documents with it: all, good and toxic ones.

    Texts are read once and never shuffled, only their digests. Rows that repeat an id and a text are
    counted before the labels are joined, and equal texts before they meet, so a text or a part that
    holds most rows is reduced in the tasks that read it. An id that holds most rows, with different
    texts, is split by adaptive execution in the join; null ids are spread by their texts.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = (
        docs.select(
            F.col("doc_id").cast("long").alias("id"),
            F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
            failures(text).alias("mask"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        )
        .groupBy("id", "part", "mask", "digest")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("key", F.coalesce("id", F.xxhash64("digest")))
        .withColumn("known", F.col("id").isNotNull())
    )
    graded = (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("key"), F.lit(True).alias("known"))
        .agg(
            F.max((F.col("quality") == 1).cast("int")).alias("good"),
            F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
        )
        .filter("good = 1 OR toxic = 1")
    )
    good, toxic = (F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("good", "toxic"))
    marked = rows.join(graded, ["key", "known"], "left").select("id", "part", "mask", "digest", "n", good, toxic)
    # Of the rows with one text, those of the least id pass E, and those without an id.
    texts = marked.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.min("id").alias("first"),
        F.coalesce(F.min_by("n", "id"), F.lit(0)).alias("at_first"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("without"),
    )
    least = F.min("first").over(Window.partitionBy("digest"))
    passing = F.col("without") + F.when(F.col("first") == F.col("least"), F.col("at_first")).otherwise(0)
    both = F.array(
        F.struct(F.col("mask").alias("mask"), F.col("passing").alias("rows")),
        F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("passing")).alias("rows")),
    )
    halves = (
        texts.withColumn("least", least)
        .withColumn("passing", passing)
        .select("part", "good", "toxic", F.inline(both))
    )
    return halves.groupBy("part", "mask").agg(
        F.sum("rows").alias("n"),
        F.sum(F.col("rows") * F.col("good")).alias("good"),
        F.sum(F.col("rows") * F.col("toxic")).alias("toxic"),
    )


def _selectors(before: np.ndarray, here: np.ndarray, after: np.ndarray) -> list[np.ndarray]:
    """For each axis, one selector per order and step: (120 * 5, 2)."""
    rows = [
        [
            here if letter == order[step] else before if letter in order[:step] else after
            for letter in FILTERS
        ]
        for order in ORDERS
        for step in range(len(FILTERS))
    ]
    return list(np.array(rows).transpose(1, 0, 2))


_HERE = _selectors(PASS, FAIL, ALL)
_KEPT = _selectors(PASS, PASS, ALL)
_FAILING = _selectors(ALL, FAIL, ALL)
_ALONE = _selectors(PASS, FAIL, PASS)
_LETTER = np.array([FILTERS.index(letter) for order in ORDERS for letter in order])


def contract(counts: np.ndarray, selectors: list[np.ndarray]) -> np.ndarray:
    """Documents that the selectors let through, per measure and step. ``counts`` has an axis for the
    measures and one of length 2 for every filter. Whole numbers throughout."""
    return np.einsum("mabcde,ka,kb,kc,kd,ke->mk", counts, *selectors, optimize=True)


def report(rows: pd.DataFrame) -> pd.DataFrame:
    """All 120 orders of one part, from its counts by mask (32 rows at most)."""
    counts = np.zeros((len(MEASURES), 32), np.int64)
    np.add.at(counts, (slice(None), rows["mask"].to_numpy()), rows[list(MEASURES)].to_numpy(np.int64).T)
    # Filter A is the lowest bit of the mask, which a reshape makes the last axis.
    counts = counts.reshape(-1, 2, 2, 2, 2, 2).transpose(0, 5, 4, 3, 2, 1)
    removed, good, toxic = contract(counts, _HERE)
    everything = counts[:1]
    shapley = np.zeros(len(FILTERS), np.int64)
    np.add.at(shapley, _LETTER, removed)
    return pd.DataFrame(
        {
            "part": rows["part"].iloc[0],
            "filter_order": np.repeat(ORDERS, len(FILTERS)),
            "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS)),
            "kept": contract(everything, _KEPT)[0],
            "removed": removed,
            "redundant": contract(everything, _FAILING)[0] - removed,
            "unique_fails": contract(everything, _ALONE)[0],
            "good_lost": good,
            "toxic_lost": toxic,
            "shapley": shapley[_LETTER],
        }
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (value of ``lang``), order of the five filters and step.

    ``docs`` has ``doc_id``, ``text`` and ``lang``; ``labels`` has ``doc_id``, ``quality`` and
    ``toxic``. Other columns, of any name, are not read. A null text counts as empty and a null lang
    as the empty string. A row without an id is a document like others, but no smaller id than it and
    not greater than any, so it passes E; it has no label. Rows that repeat an id are documents each;
    with the same text they pass E together or fail it together. Of several labels for an id any that
    is 1 counts. Very long texts cost memory in the task that reads them and nothing later. An empty
    table gives no rows, for it has no parts; missing labels give zeros.
    """
    counts = mask_counts(docs, labels)
    return counts.groupBy("part").applyInPandas(report, REPORT)
