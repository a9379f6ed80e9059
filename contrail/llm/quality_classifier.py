"""Graded quality by an ordinal cumulative-link regression over hashed text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import fresh, hashes, small_batches
from contrail.llm.labelled import fit_in_one_task, labelled_sample

RESULT = "expected_grade double, tail_prob double"

# Letters become a, capitals A, digits 9; bytes above ASCII count as letters.
_SHAPES = bytes(
    ord("A") if 65 <= b <= 90 else ord("9") if 48 <= b <= 57
    else ord("a") if b >= 128 or 97 <= b <= 122 else b
    for b in range(256)
)


@dataclass(frozen=True)
class Settings:
    grades: int = 3
    select_from: int = 1
    bits: int = 16
    sample: int = 20_000
    passes: int = 60
    rate: float = 0.5
    penalty: float = 1e-5


def features(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashed features of a text and their shares of its words, square-rooted.

    Features are words, the outline of each word (shape of its first and last two characters), and
    one for a word that repeats its predecessor. A text without words has none.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    found, outlines = raw.lower().split(), raw.translate(_SHAPES).split()
    n = len(found)
    codes = hashes(found, n)
    shapes = hashes([b"\0" + s[:1] + s[-2:] for s in outlines], n)
    again = np.count_nonzero(codes[1:] == codes[:-1])
    ids, counts = np.unique(np.concatenate([codes, shapes]) >> np.uint64(65 - bits), return_counts=True)
    ids = ids.astype(np.int64) + 1
    return (
        np.append(0, ids),
        np.sqrt(np.append(again, counts) / max(n, 1)),
    )


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1, one column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds - score[:, None], -50, 50)))


def neutral(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """What an empty sample gives: every grade equally likely for every text."""
    k = np.arange(1, settings.grades)
    return np.zeros(2**settings.bits + 1, np.float32), np.log(k / (settings.grades - k))


def fit(rows: pd.DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that make ``grade`` likely given ``ids`` and ``values``, by AdaGrad.

    Thresholds stay ordered, as each is the one before plus the exponential of a free number.
    """
    lengths = rows["ids"].map(len).to_numpy()
    ids, values = np.concatenate(rows["ids"].to_list()), np.concatenate(rows["values"].to_list())
    doc = np.repeat(np.arange(len(rows)), lengths)
    grade = rows["grade"].to_numpy().clip(0, settings.grades - 1)
    size, at = 2**settings.bits + 1, np.arange(len(rows))
    reached = [
        (np.count_nonzero(grade < k) + 0.5) / (len(grade) + 1) for k in range(1, settings.grades)
    ]
    first = np.log(np.array(reached) / (1 - np.array(reached)))
    free = np.append(first[:1], np.log(np.maximum(np.diff(first), 1e-3)))
    w, gw, gf = np.zeros(size), np.full(size, 1e-8), np.full(len(free), 1e-8)
    at_top, at_bottom = grade == settings.grades - 1, grade == 0
    for _ in range(settings.passes):
        theta = np.cumsum(np.append(free[0], np.exp(free[1:])))
        score = np.bincount(doc, w[ids] * values, len(rows))
        under = 1 / (1 + np.exp(np.clip(score[:, None] - theta, -50, 50)))  # P(grade <= k)
        padded = np.column_stack([np.zeros(len(rows)), under, np.ones(len(rows))])
        mass = np.maximum(padded[at, grade + 1] - padded[at, grade], 1e-12)
        # Slope of the log likelihood in each threshold: up at the upper edge, down at the lower.
        slope = padded * (1 - padded)
        edge = np.zeros_like(padded)
        edge[at, grade + 1] = slope[at, grade + 1] / mass
        edge[at, grade] = -slope[at, grade] / mass
        edge = edge[:, 1:-1]
        g = np.bincount(ids, -(edge.sum(1)[doc]) * values, size) / len(rows)
        g -= settings.penalty * w
        steps = edge.sum(0)[::-1].cumsum()[::-1] / len(rows)
        g_free = steps * np.append(1.0, np.exp(free[1:]))
        gw += g * g
        gf += g_free * g_free
        w += settings.rate * g / np.sqrt(gw)
        free += 0.1 * g_free / np.sqrt(gf)
    return w.astype(np.float32), np.cumsum(np.append(free[0], np.exp(free[1:])))


def train(docs: DataFrame, grades: DataFrame, settings: Settings = Settings()) -> Model:
    """Fits on at most about ``settings.sample`` graded documents.

    ``docs`` has ``doc_id`` and ``text``; ``grades`` has ``doc_id`` and ``grade`` from 0. Without a
    graded document the model is neutral. Equal grades for all are fine.
    """
    small_batches(docs.sparkSession)
    bits = settings.bits

    @F.pandas_udf("ids array<int>, values array<float>")
    def hashed(texts: pd.Series) -> pd.DataFrame:
        found = [features(t, bits) for t in texts]
        return pd.DataFrame({"ids": [f[0] for f in found], "values": [f[1] for f in found]})

    sample = labelled_sample(docs.select("doc_id", "text"), grades, settings.sample)
    rows = sample.select("grade", hashed("text").alias("x")).select("grade", "x.*")
    return Model(*fit_in_one_task(rows, lambda r: fit(r, settings), neutral(settings)))


def classify(docs: DataFrame, model: Model, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with a struct column ``graded``: expected grade and P(grade >= ``select_from``).

    One pass over whole texts without a shuffle; null and empty texts get the score of no feature.
    The column gets a longer name if the table has a ``graded``.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.thresholds))

    @F.pandas_udf(RESULT)
    def scored(texts: pd.Series) -> pd.DataFrame:
        m = Model(*shared.value)
        found = [features(t, settings.bits) for t in texts]
        tails = m.tails(np.array([float(m.weights[i] @ v) for i, v in found]))
        return pd.DataFrame(
            {"expected_grade": tails.sum(1), "tail_prob": tails[:, settings.select_from - 1]}
        )

    return docs.withColumn(fresh(docs, "graded"), scored(F.col(text)))
