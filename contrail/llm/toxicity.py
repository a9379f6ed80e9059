"""Toxicity by weak supervision: voters, a label model, and a linear classifier on its posteriors."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import fresh, hashes, small_batches
from contrail.llm.labelled import fit_in_one_task, labelled_sample
from contrail.scratch import materialise

RESULT = "score double, predicted int"

_PUNCTUATION = bytes(32 if b in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else b for b in range(256))
_BEGINNINGS = (4, 5)
_PATTERNS = (
    re.compile(r"[A-Z]{4,}\W+[A-Z]{4,}\W+[A-Z]{4,}"),  # shouting
    re.compile(r"!{3,}|[?!]{4,}"),
    re.compile(r"\b(?:you|du|tu|vous)(?: are| bist| es| eres|'re) \w+", re.I),
    re.compile(r"\b(?:hate|kill|shut up|get lost|go away)\b", re.I),
    re.compile(r"\w[*@#$]{2,}\w"),  # masked letters
)


@dataclass(frozen=True)
class Settings:
    sample: int = 20_000
    lexicon: int = 256
    lexicon_voters: int = 32
    min_texts: int = 4
    min_ratio: float = 10.0
    rounds: int = 8
    bits: int = 18
    features: int = 4096
    passes: int = 150
    rate: float = 0.3
    penalty: float = 1e-4


def word_ids(text: str | None) -> np.ndarray:
    """Hashes of the distinct words of a text and of their first 4 and 5 bytes, sorted.

    Words are lower-cased and free of punctuation. The beginnings find inflected and compound words.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    found = set(raw.lower().translate(_PUNCTUATION).split())
    found |= {b"^" + w[:k] for k in _BEGINNINGS for w in found if len(w) >= k}
    return np.sort(hashes(found, len(found)).view(np.int64))


# Lexicon ----------------------------------------------------------------------------------------


def mine_lexicon(sample: DataFrame, settings: Settings) -> dict[int, int]:
    """Hashed words that speak for label 1, dealt to voters in the order of their log-odds.

    ``sample`` is bounded. Words are counted over distinct least word hashes, which most near copies
    share, so a text that was copied a thousand times counts about once.
    """

    @F.pandas_udf("array<long>")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([word_ids(t) for t in texts])

    rows = sample.select("grade", hashed("text").alias("ids")).filter(F.size("ids") > 0)
    rows = rows.withColumn("origin", F.array_min("ids"))
    per_class = {
        r["grade"]: r["n"]
        for r in rows.groupBy("grade").agg(F.countDistinct("origin").alias("n")).collect()
    }
    seen = rows.select("grade", "origin", F.explode("ids").alias("word")).distinct()
    toxic, clean = (F.count_if(F.col("grade") == g) for g in (1, 0))
    odds = F.log((F.col("toxic") + 0.5) / (per_class.get(1, 0) + 1)) - F.log(
        (F.col("clean") + 0.5) / (per_class.get(0, 0) + 1)
    )
    best = (
        seen.groupBy("word")
        .agg(toxic.alias("toxic"), clean.alias("clean"))
        .filter(F.col("toxic") >= settings.min_texts)
        .filter(odds > float(np.log(settings.min_ratio)))
        .select("word", (odds * F.sqrt("toxic")).alias("weight"))
        .orderBy(F.desc("weight"), "word")
        .limit(settings.lexicon)
        .collect()
    )
    return {r["word"]: rank % settings.lexicon_voters for rank, r in enumerate(best)}


def vote_mask(text: str | None, ids: np.ndarray, lexicon: dict[int, int], first: int) -> int:
    """One bit per voter, set if it speaks for label 1: lexicon voters, then from bit ``first`` on
    the patterns."""
    mask = 0
    for i in ids.tolist():
        if (voter := lexicon.get(i)) is not None:
            mask |= 1 << voter
    for k, pattern in enumerate(_PATTERNS, first):
        if pattern.search(text or ""):
            mask |= 1 << k
    return mask


def bits(masks: np.ndarray, width: int) -> np.ndarray:
    return (masks[:, None] >> np.arange(width)) & 1


# Label model ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class LabelModel:
    """P(vote | label) of every voter, and how much of its evidence is its own.

    A silent voter abstains: lexicons of one language say nothing about a text in another. Only a
    text for which no voter speaks is held against label 1.
    """

    prior: float
    fires_toxic: np.ndarray
    fires_clean: np.ndarray
    share: np.ndarray

    def posterior(self, masks: np.ndarray) -> np.ndarray:
        votes = bits(masks, len(self.share))
        a, b = self.fires_toxic, self.fires_clean
        spoke = votes @ (self.share * np.log(a / b))
        silent = (self.share * np.log((1 - a) / (1 - b))).sum()
        log_odds = np.log(self.prior / (1 - self.prior)) + np.where(masks == 0, silent, spoke)
        return 1 / (1 + np.exp(-np.clip(log_odds, -50, 50)))


def label_model(n: float, sums: np.ndarray, products: np.ndarray, prior: float) -> LabelModel:
    """Accuracies and correlations from second moments, without labels.

    Given the label, independent voters covary as ``d_i * d_j`` with ``d_i = sqrt(p(1-p)) *
    (P(i|1) - P(i|0))``. The vector d is fitted to the off-diagonal covariances; what remains is the
    correlation of two voters within a label, and divides the evidence that they share.
    """
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    mean = sums / max(n, 1)
    cov = products / max(n, 1) - np.outer(mean, mean)
    var = np.maximum(mean * (1 - mean), 1e-9)
    off = cov / np.sqrt(np.outer(var, var))
    np.fill_diagonal(off, 0)
    d = np.sqrt(np.maximum(off.max(1), 1e-6))
    for _ in range(200):
        squares = (d * d).sum() - d * d
        new = np.clip(off @ d / np.maximum(squares, 1e-9), 0, 0.999)
        if np.abs(new - d).max() < 1e-9:
            break
        d = 0.5 * (d + new)
    left = np.abs(off - np.outer(d, d))
    np.fill_diagonal(left, 0)
    left[left < 0.05] = 0
    gap = d * np.sqrt(var) / np.sqrt(prior * (1 - prior))
    fires_clean = np.clip(mean - prior * gap, 1e-5, 0.999)
    fires_toxic = np.clip(mean + (1 - prior) * gap, fires_clean, 0.9999)
    return LabelModel(prior, fires_toxic, fires_clean, 1 / (1 + left.sum(1)))


def summed(masks: DataFrame, sums_of) -> tuple[np.ndarray, np.ndarray, float]:
    """Vector, matrix and number that ``sums_of(masks, counts)`` adds up to over all masks.

    A task sends at most one row per pair of voters, and the driver gets one row per pair.
    """

    def partial(batches):
        total = None
        for batch in batches:
            if len(batch):
                part = sums_of(batch["mask"].to_numpy(), batch["n"].to_numpy(np.float64))
                total = part if total is None else tuple(x + y for x, y in zip(total, part, strict=True))
        if total is not None:
            vector, matrix, number = total
            i, j = np.nonzero(matrix)
            yield pd.DataFrame({"i": i, "j": j, "x": matrix[i, j]})
            yield pd.DataFrame({"i": np.arange(len(vector)), "j": -1, "x": vector})
            yield pd.DataFrame({"i": [-1], "j": [-1], "x": [number]})

    found = masks.mapInPandas(partial, "i long, j long, x double").groupBy("i", "j")
    rows = found.agg(F.sum("x").alias("x")).collect()
    width = max([r["i"] for r in rows], default=-1) + 1
    vector, matrix, number = np.zeros(width), np.zeros((width, width)), 0.0
    for i, j, x in rows:
        if i < 0:
            number = x
        elif j < 0:
            vector[i] = x
        else:
            matrix[i, j] = x
    return vector, matrix, number


def estimate(masks: DataFrame, width: int, prior: float, rounds: int) -> LabelModel:
    """The label model of vote masks and their counts: moments first, then a few rounds of
    expectation-maximisation, which also move the share of label 1. Every round is one small job."""

    def moments(mask, n):
        v = bits(mask, width)
        return n @ v, (v * n[:, None]).T @ v, n.sum()

    sums, products, n = summed(masks, moments)
    model = label_model(n, sums, products, prior)
    for _ in range(rounds):

        def expected(mask, n, model=model):
            toxic = n * model.posterior(mask)
            return toxic @ bits(mask, width), np.zeros((1, 1)), toxic.sum()

        spoke, _, toxic = summed(masks, expected)
        a = np.clip((spoke + 0.1) / (toxic + 1), 1e-5, 0.9999)
        b = np.clip((sums - spoke + 0.01) / (n - toxic + 1), 1e-6, 0.999)
        model = LabelModel(min(max(toxic / n, 1e-4), 0.99), a, b, model.share)
    return model


# Classifier -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    bits: int

    def score(self, ids: np.ndarray) -> float:
        z = self.bias + float(self.weights[np.unique(_bucket(ids, self.bits))].sum())
        return 1 / (1 + np.exp(-min(max(z, -50.0), 50.0)))


def _bucket(ids: np.ndarray, bits: int) -> np.ndarray:
    return (ids.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def fit(rows: pd.DataFrame, voters: LabelModel, settings: Settings) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression of the posterior on the presence of words.

    Only the ``settings.features`` buckets whose presence departs most from independence of the
    posterior take part; rare words of single texts do not.
    """
    size, n = 2**settings.bits, len(rows)
    found = [np.unique(_bucket(np.asarray(i, np.int64), settings.bits)) for i in rows["ids"]]
    doc = np.repeat(np.arange(n), [len(f) for f in found])
    ids, y = np.concatenate(found), voters.posterior(rows["mask"].to_numpy())
    seen, positive = np.bincount(ids, minlength=size), np.bincount(ids, y[doc], size)
    base = min(max(y.mean(), 1e-4), 1 - 1e-4)
    z = np.where(seen >= 5, np.abs(positive - seen * base) / np.sqrt(seen * base * (1 - base) + 1e-9), 0)
    chosen = np.zeros(size, bool)
    chosen[np.argsort(-z, kind="stable")[: settings.features]] = True
    chosen &= z > 3
    keep = chosen[ids]
    ids, doc = ids[keep], doc[keep]
    w, g2, b, b2 = np.zeros(size), np.full(size, 1e-8), float(np.log(base / (1 - base))), 1e-8
    for _ in range(settings.passes):
        p = 1 / (1 + np.exp(-np.clip(b + np.bincount(doc, w[ids], n), -50, 50)))
        error = (y - p) / n
        g, gb = np.bincount(ids, error[doc], size) - settings.penalty * w / n, float(error.sum())
        g2, b2 = g2 + g * g, b2 + gb * gb
        w, b = w + settings.rate * g / np.sqrt(g2), b + settings.rate * gb / np.sqrt(b2)
    return w.astype(np.float32), b


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """The classifier, from ``docs`` (doc_id, text) and ``labels`` (doc_id, grade 0 or 1).

    The lexicon and the classifier use at most about ``settings.sample`` labelled documents, the
    label model counts the votes of all documents. Labels give the lexicon and the share of label 1;
    the classifier learns from posteriors. Without labelled documents every score is one half.
    """
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    neutral = np.zeros(2**settings.bits, np.float32), 0.0
    sample = materialise(labelled_sample(docs, labels, settings.sample), "labelled")
    shares = sample.agg(F.avg("grade").alias("prior")).first()
    if shares["prior"] is None:
        return Model(*neutral, settings.bits)
    lexicon = mine_lexicon(sample, settings)
    first = settings.lexicon_voters

    @F.pandas_udf("long")
    def voted(texts: pd.Series) -> pd.Series:
        return pd.Series([vote_mask(t, word_ids(t), lexicon, first) for t in texts], dtype="int64")

    @F.pandas_udf("mask long, ids array<long>")
    def hashed(texts: pd.Series) -> pd.DataFrame:
        ids = [word_ids(t) for t in texts]
        masks = [vote_mask(t, i, lexicon, first) for t, i in zip(texts, ids, strict=True)]
        return pd.DataFrame({"mask": masks, "ids": ids})

    masks = docs.groupBy(voted("text").alias("mask")).agg(F.count("*").alias("n"))
    masks = materialise(masks, "votes")
    voters = estimate(masks, first + len(_PATTERNS), shares["prior"], settings.rounds)
    rows = sample.select(hashed("text").alias("x")).select("x.*")
    fitted = fit_in_one_task(rows, lambda r: fit(r, voters, settings), neutral)
    return Model(*fitted, settings.bits)


def classify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``toxicity``: a score from 0 to 1, and 1 from one half on.

    One pass over whole texts; null and empty texts get the score of no word. The column gets a
    longer name if the table has a ``toxicity``.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.bits))

    @F.pandas_udf(RESULT)
    def scored(texts: pd.Series) -> pd.DataFrame:
        model = Model(*shared.value)
        score = np.array([model.score(word_ids(t)) for t in texts])
        return pd.DataFrame({"score": score, "predicted": (score >= 0.5).astype(int)})

    return docs.withColumn(fresh(docs, "toxicity"), scored(F.col(text)))
