"""Mixing to target weights: raking over source, language and topic, then calibrated sampling.

Everything is DataFrame code: the corpus is reduced to one row per cell (a source, language and
topic), and only numbers that sum up all cells reach the driver.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.llm.common import fresh, words_column
from contrail.operators.audit import observed
from contrail.scratch import materialise

_LOG = logging.getLogger(__name__)
NONE = "(none)"
MARGINS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Settings:
    """``powers``: the target share of a value is its share of the tokens to this power, scaled to a
    sum of 1; ``targets`` may give shares instead, as tables of ``value`` and ``share``.
    ``keep`` is the share of all tokens to sample, in expectation."""

    powers: Mapping[str, float] = field(
        default_factory=lambda: {"source": 0.7, "lang": 0.6, "topic": 0.8}
    )
    targets: Mapping[str, DataFrame] = field(default_factory=dict)
    keep: float = 0.7
    rounds: int = 200
    tolerance: float = 1e-9
    seed: int = 11


def _share(text: Column, characters: str) -> Column:
    found = F.length(text) - F.length(F.translate(text, characters, ""))
    return found / F.greatest(F.length(text), F.lit(1))


def topic(text: Column, tokens: Column) -> Column:
    """The form of a text, for tables without a topic column."""
    text = F.coalesce(text, F.lit(""))
    return (
        F.when(_share(text, "#*$%&|<>") > 0.03, "symbols")
        .when(_share(text, "0123456789") > 0.05, "numbers")
        .when(tokens < 100, "short")
        .when(tokens > 2000, "long")
        .otherwise("prose")
    )


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct column of its cell and token count (words and an end mark). Null
    sources and languages are one value of their own; a column ``topic`` is used if there is one."""
    tokens = (F.size(words_column(F.col("text"))) + 1).cast("long")
    cell = fresh(docs, "cell")
    counted = docs.withColumn(cell, tokens)
    found = F.col("topic") if "topic" in docs.columns else topic(F.col("text"), F.col(cell))
    return counted.withColumn(
        cell,
        F.struct(
            F.coalesce(F.col("source").cast("string"), F.lit(NONE)).alias("source"),
            F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("lang"),
            F.coalesce(found.cast("string"), F.lit(NONE)).alias("topic"),
            F.col(cell).alias("tokens"),
        ),
    )


def _wanted(cells: DataFrame, margin: str, settings: Settings) -> DataFrame:
    """Tokens that each value of a margin should have; values of the targets that no cell has are
    left out and the rest scaled up."""
    have = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("have"))
    if margin in settings.targets:
        given = settings.targets[margin].select(F.col("value").alias(margin), "share")
        have = have.join(given, margin, "left").withColumn("raw", F.coalesce("share", F.lit(0.0)))
    else:
        have = have.withColumn("raw", F.pow("have", F.lit(settings.powers[margin])))
    sums = have.agg(F.sum("raw").alias("raws"), F.sum("have").alias("total"))
    wanted = F.col("raw") / F.col("raws") * F.col("total")
    return have.crossJoin(F.broadcast(sums)).select(margin, wanted.alias("wanted"))  # one row


def rake(cells: DataFrame, settings: Settings) -> DataFrame:
    """Iterative proportional fitting: ``weight`` is scaled to each margin in turn, until a round
    changes no weight by more than ``tolerance``.

    Margins that contradict each other, as when a source is the only one of its language, cannot all be
    met; then the rounds end when they come no nearer, and the error left is logged. Each round ends in
    a written table, so the plan stays short and a lost executor costs one round. A round sends every
    cell through three shuffles; cells are what is left of the documents after they were summed up.
    """
    for m in MARGINS:
        wanted = materialise(_wanted(cells, m, settings), f"wanted-{m}").withColumnRenamed("wanted", f"wanted_{m}")
        cells = cells.join(wanted, m)
    cells = cells.withColumn("weight", F.col("tokens").cast("double"))
    kept, before = cells.columns, None
    for done in range(1, settings.rounds + 1):
        seen, off = Observation(), F.lit(0.0)
        for m in MARGINS:
            have = F.sum("weight").over(Window.partitionBy(m))
            factor = F.when(have > 0, F.col(f"wanted_{m}") / have).otherwise(0.0)
            cells = cells.withColumn(f"factor_{m}", factor)
            cells = cells.withColumn("weight", F.col("weight") * F.col(f"factor_{m}"))
            off = F.greatest(off, F.abs(F.col(f"factor_{m}") - 1))
        cells = cells.observe(seen, F.max(F.when(F.col("weight") > 0, off)).alias("worst"))
        cells = materialise(cells.select(kept), "raked")
        worst = observed(seen).get("worst")
        if worst is None or worst < settings.tolerance:
            break
        if done == settings.rounds or (before is not None and worst > 0.999 * before):
            _LOG.warning("raking ended after %d rounds, a margin is off by a factor of %g", done, 1 + worst)
            break
        before = worst
    return cells.select(*MARGINS, "tokens", "weight")


def rate(cells: DataFrame, settings: Settings) -> float:
    """The factor that gives the probabilities ``min(1, rate * weight / tokens)`` an expected
    ``keep`` of all tokens. Cells that reach 1 are taken out and the rest scaled again, until no more
    reach it; every step takes out a cell or is the last, and sends two numbers to the driver."""
    ratio = F.col("weight") / F.col("tokens")
    total = cells.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    found = 1.0
    capped = ratio >= float("inf")
    while True:
        full, free = cells.agg(
            F.sum(F.when(capped, F.col("tokens")).otherwise(0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))),
        ).first()
        if not free or settings.keep * total <= full:
            return found
        following = (settings.keep * total - full) / free
        if following == found:
            return found
        found, capped = following, ratio * following >= 1


def uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """A number in [0, 1) from the digest of the id, or of the text where the id is null; repeated
    rows share it."""
    key = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    digits = F.substring(F.md5(F.concat(key, F.lit(f":{seed}"))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / float(2**52)


def mix(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, ``source``, ``lang``) with a struct column ``mixing``: the
    cell, its ``weight`` per token, the sampling ``probability`` and whether the row is ``sampled``.

    No row is dropped. An empty table gives an empty result. The cells are joined by the planner's
    choice; if there are too many to broadcast, adaptive execution splits the hot ones.
    """
    settings = settings or Settings()
    marked = keyed(docs)
    cell, out = marked.columns[-1], fresh(docs, "mixing")
    cells = marked.groupBy(*[F.col(f"{cell}.{m}").alias(m) for m in MARGINS])
    cells = materialise(cells.agg(F.sum(f"{cell}.tokens").alias("tokens")), "cells")
    raked = rake(cells, settings)
    factor = rate(raked, settings)
    weight = F.col("weight") / F.col("tokens")
    raked_cell, raked_weight, probability = (fresh(marked, n) for n in ("raked_cell", "raked_weight", "probability"))
    side = raked.select(
        F.struct(*MARGINS).alias(raked_cell),
        weight.alias(raked_weight),
        F.least(weight * factor, F.lit(1.0)).alias(probability),
    )
    same = F.struct(*[F.col(f"{cell}.{m}").alias(m) for m in MARGINS]) == F.col(raked_cell)
    draw = uniform(F.col("doc_id"), F.col("text"), settings.seed)
    return marked.join(side, same).select(
        *docs.columns,
        F.struct(
            *[F.col(f"{cell}.{m}").alias(m) for m in (*MARGINS, "tokens")],
            F.col(raked_weight).alias("weight"),
            F.col(probability).alias("probability"),
            (draw < F.col(probability)).alias("sampled"),
        ).alias(out),
    )
