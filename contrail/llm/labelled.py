"""Bounded samples of labelled documents, and models fitted on them in one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BITS = 2**31


def labelled_sample(docs: DataFrame, grades: DataFrame, bound: int, seed: int = 7) -> DataFrame:
    """About ``bound`` documents at most, with their ``doc_id``, ``text`` and ``grade``.

    ``grades`` holds ``doc_id`` and an integer ``grade``. Null ids and grades are left out, and of
    several grades for an id the largest counts. The ids are drawn by hash before the texts are
    read, so only ids (bounded) are broadcast and only texts of the sample are shuffled. Of several
    rows of an id one is taken, by the hash of its text, so no id can fill the sample.
    """
    known = (
        grades.filter(F.col("doc_id").isNotNull() & F.col("grade").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("grade").cast("int").alias("grade"))
    )
    total = known.count()
    share = min(1.0, bound / max(total, 1))
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(_BITS))
    found = docs.select("doc_id", "text").join(F.broadcast(known.filter(draw < int(share * _BITS))), "doc_id")
    one = F.min_by("text", F.coalesce(F.xxhash64("text"), F.lit(0)))
    return found.groupBy("doc_id", "grade").agg(one.alias("text")).select("doc_id", "text", "grade")


def fit_in_one_task(
    sample: DataFrame, fit: Callable[[pd.DataFrame], tuple], default: tuple
) -> tuple:
    """The arrays that ``fit`` makes of a bounded table; ``default`` if it is empty."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": [pickle.dumps(fit(rows))]})

    together = sample.withColumn("together", F.lit(0)).groupBy("together")
    found = together.applyInPandas(run, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else default
