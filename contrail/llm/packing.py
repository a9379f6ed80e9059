"""Packing into padded batches: optimal length buckets, then batches under a token budget."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contrail.llm.common import words_column


def token_count(text: Column) -> Column:
    """Words and one end mark; null and empty texts have the mark only."""
    return F.size(words_column(text)) + 1


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` length ranges with the least padding in total.

    ``lengths`` ascend. Dynamic programming: the best k ranges up to a length are the best k-1 ranges
    up to a shorter one and one range more. Of equal solutions the one with the shorter last-but-one
    boundary wins. No lengths, no boundaries.
    """
    n = len(lengths)
    if n == 0:
        return []
    rows, tokens = (np.append(0, np.cumsum(x)).astype(np.float64) for x in (counts, counts * lengths))
    best = np.append(0.0, np.full(n, np.inf))
    choices = []
    for _ in range(min(buckets, n)):
        following, choice = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            padding = (rows[j] - rows[:j]) * lengths[j - 1] - (tokens[j] - tokens[:j])
            total = best[:j] + padding
            choice[j] = total.argmin()
            following[j] = total[choice[j]]
        choices.append(choice)
        best = following
    ends, j = [], n
    for choice in reversed(choices):
        if j == 0:
            break
        ends.append(int(lengths[j - 1]))
        j = choice[j]
    return ends[::-1]


def pieces(docs: DataFrame, tokens: Column, max_tokens: int) -> DataFrame:
    """One row per run of at most ``max_tokens`` tokens of a document: nothing is cut off."""
    counted = docs.select("doc_id", tokens.cast("long").alias("total"))
    last = F.ceil(F.col("total") / max_tokens) - 1
    split = counted.select("doc_id", "total", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * max_tokens
    return split.select(
        "doc_id",
        "piece",
        start.alias("start"),
        F.least(F.col("total") - start, F.lit(max_tokens)).cast("long").alias("n_tokens"),
    )


def pack(
    docs: DataFrame,
    tokens: Column | None = None,
    buckets: int = 16,
    max_tokens: int = 4096,
    batch_tokens: int = 65536,
    shard_rows: int = 20_000,
) -> DataFrame:
    """Batches of ``docs`` (a ``doc_id`` and, unless ``tokens`` is given, a ``text``).

    Returns ``doc_id``, ``piece``, ``start``, ``n_tokens``, ``bucket``, ``padded_to``, ``shard``,
    ``batch`` and ``slot``. A batch holds rows of one bucket and shard, each padded to ``padded_to``,
    with at most ``batch_tokens`` tokens in all. Only the histogram comes to the driver: at most
    ``max_tokens`` rows. Rows are numbered within shards of about ``shard_rows`` rows drawn by hash,
    so that no length, however common, meets in one task. Null ids are packed like others, repeated
    rows once each, other columns are ignored; an empty table gives no batch.
    """
    if batch_tokens < max_tokens:
        raise ValueError("a batch must hold a row of the greatest length")
    tokens = token_count(F.col("text")) if tokens is None else tokens
    rows = pieces(docs, tokens, max_tokens)
    histogram = rows.groupBy("n_tokens").count().orderBy("n_tokens").collect()
    lengths, counts = (np.array([r[k] for r in histogram], np.int64) for k in (0, 1))
    ends = best_boundaries(lengths, counts, buckets)
    inside = [
        int(counts[(lengths > low) & (lengths <= high)].sum())
        for low, high in zip([0, *ends], ends)
    ]
    bucket = sum((F.col("n_tokens") > e).cast("int") for e in ends[:-1]) + F.lit(0)

    def by_bucket(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values or [1]]), F.col("bucket") + 1)

    digits = F.substring(F.md5(F.concat_ws(":", "doc_id", "piece", "n_tokens")), 1, 13)
    draw = F.conv(digits, 16, 10).cast("long")
    order = Window.partitionBy("bucket", "shard").orderBy("n_tokens", "doc_id", "piece")
    per_batch = by_bucket([batch_tokens // e for e in ends])
    return (
        rows.withColumn("bucket", bucket.cast("int"))
        .withColumn("padded_to", by_bucket(ends))
        .withColumn("shard", F.pmod(draw, by_bucket([-(-n // shard_rows) for n in inside])))
        .withColumn("at", F.row_number().over(order) - 1)
        .withColumn("batch", F.floor(F.col("at") / per_batch))
        .withColumn("slot", (F.col("at") % per_batch).cast("int"))
        .drop("at")
    )
