"""Repetition coverage: which share of a text lies inside repeated n-grams and lines."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import fresh, hashes, mixed, small_batches

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "#*$%&|<>"
_WINDOW = 8
_LINE_SPACE = " \t\v\f\r"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, dup_line_share double, top_share double, dup_share double, kept boolean"
)


@dataclass(frozen=True)
class Limits:
    """Shares of the characters of all words, above which a text is rejected.

    ``top``: in the most frequent n-gram of 2, 3 and 4 words, when it occurs three times or more
    (of several as frequent, the one with the least hash).
    ``duplicate``: in n-grams of 5 to 10 words that occur twice or more, first ones included.
    ``lines``: in lines that equal an earlier line.
    """

    top: tuple[float, ...] = (0.20, 0.18, 0.16)
    duplicate: tuple[float, ...] = (0.50, 0.45, 0.40, 0.40, 0.40, 0.40)
    lines: float = 0.30
    min_words: int = 20
    repeat_pct: int = 30


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in an n-gram that begins at a marked start."""
    edges = np.zeros(size + 1, np.int32)
    edges[: len(starts)] += starts
    edges[n : n + len(starts)] -= starts
    return np.cumsum(edges[:-1]) > 0


def measure(text: str | None, limits: Limits = Limits()) -> tuple:
    """The columns of ``RESULT`` for one text.

    Null and empty texts have no word and fail the base rules. N-grams are compared by 64-bit
    rolling hashes, over the whole text however long.
    """
    text = text or ""
    found = _WORD.findall(text)
    n = len(found)
    sizes = np.fromiter(map(len, found), np.int64, n)
    chars = int(sizes.sum())
    symbols = sum(map(text.count, _SYMBOLS))
    repeated_lines, repeated_chars, seen = 0, 0, set()
    for line in text.split("\n"):
        if line.strip(_LINE_SPACE):
            if line in seen:
                repeated_lines += 1
                repeated_chars += sum(map(len, _WORD.findall(line)))
            seen.add(line)
    codes = mixed(hashes(found, n))
    rolling, repeat_words = codes.copy(), 0
    top_share = dup_share = 0.0
    passed = True
    for size in range(2, 11):
        if n < size:
            break
        rolling = rolling[: n - size + 1] * _FACTOR + codes[size - 1 :]
        _, which, counts = np.unique(rolling, return_inverse=True, return_counts=True)
        most = int(counts.max())
        if most < 2:
            break  # longer n-grams repeat only where shorter ones do
        if size <= 4:
            if most >= 3:
                inside = _covered((which == counts.argmax()).astype(np.int32), size, n)
                share = float(sizes[inside].sum() / chars)
                top_share = max(top_share, share)
                passed &= share <= limits.top[size - 2]
            continue
        inside = _covered((counts[which] > 1).astype(np.int32), size, n)
        share = float(sizes[inside].sum() / chars)
        dup_share = max(dup_share, share)
        passed &= share <= limits.duplicate[size - 5]
        if size == _WINDOW:
            repeat_words = int(inside.sum())
    line_share = repeated_chars / chars if chars else 0.0
    passed &= line_share <= limits.lines
    failed = n < limits.min_words or 100 * repeat_words > limits.repeat_pct * n
    kept = passed and not failed
    return (
        n, chars, symbols, repeated_lines, repeat_words,
        failed, line_share, top_share, dup_share, kept,
    )


def quality_rules(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """``docs`` with a struct column ``quality`` of the measures and the verdict.

    One pass without a shuffle. A column that is already called ``quality`` stays; the struct then
    gets a longer name, the last column of the result. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf(RESULT)
    def measured(texts: pd.Series) -> pd.DataFrame:
        rows = [measure(t, limits) for t in texts]
        return pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    return docs.withColumn(fresh(docs, "quality"), measured(F.col(text)))
