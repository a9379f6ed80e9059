"""What several operators share: words, hashes, batches of rows and fresh column names."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BATCH = 256
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def small_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Python workers get at most ``rows`` rows at once, so a batch of long texts fits in memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if the table has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: str | None, lower: bool = True) -> list[bytes]:
    """Words between space, tab, line feed, vertical tab, form feed and carriage return, the
    characters at which ``bytes.split`` splits; only A-Z are lower-cased."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def hashes(items: Iterable[bytes | str], n: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, items), np.uint64, n)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input changes half of the output."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def words_column(text: Column, lower: bool = True) -> Column:
    """The words of :func:`words`, JVM-side; null and empty texts have none."""
    text = F.coalesce(text, F.lit(""))
    parts = F.split(lower_ascii(text) if lower else text, WHITE_SPACE)
    return F.filter(parts, lambda w: w != "")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as held out, for it has no remainder."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(True))
