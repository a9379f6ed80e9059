"""An index of the trips that a lake holds, so that a message sent again is known in any later batch.

The index is two Parquet tables by month: the 16-byte identities, and Bloom filters over pieces of each
batch's identities. A batch asks the filters first; only identities that some filter may hold are
looked up in the table, and only in the months that have such. A batch without repeats reads filters of
a byte or two per trip and hardly any identity.

Entries carry the label of the batch that added them. A batch that is run again after a failure ignores
its own, so it does not take its first attempt's rows for repeats.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.files import exists, matching, remove, write_new
from contrail.schemas import IDENTITY_COLUMNS
from contrail.scratch import shuffles_removed, staged

# Per piece of a batch's identities: one filter, one task's group.
PIECE_ROWS = 100_000
# With ten bits a trip and seven hashes about one new trip in a hundred is looked up in vain.
BITS_PER_ROW, HASHES = 10, 7
# Of this many months at most the table is read by name; beyond it, all months are read.
NAMED_MONTHS = 1000

_KEYS = "year int, month int, digest binary, label string"
_FILTERS = "year int, month int, label string, piece long, pieces long, bits binary"
_MAYBE = "year int, month int, digest binary"


def identity() -> Column:
    """16 bytes that tell trips apart: the identifying columns and the message key. A message that
    cannot be read is told by its text."""
    columns = [*IDENTITY_COLUMNS, "message_key", "corrupt_value"]
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _draw() -> Column:
    """Deals identities to pieces: by this number modulo a power of two, so that the pieces of a large
    batch lie within those of a small one."""
    return F.xxhash64(F.lit(5), "digest")


def pieces_for(rows: int) -> int:
    return 1 << max(0, (-(-rows // PIECE_ROWS) - 1)).bit_length()


def _places(digests: list[bytes], size: int) -> np.ndarray:
    """The bits of each identity: two halves of it give all hashes."""
    halves = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    steps = np.arange(HASHES, dtype=np.uint64)[:, None]
    return (halves[:, 0] + steps * (halves[:, 1] | np.uint64(1))) % np.uint64(size)


def bloom(digests: list[bytes]) -> bytes:
    bits = np.zeros(max(64, BITS_PER_ROW * len(digests) + 7 & ~7), np.uint8)
    bits[_places(digests, len(bits)).ravel()] = 1
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes, digests: list[bytes]) -> np.ndarray:
    found = np.unpackbits(np.frombuffer(bits, np.uint8))
    return found[_places(digests, len(found))].all(0)


@dataclass(frozen=True)
class SeenIndex:
    """``root``: a folder of its own, beside the lake."""

    spark: SparkSession
    root: str

    def _generations(self) -> list[str]:
        """The notes of finished rewrites, oldest first; each is named after its folder."""
        return sorted(matching(self.spark, f"{self.root}/_generations/*"))

    def _folder(self) -> str:
        done = self._generations()
        return f"{self.root}/{done[-1].rsplit('/', 1)[1] if done else 'first'}"

    def _table(self, name: str, schema: str) -> DataFrame | None:
        path = f"{self._folder()}/{name}"
        return self.spark.read.schema(schema).parquet(path) if exists(self.spark, path) else None

    def empty(self) -> bool:
        """Whether no batch has added anything yet."""
        return self._table("filters", _FILTERS) is None or self._table("keys", _KEYS) is None

    def compact(self) -> int:
        """Rewrites the index without the many small files that batches leave; returns its identities.

        Not while a landing runs. The rewrite counts once a note names it, so one that fails, or is
        begun again, changes nothing; folders that no note names last are removed after that. Entries
        lose the labels of their batches: a batch that failed must be landed first."""
        known = self._table("keys", _KEYS)
        if known is None:
            return 0
        before, number = self._folder(), len(self._generations()) + 1
        folder = f"{number:06d}-{uuid.uuid4().hex}"
        keys = staged(known.select("year", "month", "digest").distinct(), "compact")
        rows = keys.count()
        self._add(keys, rows, "compacted", f"{self.root}/{folder}")
        write_new(self.spark, f"{self.root}/_generations/{folder}", "")
        remove(self.spark, before)
        return rows

    def extend(self, keys: DataFrame, rows: int, label: str) -> None:
        """Adds identities: ``keys`` has ``year``, ``month`` and ``digest``; ``rows`` about how many.

        A month that holds most rows is dealt to as many groups as its pieces."""
        self._add(keys, rows, label, self._folder())

    def _add(self, keys: DataFrame, rows: int, label: str, folder: str) -> None:
        pieces = pieces_for(rows)
        keys = keys.select("year", "month", "digest").withColumns(
            {"piece": F.pmod(_draw(), F.lit(pieces)), "label": F.lit(label)}
        )
        placed = keys.repartition("year", "month", "piece").sortWithinPartitions("year", "month", "digest")
        with shuffles_removed(self.spark):
            placed.drop("piece").write.mode("append").partitionBy("year", "month").parquet(f"{folder}/keys")

        def build(group: pd.DataFrame) -> pd.DataFrame:
            first = group.iloc[:1][["year", "month", "label", "piece"]]
            return first.assign(pieces=pieces, bits=bloom(group["digest"].tolist())).astype(
                {"year": "Int32", "month": "Int32"}
            )

        filters = keys.groupBy("year", "month", "piece").applyInPandas(build, _FILTERS)
        with shuffles_removed(self.spark):
            filters.write.mode("append").partitionBy("year", "month").parquet(f"{folder}/filters")

    def seen(self, keys: DataFrame, rows: int, label: str) -> DataFrame | None:
        """The ``digest`` of those ``keys`` (``year``, ``month``, ``digest``; ``rows`` of them) that a
        batch other than ``label`` has added; None if there is no index yet."""
        filters, known = self._table("filters", _FILTERS), self._table("keys", _KEYS)
        if filters is None or known is None:
            return None
        maybe = staged(self._maybe(keys, filters.filter(F.col("label") != label), rows), "maybe")
        months = [tuple(r) for r in maybe.select("year", "month").distinct().limit(NAMED_MONTHS + 1).collect()]
        if not months:
            return maybe.select("digest")
        if len(months) <= NAMED_MONTHS:
            named = F.lit(False)
            for year, month in months:
                named |= F.col("year").eqNullSafe(year) & F.col("month").eqNullSafe(month)
            known = known.filter(named)
        known = known.filter(F.col("label") != label).select("digest")
        return staged(maybe.select("digest").join(known, "digest", "left_semi"), "seen")

    def _maybe(self, keys: DataFrame, filters: DataFrame, rows: int) -> DataFrame:
        """The keys that a filter of their month may hold. Keys are dealt to groups of about
        ``PIECE_ROWS``; a filter goes to every group whose keys it may hold."""
        groups = pieces_for(rows)
        draw = _draw()
        keys = keys.select("year", "month", "digest", draw.alias("draw"))
        keys = keys.withColumn("group", F.pmod("draw", F.lit(groups)))
        # Both numbers are powers of two: a filter of few pieces meets several groups.
        meets = F.sequence(F.pmod("piece", F.lit(groups)), F.lit(groups - 1).cast("long"), F.least("pieces", F.lit(groups)))
        filters = filters.withColumn("group", F.explode(meets))

        def probe(own: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
            digests, draws = own["digest"].to_numpy(), own["draw"].to_numpy()
            found = np.zeros(len(own), bool)
            for piece, pieces, bits in zip(given["piece"], given["pieces"], given["bits"]):
                asked = np.flatnonzero(~found & (draws % pieces == piece))
                if len(asked):
                    found[asked] = may_hold(bits, digests[asked].tolist())
            return own.loc[found, ["year", "month", "digest"]].astype({"year": "Int32", "month": "Int32"})

        # Null months are a value like others here, so the groups are by their text.
        by = [F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("year", "month")]), "group"]
        return keys.groupBy(*by).cogroup(filters.groupBy(*by)).applyInPandas(probe, _MAYBE)
