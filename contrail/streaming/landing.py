"""Lands topic messages in the raw lake, by year and month.

Each run takes what has arrived since the last one and stops. A batch has its own folder in every month
that it reaches, named after the stream and the batch, and replaces it when it is run again: a run that
is repeated or interrupted adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from contrail.files import exists, matching, remove
from contrail.operators.audit import observed
from contrail.operators.enrich import broadcast_limit
from contrail.operators.messages import from_messages
from contrail.schemas import MESSAGE_TOPIC
from contrail.scratch import LEAN, in_pieces, in_slices, materialise, new_path, shuffles_removed, staged, temporary
from contrail.streaming.seen import SeenIndex, identity

# Formats that bring their own ``key`` and ``value`` columns.
_BROKER_FORMATS = ("kafka",)
_QUERY_ID = "sql.streaming.queryId"
BATCH = "batch"
# A staged table is dealt to tasks in pieces of this much of its files, some ten times that in memory.
PIECE_BYTES = 16 << 20
# About what an identity takes in a broadcast.
KEY_BYTES = 64


def read_topic(spark: SparkSession, fmt: str, options: Mapping[str, str]) -> DataFrame:
    """``key``, ``value`` and ``arrival``, by which a message comes before another. Pacing is an option
    of the source (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``)."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt in _BROKER_FORMATS:
        return reader.load().select("key", "value", F.struct("partition", "offset").alias("arrival"))
    arrival = F.struct("_metadata.file_modification_time", "_metadata.file_path")
    return reader.schema(MESSAGE_TOPIC).load().select("key", "value", arrival.alias("arrival"))


def first_of_each(rows: DataFrame) -> DataFrame:
    """One row per trip, with its ``digest``: the one that arrived first, of those that arrived together
    the least. Copies are reduced in the tasks that read them, however many a trip has."""
    columns = [c for c in rows.columns if c != "arrival"]
    whole = F.struct(F.col("arrival"), *columns)
    least = rows.groupBy(identity().alias("digest")).agg(F.min(whole).alias("row"))
    return least.select("digest", *[F.col(f"row.{c}").alias(c) for c in columns])


def _text_length(rows: DataFrame) -> Column:
    return sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in rows.columns), F.lit(1))


def sized_by_month(rows: DataFrame, file_bytes: int) -> DataFrame:
    """``rows`` dealt to tasks so that each gets about ``file_bytes`` of text.

    The histogram of the months, laid end to end, is cut into tasks of equal size: a month that holds
    most rows takes as many as its share, and many small months share one. So a month has at most its
    size divided by ``file_bytes``, and two, files; two more for each slice of a month that is larger
    than a slice. ``rows`` is read twice and should be a table."""
    spark = rows.sparkSession
    sizes = rows.groupBy("year", "month").agg(F.sum(_text_length(rows)).alias("size"))
    until = F.sum("size").over(Window.orderBy("year", "month"))
    sizes = materialise(sizes.withColumn("until", until), "months")
    total = sizes.agg(F.sum("size")).first()[0]
    if total is None:
        return rows
    tasks = -(-total // file_bytes)
    start = sizes.select(
        F.col("year").alias("of_year"), F.col("month").alias("of_month"), (F.col("until") - F.col("size")).alias("start"), "size"
    )
    same = F.col("year").eqNullSafe(F.col("of_year")) & F.col("month").eqNullSafe(F.col("of_month"))
    # Seeded, over a written table: a task that is rerun deals its rows as before.
    place = F.floor((F.col("start") + F.rand(seed=29) * F.col("size")) / file_bytes)
    placed = rows.join(start, same).withColumn("task", F.least(place, F.lit(tasks - 1)).cast("int"))
    return placed.repartitionById(int(tasks), "task").select(rows.columns)


@dataclass(frozen=True)
class BatchCounts:
    """What became of the messages of a batch."""

    batch: int
    messages: int
    unreadable: int
    repeats: int
    landed: int


@dataclass(frozen=True)
class Landing:
    """Lands one batch after the other. ``index``: where to remember trips; a trip that any batch has
    brought is dropped. ``file_bytes``: about how much text a file gets; without it every task writes
    what it has read, which suits a month at a time."""

    spark: SparkSession
    root: str
    index: str | None = None
    file_bytes: int | None = None
    report: Callable[[BatchCounts], None] = lambda counts: None

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        stream = messages.sparkSession.sparkContext.getLocalProperty(_QUERY_ID) or "batch"
        label = f"{stream}-{batch_id}"
        arrival = F.col("arrival") if "arrival" in messages.columns else F.lit("").alias("arrival")
        read = Observation()
        rows = from_messages(messages, [arrival]).observe(
            read, F.count(F.lit(1)).alias("rows"), F.count("corrupt_value").alias("unreadable")
        )
        if self.index is None and self.file_bytes is None:
            landed = self._write(rows.drop("arrival"), label)
        else:
            with temporary(self.spark):
                landed = self._stage(rows, label)
        found = observed(read)
        n = found.get("rows", 0)
        repeats = 0 if self.index is None else n - landed
        self.report(BatchCounts(batch_id, n, found.get("unreadable", 0), repeats, landed))

    def _stage(self, rows: DataFrame, label: str) -> int:
        """Lands through a table of the batch, which the steps that follow read. Their session plans
        adaptively, which the stream's may not."""
        index = None if self.index is None else SeenIndex(self.spark, self.index)
        rows = rows.drop("arrival") if index is None else self._unseen(rows, index, label)
        if index is None:
            return self._write_sized(rows, label)
        path = new_path(self.spark, "landing")
        staged(rows, "landing", path=path)
        fresh = self.spark.read.schema(rows.schema).parquet(path)
        trips = fresh.drop("digest")
        landed = self._write(trips, label) if self.file_bytes is None else self._write_sized(trips, label)
        index.extend(fresh, landed, label)
        return landed

    def _write_sized(self, rows: DataFrame, label: str) -> int:
        """Months by size, some months at a time: the rows that are dealt to tasks lie in shuffle files,
        which are larger than the table."""
        self._clear(label)
        pieces = in_pieces(self.spark, PIECE_BYTES)
        parts = in_slices(rows, "landing", ("year", "month"), pieces, split=True)
        return sum(self._append(sized_by_month(part, self.file_bytes), label) for part in parts)

    def _unseen(self, rows: DataFrame, index: SeenIndex, label: str) -> DataFrame:
        """The first row of each trip that no other batch has brought. The index is asked for identities
        alone, so whole rows of known trips are neither shuffled nor written; the batch is read once
        more for that if there is an index."""
        first = first_of_each(rows)
        if index.empty():
            return first
        keys = staged(rows.select("year", "month", identity().alias("digest")).distinct(), "keys")
        asked = keys.count()
        seen = index.seen(keys, asked, label)
        path = new_path(self.spark, "fresh")
        n = staged(keys.select("digest").join(seen, "digest", "left_anti"), "fresh", path=path).count()
        if n == asked:
            return first
        if not n:
            return rows.sparkSession.createDataFrame([], first.schema)
        new = rows.sparkSession.read.schema("digest binary").parquet(path)
        if n * KEY_BYTES <= broadcast_limit(self.spark):
            return first_of_each(rows.join(F.broadcast(new), identity() == F.col("digest"), "left_semi"))
        # Reduced by identity first, in the tasks that read: the join needs no other shuffle of the rows.
        return first.join(new, "digest", "left_semi")

    def _write(self, rows: DataFrame, label: str) -> int:
        """Replaces the folders of this batch, so a second attempt leaves no row of the first."""
        self._clear(label)
        return self._append(rows, label)

    def _clear(self, label: str) -> None:
        for folder in matching(self.spark, f"{self.root}/year=*/month=*/{BATCH}={label}"):
            remove(self.spark, folder)

    def _append(self, rows: DataFrame, label: str) -> int:
        """Only appends to the lake, for which any committer will do."""
        landed = Observation()
        writer = (
            rows.withColumn(BATCH, F.lit(label))
            .observe(landed, F.count(F.lit(1)).alias("rows"))
            .write.mode("append")
            .options(**LEAN)
            .partitionBy("year", "month", BATCH)
        )
        with shuffles_removed(rows.sparkSession):
            writer.parquet(self.root)
        return observed(landed).get("rows", 0)


def land(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    index: str | None = None,
    file_bytes: int | None = None,
    report: Callable[[BatchCounts], None] = lambda counts: None,
) -> StreamingQuery:
    """Lands what has arrived; see :class:`Landing`. ``report`` gets the counts of every batch."""
    spark = messages.sparkSession
    if exists(spark, f"{root}/_spark_metadata"):
        raise ValueError(f"{root} is kept by a file sink, whose readers see only the files in its log")
    return (
        messages.writeStream.foreachBatch(Landing(spark, root, index, file_bytes, report))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
