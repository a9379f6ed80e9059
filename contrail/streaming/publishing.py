"""Publishes trip files so that a run which fails can be resumed.

The checkpoint of a stream over the files is the ledger of those that are sent: a run takes the files that
no earlier run has finished, a few per batch, and notes each batch when all its messages are out. After a
failure the next run sends the batch under way again, and no other. A file that is added later is new.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from contrail.files import is_file
from contrail.operators.audit import counted, observed
from contrail.operators.messages import to_messages
from contrail.schemas import RAW_TRIPS
from contrail.sinks.topic import publish


@dataclass(frozen=True)
class Sent:
    """What a batch has read and sent."""

    batch: int
    total_rows: int
    published: int


def read_trip_files(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """A file, a folder or a pattern, every column as text; headers are checked file by file."""
    reader = spark.readStream.schema(RAW_TRIPS).option("header", True).option("enforceSchema", False)
    if is_file(spark, path):  # a stream watches folders
        path, name = path.rpartition("/")[::2]
        reader = reader.option("pathGlobFilter", name)
    return reader.option("maxFilesPerTrigger", files_per_batch).csv(path or ".")


def publish_files(
    trips: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str,
    report: Callable[[Sent], None] = lambda sent: None,
    ingested_at: str | None = None,
) -> StreamingQuery:
    """Sends what the checkpoint does not yet list, then stops. ``report`` gets the counts of every
    batch once it is out. A batch is one parallel write, a task per part of its files."""

    def send(batch: DataFrame, number: int) -> None:
        read, rows = counted(batch, "read")
        messages, out = counted(to_messages(read, ingested_at), "sent")
        publish(messages, fmt, options)
        report(Sent(number, observed(rows).get("rows", 0), observed(out).get("rows", 0)))

    writer = trips.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
