"""Message topic: a broker through the connector of the cluster, or a folder with the same rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from contrail.scratch import LEAN, shuffles_removed

# Delivery settings of the message client. They allow repeats (at least once).
DELIVERY_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "10",
    "kafka.compression.type": "gzip",
}


def broker_options(servers: str, topic: str) -> dict[str, str]:
    return {**DELIVERY_OPTIONS, "kafka.bootstrap.servers": servers, "topic": topic}


def publish(messages: DataFrame, fmt: str, options: Mapping[str, str]) -> None:
    """Sends ``key``, ``value`` rows in parallel, one task per input split."""
    own = LEAN if fmt == "parquet" else {}
    with shuffles_removed(messages.sparkSession):
        messages.select("key", "value").write.format(fmt).options(**own | dict(options)).mode("append").save()
