"""Settings from the environment. Credentials have no default."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from contrail.functions.trips import QUARTER_MONTHS
from contrail.sinks.store import FeatureStore, FolderStore, JdbcStore
from contrail.sinks.topic import broker_options

@dataclass(frozen=True)
class Settings:
    data_path: str = "data"
    lake_root: str = "lake"
    quarter: str | None = None
    broker: str = "localhost:9092"
    topic: str = "flight-records-raw"
    jdbc_url: str | None = None
    jdbc_driver: str = "org.postgresql.Driver"
    store_root: str | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Settings:
        quarter = env.get("QUARTER") or None
        if quarter is not None and quarter not in QUARTER_MONTHS:
            raise ValueError(f"QUARTER must be one of {sorted(QUARTER_MONTHS)}, not {quarter!r}")
        host, port = env.get("POSTGRES_HOST"), env.get("POSTGRES_PORT", "5432")
        database = env.get("POSTGRES_DB", "flight_features")
        return cls(
            data_path=env.get("DATA_LOCAL_PATH", cls.data_path).rstrip("/"),
            lake_root=env.get("LAKE_ROOT", cls.lake_root).rstrip("/"),
            quarter=quarter,
            broker=env.get("KAFKA_BROKER", cls.broker),
            topic=env.get("KAFKA_TOPIC", cls.topic),
            jdbc_url=f"jdbc:postgresql://{host}:{port}/{database}" if host else None,
            jdbc_driver=env.get("JDBC_DRIVER", cls.jdbc_driver),
            store_root=env.get("FEATURE_STORE_ROOT"),
        )

    @property
    def trips_path(self) -> str:
        return f"{self.data_path}/flights.csv"

    @property
    def carriers_path(self) -> str:
        return f"{self.data_path}/airlines.csv"

    @property
    def airports_path(self) -> str:
        return f"{self.data_path}/airports.csv"

    @property
    def raw_root(self) -> str:
        return f"{self.lake_root}/raw"

    @property
    def processed_root(self) -> str:
        return f"{self.lake_root}/processed"

    @property
    def seen_root(self) -> str:
        """The identities of landed trips."""
        return f"{self.lake_root}/seen"

    @property
    def landing_checkpoint(self) -> str:
        return f"{self.lake_root}/checkpoints/raw"

    @property
    def publishing_checkpoint(self) -> str:
        return f"{self.lake_root}/checkpoints/publish"

    def topic_sink(self) -> dict[str, str]:
        return broker_options(self.broker, self.topic)

    def topic_source(
        self, rows_per_batch: int | None = None, min_tasks: int | None = None
    ) -> dict[str, str]:
        """``rows_per_batch`` paces the reading. ``min_tasks`` splits the offset ranges of a topic
        with few partitions, or with one that holds most rows, over more tasks."""
        options = {
            "kafka.bootstrap.servers": self.broker,
            "subscribe": self.topic,
            "startingOffsets": "earliest",
        }
        if rows_per_batch is not None:
            options["maxOffsetsPerTrigger"] = str(rows_per_batch)
        if min_tasks is not None:
            options["minPartitions"] = str(min_tasks)
        return options

    def feature_store(self, env: Mapping[str, str] = os.environ) -> FeatureStore:
        """The folder ``FEATURE_STORE_ROOT``, or else the database at ``POSTGRES_HOST``, for which
        user and password must be set."""
        if self.store_root is not None:
            return FolderStore(self.store_root)
        if self.jdbc_url is None:
            raise ValueError("neither FEATURE_STORE_ROOT nor POSTGRES_HOST is set")
        login = {"user": env["POSTGRES_USER"], "password": env["POSTGRES_PASSWORD"]}
        return JdbcStore(self.jdbc_url, {**login, "driver": self.jdbc_driver})


# What the connectors of object stores call their committers.
_COMMITTER = "spark.hadoop.mapreduce.outputcommitter.factory.scheme."
_MANIFEST = "org.apache.hadoop.mapreduce.lib.output.committer.manifest.ManifestCommitterFactory"
COMMITTERS = {
    "s3a": {
        f"{_COMMITTER}s3a": "org.apache.hadoop.fs.s3a.commit.S3ACommitterFactory",
        "spark.hadoop.fs.s3a.committer.name": "magic",
    },
    "abfs": {f"{_COMMITTER}abfs": "org.apache.hadoop.fs.azurebfs.commit.AzureManifestCommitterFactory"},
    "abfss": {f"{_COMMITTER}abfss": "org.apache.hadoop.fs.azurebfs.commit.AzureManifestCommitterFactory"},
    "gs": {f"{_COMMITTER}gs": _MANIFEST},
}
_CLOUD_PROTOCOL = {
    "spark.sql.sources.commitProtocolClass": "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol",
    "spark.sql.parquet.output.committer.class": "org.apache.spark.internal.io.cloud.BindingParquetOutputCommitter",
}


def committer_settings(*roots: str | None) -> dict[str, str]:
    """How files get their final names: on a file system by renaming, which needs no setting. An object
    store has no cheap rename; there each task leaves a manifest, or an upload that is not yet completed,
    and the job's commit makes them visible. The lake is only appended to, and published by a manifest of
    its own, so no committer has to replace folders."""
    schemes = {root.split("://", 1)[0].lower() for root in roots if root and "://" in root}
    found: dict[str, str] = {}
    for scheme in sorted(schemes & COMMITTERS.keys()):
        found |= COMMITTERS[scheme] | _CLOUD_PROTOCOL
    return found


def session_settings(env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """What the jobs need, whatever the cluster. Master, memory and partition counts are left to
    ``spark-submit``: adaptive execution sizes the shuffles, and a fixed count would not fit every
    input."""
    found = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    object_store = {
        "spark.hadoop.fs.s3a.endpoint": env.get("S3_ENDPOINT"),
        "spark.hadoop.fs.s3a.access.key": env.get("S3_ACCESS_KEY"),
        "spark.hadoop.fs.s3a.secret.key": env.get("S3_SECRET_KEY"),
    }
    found |= {key: value for key, value in object_store.items() if value}
    if env.get("S3_ENDPOINT"):
        found["spark.hadoop.fs.s3a.path.style.access"] = "true"
    return found | committer_settings(env.get("LAKE_ROOT"), env.get("FEATURE_STORE_ROOT"))


def create_spark_session(
    app_name: str = "trip-features", env: Mapping[str, str] = os.environ
) -> SparkSession:
    """Session for the jobs, with :func:`session_settings`."""
    return SparkSession.builder.appName(app_name).config(map=session_settings(env)).getOrCreate()
