"""Message-broker sinks. The rows are built here; a connector delivers them."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tagloom.functions import event_json, message_attributes

# Fixed defaults of the Kafka producer.
KAFKA_DEFAULTS = {
    "bootstrap_servers": "localhost:9092",
    "compression_type": "snappy",
    "linger_ms": 50,
    "batch_num_messages": 10000,
    "message_timeout_ms": 300000,
}
PUBSUB_TIMEOUT_SECONDS = 60.0


def kafka_rows(events: DataFrame) -> DataFrame:
    """key, value, headers. The broker partitions by key, so no shuffle is needed here."""
    return events.select(
        F.col("tag").cast("binary").alias("key"),
        event_json().cast("binary").alias("value"),
        message_attributes().alias("headers"),
    )


def kafka_options(topic: str, extra: dict[str, Any] | None = None, **settings: Any) -> dict[str, str]:
    """Options of Spark's Kafka sink, which runs the Java producer: its names differ."""
    s = {**KAFKA_DEFAULTS, **settings}
    options = {
        "topic": topic,
        "includeHeaders": "true",
        "kafka.bootstrap.servers": s["bootstrap_servers"],
        "kafka.compression.type": s["compression_type"],
        "kafka.linger.ms": s["linger_ms"],
        "kafka.delivery.timeout.ms": s["message_timeout_ms"],
    }
    if "client_id" in s:
        options["kafka.client.id"] = s["client_id"]
    options.update({f"kafka.{k}": v for k, v in (extra or {}).items()})
    return {k: str(v) for k, v in options.items()}


def write_kafka(events: DataFrame, topic: str, extra: dict[str, Any] | None = None, **settings: Any) -> None:
    kafka_rows(events).write.format("kafka").options(**kafka_options(topic, extra, **settings)).save()


def pubsub_rows(events: DataFrame, ordering_key_by_tag: bool = False) -> DataFrame:
    """data, attributes and, when wanted, the tag as ordering key."""
    key = F.col("tag") if ordering_key_by_tag else F.lit(None).cast("string")
    attributes = F.map_from_arrays(
        F.array(*[F.lit(a) for a in ("tag", "site", "server", "quality")]),
        F.array("tag", "site", "server", "quality"),
    )
    return events.select(
        event_json().cast("binary").alias("data"), attributes.alias("attributes"), key.alias("ordering_key")
    )


class MessageClient:
    """What a broker client must offer. One instance is opened per task."""

    def send(self, data: bytes, attributes: dict[str, str], ordering_key: str | None) -> Any:
        """Send one message and return a handle to wait for."""
        raise NotImplementedError

    def wait(self, handles: list[Any], timeout_seconds: float) -> None:
        """Return when every handle is acknowledged; raise otherwise."""
        raise NotImplementedError

    def close(self) -> None:
        return None


class _MessageWriter(DataSourceWriter):
    def __init__(self, open_client, batch_rows: int, timeout_seconds: float):
        self._open_client = open_client
        self._batch_rows = batch_rows
        self._timeout_seconds = timeout_seconds

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        client = self._open_client()
        pending: list[Any] = []
        try:
            for row in iterator:
                pending.append(client.send(bytes(row.data), dict(row.attributes), row.ordering_key))
                if len(pending) >= self._batch_rows:
                    client.wait(pending, self._timeout_seconds)
                    pending = []
            client.wait(pending, self._timeout_seconds)
        finally:
            client.close()
        return WriterCommitMessage()


def register_message_sink(
    spark: SparkSession, name: str, open_client, batch_rows: int = 1000, timeout_seconds: float = PUBSUB_TIMEOUT_SECONDS
) -> None:
    """Make ``df.write.format(name).mode("append").save()`` send :func:`pubsub_rows`.

    ``open_client`` is called in each task and returns a :class:`MessageClient`. A failed
    task sends its rows again, so consumers drop repeats by ``event_id``.
    """

    class MessageSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "data binary, attributes map<string,string>, ordering_key string"

        def writer(self, schema, overwrite):
            return _MessageWriter(open_client, batch_rows, timeout_seconds)

    spark.dataSource.register(MessageSink)
