"""Sinks by name, and which mode may use which."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from tagloom.options import DEFAULT_PUBLISH_RETRIES, DEFAULT_RETRY_SLEEP_SECONDS
from tagloom.sinks.messages import KAFKA_DEFAULTS

# The sinks each mode accepts.
HISTORICAL = ("parquet", "parquet_gcs", "parquet_gcs_bigquery")
REALTIME = ("console", "file", "kafka", "pubsub", "bigquery")


def _console(events: DataFrame) -> None:
    from tagloom.sinks.tables import print_summary

    print_summary(events)


def _file(events: DataFrame, path: str, **options) -> None:
    from tagloom.sinks.tables import append_jsonl

    append_jsonl(events, path, **options)


def _kafka(events: DataFrame, topic: str, **options) -> None:
    from tagloom.sinks.messages import write_kafka

    write_kafka(events, topic, **options)


def _pubsub(events: DataFrame, format_name: str, ordering_key_by_tag: bool = False) -> None:
    from tagloom.sinks.messages import pubsub_rows

    pubsub_rows(events, ordering_key_by_tag).write.format(format_name).mode("append").save()


def _insert(events: DataFrame, path: str) -> None:
    from tagloom.sinks.inserts import insert_new

    insert_new(events.sparkSession, path, events)


def _partitions(events: DataFrame, path: str, **options) -> None:
    from tagloom.sinks.tables import overwrite_partitions

    overwrite_partitions(events, path, **options)


def _merge(events: DataFrame, path: str, **options) -> None:
    from tagloom.operators.merge import reconcile

    reconcile(events.sparkSession, path, events, **options)


SINKS: dict[str, Callable[..., None]] = {
    "console": _console,
    "file": _file,
    "kafka": _kafka,
    "pubsub": _pubsub,
    "bigquery": _insert,
    "parquet": _partitions,
    "parquet_gcs": _partitions,
    "parquet_gcs_bigquery": _merge,
}

_REQUIRED = {
    "console": (),
    "file": ("path",),
    "kafka": ("topic",),
    "pubsub": ("format_name",),
    "bigquery": ("path",),
    "parquet": ("path",),
    "parquet_gcs": ("path",),
    "parquet_gcs_bigquery": ("path",),
}


_OPTIONS = {
    "console": set(),
    "file": {"path", "max_records_per_file"},
    "kafka": {"topic", "extra", *KAFKA_DEFAULTS},
    "pubsub": {"format_name", "ordering_key_by_tag"},
    "bigquery": {"path"},
    "parquet": {"path", "file_format", "max_records_per_file"},
    "parquet_gcs": {"path", "file_format", "max_records_per_file"},
    "parquet_gcs_bigquery": {"path", "compare", "on_conflict", "newest_by", "max_records_per_file"},
}


def choose_sink(mode: str, name: str, **options) -> Callable[[DataFrame], None]:
    """The sink ``name`` bound to its options, or an error if ``mode`` cannot use it."""
    allowed = {"historical": HISTORICAL, "realtime": REALTIME}.get(mode)
    if allowed is None:
        raise ValueError(f"no such mode: {mode} (historical or realtime)")
    chosen = name.lower()
    if chosen not in allowed:
        raise ValueError(f"a {mode} job delivers to one of {', '.join(allowed)}, not to {chosen}")
    missing = [o for o in _REQUIRED[chosen] if not options.get(o)]
    if missing:
        raise ValueError(f"sink {chosen} is not configured: {', '.join(missing)}")
    unknown = sorted(options.keys() - _OPTIONS[chosen])
    if unknown:
        raise ValueError(f"sink {chosen} has no option {', '.join(unknown)}")
    return lambda events: SINKS[chosen](events, **options)


def with_retry(
    sink: Callable[[DataFrame], None],
    retries: int = DEFAULT_PUBLISH_RETRIES,
    sleep_seconds: float = DEFAULT_RETRY_SLEEP_SECONDS,
) -> Callable[[DataFrame], None]:
    """For a broker that is away for longer than Spark's task retries last: pauses that grow by
    ``sleep_seconds``, then a last try whose error counts. A plan that Spark cannot analyse fails
    at once: it would fail again."""

    def publish(events: DataFrame) -> None:
        for pause in (sleep_seconds * n for n in range(1, retries + 1)):
            try:
                sink(events)
            except (AnalysisException, ValueError, TypeError):
                raise
            except Exception:
                time.sleep(pause)
            else:
                return
        sink(events)

    return publish
