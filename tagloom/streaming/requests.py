"""Write-back requests, as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tagloom.operators.writeback import parse_requests, put_archive, rejected, resolve_requests
from tagloom.session import drop_scratch, scratch_path


def request_batches(
    load_sites: Callable[[], DataFrame],
    load_points: Callable[[], DataFrame],
    archive_path: str,
    dead_letter_path: str,
    **join_options,
) -> Callable[[DataFrame, int], None]:
    """Batch function: accepted requests go to the archive, the others to a dead-letter
    table with their reason. Committing the offsets acknowledges the batch; a batch that
    fails is read again, and both writes give the same result when repeated."""

    def on_batch(messages: DataFrame, batch: int) -> None:
        spark = messages.sparkSession
        path = scratch_path(spark, "requests")
        resolve_requests(parse_requests(messages), load_sites(), load_points(), **join_options).write.parquet(path)
        requests = spark.read.parquet(path)
        put_archive(spark, archive_path, requests)
        bad = rejected(requests).select("message_id", "arrival", "data", "reason")
        bad.write.mode("overwrite").parquet(f"{dead_letter_path.rstrip('/')}/batch={batch}")
        drop_scratch(spark, path)

    return on_batch
