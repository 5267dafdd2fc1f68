"""An outbox and a ledger for sinks that cannot tell a repeated row: lines, consoles, brokers.

The events of a micro-batch are first written to the outbox, in pieces by event id, and marked as ready. A
piece is handed to the sink and then recorded. A batch that is run again after a failure takes its events from
the outbox, even if dimensions have changed meanwhile, and skips the pieces on record; only the
piece that was under way when the sink failed may be delivered twice. Once all are delivered the
outbox of the batch is dropped, and a further repeat does nothing at all.

Records are empty files: ``<path>/<query>/ready/<batch>`` and ``<path>/<query>/delivered/<batch>/<piece>``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.schema import EVENT_SCHEMA
from tagloom.session import drop_scratch
from tagloom.sinks.current import names_in

#: Records of so many batches are kept; a stream repeats the last one only.
KEPT_BATCHES = 100
ALL = "all"


class Ledger:
    """Of one query, under ``path``. ``pieces``: how many parts of a batch are recorded one by one;
    each is a Spark job of its own, over all executors."""

    def __init__(self, spark: SparkSession, path: str, query: str, pieces: int = 4):
        if pieces < 1:
            raise ValueError("pieces must be greater than zero")
        self._spark, self._path, self._pieces = spark, f"{path.rstrip('/')}/{query}", pieces

    def _record(self, name: str) -> None:
        place = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._path}/{name}")
        files = place.getFileSystem(self._spark._jsc.hadoopConfiguration())
        files.mkdirs(place.getParent())
        files.create(place, True).close()

    def delivered(self, batch: int) -> set[str]:
        """The pieces of a batch on record."""
        return set(names_in(self._spark, f"{self._path}/delivered/{batch}"))

    def deliver(self, make: Callable[[], DataFrame], batch: int, sink: Callable[[DataFrame], None]) -> int:
        """Hand the events of a batch to ``sink``, as far as they are not on record; returns how many
        pieces that were. ``make()`` is asked for the events only if they are not in the outbox."""
        done = self.delivered(batch)
        if ALL in done:
            return 0
        outbox = f"{self._path}/outbox/batch={batch}"
        if str(batch) not in names_in(self._spark, f"{self._path}/ready"):
            piece = F.pmod(F.xxhash64("event_id"), F.lit(self._pieces)).cast("int")
            make().withColumn("piece", piece).write.mode("overwrite").partitionBy("piece").parquet(outbox)
            self._record(f"ready/{batch}")
        stored = self._spark.read.schema(EVENT_SCHEMA).parquet
        found = sorted(name for name in names_in(self._spark, outbox) if name.startswith("piece="))
        due = [name for name in found if name not in done]
        for name in due:
            sink(stored(f"{outbox}/{name}"))
            self._record(f"delivered/{batch}/{name}")
        self._record(f"delivered/{batch}/{ALL}")
        drop_scratch(self._spark, outbox)
        for kind in ("ready", "delivered"):
            old = [n for n in names_in(self._spark, f"{self._path}/{kind}") if n.isdigit() and int(n) <= batch - KEPT_BATCHES]
            drop_scratch(self._spark, *[f"{self._path}/{kind}/{n}" for n in old])
        return len(due)
