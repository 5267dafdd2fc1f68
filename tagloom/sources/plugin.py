"""Readers for other historians, as Spark data sources.

A reader says how its work splits and yields the rows of one split; Spark schedules
the splits and batches the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)


class ReadingSource:
    """What a reader must offer. Instances are pickled to the executors."""

    def splits(self, options: dict[str, str]) -> list[Any]:
        """Independent pieces of the read, such as (tags, start, end)."""
        raise NotImplementedError

    def read(self, split: Any, options: dict[str, str]) -> Iterator[tuple]:
        """Rows (site, server, tag, ts, rval, istat, status) of one piece; ts in UTC."""
        raise NotImplementedError

    def splits_where(self, options: dict[str, str], wanted: list[tuple[str, str, Any]]) -> list[Any]:
        """Pieces that may hold rows meeting all of ``wanted``, conditions (column, operator,
        value) on site, server, tag and ts; the operators are =, in, >, >=, <, <=. Spark checks
        the rows again, so a reader may take any of them into account or none."""
        return self.splits(options)

    def newest(self, options: dict[str, str]) -> int:
        """For streams: a number that grows as readings arrive, such as microseconds."""
        raise NotImplementedError

    def splits_between(self, options: dict[str, str], after: int, upto: int) -> list[Any]:
        """For streams: pieces of what arrived after one such number up to another. Asked again
        after a failure, it must give the same readings."""
        raise NotImplementedError


class _Split(InputPartition):
    def __init__(self, value: Any):
        super().__init__(value)


_OPERATORS = {EqualTo: "=", In: "in", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
_NARROWING = ("site", "server", "tag", "ts")


class _Reader(DataSourceReader):
    def __init__(self, source: ReadingSource, options: dict[str, str]):
        self._source = source
        self._options = options
        self._wanted: list[tuple[str, str, Any]] = []

    def pushFilters(self, filters):
        for f in filters:
            operator = _OPERATORS.get(type(f))
            if operator and f.attribute[0] in _NARROWING:
                self._wanted.append((f.attribute[0], operator, f.value))
            yield f  # checked by Spark as well

    def partitions(self):
        return [_Split(s) for s in self._source.splits_where(self._options, self._wanted)]

    def read(self, partition):
        yield from self._source.read(partition.value, self._options)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, source: ReadingSource, options: dict[str, str]):
        self._source = source
        self._options = options

    def initialOffset(self):
        return {"at": int(self._options.get("startat", "-1"))}

    def latestOffset(self):
        return {"at": int(self._source.newest(self._options))}

    def partitions(self, start, end):
        return [_Split(s) for s in self._source.splits_between(self._options, start["at"], end["at"])]

    def read(self, partition):
        yield from self._source.read(partition.value, self._options)


def register_reading_source(spark: SparkSession, name: str, source: ReadingSource) -> None:
    """Make ``spark.read.format(name).options(...).load()`` read through ``source``, and
    ``spark.readStream`` too where it offers the parts for streams. Conditions reach a source
    while ``spark.sql.python.filterPushdown.enabled`` is on, which this sets."""

    class ReadingDataSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return (
                "site string, server string, tag string, ts timestamp, rval double, istat bigint, status bigint"
            )

        def reader(self, schema):
            return _Reader(source, dict(self.options))

        def streamReader(self, schema):
            return _StreamReader(source, dict(self.options))

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ReadingDataSource)
