"""A Spark data source over an injected transport: one partition a chunk of ids, retried in the reader."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ATTEMPTS, LEAST_WAIT, MOST_WAIT = 4, 2.0, 16.0


class Transient(Exception):
    """Rate limits, server errors and lost connections: worth another attempt."""


def failed(status: int) -> None:
    """Raise for an HTTP status: 429 and 5xx are transient, other errors are not."""
    if status == 429 or status >= 500:
        raise Transient(f"HTTP {status}")
    if status >= 400:
        raise ValueError(f"HTTP {status}")


def retried(call: Callable[[], Any], attempts: int = ATTEMPTS, sleep: Callable[[float], None] = time.sleep) -> Any:
    """The call's result; waits grow from 2 to 16 seconds, with jitter."""
    for k in range(attempts):
        try:
            return call()
        except Transient:
            if k == attempts - 1:
                raise
            sleep(min(MOST_WAIT, LEAST_WAIT * 2**k) * random.uniform(0.5, 1.0))
    return None


class Chunk(InputPartition):
    def __init__(self, ids: list[str]) -> None:
        super().__init__(0)
        self.ids = ids


class _Reader(DataSourceReader):
    def __init__(self, ids: list[str], size: int, fetch: Callable[[list[str]], list[tuple]]) -> None:
        self.ids, self.size, self.fetch = ids, size, fetch

    def partitions(self) -> list[Chunk]:
        return [Chunk(self.ids[k : k + self.size]) for k in range(0, len(self.ids), self.size)] or [Chunk([])]

    def read(self, partition: Chunk) -> Iterator[tuple]:
        if partition.ids:
            yield from retried(lambda: self.fetch(partition.ids))


def source(name: str, schema: str, fetch: Callable[[list[str]], list[tuple]], size: int = 50) -> type[DataSource]:
    """A data source class to register: ``spark.read.format(name).option("ids", "a,b").load()``.

    fetch takes a chunk of ids and returns tuples of the schema; a size of 1 fetches them one by one.
    """

    class Remote(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema: Any) -> DataSourceReader:
            return _Reader([x for x in self.options.get("ids", "").split(",") if x], size, fetch)

    return Remote
