"""A search service as a Spark source: the query is a pushed filter, a page of results is a partition.

    spark.read.format(name).load().where("query = 'all:graphs'")

The transport is injected: ``search(query, start, size)`` returns (number of all results, rows of this page). Rate limits and
server errors are tried again inside tasks. As a stream, the offset is the number of results that were read.

Spark keeps what was pushed with the loaded frame, so that a frame that was filtered by one query gives that query's results
when it is used again under another filter or none. Load anew for each query, as :func:`found` does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

from loomsift.sources.remote import retried

Search = Callable[[str, int, int], tuple[int, list[tuple]]]


class Page(InputPartition):
    def __init__(self, query: str | None, start: int, size: int) -> None:
        super().__init__(start)
        self.query, self.start, self.size = query, start, size


def _rows(search: Search, page: Page, sleep: Callable[[float], None] | None) -> Iterator[tuple]:
    if page.query is not None:
        pause = {} if sleep is None else {"sleep": sleep}
        for r in retried(lambda: search(page.query, page.start, page.size)[1], **pause)[: page.size]:
            yield (page.query, *r)


def _pages(query: str, start: int, end: int, size: int) -> list[Page]:
    return [Page(query, k, min(size, end - k)) for k in range(start, end, size)]


class _Reader(DataSourceReader):
    def __init__(self, search: Search, queries: list[str], size: int, most: int | None, sleep: Callable[[float], None] | None) -> None:
        self.search, self.queries, self.size, self.most, self.sleep = search, queries, size, most, sleep

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802  Spark's name
        """Queries by equality; whatever else is asked is left to Spark, which looks at the rows."""
        for f in filters:
            asked = None
            if isinstance(f, EqualTo) and f.attribute == ("query",):
                asked = [f.value]
            elif isinstance(f, In) and f.attribute == ("query",):
                asked = list(f.value)
            if asked is None:
                yield f
            else:
                self.queries = [q for q in dict.fromkeys(asked) if q is not None and (not self.queries or q in self.queries)]
                if not self.queries:
                    self.queries = [None]  # nothing is asked that may be

    def partitions(self) -> list[Page]:
        if not self.queries:
            raise ValueError("a search wants where(query = ...), or the option query")
        pause = {} if self.sleep is None else {"sleep": self.sleep}
        out = []
        for q in self.queries:
            if q is not None:
                total = retried(lambda q=q: self.search(q, 0, 0)[0], **pause)
                out += _pages(q, 0, total if self.most is None else min(total, self.most), self.size)
        return out or [Page(None, 0, 0)]

    def read(self, partition: Page) -> Iterator[tuple]:
        yield from _rows(self.search, partition, self.sleep)


class _Stream(DataSourceStreamReader):
    def __init__(self, search: Search, query: str, size: int, sleep: Callable[[float], None] | None) -> None:
        self.search, self.query, self.size, self.sleep = search, query, size, sleep

    def initialOffset(self) -> dict:  # noqa: N802
        return {"read": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        pause = {} if self.sleep is None else {"sleep": self.sleep}
        return {"read": retried(lambda: self.search(self.query, 0, 0)[0], **pause)}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        return _pages(self.query, start["read"], end["read"], self.size)

    def read(self, partition: Page) -> Iterator[tuple]:
        yield from _rows(self.search, partition, self.sleep)


def source(name: str, columns: str, search: Search, size: int = 100, sleep: Callable[[float], None] | None = None) -> type[DataSource]:
    """A data source class to register. columns: of a result; the query comes before it as a column.

    Options: query (for streams, and where no filter names one), most (results a query: the source's cap). Pushed filters
    want ``spark.sql.python.filterPushdown.enabled``. A query without results gives no rows. For a stream, results keep their
    order and new ones come last.
    """

    class Found(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return f"query string, {columns}"

        def _query(self) -> str | None:
            return self.options.get("query")

        def reader(self, schema: Any) -> DataSourceReader:
            most = self.options.get("most")
            return _Reader(search, [self._query()] if self._query() is not None else [], size, None if most is None else int(most), sleep)

        def streamReader(self, schema: Any) -> DataSourceStreamReader:  # noqa: N802
            if self._query() is None:
                raise ValueError("a stream of results wants the option query")
            return _Stream(search, self._query(), size, sleep)

    return Found


def found(spark: SparkSession, name: str, *queries: str, most: int | None = None) -> DataFrame:
    """The results of queries, of a registered source: a load of their own."""
    reader = spark.read.format(name) if most is None else spark.read.format(name).option("most", str(most))
    return reader.load().where(F.col("query").isin(*queries))
