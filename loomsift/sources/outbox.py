"""Publishing that sends each document once: an outbox keyed by uid, and a Spark sink and source over it.

Before a document is sent, its uid is claimed; afterwards the answer is kept as its receipt. A task that is repeated finds
receipts and sends nothing for them. A claim without a receipt means that an attempt stopped in between, or still runs: the
service is asked for the uid's page until the claim's lease is over; only then is the document sent anew. Claims and receipts
outlive failed jobs, so a job that is run again goes on where the last one stopped.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage


class Box(Protocol):
    """What keeps claims and receipts; all tasks see the same."""

    def claim(self, uid: str) -> float | None:
        """Claim a uid. None: it is the caller's now; else the seconds since another claimed it."""

    def renew(self, uid: str) -> None: ...

    def keep(self, uid: str, page_id: str) -> None: ...

    def receipt(self, uid: str) -> str | None: ...

    def receipts(self, part: int) -> Iterator[tuple[str, str]]: ...


PARTS = 256


@dataclass
class Folder:
    """A box in a folder that all executors share: files that only one can make, and receipts renamed into place."""

    path: str

    def _at(self, kind: str, uid: str) -> str:
        h = hashlib.sha256(uid.encode()).hexdigest()
        folder = os.path.join(self.path, kind, h[:2])
        os.makedirs(folder, exist_ok=True)
        return os.path.join(folder, h)

    def claim(self, uid: str) -> float | None:
        at = self._at("claims", uid)
        try:
            os.close(os.open(at, os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return max(0.0, time.time() - os.stat(at).st_mtime)
        return None

    def renew(self, uid: str) -> None:
        os.utime(self._at("claims", uid))

    def keep(self, uid: str, page_id: str) -> None:
        at = self._at("receipts", uid)
        new = f"{at}.{uuid.uuid4().hex}.new"
        with open(new, "w", encoding="utf-8") as f:
            json.dump([uid, page_id], f)
        os.replace(new, at)

    def receipt(self, uid: str) -> str | None:
        try:
            with open(self._at("receipts", uid), encoding="utf-8") as f:
                return json.load(f)[1]
        except FileNotFoundError:
            return None

    def receipts(self, part: int) -> Iterator[tuple[str, str]]:
        folder = os.path.join(self.path, "receipts", f"{part:02x}")
        for name in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
            if not name.endswith(".new"):
                with open(os.path.join(folder, name), encoding="utf-8") as f:
                    yield tuple(json.load(f))


def delivered(uid: str, payload: str, box: Box, send: Callable[[str, str], str], find: Callable[[str], str | None], lease: float, sleep: Callable[[float], None] = time.sleep) -> tuple[str, bool]:
    """The document's page, and whether this call sent it."""
    while True:
        page = box.receipt(uid)
        if page is not None:
            return page, False
        age = box.claim(uid)
        if age is None:
            break
        page = find(uid)
        if page is not None:  # sent, but the attempt stopped before it kept the receipt
            box.keep(uid, page)
            return page, False
        if age >= lease:
            box.renew(uid)
            break
        sleep(min(1.0, lease - age))
    page = send(uid, payload)
    box.keep(uid, page)
    return page, True


@dataclass
class Sent(WriterCommitMessage):
    """A task's part: how many it sent, and how many had been."""

    sent: int
    before: int


class _Part(InputPartition):
    def __init__(self, k: int) -> None:
        super().__init__(k)
        self.k = k


def outbox(name: str, box: Box, send: Callable[[str, str], str], find: Callable[[str], str | None], lease: float = 600.0, told: Callable[[int, int], None] | None = None) -> type[DataSource]:
    """A data source class to register. ``df.write.format(name).mode("append").save()`` sends rows (uid, payload);
    ``spark.read.format(name).load()`` gives the receipts (uid, page_id), a partition for each of 256 parts of the box.

    told: called with (sent, sent before) once all tasks are done. A null payload is sent as an empty one; rows of a null uid
    are an error; a uid that comes twice is sent once.
    """

    class Writer(DataSourceWriter):
        def write(self, iterator: Iterator[Any]) -> Sent:
            n = [0, 0]
            for r in iterator:
                if r.uid is None:
                    raise ValueError("a document without uid can't be sent once")
                n[0 if delivered(r.uid, r.payload or "", box, send, find, lease)[1] else 1] += 1
            return Sent(*n)

        def commit(self, messages: list[Any]) -> None:
            done = [m for m in messages if m is not None]
            if told is not None:
                told(sum(m.sent for m in done), sum(m.before for m in done))

        def abort(self, messages: list[Any]) -> None:
            """What was sent stays sent: its receipts keep the next run from sending it again."""

    class Reader(DataSourceReader):
        def partitions(self) -> list[_Part]:
            return [_Part(k) for k in range(PARTS)]

        def read(self, partition: _Part) -> Iterator[tuple]:
            yield from box.receipts(partition.k)

    class Outbox(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "uid string, page_id string"

        def reader(self, schema: Any) -> DataSourceReader:
            return Reader()

        def writer(self, schema: Any, overwrite: bool) -> DataSourceWriter:
            return Writer()

    return Outbox
