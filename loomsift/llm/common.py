"""What the training-data operators share: reading, scratch tables and word hashes."""

from __future__ import annotations

import atexit
import contextlib
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from loomsift.scratch import shared_dir

#: ASCII white space; every operator's words are the runs between it.
WORD = re.compile("[^\x20\x09-\x0d]+")
#: Odd multipliers of the polynomial and of the final mix of 64-bit hashes.
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, which bounds what a Python task holds of its results."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


@contextlib.contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings (dots as double underscores) for the queries inside; put back afterwards."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def free(name: str, taken: list[str]) -> str:
    """A column name like ``name`` that none of ``taken`` is (upper and lower case are one)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors.

    Spark removes the query's shuffle files as soon as it has ended, so phases don't add up on disk. The table is removed
    when the driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.option("compression", "zstd").parquet(path)
    atexit.register(_removed, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _removed(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session has ended: the folder's owner clears it
        return


#: Characters of the strings that a generation of a memory holds, about.
CHARACTERS = 9_600_000


class Memory:
    """Values of strings that repeat, made by a function of many at once.

    Two generations of some ``most`` strings, of 32 characters on average at most and ``CHARACTERS`` in all, are held: one that
    isn't asked for again goes with its generation, so memory is bounded and follows the data. Only speed depends on it.
    """

    def __init__(self, make: Callable[[list[str]], Iterable[bytes]], most: int = 300_000) -> None:
        self.make, self.most = make, most
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def of(self, lists: list[list[str]]) -> list[list[bytes]]:
        if len(self.known) > self.most or self.held > min(32 * self.most, CHARACTERS):
            self.known, self.old, self.held = {}, self.known, 0
        get, old = self.known.get, self.old
        found = [list(map(get, x)) for x in lists]
        holes = [[k for k, v in enumerate(f) if v is None] if None in f else [] for f in found]
        new = {x[k] for x, h in zip(lists, holes, strict=True) for k in h}
        met = new & old.keys()
        self.known.update((x, old[x]) for x in met)
        todo = list(new - met)
        self.held += sum(map(len, new))
        if todo:
            self.known.update(zip(todo, self.make(todo), strict=True))
        for x, f, h in zip(lists, found, holes, strict=True):
            for k in h:
                f[k] = get(x[k])
        return found


def words(text: str | None) -> list[bytes]:
    """UTF-8 words between ASCII white space; none for null."""
    return text.encode().split() if text else []


def ascii_lower(text: str | None) -> bytes:
    """UTF-8 with only A-Z lower-cased; empty for null."""
    return text.encode().lower() if text else b""


def hashes(ws: list[bytes]) -> np.ndarray:
    """A 64-bit hash for each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(32))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash for each window of k consecutive words; none if there are fewer words."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = h[:n].copy()
    for i in range(1, k):
        acc *= BASE
        acc += h[i : n + i]
    return mixed(acc)


def covered(n: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Mask of n words: those inside a stretch of so many words that begins at one of ``starts``."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + lengths, n), -1)
    return np.cumsum(edge[:n]) > 0


def batch(columns: dict[str, object], like: pa.Schema) -> pa.RecordBatch:
    """An Arrow batch of the given schema; values are Arrow arrays, numpy arrays or lists."""
    arrays = []
    for f in like:
        x = columns[f.name]
        arrays.append(x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, type=f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=like)
