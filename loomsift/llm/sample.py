"""Bounded samples of labelled rows, as hashed sparse features, for the two classifiers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.llm import common


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents (doc_id, text, label), the first by a hash of the id.

    Labels are narrowed to the sample before any text is read; rows without text or label are left out, and of several
    texts of a doc_id the least is taken, so there are no more rows than labels.
    """
    few = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    few = few.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    return docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(few), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def sparse(sample: DataFrame, features: Callable[[str], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """CSR parts (start, index, value), labels and ids of the sample; features are made on the executors.

    What reaches the driver is bounded: the sample's rows times the dimension of ``features``.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            made = [features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("label"), pa.array([i.astype("<i4").tobytes() for i, _ in made], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary())],
                names=["doc_id", "label", "idx", "val"],
            )

    got = sample.mapInArrow(of, "doc_id long, label int, idx binary, val binary").collect()
    got.sort(key=lambda r: (r.doc_id, r.label, bytes(r.idx)))
    idx = [np.frombuffer(r.idx, "<i4") for r in got]
    start = np.concatenate([[0], np.cumsum([len(i) for i in idx])]).astype(np.int64)
    none_i, none_v = np.empty(0, np.int32), np.empty(0, np.float32)
    return start, np.concatenate([*idx, none_i]), np.concatenate([*(np.frombuffer(r.val, "<f4") for r in got), none_v]), np.array([r.label for r in got], np.int64), [r.doc_id for r in got]


class Matrix:
    """A CSR matrix with the two products that gradient descent needs."""

    def __init__(self, start: np.ndarray, idx: np.ndarray, val: np.ndarray, dim: int) -> None:
        self.row = np.repeat(np.arange(len(start) - 1), np.diff(start))
        self.idx, self.val, self.rows, self.dim = idx, val, len(start) - 1, dim

    def keep(self, columns: np.ndarray) -> None:
        """Drop the entries of the other columns."""
        use = columns[self.idx]
        self.row, self.idx, self.val = self.row[use], self.idx[use], self.val[use]

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.idx], self.rows)

    def t_dot(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.idx, self.val * r[self.row], self.dim)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))
