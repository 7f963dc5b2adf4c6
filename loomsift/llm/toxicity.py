"""Toxicity: a cumulative-link ordinal regression on sparse word features.

Grades: labels say only toxic or not, so grade 0 is "not toxic" and a toxic row's grade 1, 2 or 3 follows how many
different signs of toxicity (words over ten times likelier in toxic rows of the sample, seen in five of them at
least) it has: up to ``LEVELS[0]``, up to ``LEVELS[1]``, or more.
Model: P(grade > k) = sigmoid(w . x - threshold_k) with one weight vector for all ordered thresholds. A feature is
1 + log2(min(16, n)) / 2
for a hashed word (letters only, lower case) found n times. An L1 penalty (proximal gradient steps) leaves weights
on few words, so long clean texts gather no noise. The fit uses at most ``SAMPLE`` labelled rows (a documented
bound); every document is scored whole in Arrow batches. severity is the sum of P(grade > k), between 0 and 3.

Defined results: null, empty and wordless texts score as a text without features; a text of any length is scored whole;
with no toxic or no clean row in the sample, as in an empty one, nothing is called toxic (severity 0); labels that tie by
their hash are taken in order of doc_id and label; a null doc_id is kept; repeated rows score each for itself; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from loomsift.llm import common, sample

BITS, SAMPLE, LEVELS, THRESHOLD = 18, 6000, (2, 5), 0.4
LETTERS = re.compile(r"[^\W\d_]+")
SCHEMA = "doc_id long, p_toxic double, severity double, toxic boolean"


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    count: dict[int, int] = {}
    for word, n in Counter(LETTERS.findall(text.lower())).items() if text else ():
        h = xxhash.xxh32_intdigest(word) >> (32 - BITS)
        count[h] = max(n, count.get(h, 0))
    return np.fromiter(count, np.int64, len(count)), value(np.fromiter(count.values(), np.float64, len(count)))


def value(n: np.ndarray) -> np.ndarray:
    return 1 + 0.5 * np.log2(np.minimum(16, n))


def grades(x: sample.Matrix, toxic: np.ndarray) -> np.ndarray:
    """Severity 0..3 of each sampled row, from its label and its signs."""
    bad = toxic == 1
    here = np.bincount(x.idx, bad[x.row].astype(float), x.dim)
    there = np.bincount(x.idx, (~bad)[x.row].astype(float), x.dim)
    sign = (here >= 5) & ((here + 0.5) / (bad.sum() + 1) > 10 * (there + 0.5) / ((~bad).sum() + 1))
    signs = np.bincount(x.row, sign[x.idx].astype(float), x.rows)
    return np.where(bad, 1 + (signs > LEVELS[0]) + (signs > LEVELS[1]), 0)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, steps: int = 600, l1: float = 1e-3) -> Model | None:
    start, idx, val, toxic, _ = sample.sparse(sample.labelled(docs, labels, "toxic", rows), features)
    if len(set(toxic.tolist())) < 2:
        return None
    x = sample.Matrix(start, idx, val, 1 << BITS)
    grade = grades(x, toxic)
    above = np.stack([grade > k for k in range(3)]).astype(float)
    # only words in five sampled rows or more that go with toxicity beyond chance (four standard errors) are fitted
    centred = above[0] - above[0].mean()
    size = np.bincount(x.idx, x.val**2, x.dim)
    z = x.t_dot(centred) / np.sqrt(np.maximum(1e-12, size * centred.var()))
    of_use = (np.bincount(x.idx, minlength=x.dim) >= 5) & (np.abs(z) > 4)
    x.keep(of_use)
    v = of_use.astype(float)
    for _ in range(20):  # power iteration: the largest curvature along all weights
        v = x.t_dot(x.dot(v)) / x.rows
        top = np.linalg.norm(v)
        v = v / (top + 1e-12)
    rate = 1 / (0.75 * top + 1.0)
    w = ahead = np.zeros(x.dim)
    theta, pace = np.array([1.0, 2.0, 3.0]), 1.0
    for _ in range(steps):  # accelerated proximal gradient
        r = (sample.sigmoid(x.dot(ahead)[None, :] - theta[:, None]) - above) / x.rows
        new = ahead - rate * x.t_dot(r.sum(0))
        new = np.sign(new) * np.maximum(0, np.abs(new) - rate * l1)
        theta = np.maximum.accumulate(theta + rate * 3 * r.sum(1))
        pace, was = (1 + np.sqrt(1 + 4 * pace**2)) / 2, pace
        ahead, w = new + (was - 1) / pace * (new - w), new
    return Model(w.astype(np.float32), theta)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, p_toxic = P(grade > 0), severity (expected grade) and toxic for each document."""
    like = pa.schema([("doc_id", pa.int64()), ("p_toxic", pa.float64()), ("severity", pa.float64()), ("toxic", pa.bool_())])
    weight = {} if model is None else {int(i): float(model.weights[i]) for i in np.flatnonzero(model.weights)}

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for b in common.sliced(batches):
            out = []
            for text in b.column("text").to_pylist():
                z = 0.0
                found: dict[int, int] = {}
                for word, n in Counter(LETTERS.findall(text.lower())).items() if text and weight else ():
                    if (h := known.get(word)) is None:
                        h = xxhash.xxh32_intdigest(word) >> (32 - BITS)
                        if len(known) < 200_000:
                            known[word] = h
                    if h in weight:
                        found[h] = max(n, found.get(h, 0))
                z += sum(weight[h] * float(value(n)) for h, n in found.items())
                out.append(z)
            p = sample.sigmoid(np.array(out)[None, :] - model.thresholds[:, None]) if model is not None else np.zeros((3, len(out)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p[0]), pa.array(p.sum(0)), pa.array(p[0] >= THRESHOLD)], schema=like)

    return docs.select("doc_id", "text").mapInArrow(of, SCHEMA)
