"""Quality rules: text statistics, then a calibrated logistic regression on hashed n-grams.

Model: word uni- and bigrams hashed to ``WORD_DIM`` and character trigrams hashed to ``CHAR_DIM`` buckets; a
feature is the square root of its share among the n-grams of its kind. It is fitted on the driver from at most
``SAMPLE`` labelled rows (a documented bound), two thirds for the weights, one third for Platt's calibration.
Every document is scored whole, in Arrow batches, against the fixed ``THRESHOLD``.

Defined results: a null, empty or blank text has no words, fails the base rules and goes; a text of any length is scored
whole; without labels of both classes the verdict rests on the base rules alone; a score at the threshold is kept; labels
that tie by their hash are taken in order of doc_id and label; a null doc_id is kept; repeated rows are scored each for
itself; an empty table gives no rows; extra columns are ignored by :func:`score` and kept by :func:`keep`.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomsift.llm import common, sample

WORD_DIM, CHAR_DIM, SAMPLE, THRESHOLD = 8192, 4096, 3000, 0.5
SYMBOLS = "#*$%&|<>"
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, p_good double, kept boolean"


class Model(NamedTuple):
    """Log-odds of good quality: scale * (features . weights + bias) + shift."""

    weights: np.ndarray
    bias: float
    scale: float
    shift: float


def statistics(text: str | None, ws: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words of a text with the words ``ws``."""
    if not text:
        return 0, 0, 0, 0
    chars = len(text) - sum(text.count(c) for c in " \t\n\x0b\x0c\r")
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(" \t\x0b\x0c\r"):
            dup += line in seen
            seen.add(line)
    repeated = 0
    if len(ws) > 5:
        win = common.window_hashes(common.hashes(ws), 5)
        _, where, n = np.unique(win, return_inverse=True, return_counts=True)
        if len(n) < len(win):
            repeated = int(common.covered(len(ws), np.flatnonzero(n[where] > 1), 5).sum())
    return chars, sum(text.count(c) for c in SYMBOLS), dup, repeated


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < 10 or 100 * n_repeat > 20 * n_words


def features(text: str | None, ws: list[bytes] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features; none for an empty one."""
    ws = common.words(text) if ws is None else ws
    if not text or not ws:
        return np.empty(0, np.int64), np.empty(0)
    h = np.fromiter(map(zlib.crc32, ws), np.uint64, len(ws))
    both = np.concatenate([h, common.mixed(h[:-1] * common.BASE + h[1:])]) % np.uint64(WORD_DIM)
    grams = np.bincount(both.astype(np.int64), minlength=WORD_DIM) / len(both)
    c = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    if len(c) > 2:
        tri = (((c[:-2] * np.uint64(2097152) + c[1:-1]) * np.uint64(2097152) + c[2:]) * common.BASE) >> np.uint64(52)
        chars = np.bincount(tri.astype(np.int64) % CHAR_DIM, minlength=CHAR_DIM) / len(tri)
    else:
        chars = np.zeros(CHAR_DIM)
    v = np.sqrt(np.concatenate([grams, chars]))
    at = np.flatnonzero(v)
    return at, v[at]


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, steps: int = 250, penalty: float = 1e-4) -> Model | None:
    """Fit on at most ``rows`` labelled documents; None if they lack one of the classes."""
    start, idx, val, y, ids = sample.sparse(sample.labelled(docs, labels, "quality", rows), features)
    part = np.fromiter((zlib.crc32(b"fold%d" % i) % 3 for i in ids), np.int64, len(ids))
    if len(set(y[part > 0].tolist())) < 2 or len(set(y[part == 0].tolist())) < 2:
        return None
    x = sample.Matrix(start, idx, val, WORD_DIM + CHAR_DIM)
    # each class weighs the same in the fit; calibration then undoes it
    use = (part > 0) / np.where(y == 1, (y[part > 0] == 1).sum(), (y[part > 0] == 0).sum()) / 2
    w, bias, m, v = np.zeros(x.dim + 1), 0.0, np.zeros(x.dim + 1), np.zeros(x.dim + 1)
    for t in range(1, steps + 1):
        r = (sample.sigmoid(x.dot(w[:-1]) + w[-1]) - y) * use
        g = np.append(x.t_dot(r) + penalty * w[:-1], r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.3 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    bias = float(w[-1])
    held = part == 0
    scale, shift = _platt((x.dot(w[:-1]) + bias)[held], y[held])
    return Model(w[:-1].astype(np.float32), bias, scale, shift)


def _platt(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton's method for P(good) = sigmoid(a * score + b), with Platt's smoothed targets."""
    good, bad = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0, 0.0
    design = np.stack([score, np.ones_like(score)])
    for _ in range(50):
        p = sample.sigmoid(a * score + b)
        hess = (design * (p * (1 - p))) @ design.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, design @ (p - target) + 1e-6 * np.array([a, b]))
        step *= min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        a, b = a - step[0], b - step[1]
    return float(max(a, 1e-3)), float(b)


def judged(texts: list[str | None], model: Model | None) -> Iterator[tuple[int, int, int, int, int, bool, float | None, bool]]:
    for text in texts:
        ws = common.words(text)
        stats = statistics(text, ws)
        failed, p = base_failed(len(ws), stats[3]), None
        if model is not None:
            i, v = features(text, ws)
            p = float(sample.sigmoid(model.scale * (float(model.weights[i] @ v) + model.bias) + model.shift))
        yield len(ws), *stats, failed, p, not failed and (p is None or p >= THRESHOLD)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, n_words, statistics, base_failed, p_good (null without a model) and kept for each document."""
    like = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", pa.bool_()), ("p_good", pa.float64()), ("kept", pa.bool_())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            cols = list(zip(*judged(b.column("text").to_pylist(), model), strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(list(c), f.type) for c, f in zip(cols, list(like)[1:], strict=True))], schema=like)

    return docs.select("doc_id", "text").mapInArrow(of, SCHEMA)


def keep(docs: DataFrame, model: Model | None) -> DataFrame:
    """The documents that pass, with all their columns; one pass, no shuffle."""
    at = docs.columns.index("text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            yield b.filter(pa.array([x[-1] for x in judged(b.column(at).to_pylist(), model)], pa.bool_()))

    return docs.mapInArrow(of, docs.schema)
