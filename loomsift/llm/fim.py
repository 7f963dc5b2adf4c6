"""Fill-in-middle: texts cut into prefix, middle and suffix at unit boundaries, in the order psm or spm, with markers.

A text's units are code points or the matches of a pattern, left to right (what it leaves out is a unit a code point).
The text is cut into fixed blocks of ``BLOCK`` UTF-8 bytes; a Fenwick tree over the blocks holds how many units and how
many code points begin in each. To find the boundary after so many units, binary lifting goes down the tree to the last
block with no more units before it, and with the block's code points before it; the boundary is then looked up among the
bytes of this block alone.

Where the text is cut, and which form it takes, follow from a hash of its doc_id, so that any task gives the same.

Defined results: a null text is an empty one; empty texts, texts that hold a marker and rows with a null doc_id are plain; very
long texts are cut like others; repeated rows are cut alike; an empty table gives no rows; extra columns are kept by
:func:`transform` (a column of the name that it adds gives way) and ignored by :func:`digest`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.llm import common

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKER = re.compile("|".join([PREFIX, SUFFIX, MIDDLE]))
BLOCK, RATE, SPM, SEED = 1024, 90, 20, "1"


class Fenwick:
    """Prefix sums over blocks of several counts at once, built in one pass a level."""

    def __init__(self, counts: np.ndarray) -> None:
        self.size = len(counts)
        self.tree = np.zeros((self.size + 1, counts.shape[1]), np.int64)
        self.tree[1:] = counts
        step = 1
        while step <= self.size:  # nodes that end at odd multiples of step are summed up into the next
            at = np.arange(step, self.size + 1, 2 * step)
            up = at + step
            some = up <= self.size
            self.tree[up[some]] += self.tree[at[some]]
            step *= 2

    def down(self, rank: int) -> tuple[int, np.ndarray]:
        """The most blocks whose first counts sum to no more than rank, and all their sums."""
        at, sums = 0, np.zeros(self.tree.shape[1], np.int64)
        step = 1 << (self.size.bit_length() - 1) if self.size else 0
        while step:
            if at + step <= self.size and sums[0] + self.tree[at + step, 0] <= rank:
                at += step
                sums = sums + self.tree[at]
            step >>= 1
        return at, sums


class Blocks:
    """A text's bytes in blocks, with a tree over the units and code points that begin in each."""

    def __init__(self, text: str, unit: re.Pattern[str] | None = None, block: int = BLOCK) -> None:
        self.data = np.frombuffer(text.encode(), np.uint8)
        self.block = block
        self.points = (self.data & 0xC0) != 0x80
        self.units = self.points if unit is None else self._begins(text, unit)
        edges = np.arange(0, len(self.data), block)
        counts = np.stack([np.add.reduceat(x.astype(np.int64), edges) for x in (self.units, self.points)], axis=1) if len(edges) else np.empty((0, 2), np.int64)
        self.tree = Fenwick(counts)
        self.n = int(self.units.sum())

    def _begins(self, text: str, unit: re.Pattern[str]) -> np.ndarray:
        """Marks the bytes at which a unit begins."""
        begins = np.ones(len(text), bool)
        for m in unit.finditer(text):
            begins[m.start() + 1 : m.end()] = False
        out = np.zeros(len(self.data), bool)
        out[np.flatnonzero(self.points)[begins]] = True
        return out

    def boundary(self, rank: int) -> tuple[int, int]:
        """The byte and the code point after the first ``rank`` units."""
        if rank >= self.n:
            return len(self.data), int(self.points.sum()) if self.units is not self.points else self.n
        block, sums = self.tree.down(rank)  # the unit of number rank (from 0) begins in this block
        here = slice(block * self.block, (block + 1) * self.block)
        inside = int(np.flatnonzero(self.units[here])[rank - int(sums[0])])
        return here.start + inside, int(sums[1]) + int(self.points[here][:inside].sum())


@dataclass
class Cut:
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: str


def draws(doc_id: int, seed: str = SEED) -> list[int]:
    x = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(x[k : k + 8], 16) for k in range(0, 32, 8)]


def cut(doc_id: int | None, text: str | None, unit: re.Pattern[str] | None = None, rate: int = RATE, spm: int = SPM, seed: str = SEED, block: int = BLOCK) -> Cut:
    """One document in its form. rate: percent of the texts that aren't left plain; spm: percent of these in that order."""
    t = text or ""
    blocks = Blocks(t, unit, block)
    h = draws(doc_id, seed) if doc_id is not None else None
    if h is None or not t or MARKER.search(t) or h[2] % 100 >= rate:
        return Cut(blocks.n, "plain", None, None, t)
    (a, first), (z, second) = (blocks.boundary(k) for k in sorted((h[0] % (blocks.n + 1), h[1] % (blocks.n + 1))))
    data = blocks.data
    prefix, middle, suffix = (data[x].tobytes().decode() for x in (slice(0, a), slice(a, z), slice(z, None)))
    form = "spm" if h[3] % 100 < spm else "psm"
    out = f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}" if form == "spm" else f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return Cut(blocks.n, form, first, second - first, out)


def restored(output: str, form: str) -> str:
    """The text that was cut. Markers can't arise where parts meet, since none begins as another or itself ends."""
    if form == "plain":
        return output
    head, middle = output.split(MIDDLE, 1)
    first, second = head[len(PREFIX) :].split(PREFIX if form == "spm" else SUFFIX, 1)
    prefix, suffix = (second, first) if form == "spm" else (first, second)
    return prefix + middle + suffix


def transform(docs: DataFrame, unit: str | None = None, rate: int = RATE, spm: int = SPM, seed: str = SEED, into: str = "fim") -> DataFrame:
    """The documents with a struct: n units, form, code points of prefix and middle (null: plain), and the output text."""
    like = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
    names = [c for c in docs.columns if c != into]
    id_at, text_at = docs.columns.index("doc_id"), docs.columns.index("text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(unit, re.DOTALL) if unit is not None else None
        for b in common.sliced(batches):
            made = [vars(cut(i, t, pattern, rate, spm, seed)) for i, t in zip(b.column(id_at).to_pylist(), b.column(text_at).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(made, like)], names=[*names, into])

    kept = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes if c != into)
    return docs.mapInArrow(of, f"{kept}, `{into}` struct<n: long, form: string, prefix_chars: long, middle_chars: long, output: string>")


def digest(docs: DataFrame) -> DataFrame:
    """Digests of the outputs, and of the texts rebuilt from them."""
    made = transform(docs.select("doc_id", "text"), into="made").select("doc_id", "made.*")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            out, form = b.column("output").to_pylist(), b.column("form").to_pylist()
            sha = [[hashlib.sha256(x.encode()).hexdigest() for x in texts] for texts in (out, map(restored, out, form))]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], *(pa.array(x, pa.string()) for x in sha)], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"])

    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").mapInArrow(of, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")
