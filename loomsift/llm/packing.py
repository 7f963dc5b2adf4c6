"""Packing: first-fit decreasing with a tournament tree, in randomised groups of documents.

A document's ids (word-level BPE and the end id) are cut into full sequences of ``LENGTH``, which need no packing, and a
rest. The pieces are a stored table. Rests are dealt by a hash of their place in it into groups of some ``GROUP`` rests, so
a group's size follows neither any column's skew nor the texts' lengths; each group places its rests, longest first, in the
first bin with room. Bin capacities stand in a tournament tree whose nodes hold the most room below them: the first fitting
bin is found by going down, in logarithmic time. Sequence ids: group * 2**32 + bin; full sequences have negative ones.

Defined results: a null or empty text is one piece, the end id; repeated rows are packed each for itself, and are dealt by
their place in the input; ties of length go by doc_id, then start; a null doc_id is kept; a very long text is many full
sequences; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.llm import common
from loomsift.llm.tokens import Encoder

LENGTH, GROUP, END_ID, VOCABULARY = 4096, 4096, 2, "word_bpe_49k.json"
PIECE = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, place long"


class Tournament:
    """Bins of equal size; ``place`` takes the first with room, opening a new one if there is none."""

    def __init__(self, size: int, most: int) -> None:
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.room = [size] * (2 * self.leaves)

    def place(self, need: int) -> tuple[int, int]:
        """The bin's number and its room before."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < need:
                at += 1
        left = room[at]
        room[at] = left - need
        bin_ = at - self.leaves
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
        return bin_, left


def pieces(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Encode each document and cut its ids at multiples of LENGTH. place: the piece's own number; stored."""
    vocabulary = path or public_tokenizers.path(VOCABULARY)
    like = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("place", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = Encoder(vocabulary, spaces=False), np.array([END_ID], "<u4").tobytes()
        place = TaskContext.get().partitionId() << 40
        for b in common.sliced(batches):
            out = []
            for i, ids in zip(b.column("doc_id").to_pylist(), enc.encode(b.column("text").to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                for k in range(0, n, LENGTH):
                    part = ids[4 * k : 4 * (k + LENGTH)]
                    out.append((i, k, len(part) // 4, part if with_ids else None, zlib.crc32(part), n, place))
                    place += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out, strict=True), like, strict=True)] if out else [pa.array([], f.type) for f in like], schema=like)

    return common.stored(docs.select("doc_id", "text").mapInArrow(cut, PIECE), "packing-pieces")


def pack(docs: DataFrame, path: str | None = None, group: int = GROUP, with_ids: bool = True) -> DataFrame:
    """A row a piece: doc_id, start, length, ids (if asked for), ids_crc32, doc_tokens, sequence_id and offset."""
    made = pieces(docs, path, with_ids)
    rest = F.col("length") < LENGTH
    groups = max(1, -(-made.where(rest).count() // group))
    out = ["doc_id", "start", "length", *(["ids"] if with_ids else []), "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kinds = {"ids": pa.binary()}
    like = pa.schema([(c, kinds.get(c, pa.int64())) for c in out])

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        order = pc.sort_indices(rows.select(["length", "doc_id", "start", "place"]), sort_keys=[("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("place", "ascending")])
        rows = rows.take(order)
        tree = Tournament(LENGTH, rows.num_rows)
        first = key[0].as_py() << 32
        seq, off = [], []
        for n in rows.column("length").to_pylist():
            bin_, left = tree.place(n)
            seq.append(first + bin_)
            off.append(LENGTH - left)
        cols = {c: rows.column(c) for c in out[:-2]} | {"sequence_id": pa.array(seq, pa.int64()), "offset": pa.array(off, pa.int64())}
        return pa.table([cols[c] for c in out], schema=like)

    schema = ", ".join(f"{c} {'binary' if c == 'ids' else 'long'}" for c in out)
    rests = made.where(rest).select(*out[:-2], "place", F.pmod(F.xxhash64("place"), F.lit(groups)).alias("grp"))
    full = made.where(~rest).select(*out[:-2], (-1 - F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(rests.groupBy("grp").applyInArrow(fill, schema))
