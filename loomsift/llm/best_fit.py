"""Best-fit packing whose bin counts are certified by lower bounds, and mended by exchange where they aren't.

1. A document's ids (byte-level BPE and the end id) are one piece; a longer one is a rest and full pieces of ``LENGTH``,
   the rest first. Full pieces are sequences of their own. What is left is dealt by a hash into partitions.
2. Each partition is packed by best-fit decreasing: the bins by room, so that the fullest with room enough is found in the
   set bits of an integer. Dual-feasible functions give a lower bound of its bins; where the bins are as many, the partition
   is certified: nothing packs it into fewer.
3. Partitions with a gap exchange documents: their full bins stay, the other documents are dealt anew over as many partitions
   as they now fill, and packed again. After ``ROUNDS`` rounds, or when no partition has a gap, what there is stays. A round
   that doesn't lower the number of bins isn't taken.

Between rounds pieces are stored tables, without ids; the driver sees three numbers a round. Sequence ids: full pieces have
negative ones, others round * 2**56 + partition * 2**24 + bin.

Defined results: a null or empty text is one piece, the end id; repeated rows are packed each for itself, and dealt by their
place in the input; ties of length go by that place; a null doc_id is kept; a very long text is many full sequences; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.llm import common
from loomsift.llm.tokens import Encoder

LENGTH, GROUP, ROUNDS, END_ID, VOCABULARY = 1024, 65_536, 4, 2, "byte_bpe_50k.json"
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, place long"


def best_fit(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each size, taken in the given (falling) order, and how full each bin is."""
    by_room: list[list[int]] = [[] for _ in range(room + 1)]
    some = 0  # bit r: there is a bin with room r
    full: list[int] = []
    bins, offsets = [], []
    for n in sizes.tolist():
        fits = some >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            here = by_room[left]
            k = here.pop()
            if not here:
                some ^= 1 << left
        else:
            k, left = len(full), room
            full.append(0)
        bins.append(k)
        offsets.append(room - left)
        full[k] += n
        if left > n:
            by_room[left - n].append(k)
            some |= 1 << (left - n)
    return np.array(bins, np.int64), np.array(offsets, np.int64), np.array(full, np.int64)


def bound(counts: np.ndarray) -> int:
    """A lower bound of the bins for counts[n] pieces of length n, 0 to the bin's length: the best of three families of
    dual-feasible functions (whatever fits into one bin is mapped to at most 1 in all).

    For a threshold t: lengths above the bin's less t count as a bin, those below t as nothing, others as they are. For a
    unit t: a length counts as the units that it holds, one of more than half a bin as the units that no longer fit beside
    it. For k: whole (k + 1)-th parts of a bin count as they are, other lengths as the k-th parts of whole ones below.
    """
    room = len(counts) - 1
    n = np.arange(room + 1)
    at = [-(-int(counts @ n) // room)]
    upto, weight = np.cumsum(counts), np.cumsum(counts * n)
    for t in range(1, room // 2 + 1):
        large = int(upto[room] - upto[room - t])
        at.append(large + -(-int(weight[room - t] - weight[t - 1]) // room))
        half = n > room // 2
        whole = room // t
        f = np.where(half, 2 * (whole - (room - n) // t), np.where(2 * n == room, whole, np.where(n >= t, 2 * (n // t), 0)))
        at.append(-(-int(counts @ f) // (2 * whole)))
    for k in range(1, 64):
        x = n * (k + 1)
        f = np.where(x % room == 0, n * k, x // room * room)  # times 1 / (k * room)
        at.append(-(-int(counts @ f) // (k * room)))
    return max(at)


def pieces(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Encode each document and cut its ids. place: the piece's own number, by which it is dealt; stored."""
    vocabulary = path or public_tokenizers.path(VOCABULARY)
    like = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("place", pa.int64()), *([("ids", pa.binary())] if with_ids else [])])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = Encoder(vocabulary, spaces=True), np.array([END_ID], "<u4").tobytes()
        place = TaskContext.get().partitionId() << 40
        for b in common.sliced(batches):
            out = []
            for i, ids in zip(b.column("doc_id").to_pylist(), enc.encode(b.column("text").to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                edges = [0, *range(n % LENGTH or LENGTH, n + 1, LENGTH)]
                for k, (a, z) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    part = ids[4 * a : 4 * z]
                    out.append((i, k, a, z - a, zlib.crc32(part), place, *([part] if with_ids else [])))
                    place += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out, strict=True), like, strict=True)] if out else [pa.array([], f.type) for f in like], schema=like)

    return common.stored(docs.select("doc_id", "text").mapInArrow(cut, PIECE + (", ids binary" if with_ids else "")), "best-fit-pieces")


DEALT = "place long, length long, sequence_id long, offset long, filled long, gap int"


def packed(rests: DataFrame, turn: int, groups: int) -> DataFrame:
    """The pieces (place, length) dealt into groups and packed. filled: the bin's tokens; gap: the group's bins above its
    bound."""
    like = pa.schema([("place", pa.int64()), ("length", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("filled", pa.int64()), ("gap", pa.int32())])

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        place, n = rows.column("place").to_numpy(), rows.column("length").to_numpy()
        order = np.lexsort((place, -n))
        place, n = place[order], n[order]
        bins, offsets, full = best_fit(n, LENGTH)
        gap = len(full) - bound(np.bincount(n, minlength=LENGTH + 1))
        first = (turn << 56) + (key[0].as_py() << 24)
        return pa.table([pa.array(place), pa.array(n), pa.array(first + bins), pa.array(offsets), pa.array(full[bins]), pa.array(np.full(len(n), gap, np.int32))], schema=like)

    dealt = rests.select("place", "length", F.pmod(F.xxhash64("place", F.lit(turn)), F.lit(groups)).alias("grp"))
    return common.stored(dealt.groupBy("grp").applyInArrow(fill, DEALT), "best-fit-packed")


def bins(packing: DataFrame) -> int:
    """The bins of pieces, counted by their first ones."""
    return packing.where("offset = 0").count()


def repacked(rests: DataFrame, group: int = GROUP, rounds: int = ROUNDS) -> DataFrame | None:
    """place, sequence_id and offset of rests (place, length), after rounds of exchange; None if there are none."""
    left, parts = rests, []
    before: DataFrame | None = None  # what `left` was packed as
    for turn in range(rounds):
        n = left.count()
        if not n:
            before = None
            break
        now = packed(left, turn, -(-n // group))
        if before is not None and bins(now) >= bins(before):
            break
        stays = (F.col("gap") == 0) | (F.col("filled") == LENGTH)
        parts.append(now.where(stays))
        before = now.where(~stays)
        left = before.select("place", "length")
    parts += [before] if before is not None else []
    return functools.reduce(DataFrame.unionByName, parts).select("place", "sequence_id", "offset") if parts else None


def pack(docs: DataFrame, path: str | None = None, group: int = GROUP, rounds: int = ROUNDS, with_ids: bool = True) -> DataFrame:
    """A row a piece: doc_id, piece, start, length, ids (if asked for), ids_crc32, sequence_id and offset."""
    made = pieces(docs, path, with_ids)
    rest = F.col("length") < LENGTH
    out = ["doc_id", "piece", "start", "length", *(["ids"] if with_ids else []), "ids_crc32"]
    full = made.where(~rest).select(*out, (-1 - F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    found = repacked(made.where(rest).select("place", "length"), group, rounds)
    return full if found is None else full.unionByName(made.where(rest).join(found, "place").select(*out, "sequence_id", "offset"))
