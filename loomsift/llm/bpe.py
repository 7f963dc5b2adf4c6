"""Byte-level BPE encoding and decoding by overlapping chunks.

Every text is chunks of ``CHUNK`` code points, each with the first ``OVERLAP`` of the next. A chunk is pre-tokenised on its
own; its first pre-token may begin mid-word, its last may be cut off. Two neighbours' pre-tokens resynchronise at a
boundary that both find in their overlap. The boundaries that count are those which every scan finds, wherever it began:
behind a non-space before white space, and where letters, numbers and symbols change (but for an apostrophe before a letter,
which may be a contraction). No pre-token of the pattern spans one, and none looks behind it, so text without white space
(Chinese, base64) is stitched too. A chunk's pre-tokens from the first such boundary at its head to the first
one at its tail are encoded where the chunk is; the ids are put in order where neighbours agree on the boundary. Chunks
whose overlap has none (a run of one kind, over ``OVERLAP`` long, which is one pre-token) are joined and encoded together.
Decoding concatenates the ids' raw bytes.

A text of one chunk has no overlap to stitch, and is encoded where it is read; the chunks of longer ones are dealt out, so
one long text is the work of many tasks.

Defined results: a null or empty text has no ids; a text of any length gives one row; repeated rows give one result each; a
null doc_id is kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomsift.llm import common
from loomsift.llm.secrets import vocabulary
from loomsift.llm.tokens import SEPARATOR, pattern

CHUNK, OVERLAP, VOCABULARY = 16_384, 1024, "byte_bpe_multi_50k.tiktoken"
OUT = "doc_id long, n_tokens long, ids binary, decoded binary"


@functools.lru_cache(maxsize=1)
def kinds() -> tuple[str, str, str]:
    """Classes of letters, numbers and symbols: characters of the basic plane on whose kind Unicode's versions agree.

    Symbols are what the pattern takes for such: all but letters, numbers and white space, here without controls.
    """
    of: dict[str, list[int]] = {"L": [], "N": [], "S": []}
    for k in range(0x10000):
        old, new = (u.category(chr(k))[0].translate(str.maketrans("MP", "SS")) for u in (unicodedata.ucd_3_2_0, unicodedata))
        if old == new and old in of:
            of[old].append(k)
    runs = [[[x[1] for x in g] for _, g in itertools.groupby(enumerate(ks), lambda x: x[1] - x[0])] for ks in of.values()]
    letters, numbers, symbols = ("".join(f"\\u{g[0]:04x}-\\u{g[-1]:04x}" for g in r) for r in runs)
    return letters, numbers, symbols


@functools.lru_cache(maxsize=1)
def boundaries() -> re.Pattern[str]:
    """The character before a boundary. (The separators are white space to Python only, so they are on neither side.)"""
    letter, number, symbol = kinds()
    return re.compile(rf"\S(?=[^\S\x1c-\x1f])|[{letter}](?=[{number}{symbol}])|[{number}](?=[{letter}{symbol}])|[{symbol}](?=[{number}])|(?!')[{symbol}](?=[{letter}])")


def encode(enc: tiktoken.Encoding, text: str) -> bytes:
    return np.array(enc.encode_ordinary(text), "<u4").tobytes()


class Encoder:
    """Encodes pre-tokens, with a memory of them; what the pre-tokens' pattern leaves open goes to the library whole."""

    def __init__(self, path: str) -> None:
        self.enc = vocabulary(path)
        self.find = pattern(spaces=True).findall
        self.memory = common.Memory(lambda new: [encode(self.enc, x) for x in new])

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [[] if SEPARATOR.search(t) else self.find(t) for t in texts]
        return [b"".join(x) if x or not t else encode(self.enc, t) for t, x in zip(texts, self.memory.of(parts), strict=True)]


def decode(enc: tiktoken.Encoding, ids: bytes) -> bytes:
    return enc.decode_bytes(np.frombuffer(ids, "<u4").tolist())


def boundary(text: str, low: int, high: int) -> int | None:
    """The first place in [low, high) that is a boundary to every scan; not at the text's ends."""
    m = boundaries().search(text, max(0, low - 1), high)
    return m.end() if m and m.end() < min(high, len(text)) else None


def of_one_chunk(docs: DataFrame, path: str, digest: bool) -> DataFrame:
    """Texts that are one chunk: pre-tokenise and encode it."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(path)
        for b in common.sliced(batches):
            ids = enc.encode([t or "" for t in b.column("text").to_pylist()])
            yield _result(b.column("doc_id"), ids, [decode(enc.enc, x) for x in ids], digest)

    return docs.mapInArrow(of, _schema(digest))


def _schema(digest: bool) -> str:
    return "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else OUT


def _result(doc_ids: pa.Array, ids: list[bytes], raw: list[bytes], digest: bool) -> pa.RecordBatch:
    n = pa.array([len(x) // 4 for x in ids], pa.int64())
    if digest:
        return pa.RecordBatch.from_arrays([doc_ids, n, *(pa.array([hashlib.sha256(x).hexdigest() for x in c], pa.string()) for c in (ids, raw))], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return pa.RecordBatch.from_arrays([doc_ids, n, pa.array(ids, pa.binary()), pa.array(raw, pa.binary())], names=["doc_id", "n_tokens", "ids", "decoded"])


def chunks(docs: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """Each distinct text's chunks (key, n), encoded between the boundaries head and tail, code points of the text.

    A chunk at the text's end has no tail; head or tail is null, and the chunk's text is kept, where an overlap has no
    boundary.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            for t in b.column("text").to_pylist():
                key = hashlib.sha256(t.encode()).hexdigest()
                for n, a in enumerate(range(0, len(t), chunk)):
                    cols = [pa.array([key]), pa.array([n], pa.int32()), pa.array([a + chunk >= len(t)]), pa.array([t[a : a + chunk + overlap]])]
                    yield pa.RecordBatch.from_arrays(cols, names=["key", "n", "last", "text"])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(path)
        for b in common.sliced(batches, 100):
            rows = list(zip(*(b.column(c).to_pylist() for c in ("n", "last", "text")), strict=True))
            head = [boundary(t, 1, overlap) if n else 0 for n, _, t in rows]
            tail = [len(t) if last else boundary(t, chunk + 1, chunk + overlap) for _, last, t in rows]
            whole = [a is not None and z is not None for a, z in zip(head, tail, strict=True)]
            ids = iter(enc.encode([r[2][a:z] for r, a, z, w in zip(rows, head, tail, whole, strict=True) if w]))
            place = lambda xs: pa.array([None if x is None else r[0] * chunk + x for r, x in zip(rows, xs, strict=True)], pa.int64())
            cols = [place(head), place(tail), pa.array([next(ids) if w else None for w in whole], pa.binary()), pa.array([None if w else r[2] for r, w in zip(rows, whole, strict=True)], pa.string())]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("key", "n", "last")), *cols], names=["key", "n", "last", "head", "tail", "ids", "text"])

    parts = docs.select("text").distinct().mapInArrow(cut, "key string, n int, last boolean, text string")
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(shuffles, "key", "n").mapInArrow(encoded, "key string, n int, last boolean, head long, tail long, ids binary, text string")


def of_many_chunks(docs: DataFrame, path: str, digest: bool, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Stitched ids of texts of several chunks; one row a distinct text (key), without its doc_ids."""
    made = common.stored(chunks(docs, path, chunk, overlap), "bpe-chunks")
    row = Window.partitionBy("key").orderBy("n")
    # a chunk whose head isn't where the tail of the one before is continues that one's piece
    in_step = F.coalesce(F.col("head") == F.lag("tail").over(row), F.col("n") == 0)
    pieces = made.withColumn("step", in_step.cast("int")).withColumn("piece", F.sum("step").over(row))
    whole = pieces.groupBy("key", "piece").agg(F.sort_array(F.collect_list(F.struct("n", "last", "head", "tail", "ids", "text"))).alias("parts"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(path)
        for b in common.sliced(batches, 100):
            out = []
            for parts in b.column("parts").to_pylist():
                if len(parts) == 1:
                    out.append(parts[0]["ids"])
                else:  # a run of one kind over their overlaps
                    text = "".join(p["text"] if p is parts[-1] else p["text"][:chunk] for p in parts)
                    base, first, last = parts[0]["n"] * chunk, parts[0]["head"], parts[-1]["tail"]
                    out += enc.encode([text[first - base : last - base]])
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("piece"), pa.array(out, pa.binary())], names=["key", "piece", "ids"])

    in_order = whole.mapInArrow(joined, "key string, piece long, ids binary").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("piece", "ids"))).alias("parts"))

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = vocabulary(path)
        for b in common.sliced(batches, 100):
            ids = [b"".join(p["ids"] for p in parts) for parts in b.column("parts").to_pylist()]
            raw = [b"".join(decode(enc, p["ids"]) for p in parts) for parts in b.column("parts").to_pylist()]
            result = _result(pa.nulls(len(ids), pa.int64()), ids, raw, digest)
            yield pa.RecordBatch.from_arrays([b.column("key"), *result.columns[1:]], names=["key", *result.schema.names[1:]])

    return in_order.mapInArrow(finished, _schema(digest).replace("doc_id long", "key string"))


def tokenise(docs: DataFrame, path: str | None = None, digest: bool = False, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_tokens, and ids (little-endian uint32) with decoded bytes, or the SHA-256 of both."""
    path = path or public_tokenizers.path(VOCABULARY)
    docs = docs.select("doc_id", "text")
    is_long = F.coalesce(F.length("text"), F.lit(0)) > chunk
    few = docs.where(is_long)
    ids = few.select("doc_id", F.sha2("text", 256).alias("key"))
    return of_one_chunk(docs.where(~is_long), path, digest).unionByName(ids.join(of_many_chunks(few, path, digest, chunk, overlap), "key").drop("key"))
