"""Media columns: payload bytes stored as lossless WebP images and read back to pixel arrays.

A payload is a text's UTF-8, filled with spaces to a positive multiple of 192: rows of 64 RGB pixels, 8-bit samples.
Images have at most 16,384 rows; a longer payload is a sequence of WebP files. Each is stored with the prefix codes,
back-references, colour cache and transforms that shrink it (vp8l_encode), and read back by the whole decoder (vp8l).
feature: images, rows, and the sum of each colour's samples over all pixels.

Defined results: a null or empty text is 192 spaces (n_bytes 0); a text of any length is one row; repeated rows and equal
texts give equal values; a null doc_id is kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomsift.llm import common, vp8l, vp8l_encode

UNIT, WIDTH = 192, 64


def payload(text: str | None) -> tuple[int, bytes]:
    """Unpadded length and padded bytes."""
    raw = (text or "").encode()
    return len(raw), raw.ljust(max(1, -(-len(raw) // UNIT)) * UNIT)


def store(data: bytes) -> bytes:
    return store_all([data])[0]


def store_all(payloads: Sequence[bytes]) -> list[bytes]:
    rows = [np.frombuffer(x, np.uint8).reshape(-1, WIDTH, 3) for x in payloads]
    made = iter(vp8l_encode.encode_all([p[k : k + vp8l.SIDE] for p in rows for k in range(0, len(p), vp8l.SIDE)]))
    return [b"".join(itertools.islice(made, -(-len(p) // vp8l.SIDE))) for p in rows]


def load(media: bytes) -> list[np.ndarray]:
    return next(load_all([media]))


def load_all(media: Sequence[bytes]) -> Iterator[list[np.ndarray]]:
    """The images of each, in order."""
    of = [vp8l.frames(x) for x in media]
    images = vp8l.decode_all([*itertools.chain.from_iterable(of)])
    return (list(itertools.islice(images, len(x))) for x in of)


def encode(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media (WebP) of each text."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            made = [payload(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([n for n, _ in made], pa.int64()), pa.array(store_all([x for _, x in made]), pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(of, "doc_id long, n_bytes long, media binary")


def describe(media: DataFrame) -> DataFrame:
    """Digests and features of the pixels that the stored bytes hold."""
    like = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches, vp8l.IMAGES):
            out = []
            media_of = b.column("media").to_pylist()
            for i, n, stored, images in zip(b.column("doc_id").to_pylist(), b.column("n_bytes").to_pylist(), media_of, load_all(media_of), strict=True):
                data = b"".join(p[..., :3].tobytes() for p in images)
                sums = np.frombuffer(data, np.uint8).reshape(-1, UNIT).sum(0, dtype=np.int64).reshape(-1, 3).sum(0)
                out.append((i, n, len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), f"{len(images)}x{sum(len(p) for p in images)}:{','.join(map(str, sums.tolist()))}"))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out, strict=True), like, strict=True)] if out else [pa.array([], f.type) for f in like], schema=like)

    return media.mapInArrow(of, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
