"""Secret scans: three fixed patterns, then a token-efficiency test for random strings.

Spans are half-open code-point offsets of whole matches. A random string costs a byte-level BPE many tokens: a run
of ``RUN`` with fewer than ``RATIO`` characters a token is a span of kind ``dense``, unless it overlaps a span of
the fixed patterns, is a known digest (hex of a usual length, UUID) or an identifier (letters or digits alone, or
words and short numbers joined by ``_``, ``-``, ``=``, ``/`` or ``+``).

Defined results: a null or empty text has no spans; a text of any length is scanned whole; spans that tie on their start
come in order of kind; a null doc_id is kept; an empty table gives no rows; repeated rows are scanned each for itself; extra columns are
ignored by :func:`scan` and kept by :func:`redact`.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from loomsift.llm import common

KINDS = ("assign", "access", "hex", "dense")
VOCABULARY, RATIO, LEAST = "byte_bpe_50k.tiktoken", 2.0, 24
# The contract's patterns (lengths are checked below or by the quantifier).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{24,}")
DIGEST = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})")
IDENTIFIER = re.compile(r"[_=/+-]*(?:(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})(?:[_=/+-]+|$))+|[A-Za-z]+|[0-9=/+_-]+")
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def vocabulary(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str, longest: int) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns. longest: bytes of the longest word, which rules runs out."""
    low = text.lower()
    found = []
    if any(x in low for x in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if longest >= 32:
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def dense_spans(text: str, base: list[tuple[int, int, int]], longest: int, enc: tiktoken.Encoding) -> list[tuple[int, int, int]]:
    found = []
    for m in RUN.finditer(text) if longest >= LEAST else ():
        s = m.group()
        if DIGEST.fullmatch(s) or IDENTIFIER.fullmatch(s) or any(a < m.end() and m.start() < b for a, _, b in base):
            continue
        if len(s) < RATIO * len(enc.encode_ordinary(s)):
            found.append((m.start(), 3, m.end()))
    return found


def spans(text: str | None, enc: tiktoken.Encoding) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and base with dense ones, of a text; each sorted by start and kind."""
    if not text:
        return [], []
    longest = max(map(len, text.encode().split()), default=0)
    base = base_spans(text, longest)
    return base, sorted(base + dense_spans(text, base, longest, enc))


def said(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def scan(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """doc_id, counts by kind, SHA-256 of the base spans and all spans of each document."""
    like = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_assign", "n_access", "n_hex")), ("base_sha256", pa.string()), ("spans", pa.string())])
    path = vocabulary_path or public_tokenizers.path(VOCABULARY)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = vocabulary(path)
        for b in common.sliced(batches):
            found = [spans(t, enc) for t in b.column("text").to_pylist()]
            yield common.batch(
                {"doc_id": b.column("doc_id"), "base_sha256": [hashlib.sha256(said(x).encode()).hexdigest() for x, _ in found], "spans": [said(x) for _, x in found]}
                | {f"n_{KINDS[k]}": [sum(s[1] == k for s in x) for x, _ in found] for k in range(3)},
                like,
            )

    return docs.select("doc_id", "text").mapInArrow(of, SCHEMA)


def redacted(text: str | None, enc: tiktoken.Encoding) -> str | None:
    """The text with each union of overlapping spans replaced by <kind> of its first span."""
    _, found = spans(text, enc)
    if not found:
        return text
    out, at, n = [], 0, 0
    while n < len(found):
        start, kind, end = found[n]
        n += 1
        while n < len(found) and found[n][0] < end:
            end = max(end, found[n][2])
            n += 1
        out += [text[at:start], f"<{KINDS[kind]}>"]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """The documents with secrets replaced in text, and n_chars, if present, to match."""
    path, names = vocabulary_path or public_tokenizers.path(VOCABULARY), docs.columns
    schema = docs.schema

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = vocabulary(path)
        for b in common.sliced(batches):
            new = [redacted(t, enc) for t in b.column(names.index("text")).to_pylist()]
            yield with_text(b, names, new)

    return docs.mapInArrow(of, schema)


def with_text(b: pa.RecordBatch, names: list[str], new: list[str | None]) -> pa.RecordBatch:
    """The batch with new texts; n_chars, where it is a column, follows for rows whose text changed."""
    cols = list(b.columns)
    at = names.index("text")
    if "n_chars" in names:
        was, n = cols[at].to_pylist(), cols[names.index("n_chars")]
        kept = n.to_pylist()
        cols[names.index("n_chars")] = pa.array([k if w == t or t is None else len(t) for k, w, t in zip(kept, was, new, strict=True)], n.type)
    cols[at] = pa.array(new, cols[at].type)
    return pa.RecordBatch.from_arrays(cols, names=b.schema.names)
