"""Encoding with a tokenizers file, and token ids in patched frame-of-reference blocks.

File format (a table, one row a chunk, written by Spark's own committer): ids of consecutive documents in ascending
doc_id order, in chunks of whole documents of some ``CHUNK`` ids inside a shard. A chunk holds its documents' ids and
numbers of ids, the byte offset at which each of its blocks of ``BLOCK`` ids starts (the index), and the blocks. A
block is a header (number of ids, least id, bit width, number of exceptions), the offsets from the least id packed at
that width in little-endian bit order, and an exception list: place (uint16) and full offset (uint32) of each value
that needs more bits. The width is the least that holds ``PERCENTILE`` % of the block's offsets, so that a few large
ids don't widen the rest.

Defined results: a null or empty text has only the end id; rows with equal doc_id are ordered by their text; a null
doc_id sorts first; a very long text is a chunk of its own, of many blocks; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import array
import functools
import itertools
import operator
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomsift.llm import common

BLOCK, CHUNK, PERCENTILE, END_ID, VOCABULARY = 4096, 65_536, 90, 2, "byte_bpe_50k.json"
#: Letters and numbers below U+0250: the same in every Unicode version, alone in Unicode's normal form, and with one letter
#: as lower case. All further characters, and U+0130 (in lower case a letter and a mark), are left to the library.
LETTER, NUMBER, FURTHER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\u0130\u0250-\U0010ffff"
#: Separators that Python takes for white space and the library doesn't: the library gets the whole text.
SEPARATOR = re.compile("[\x1c-\x1f]")
IS_FURTHER = re.compile(f"[{FURTHER}]")


@functools.lru_cache(maxsize=1)
def marks() -> str:
    """A class of the characters that may become one with a letter before them in Unicode's normal form: marks, and those
    that Python's Unicode version doesn't know."""
    odd = [k for k in range(0x250, 0x110000) if unicodedata.category(chr(k)) in ("Mn", "Mc", "Me", "Cn")]
    runs = itertools.groupby(enumerate(odd), lambda x: x[1] - x[0])
    edges = [(run[0][1], run[-1][1]) for _, g in runs for run in [list(g)]]
    return "".join(f"\\U{a:08x}-\\U{z:08x}" for a, z in edges)


def pattern(spaces: bool) -> re.Pattern[str]:
    """Matches pre-tokens, in the order of the vocabularies' own patterns.

    A run of letters, numbers or symbols is certain if no further character follows; else all up to the next white space
    is one match for the library to cut. White space is in no match unless the tokenizer keeps it (``spaces``); a
    tokenizer that doesn't composes characters first, so that a mark may take a contraction's last letter: with a mark
    behind it, all up to the next white space is left to the library.
    """
    s = " ?" if spaces else ""
    number = f"[{NUMBER}]++" if spaces else f"[{NUMBER}]"
    certain = [f"{s}{run}(?![{FURTHER}])" for run in (f"[{LETTER}]++", number, f"[^\\s{LETTER}{NUMBER}{FURTHER}]++")]
    contraction = "'(?:[stmd]|re|ve|ll)" if spaces else f"'(?:[sStTmMdD]|[rRvV][eE]|[lL][lL])(?:(?![{marks()}])|\\S*)"
    return re.compile("|".join([contraction, *certain, f"{s}\\S+", *(["\\s+(?!\\S)", "\\s+"] if spaces else [])]))


#: Classes of characters below U+0250; GAP stands between texts, OTHER is left to the pattern.
SPACES, LETTERS, NUMBERS, SYMBOLS, GAP, OTHER = range(6)


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each character below U+0250, and of one above."""
    kinds = [(SPACES, "\\s"), (LETTERS, f"[{LETTER}]"), (NUMBERS, f"[{NUMBER}]"), (OTHER, f"[{FURTHER}]")]
    found = [next((k for k, p in kinds if re.match(p, chr(c))), SYMBOLS) for c in range(0x251)]
    found[0x1C] = GAP
    return np.array(found, np.uint8)


def cut(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pre-tokens of ``pattern(spaces=True)`` begin in UTF-8 texts that stand between gaps, the bytes 0x1C, which are
    one each; and where characters are that it doesn't tell, for which the first result is void."""
    table = classes()
    kind = table[np.minimum(data, 0x7F)]
    lead = np.flatnonzero(data >= 0xC2)
    of = (data[lead] & 0x1F).astype(np.uint16) << 6 | data[lead + 1] & 0x3F
    of = table[np.where(data[lead] > 0xC9, 0x250, np.minimum(of, 0x250))]
    kind[lead] = kind[lead + 1] = of
    odd = lead[of == OTHER]
    begins = np.ones(len(data), bool)
    np.not_equal(kind[1:], kind[:-1], out=begins[1:])
    word = (kind != SPACES) & (kind != GAP)
    begins[1:] &= ~(word[1:] & (data[:-1] == 0x20))  # a space goes with the word behind it
    last = np.flatnonzero(word[1:] & (kind[:-1] == SPACES))  # and white space before one ends a character early
    begins[last - (data[last] >= 0x80)] = True
    quote = np.flatnonzero(begins & (data == ord("'")))
    a, b = data[quote + 1], data[np.minimum(quote + 2, len(data) - 1)]
    one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
    two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    begins[quote[one | two] + 1] = False
    begins[quote[one] + 2] = begins[quote[two] + 3] = True
    return np.flatnonzero(begins), odd


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One for all tasks of a Python worker. The strings of special tokens in a text are ordinary text, as the
    vocabularies' description has it."""
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return tok


@functools.lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else one from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in prints]
    return {b: chr(0x100 + k) for k, b in enumerate(others)} | {b: chr(b) for b in prints}


class Encoder:
    """A tokenizer with a memory of pre-tokens: texts repeat their words, so most are looked up.

    New pre-tokens are encoded by the tokenizer's model, those with further characters by the whole tokenizer.
    ``spaces``: whether the tokenizer keeps white space (and case).
    """

    def __init__(self, path: str, spaces: bool, most: int = 300_000) -> None:
        self.tok = tokenizer(path)
        self.find, self.letters, self.spaces = pattern(spaces).findall, byte_letters(), spaces
        self.memory = common.Memory(self._made, most)

    def _alone(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _made(self, new: list[str]) -> list[bytes]:
        odd = {x for x in new if IS_FURTHER.search(x)} if IS_FURTHER.search("".join(new)) else set()
        gap, tokenize, number = "\x1c", self.tok.model.tokenize, operator.attrgetter("id")
        told = gap.join([x for x in new if x not in odd] if odd else new)
        if not self.spaces:
            told = told.lower()
        ids, ends = array.array("I"), [0]
        for x in map(tokenize, told.encode().decode("latin-1").translate(self.letters).split(self.letters[ord(gap)])):
            ids.extend(map(number, x))  # the library's tokens are let go at once
            ends.append(len(ids))
        data = np.array(ids, "<u4").tobytes()
        made = [data[4 * a : 4 * z] for a, z in itertools.pairwise(ends)]
        if not odd:
            return made
        at = iter(made)
        return [self._alone(x) if x in odd else next(at) for x in new]

    def _found(self, texts: list[str]) -> list[bytes]:
        return [b"".join(x) for x in self.memory.of(list(map(self.find, texts)))]

    def _cut(self, texts: list[str]) -> list[bytes]:
        """As ``_found``, of pre-tokens that are cut by classes of bytes, and looked up once for all texts."""
        data = np.frombuffer("\x1c".join(["", *texts, ""]).encode(), np.uint8)
        begin, odd = cut(data)
        if len(odd):
            left = set((np.searchsorted(np.flatnonzero(data == 0x1C), odd) - 1).tolist())
            rest = [t for k, t in enumerate(texts) if k not in left]
            told, found = iter(self._cut(rest) if rest else []), iter(self._found([texts[k] for k in sorted(left)]))
            return [next(found) if k in left else next(told) for k in range(len(texts))]
        strings = pa.StringArray.from_buffers(len(begin), pa.py_buffer(np.append(begin, len(data)).astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        ids = [b"", *self.memory.of([strings.dictionary[1:].to_numpy(zero_copy_only=False).tolist()])[0]]  # the first one is the gap
        code, size = strings.indices.to_numpy(), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, n = np.cumsum(size) - size, size[code]
        end = np.cumsum(n)
        out = np.frombuffer(b"".join(ids), "<u4")[np.repeat(first[code] - end + n, n) + np.arange(end[-1])]
        edge = end[code == 0].tolist()
        return [out[a:z].tobytes() for a, z in itertools.pairwise(edge)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian uint32. Some texts at a time, to bound the pre-tokens held."""
        out: list[bytes] = [b""] * len(texts)
        at: list[int] = []
        size, most = 0, 2_000_000 if self.spaces else 1_000_000
        for k, t in enumerate(texts):
            if t and SEPARATOR.search(t):
                out[k] = self._alone(t)
            elif t:
                at.append(k)
                size += len(t)
            if at and (size > most or k == len(texts) - 1):
                for j, x in zip(at, (self._cut if self.spaces else self._found)([texts[j] for j in at]), strict=True):
                    out[j] = x
                at, size = [], 0
        return out


@functools.lru_cache(maxsize=1)
def shared_encoder(path: str, spaces: bool, job: str) -> Encoder:
    """One for all tasks of a job in a Python worker, so that a task finds the pre-tokens of those before it. Another job's
    takes its place."""
    return Encoder(path, spaces, most=600_000)


HEADER = struct.Struct("<HxxIBxH")


def pack(ids: np.ndarray) -> bytes:
    """One block of at most 4096 ids."""
    least = ids.min()
    off = ids - least
    at = -(-len(off) * PERCENTILE // 100) - 1  # the least offset that PERCENTILE % don't exceed
    width = int(np.partition(off, at)[at]).bit_length()
    wide = np.flatnonzero(off >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    low = off.astype("<u4")
    low[wide] = 0
    bits = np.unpackbits(low.view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little") if width else np.empty(0, np.uint8)
    return HEADER.pack(len(ids), int(least), width, len(wide)) + np.packbits(bits.ravel(), bitorder="little").tobytes() + wide.astype("<u2").tobytes() + off[wide].astype("<u4").tobytes()


@functools.lru_cache(maxsize=32)
def places(width: int) -> tuple[np.ndarray, np.ndarray]:
    """The first byte of each of a block's packed values, and the bits before it there."""
    bit = np.arange(BLOCK, dtype=np.int64) * width
    return bit >> 3, (bit & 7).astype(np.uint64)


def unpack(data: bytes, at: int = 0) -> np.ndarray:
    """The ids of the block that begins at a byte offset."""
    n, least, width, k = HEADER.unpack_from(data, at)
    at, size = at + HEADER.size, (n * width + 7) // 8
    byte, shift = places(width)
    raw = np.zeros(size + 8, np.uint8)
    raw[:size] = np.frombuffer(data, np.uint8, size, at)
    off = np.zeros(n, np.uint64)
    for j in range((width + 14) // 8):  # bytes that a value can lie in
        off |= raw[byte[:n] + j].astype(np.uint64) << np.uint64(8 * j)
    off = ((off >> shift[:n]) & np.uint64((1 << width) - 1)).astype("<u4")
    off[np.frombuffer(data, "<u2", k, at + size)] = np.frombuffer(data, "<u4", k, at + size + 2 * k)
    return off + np.uint32(least)


SCHEMA = "shard int, start long, n long, doc_ids array<long>, doc_tokens array<long>, block_starts array<int>, blocks binary"


def write(docs: DataFrame, out: str | None = None, path: str | None = None, shards: int | None = None) -> DataFrame:
    """Encode the documents and write their chunks to the folder ``out`` (none: a scratch folder of this session);
    returns the table read back. path: the vocabulary.

    Texts are dealt out by ranges of doc_id and sorted inside them, so that shards in order hold ascending ids; a
    shard is worked through batch by batch and holds less than a chunk between batches. start: the place of the
    chunk's first id in its shard.
    """
    spark = docs.sparkSession
    vocabulary, job = path or public_tokenizers.path(VOCABULARY), uuid.uuid4().hex
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    like = pa.schema([("shard", pa.int32()), ("start", pa.int64()), ("n", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("block_starts", pa.list_(pa.int32())), ("blocks", pa.binary())])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = shared_encoder(vocabulary, True, job), np.array([END_ID], "<u4").tobytes()
        at, shard = 0, 0
        held: list[tuple[int, bytes]] = []
        size = 0

        def chunk() -> pa.RecordBatch:
            nonlocal at, held, size
            ids = np.frombuffer(b"".join(x for _, x in held), "<u4")
            made = [pack(ids[k : k + BLOCK]) for k in range(0, len(ids), BLOCK)]
            begin = np.concatenate([[0], np.cumsum([len(x) for x in made])])[:-1].tolist()
            row = (shard, at, len(ids), [i for i, _ in held], [len(x) // 4 for _, x in held], begin, b"".join(made))
            at, held, size = at + len(ids), [], 0
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, like, strict=True)], schema=like)

        for b in common.sliced(batches):
            if b.num_rows:
                shard = b.column("shard")[0].as_py()
            for i, ids in zip(b.column("doc_id").to_pylist(), enc.encode(b.column("text").to_pylist()), strict=True):
                held.append((i, ids + end))
                size += len(ids) // 4 + 1
                if size >= CHUNK:
                    yield chunk()
        if held:
            yield chunk()

    dealt = docs.select("doc_id", "text").repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text").withColumn("shard", F.spark_partition_id())
    made = dealt.mapInArrow(encoded, SCHEMA)
    if out is None:
        return common.stored(made, "token-blocks")
    made.write.parquet(out)
    return spark.read.schema(SCHEMA).parquet(out)


def read(table: DataFrame, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian uint32, if asked for) and ids_crc32.

    Chunks hold whole documents, so each is decoded where it is read; where documents end is in the chunk's columns. The
    driver sees one number a shard.
    """
    totals = sorted((r.shard, r.n) for r in table.groupBy("shard").agg(F.sum("n").alias("n")).collect())
    before, at = {}, 0
    for shard, n in totals:
        before[shard], at = at, at + n
    like = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), *([("ids", pa.binary())] if with_ids else []), ("ids_crc32", pa.int64())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches, 1):
            for r in b.to_pylist():
                ids = np.concatenate([unpack(r["blocks"], k) for k in r["block_starts"]]).tobytes()
                ends = np.cumsum(r["doc_tokens"]).tolist()
                parts = [ids[4 * a : 4 * z] for a, z in zip([0, *ends[:-1]], ends, strict=True)]
                first = before[r["shard"]] + r["start"]
                yield common.batch({"doc_id": r["doc_ids"], "start": [first + a for a in [0, *ends[:-1]]], "n_tokens": r["doc_tokens"], "ids": parts, "ids_crc32": list(map(zlib.crc32, parts))}, like)

    return table.mapInArrow(decoded, f"doc_id long, start long, n_tokens long, {'ids binary, ' if with_ids else ''}ids_crc32 long")
