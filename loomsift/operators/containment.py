"""Which texts hold which needles: one pass of a multi-pattern automaton over the texts."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of needles in one automaton, about: what tasks are sent and hold has a fixed size.
PART = 4_000_000


def held(texts: DataFrame, needles: DataFrame, part: int = PART) -> DataFrame:
    """Distinct (key, id): the texts (key, text) that hold a needle (id, needle) as a substring, exactly.

    Distinct needles are dealt by a hash into parts of some ``part`` characters. The needles of a part are the patterns of an
    Aho-Corasick automaton, which each task builds once and runs over its texts, so that a text costs its length and its
    findings, whatever the number of needles. More parts are more passes. A needle of any length is whole in one part.

    Null and empty needles are held by no text, null texts hold none; repeated needles give each id; repeated keys hold what any
    of their texts holds; empty tables give no rows; further columns are ignored.
    """
    texts = texts.select("key", "text").where("text <> ''")
    needles = needles.select("id", "needle").where("needle <> ''")
    distinct = needles.select("needle").distinct()
    chars = distinct.agg(F.sum(F.length("needle"))).first()[0] or 0
    parts = -(-chars // part)
    like = texts.schema["key"].dataType.simpleString()

    def passed(n: int) -> DataFrame:
        words = distinct.where(F.pmod(F.xxhash64("needle"), F.lit(parts)) == n).toArrow().column("needle").to_pylist()

        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = ahocorasick.Automaton()
            for k, w in enumerate(words):
                find.add_word(w, k)
            find.make_automaton()
            for b in batches:
                at, found = [], []
                for row, t in enumerate(b.column(1).to_pylist()):
                    mine = {k for _, k in find.iter(t)}
                    at += [row] * len(mine)
                    found += [words[k] for k in mine]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(found, pa.string())], names=["key", "needle"])

        return texts.mapInArrow(of, f"key {like}, needle string") if words else texts.where(F.lit(False)).select("key", F.lit("").alias("needle"))

    if not parts:
        return texts.select("key", F.lit(None).cast(needles.schema["id"].dataType).alias("id")).where(F.lit(False))
    return functools.reduce(DataFrame.unionByName, map(passed, range(parts))).join(needles, "needle").select("key", "id").distinct()
