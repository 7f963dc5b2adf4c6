"""The output firewall over conversations: each turn's anchors against all that was said in the turns before."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomsift.functions.guards import anchors
from loomsift.functions.text import straight
from loomsift.scratch import checkpointed

#: Characters of a conversation's anchors that a task holds at once, about.
PART = 4_000_000


def first_said(turns: DataFrame, wanted: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, needle, and the first turn whose text (conv_id, turn, text) holds it, of needles (conv_id, needle) held at all.

    Texts are dealt by ranges of (conv_id, turn), so that a long conversation is many pieces; a conversation's distinct needles
    go to each of its pieces, in parts of some ``part`` characters. A piece comes as a stream: the needles, which become an
    automaton, then the texts in order, each read once.
    """
    rows = checkpointed(turns.select("conv_id", "turn", "text").where("text <> ''").repartitionByRange("conv_id", "turn").withColumn("piece", F.spark_partition_id()))
    needles = wanted.select("conv_id", "needle").where("needle <> ''").distinct()
    parts = needles.groupBy("conv_id").agg(F.ceil(F.sum(F.length("needle")) / part).cast("int").alias("parts"))
    dealt = needles.join(parts, "conv_id").withColumn("part", F.pmod(F.xxhash64("needle"), "parts").cast("int")).drop("parts")
    none = F.lit(None)
    asked = dealt.join(rows.select("conv_id", "piece").distinct(), "conv_id").select("conv_id", "piece", "part", F.lit(0).alias("kind"), none.cast(turns.schema["turn"].dataType).alias("turn"), F.col("needle").alias("text"))
    told = rows.join(parts, "conv_id").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("conv_id", "piece", "part", F.lit(1).alias("kind"), "turn", "text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, find, open_, built = None, None, set(), False
        for b in batches:
            where, needle, turn = [], [], []
            cols = [b.column(c).to_pylist() for c in ("conv_id", "piece", "part", "kind", "turn", "text")]
            for k, (conv, piece, p, kind, at, t) in enumerate(zip(*cols, strict=True)):
                if here != (conv, piece, p):
                    here, find, open_, built = (conv, piece, p), ahocorasick.Automaton(), set(), False
                if kind == 0:
                    find.add_word(t, t)
                    open_.add(t)
                    continue
                if not built:
                    find.make_automaton()
                    built = True
                for n in {n for _, n in find.iter(t)} & open_ if open_ else ():
                    open_.discard(n)
                    where.append(k)
                    needle.append(n)
                    turn.append(at)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(where, pa.int64())), pa.array(needle, pa.string()), pa.array(turn, b.schema.field("turn").type)], names=["conv_id", "needle", "turn"])

    kinds = {f.name: f.dataType.simpleString() for f in turns.schema}
    stream = asked.unionByName(told).repartition("conv_id", "piece", "part").sortWithinPartitions("conv_id", "piece", "part", "kind", "turn")
    return stream.mapInArrow(of, f"conv_id {kinds['conv_id']}, needle string, turn {kinds['turn']}").groupBy("conv_id", "needle").agg(F.min("turn").alias("first_turn"))


def checked_turns(turns: DataFrame, strict: bool = False, part: int = PART) -> DataFrame:
    """conv_id, turn, passed, anchors_checked, n_violations and n_warnings of each turn (conv_id, turn, text).

    An anchor that no earlier turn of the conversation holds, character by character after quotes, dashes and white space are
    made plain, is a violation; without ``strict`` a warning, and the turn passes. Null and empty texts have no anchors and
    hold none; a turn that comes twice counts as one; null conversations and turns take no part; an empty table gives no
    rows; further columns are ignored.
    """
    said = turns.select("conv_id", "turn", "text").where("conv_id is not null and turn is not null")
    found = checkpointed(said.select("conv_id", "turn", F.explode(anchors("text")).alias("a")).select("conv_id", "turn", straight(F.col("a.raw")).alias("needle")))
    first = first_said(said.withColumn("text", straight(F.col("text"))), found, part)
    judged = found.join(first, ["conv_id", "needle"], "left").withColumn("absent", F.coalesce(F.col("first_turn") >= F.col("turn"), F.lit(True)))
    n = judged.groupBy("conv_id", "turn").agg(F.count("*").cast("int").alias("anchors_checked"), F.count_if("absent").cast("int").alias("absent"))
    zero, absent = F.lit(0), F.coalesce("absent", F.lit(0))
    return said.select("conv_id", "turn").distinct().join(n, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", (F.lit(not strict) | (absent == 0)).alias("passed"), F.coalesce("anchors_checked", zero).alias("anchors_checked"),
        (absent if strict else zero).alias("n_violations"), (zero if strict else absent).alias("n_warnings"),
    )
