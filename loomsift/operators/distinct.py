"""Distinct counts that add up: bitmaps of dense ids, a row a day, from which any span of days is counted exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomsift.scratch import checkpointed


def numbered(uids: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """uid and id of the distinct uids, not null; those of ``known`` (uid, id) keep theirs, new ones follow, in order.

    Ids are dense, so that bitmaps of 32,768 bits are well filled. Uids are dealt by ranges and numbered inside them; the
    windows over ranges have a row a partition.
    """
    new = uids.select("uid").where("uid is not null").distinct()
    first = 0
    if known is not None:
        new = new.join(known.select("uid"), "uid", "left_anti")
        first = known.agg(F.coalesce(F.max("id") + 1, F.lit(0))).first()[0]
    dealt = checkpointed(new.repartitionByRange("uid").withColumn("piece", F.spark_partition_id()))
    sizes = dealt.groupBy("piece").agg(F.count("*").alias("n"))
    before = sizes.select("piece", (F.sum("n").over(Window.orderBy("piece")) - F.col("n")).alias("before"))  # a row a partition
    inside = F.row_number().over(Window.partitionBy("piece").orderBy("uid")) - 1
    made = dealt.withColumn("inside", inside).join(before, "piece").select("uid", (F.lit(first) + F.col("before") + F.col("inside")).alias("id"))
    return made if known is None else known.select("uid", F.col("id").cast("long").alias("id")).unionByName(made)


def daily(rows: DataFrame, ids: DataFrame, keys: list[str]) -> DataFrame:
    """keys, day, bucket and bitmap of the rows (keys, day, uid): which ids a key has on a day. To be kept; a day's rows are
    replaced or or-ed with later ones (:func:`added`)."""
    x = rows.select(*keys, "day", "uid").join(ids, "uid").select(*keys, "day", F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("bit"))
    return x.groupBy(*keys, "day", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def added(kept: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The daily rows of both."""
    return kept.unionByName(new).groupBy(*keys, "day", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counted(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """n: the distinct ids of daily rows, by any columns or none."""
    whole = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return whole.groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias("n"))


def rolling(bitmaps: DataFrame, keys: list[str], days: int) -> DataFrame:
    """keys, day and n: the distinct ids of the ``days`` days up to each day that has rows; each daily row is part of as many
    windows, and no day's ids are read again."""
    ends = bitmaps.select(*keys, F.col("day").alias("end")).distinct()
    spread = bitmaps.withColumn("end", F.explode(F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda k: F.date_add("day", k.cast("int")))))
    return counted(spread.join(ends, [*keys, "end"]), [*keys, "end"]).withColumnRenamed("end", "day")
