"""Similar titles as they come: an index of runs of characters in the shared folder, read and extended by micro-batches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomsift.operators.dedup import matched, offered
from loomsift.schema import TITLE_RATIO

RUNS = "y string, y1 long, y2 long, size int, at int, run string, batch long"
ROWS = "id string, title string, batch long"


@dataclass
class TitleIndex:
    """Titles seen, and their runs, by micro-batch. A title is cut into runs once, when it first comes.

    A micro-batch writes its own part, which a repeated attempt replaces, and reads the parts of batches up to its own: a
    restart finds what it would have found.
    """

    path: str
    threshold: float = TITLE_RATIO

    def _read(self, spark: SparkSession, kind: str, schema: str, batch: int) -> DataFrame:
        """The parts of all batches up to this one."""
        try:
            rows = spark.read.schema(schema).parquet(f"{self.path}/{kind}")
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return spark.createDataFrame([], schema)
        return rows.where(F.col("batch") <= batch)

    def _write(self, rows: DataFrame, kind: str, batch: int) -> None:
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/{kind}/batch={batch}")

    def extended(self, rows: DataFrame, batch: int) -> DataFrame:
        """Pairs (left_id, right_id, score) of this batch's rows (id, title) with all rows up to and in it, like or equal.

        Rows of null and empty titles have no pairs. Ids are distinct.
        """
        spark = rows.sparkSession
        mine = rows.select(F.col("id").cast("string").alias("id"), "title").where("title <> ''")
        self._write(mine, "rows", batch)
        mine = spark.read.schema("id string, title string").parquet(f"{self.path}/rows/batch={batch}")
        known = self._read(spark, "rows", ROWS, batch - 1).select("title").distinct()
        self._write(offered(mine.join(known, "title", "left_anti"), self.threshold), "runs", batch)
        found = matched(mine, self._read(spark, "runs", RUNS, batch).drop("batch"), self.threshold)
        every = self._read(spark, "rows", ROWS, batch)
        return mine.select(F.col("id").alias("left_id"), F.col("title").alias("x")).join(found, "x").join(every.select(F.col("id").alias("right_id"), F.col("title").alias("y")), "y").select("left_id", "right_id", "score")


def similar_as_they_come(rows: DataFrame, index: TitleIndex, out: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand the pairs of each micro-batch of a stream (id, title) to ``out``, until all that is there is done."""
    return rows.writeStream.foreachBatch(lambda df, n: out(index.extended(df, n), n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
