"""The cluster's shared scratch folder, for checkpoints and tables between phases."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. A folder of this machine only where all tasks run in one process."""
    named = spark.conf.get("spark.checkpoint.dir", "")
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, stored: computed once, whatever becomes of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def free_name(name: str, taken: list[str]) -> str:
    """A column name like ``name`` that none of ``taken`` is; upper and lower case are one."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name
