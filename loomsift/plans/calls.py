"""Model calls inside tasks: a bounded number in flight, a rate limit, retries, and failures as a column."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomsift.plans.review import structured
from loomsift.scratch import checkpointed, free_name
from loomsift.sources.remote import Transient, retried

ERROR = "struct<type:string,detail:string,transient:boolean>"
LONGEST = 500


class Rate:
    """At most so many calls a second, evenly; threads wait their turn."""

    def __init__(self, per_second: float | None) -> None:
        self.gap, self.next, self.lock = 1 / per_second if per_second else 0.0, 0.0, threading.Lock()

    def wait(self) -> None:
        with self.lock:
            now = time.monotonic()
            at, self.next = max(now, self.next), max(now, self.next) + self.gap
        if at > now:
            time.sleep(at - now)


def answered(
    todo: DataFrame, prompt: Column, call: Callable[[str], str], schema: str, choices: dict[str, tuple[str, ...]] | None = None,
    attempts: int = 3, in_flight: int = 4, per_second: float | None = None, wait: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """The rows with answer (a struct of the schema) and error (``ERROR``): one of both is null. Stored, so that whatever is
    made of the result asks nothing again.

    Each task has ``in_flight`` calls open at once over its rows as they come, no more than ``per_second`` begin in a second,
    and a transient failure is tried again. An answer that is no JSON of the schema, or has a field without one of its choices, is
    asked for once more with what was wrong, and then is a lasting error. A null prompt isn't asked: both columns are null.
    """
    raw, asked = free_name("raw", todo.columns), free_name("prompt", todo.columns)
    again = free_name("again", todo.columns)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rate = Rate(per_second)

        def one(text: str | None) -> tuple[str | None, dict | None]:
            if text is None:
                return None, None

            def attempt() -> str:
                rate.wait()
                return call(text)

            try:
                return retried(attempt, attempts, wait), None
            except Exception as e:  # noqa: BLE001  a failed call is a row's result
                return None, {"type": type(e).__name__, "detail": str(e)[:LONGEST], "transient": isinstance(e, Transient)}

        error = pa.struct([("type", pa.string()), ("detail", pa.string()), ("transient", pa.bool_())])
        with ThreadPoolExecutor(in_flight) as pool:
            for b in batches:
                for k in range(0, b.num_rows, 64):  # what waits for answers is bounded
                    part = b.slice(k, 64)
                    out = list(pool.map(one, part.column(asked).to_pylist()))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x for x, _ in out], pa.string()), pa.array([e for _, e in out], error)], names=[*part.schema.names, raw, "error"])

    def pass_(df: DataFrame, text: Column) -> DataFrame:
        rows = df.withColumn(asked, text)
        kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
        made = checkpointed(rows.mapInArrow(of, f"{kinds}, `{raw}` string, error {ERROR}"))
        return made.withColumn("answer", structured(F.col(raw), schema, choices or {}))

    left = todo.select(*[c for c in todo.columns if c not in ("answer", "error")])
    first = pass_(left.withColumn(again, prompt), F.col(again))
    wrong = F.col("answer").isNull() & F.col("error").isNull() & F.col(asked).isNotNull()
    hint = F.concat(F.col(again), F.lit("\n\nThe last answer was not of the form asked for. Answer with JSON only:\n"), F.substring(F.coalesce(raw, F.lit("")), 1, LONGEST))
    second = pass_(first.where(wrong).withColumn(again, hint).drop(asked, raw, "answer", "error"), F.col(again))
    lasting = F.struct(F.lit("InvalidAnswer").alias("type"), F.substring(F.coalesce(raw, F.lit("")), 1, LONGEST).alias("detail"), F.lit(False).alias("transient"))
    second = second.withColumn("error", F.when(wrong, lasting).otherwise(F.col("error")))
    return first.where(~wrong).unionByName(second).drop(raw, asked, again)
