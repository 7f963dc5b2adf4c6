"""Spark-native extensions: the curation state as streams (the batch forms define the results)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from loomsift.schema import NO_BATCH_HOURS, REALERT_HOURS, TTL_HOURS


def windowed_failures(dlq: DataFrame, late: str = "1 hour", span: str = "24 hours", step: str = "1 hour") -> DataFrame:
    """Failures by source and sliding window; rows later than the watermark are left out."""
    return dlq.withWatermark("created_at", late).groupBy(F.window("created_at", span, step), F.substring_index("uid", ":", 1).alias("source")).agg(F.count("*").alias("n"))


def alert_transitions(signals: DataFrame) -> DataFrame:
    """Transitions of alerts from a stream of (key, wanted, at): OPEN, REALERT after a day, RESOLVED."""

    def step(key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        is_open, told = state.get if state.exists else (False, 0.0)
        out = []
        for r in pd.concat(list(frames)).sort_values("at").itertuples():
            at = r.at.timestamp()
            kind = "OPEN" if r.wanted and not is_open else "RESOLVED" if is_open and not r.wanted else "REALERT" if is_open and at - told >= 3600 * REALERT_HOURS else None
            if kind:
                is_open, told = kind != "RESOLVED", at
                out.append((key[0], kind, r.at))
        state.update((is_open, told))
        yield pd.DataFrame(out, columns=["key", "transition", "at"])

    return signals.groupBy("key").applyInPandasWithState(step, "key string, transition string, at timestamp", "is_open boolean, told double", "append", GroupStateTimeout.NoTimeout)


class AlertTimers(StatefulProcessor):
    """State of an alert: whether it is open, since when it was told, and when its source was last heard of.

    A timer stands at the next moment at which something is due: a reminder of an open alert, or the alert of a silent
    source. It goes off when the watermark passes it, whether or not the key has a new row.
    """

    def __init__(self, remind: float, silent: float | None) -> None:
        self.remind, self.silent = remind, silent

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("alert", "is_open boolean, told double, heard double")

    def close(self) -> None:
        pass

    def _due(self, is_open: bool, told: float, heard: float) -> float | None:
        if is_open:
            return told + self.remind
        return heard + self.silent if self.silent is not None else None

    def _keep(self, is_open: bool, told: float, heard: float) -> None:
        self.state.update((is_open, told, heard))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        due = self._due(is_open, told, heard)
        if due is not None:
            self.handle.registerTimer(int(due * 1000))

    def _until(self, key: Any, now: float, is_open: bool, told: float, heard: float, out: list[tuple]) -> tuple[bool, float]:
        """What was due before ``now``, each at its own time."""
        while (due := self._due(is_open, told, heard)) is not None and due <= now:
            out.append((key, "REALERT" if is_open else "OPEN", pd.Timestamp(due, unit="s")))
            is_open, told = True, due
        return is_open, told

    def _frame(self, out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["key", "transition", "at"]).astype({"at": "datetime64[ns]"})

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  Spark's names
        state = self.state.get() if self.state.exists() else None
        out: list[tuple] = []
        for r in pd.concat(list(rows)).sort_values("at").itertuples():
            at = r.at.timestamp()
            is_open, told, heard = state if state is not None else (False, at, at)
            if state is not None:
                is_open, told = self._until(key[0], at, is_open, told, heard, out)
            heard = max(heard, at)
            if bool(r.wanted) != is_open:
                is_open, told = not is_open, at
                out.append((key[0], "OPEN" if is_open else "RESOLVED", pd.Timestamp(at, unit="s")))
            state = (is_open, told, heard)
        self._keep(*state)
        yield self._frame(out)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        is_open, told, heard = self.state.get()
        out: list[tuple] = []
        is_open, told = self._until(key[0], expiredTimerInfo.getExpiryTimeInMs() / 1000, is_open, told, heard, out)
        self._keep(is_open, told, heard)
        yield self._frame(out)


def timed_alerts(signals: DataFrame, remind_hours: float = REALERT_HOURS, silent_hours: float | None = NO_BATCH_HOURS, late: str = "0 seconds") -> DataFrame:
    """Transitions of alerts from a stream of (key, wanted, at) whose clock is the watermark: OPEN when it is wanted, or when
    nothing came for ``silent_hours``; REALERT after each ``remind_hours`` of being open; RESOLVED.

    Reminders and alerts of silence don't wait for a row of their key. Needs the RocksDB state store.
    """
    silent = None if silent_hours is None else 3600 * silent_hours
    return signals.withWatermark("at", late).groupBy("key").transformWithStateInPandas(AlertTimers(3600 * remind_hours, silent), "key string, transition string, at timestamp", "append", "eventTime")


class Expiring(StatefulProcessor):
    """The last touch of each key; a timer ends it when the watermark is ``hours`` past that."""

    def __init__(self, hours: float) -> None:
        self.span = 3600 * hours

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("touched", "at double")

    def close(self) -> None:
        pass

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        at = max(r["at"].max().timestamp() for r in rows)
        if self.state.exists():
            at = max(at, self.state.get()[0])
        self.state.update((at,))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(int((at + self.span) * 1000))
        yield pd.DataFrame({"uid": pd.Series([], dtype=str), "at": pd.Series([], dtype="datetime64[ns]")})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.state.clear()
        yield pd.DataFrame({"uid": [key[0]], "at": [pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")]})


def expired(touches: DataFrame, hours: float = TTL_HOURS, late: str = "0 seconds") -> DataFrame:
    """uid and the time at which it ran out, from a stream of touches (uid, at): ``hours`` after the last one. Needs the
    RocksDB state store."""
    return touches.withWatermark("at", late).groupBy("uid").transformWithStateInPandas(Expiring(hours), "uid string, at timestamp", "append", "eventTime")


def incremental(rows: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Hand each micro-batch of what is there to a batch plan, then stop."""
    return rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
