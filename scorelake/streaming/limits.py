"""Stateful streams: rate limit, alert hold times, silent sources.

State is a few numbers per key. These need the RocksDB state store provider, see
``use_state_store``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from scorelake.session import ship_by_value

ship_by_value(__name__)


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


class RateLimiter(StatefulProcessor):
    """A window opens at a key's first event; the first ``limit`` events in it are allowed.

    Refused events still count. Events of a batch are taken in time order.
    """

    def __init__(self, limit: int, window_us: int):
        self.limit, self.window_us = limit, window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("window", "start bigint, n bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["us", "id"], kind="stable")
        start, n = self.state.get() if self.state.exists() else (-(2**62), 0)
        starts, allowed = [], []
        for us in pdf["us"]:
            if us >= start + self.window_us:
                start, n = int(us), 0
            n += 1
            starts.append(start)
            allowed.append(n <= self.limit)
        self.state.update((int(start), int(n)))
        yield pd.DataFrame({"id": pdf["id"], "key": key[0], "window_us": starts, "allowed": allowed})

    def close(self) -> None:
        pass


def limit_stream(events: DataFrame, limit: int = 100, window_s: int = 60) -> DataFrame:
    """``events`` has (id bigint, key bigint, us bigint); adds window start and whether allowed."""
    return events.groupBy("key").transformWithStateInPandas(
        statefulProcessor=RateLimiter(limit, window_s * 1_000_000),
        outputStructType="id bigint, key bigint, window_us bigint, allowed boolean",
        outputMode="Append",
        timeMode="None",
    )


class AlertHold(StatefulProcessor):
    """Fires once when a rule has been true at every step for the hold time; a false or missing step resets."""

    def __init__(self, step_us: int, hold_us: int):
        self.step_us, self.hold_us = step_us, hold_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("run", "first bigint, last bigint, fired boolean")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values("us", kind="stable")
        first, last, fired = self.state.get() if self.state.exists() else (0, -(2**62), False)
        out = []
        for us, true in zip(pdf["us"], pdf["true"]):
            if not true:
                last, fired = -(2**62), False
                continue
            if us - last != self.step_us:
                first, fired = int(us), False
            last = int(us)
            if not fired and last - first >= self.hold_us:
                fired = True
                out.append((key[0], first, last))
        self.state.update((int(first), int(last), bool(fired)))
        yield pd.DataFrame(out, columns=["rule", "pending_us", "firing_us"]).astype(
            {"rule": object, "pending_us": np.int64, "firing_us": np.int64}
        )

    def close(self) -> None:
        pass


def hold_stream(series: DataFrame, step_s: int, hold_s: int) -> DataFrame:
    """``series`` has (rule string, us bigint, true boolean), one row per rule and evaluation step."""
    return series.groupBy("rule").transformWithStateInPandas(
        statefulProcessor=AlertHold(step_s * 1_000_000, hold_s * 1_000_000),
        outputStructType="rule string, pending_us bigint, firing_us bigint",
        outputMode="Append",
        timeMode="None",
    )


class SilenceWatch(StatefulProcessor):
    """Reports a source when processing time passes its last event by the limit."""

    def __init__(self, limit_ms: int):
        self.limit_ms = limit_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", "timer bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for _ in rows:
            pass
        if self.state.exists():
            self.handle.deleteTimer(self.state.get()[0])
        at = timerValues.getCurrentProcessingTimeInMs() + self.limit_ms
        self.handle.registerTimer(at)
        self.state.update((at,))
        yield pd.DataFrame({"source": pd.Series([], dtype=object), "silent_at_ms": pd.Series([], dtype="int64")})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.state.clear()
        yield pd.DataFrame({"source": [key[0]], "silent_at_ms": [expiredTimerInfo.getExpiryTimeInMs()]})

    def close(self) -> None:
        pass


def silence_stream(beats: DataFrame, limit_s: int = 60) -> DataFrame:
    """``beats`` has a string column ``source``; emits a row when a source goes silent."""
    return beats.groupBy("source").transformWithStateInPandas(
        statefulProcessor=SilenceWatch(limit_s * 1000),
        outputStructType="source string, silent_at_ms bigint",
        outputMode="Update",
        timeMode="ProcessingTime",
    )
