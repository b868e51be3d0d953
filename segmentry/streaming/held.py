"""Alerts that must hold for a while before they fire, kept as state inside the stream.

Each alert name has a state: since when its condition has held without a break, the last closed window, whether it
has fired. Transitions leave the stream as rows: ``pending`` at the first breach, ``firing`` once every window of the
hold has breached, ``resolved`` at the first window after a fired alert that does not breach or never closes with
requests. The last is noticed by a timer, so an alert ends even if no request ever comes again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from segmentry import fixed_values as fv
from segmentry.streaming.alerts import _is_error

TRANSITIONS = "alert string, transition string, at timestamp"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MINUTE = 60_000


class Holding(StatefulProcessor):
    """State and timers of one alert, in milliseconds. Windows of an alert arrive in any order within a micro-batch."""

    def __init__(self, length: int, slide: int, hold: int) -> None:
        self.length, self.slide, self.hold = (m * MINUTE for m in (length, slide, hold))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "since bigint, last bigint, fired boolean")

    def _timer(self, last: int) -> int:
        """When the window after ``last`` has closed without requests."""
        return last + self.slide + self.length

    def _forget(self) -> None:
        self.run.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def _rows(self, name: str, found: list[tuple[str, int]]) -> Iterator[pd.DataFrame]:
        if found:
            at = [dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).replace(tzinfo=None) for _, ms in found]
            text = lambda values: pd.Series(values, dtype=object)
            yield pd.DataFrame({"alert": text([name] * len(found)), "transition": text([t for t, _ in found]), "at": pd.Series(at, dtype="datetime64[ns]")})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        windows = sorted(
            (int(start), bool(breach)) for batch in rows for start, breach in zip(batch["start_ms"].tolist(), batch["breach"].tolist())
        )
        state = self.run.get()
        since, last, fired = state if state is not None else (None, None, False)
        found: list[tuple[str, int]] = []
        for start, breach in windows:
            if since is not None and (not breach or start > last + self.slide):
                if fired:
                    found.append(("resolved", last + self.slide))
                since, last, fired = None, None, False
            if breach:
                if since is None:
                    since = start
                    found.append(("pending", start))
                if start - since >= self.hold and not fired:
                    fired = True
                    found.append(("firing", start))
                last = start
        self._forget()
        if since is not None:
            self.run.update((since, last, fired))
            self.handle.registerTimer(self._timer(last))
        yield from self._rows(key[0], found)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        state = self.run.get()
        found = []
        if state is not None:
            since, last, fired = state
            if expiredTimerInfo.getExpiryTimeInMs() >= self._timer(last):
                found = [("resolved", last + self.slide)] if fired else []
                self.run.clear()
        yield from self._rows(key[0], found)

    def close(self) -> None:
        pass


def held_alerts(
    requests: DataFrame,
    conditions: dict[str, Column],
    delay: str = "10 minutes",
    length: int = fv.ALERT_WINDOW_MINUTES,
    slide: int = 1,
    hold: int = fv.ALERT_HOLD_MINUTES,
) -> DataFrame:
    """Transitions of each alert over sliding windows of a stream of requests.

    ``conditions``: alert names and boolean expressions over ``requests`` and ``errors``, the counts of a window. State is
    one row per alert and open window. Needs the RocksDB state store (``STATE_STORE``).
    """
    stamped = requests.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    windows = stamped.groupBy(F.window("ts", f"{length} minutes", f"{slide} minutes").alias("w")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(_is_error()).alias("errors")
    )
    named = F.explode(F.array(*[F.struct(F.lit(name).alias("alert"), F.coalesce(c, F.lit(False)).alias("breach")) for name, c in conditions.items()]))
    rows = windows.select(F.window_time("w").alias("closes"), F.unix_millis(F.col("w.start")).alias("start_ms"), named.alias("a"))
    rows = rows.select("closes", "start_ms", F.col("a.alert").alias("alert"), F.col("a.breach").alias("breach"))
    return rows.groupBy("alert").transformWithStateInPandas(
        statefulProcessor=Holding(length, slide, hold), outputStructType=TRANSITIONS, outputMode="Append", timeMode="EventTime"
    )
