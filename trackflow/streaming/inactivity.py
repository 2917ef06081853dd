"""Event-time timers for taxis that fall silent (off by default)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from trackflow.config import DEFAULTS, END, INACTIVE, Settings
from trackflow.schema import DOUBLE, INT, LONG, TEXT, row

PING = row(
    seq=LONG, taxi_id=INT, event_s=LONG, latitude=DOUBLE, longitude=DOUBLE, trip_status=TEXT
)
NAMES = [f.name for f in PING.fields]


class SilenceWatch(StatefulProcessor):
    """Keeps the newest ping of a running trip and a timer that the next ping moves."""

    def __init__(self, timeout_s: int):
        self.timeout_s = timeout_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", T.StructType(PING.fields))

    def _forget(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.newest.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pings = pd.concat(list(rows)).sort_values("seq")[NAMES]
        pings = pings[pings["event_s"].notna()].reset_index(drop=True)
        if pings.empty:
            return
        stored = self.newest.get() if self.newest.exists() else None
        if stored is not None:
            pings = pd.concat([pd.DataFrame([stored], columns=NAMES), pings], ignore_index=True)
        silence = pings["event_s"].shift(-1) - pings["event_s"]
        silent = pings[(pings["trip_status"] != END) & (silence > self.timeout_s)]
        self._forget()
        last = pings.iloc[-1]
        if last["trip_status"] != END:
            self.newest.update(tuple(None if pd.isna(v) else v for v in last.tolist()))
            self.handle.registerTimer((int(last["event_s"]) + self.timeout_s) * 1000)
        yield silent.assign(trip_status=INACTIVE)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.newest.exists():
            yield pd.DataFrame([self.newest.get()], columns=NAMES).assign(trip_status=INACTIVE)
        self._forget()

    def close(self) -> None:
        pass


def inactive_stream(pings: DataFrame, cfg: Settings = DEFAULTS, lateness: str = "0 seconds") -> DataFrame:
    timed = pings.select(*NAMES, F.timestamp_seconds("event_s").alias("ts"))
    timed = timed.withWatermark("ts", lateness)
    return timed.groupBy("taxi_id").transformWithStateInPandas(
        statefulProcessor=SilenceWatch(cfg.inactivity_timeout_s), outputStructType=PING,
        outputMode="Append", timeMode="EventTime",
    )
