"""The rolling features of `kpi.kpi_window_features` for a stream of measurements.

The state of an element is a ring of its measurements: those of the last long window, and at least as many as the trend
looks back on. A measurement waits until the watermark has passed it, so measurements that arrive in any order within the
lateness are taken in order of time. One timer, at the first that waits, wakes an element; a ring that nothing follows is
dropped a long window later.

Nulls and edge cases: measurements without an element or a time give no row; a null value is a row of its own with null
features, and counts in the trend as a step without a point; measurements of one time are in each other's windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.kpi import from_windows
from ..operators.shared import ship

#: Rows before a measurement that its trend takes in.
BACK = 12
HELD = "ne_id long, us long, kpi_value double, m double, s0 double, low double, high double, m_far double, kpi_trend double"


def _slope(values: list[float | None]) -> float:
    """The least-squares slope over the places of the values; 0 with fewer than three."""
    at = np.array([i for i, v in enumerate(values) if v is not None], float)
    if len(at) < 3:
        return 0.0
    v = np.array([x for x in values if x is not None])
    at = at - at.mean()
    return float(at @ (v - v.mean()) / (at @ at))


def windows(us: list[int], values: list[float | None], first: int, short: int, long: int, least: int) -> Iterator[tuple]:
    """(m, s0, low, high, m_far, kpi_trend) of the measurements from place ``first`` on, which are in order of time."""
    times = np.array(us, np.int64)
    for i in range(first, len(us)):
        end = int(np.searchsorted(times, us[i], "right"))
        near = [v for v in values[int(np.searchsorted(times, us[i] - short, "right")) : end] if v is not None]
        far = [v for v in values[int(np.searchsorted(times, us[i] - long, "right")) : end] if v is not None]
        held = (None,) * 4
        if len(near) >= least:
            x = np.array(near)
            held = float(x.mean()), float(x.std(ddof=1)) if len(x) > 1 else None, float(x.min()), float(x.max())
        yield *held, float(np.mean(far)) if len(far) >= least else None, _slope(values[max(0, i - BACK) : i + 1])


class KpiFeatures(StatefulProcessor):
    def __init__(self, short: int, long: int, least: int):
        self.short, self.long, self.least = short * 1_000_000, long * 1_000_000, least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us long, kpi_value double")
        self.ring = handle.getListState("ring", "us long, kpi_value double")
        self.timer = handle.getValueState("timer", "ms long")

    def _wake(self, ms: int) -> None:
        if not self.timer.exists() or ms < self.timer.get()[0]:
            self.handle.registerTimer(ms)
            self.timer.update((ms,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [(r.us, r.kpi_value) for r in rows]
        self.waiting.appendList(new)
        self._wake(-(-min(r[0] for r in new) // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted((tuple(r) for r in self.waiting.get()), key=lambda r: r[0])
        ready, waiting = [r for r in rows if r[0] <= now], [r for r in rows if r[0] > now]
        ring = [tuple(r) for r in self.ring.get()]
        every = ring + ready
        us, values = [r[0] for r in every], [r[1] for r in every]
        for row, held in zip(ready, windows(us, values, len(ring), self.short, self.long, self.least)):
            yield Row(**dict(zip((c.split()[0] for c in HELD.split(", ")), (key[0], *row, *held))))
        # A measurement later than the watermark looks back so far.
        keep = [r for i, r in enumerate(every) if r[0] > now - self.long or i >= len(every) - BACK]
        idle = not waiting and (not every or every[-1][0] <= now - self.long)
        self.ring.put(keep) if keep and not idle else self.ring.clear()
        self.waiting.put(waiting) if waiting else self.waiting.clear()
        self.timer.clear()
        if waiting or not idle:
            self._wake(-(-waiting[0][0] // 1000) if waiting else (every[-1][0] + self.long) // 1000 + 1)

    def close(self) -> None:
        pass


def kpi_feature_stream(kpi: DataFrame, threshold: float = 80.0, short: int = 3600, long: int = 86_400, least: int = 3, late: str = "10 minutes") -> DataFrame:
    """The features of each measurement (ne_id, ts, kpi_value) when the watermark has passed it; a model fitted on the batch
    features scores them. An element that was silent for a long window starts anew, its trend too. The session has to use
    the RocksDB state store."""
    ship(kpi.sparkSession)
    rows = kpi.withWatermark("ts", late).where("ne_id IS NOT NULL AND ts IS NOT NULL")
    rows = rows.select(F.col("ne_id").cast("long").alias("ne_id"), "ts", F.unix_micros("ts").alias("us"), F.col("kpi_value").cast("double").alias("kpi_value"))
    held = rows.groupBy("ne_id").transformWithState(KpiFeatures(short, long, least), HELD, "append", "eventTime")
    return from_windows(held.withColumn("ts", F.timestamp_micros("us")), threshold)
