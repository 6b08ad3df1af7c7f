"""Gaps of telemetry as they happen: state and timers of each generator.

Readings wait in a generator's state until the watermark has passed them, so they are taken in the
order of time however they arrived. A timer stands at the next waiting reading, or where the gap
after the last one becomes too long. When that fires with nothing waiting, the gap is open and is
told at once; when a reading ends it, it is told again with its length. Ended gaps are those of the
batch operator over the same readings. State is one time of each generator and the readings within
the watermark's delay; it is restored from the query's checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.series import KEY

SCHEMA = f"{KEY} string, kind string, gap_start_us long, gap_end_us long, gap_minutes double"


class GapWatch(StatefulProcessor):
    """Rows (generator, kind, gap_start_us, gap_end_us, gap_minutes) of kind open or ended. Readings
    behind the watermark come too late and are left out."""

    def __init__(self, minutes: float, limits: dict[str, float]):
        self.minutes, self.limits = minutes, limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us long, told boolean")
        self.waiting = handle.getListState("waiting", "us long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        times = [int(t.value // 1000) for frame in rows for t in frame["timestamp"] if not pd.isna(t)]
        last = self.last.get()[0] if self.last.exists() else None
        times = [t for t in times if last is None or t >= last]
        if times:
            held = [r[0] for r in self.waiting.get()] if self.waiting.exists() else []
            self.waiting.put([(t,) for t in [*held, *times]])
            self._timer(min([*held, *times]))
        yield self._told(key, [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = sorted(r[0] for r in self.waiting.get()) if self.waiting.exists() else []
        ready, rest = [t for t in held if t <= passed], [t for t in held if t > passed]
        last, told = self.last.get() if self.last.exists() else (None, False)
        longest, out = int(self.limits.get(key[0], self.minutes) * 60_000_000), []
        for t in ready:
            if last is not None and t - last > longest:
                out.append(("ended", last, t))
            last, told = t, False
        if last is not None:
            if not told and passed - last > longest and not (rest and rest[0] - last <= longest):
                out.append(("open", last, None))
                told = True
            self.last.update((last, told))
        if rest:
            self.waiting.put([(t,) for t in rest])
        else:
            self.waiting.clear()
        if rest or (last is not None and not told):
            self._timer(min([*rest[:1], *([] if told or last is None else [last + longest + 1000])]))
        yield self._told(key, out)

    def close(self) -> None:
        pass

    def _timer(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))

    def _told(self, key, events: list[tuple[str, int, int | None]]) -> pd.DataFrame:
        minutes = [None if end is None else round((end - start) / 60e6, 4) for _, start, end in events]
        return pd.DataFrame({KEY: pd.Series([key[0]] * len(events), dtype=object), "kind": pd.Series([e[0] for e in events], dtype=object), "gap_start_us": pd.array([e[1] for e in events], "Int64"), "gap_end_us": pd.array([e[2] for e in events], "Int64"), "gap_minutes": pd.array(minutes, "Float64")})


def watched_gaps(stream: DataFrame, minutes: float = 2.0, late: str = "10 minutes", limits: dict[str, float] | None = None) -> DataFrame:
    """Gap events of a stream (generator_id, timestamp): open gaps as soon as the watermark is `minutes`
    past the last reading, ended ones with their length. limits: other minutes for some generators.
    The session must keep state in RocksDB (spark.sql.streaming.stateStore.providerClass)."""
    named = stream.where(f"{KEY} IS NOT NULL").select(KEY, "timestamp").withWatermark("timestamp", late)
    return named.groupBy(KEY).transformWithStateInPandas(GapWatch(minutes, limits or {}), SCHEMA, "Append", "EventTime")
