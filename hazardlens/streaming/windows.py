"""Window counts kept in keyed state: corrections for late rows, state that ends by itself.

Rows may come late. A window's count is given out whenever it has changed, with a revision number; the newest revision is
the count. State is one counter for each window and key. It is removed by a timer once the watermark has passed the
window's end by ``keep``; a row for a window whose counter is gone counts from nothing again, as a new part, so parts and
revisions together lose no row however late it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "part long, revision long, n long"


class CountWithCorrections(StatefulProcessor):
    """One counter for each window and key. ``keep_ms``: how long after a window's end its counter stays."""

    def __init__(self, keys: list[str], keep_ms: int):
        self.keys, self.keep_ms = keys, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counter = handle.getValueState("counter", "part long, revision long, n long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        added = sum(int(frame["rows"].sum()) for frame in rows)
        end_ms = int(pd.Timestamp(key[1]).value // 1_000_000)
        now = timerValues.getCurrentWatermarkInMs()
        if self.counter.exists():
            part, revision, n = self.counter.get()
        else:
            # A counter that begins after the window's time is a part of its own, named by the watermark it began at.
            part, revision, n = (now if now > end_ms + self.keep_ms else 0), 0, 0
            self.handle.registerTimer(max(end_ms + self.keep_ms, now + 1))
        self.counter.update((part, revision + 1, n + added))
        yield pd.DataFrame({**{k: [v] for k, v in zip(self.keys, key)}, "part": [part], "revision": [revision + 1], "n": [n + added]})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.counter.clear()
        yield from ()

    def close(self) -> None:
        pass


def _counted(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = pa.Table.from_batches([batch]).group_by(columns, use_threads=False).aggregate([("rows", "sum")])
        yield from counts.select([*columns, "rows_sum"]).rename_columns([*columns, "rows"]).to_batches()


def corrected_window_counts(stream: DataFrame, width: str = "15 minutes", keys: tuple[str, ...] = ("event_type",),
                            delay: str = "1 hour", keep_minutes: int = 24 * 60) -> DataFrame:
    """Every change of a window's count: ``window_start, window_end, *keys, part, revision, n``.

    Rows are counted by window and key before they are dealt out, so a hot key costs a row for each Arrow batch. ``delay`` only moves the
    clock that removes state; no row is dropped for being late. See :func:`newest_counts` for the counts."""
    columns = ["window_start", "window_end", *keys]
    at = F.window("ts", width)
    # The time column itself is left out: rows are not filtered by the watermark then.
    rows = stream.where(F.col("ts").isNotNull()).withWatermark("ts", delay).select(
        at.start.alias("window_start"), at.end.alias("window_end"), *keys, F.lit(1).cast("long").alias("rows"))
    types = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)
    counted = rows.mapInArrow(lambda batches: _counted(batches, columns), f"{types}, rows long")
    return counted.groupBy(*columns).transformWithStateInPandas(
        CountWithCorrections(columns, keep_minutes * 60_000), f"{types}, {OUTPUT}", outputMode="Update", timeMode="EventTime")


def newest_counts(changes: DataFrame, keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """The counts that stored ``changes`` come to: the newest revision of every part, added up."""
    columns = ["window_start", "window_end", *keys]
    parts = changes.groupBy(*columns, "part").agg(F.max_by("n", "revision").alias("n"))
    return parts.groupBy(*columns).agg(F.sum("n").alias("n"))
