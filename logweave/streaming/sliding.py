"""Sliding keyed counts on a stream by difference counts (W2 at any slide).

A count of a bucket enters a window count when the window reaches it and leaves when the
window has passed it: ``+n`` at window start ``bucket - length + slide`` and ``-n`` at
``bucket + slide``.  Two differences a bucket and a running sum per key give the counts of
all windows as *runs*: stretches of window starts that share a count.  So a 300 s window
that slides by 1 s costs two rows a bucket, not 300.

1. a streaming aggregate counts rows per (slide bucket, key), combined map-side;
2. ``transformWithState`` keeps, per key, the buckets that open windows still need and
   emits the runs of all windows the watermark has passed.  Every key that has open
   buckets emits up to the same window in the same batch (an event-time timer fires as
   soon as the watermark moves), so a batch holds whole windows and can be ranked by itself.

State per key: at most ``length / slide`` buckets.  Rows later than the watermark are
dropped, as everywhere.  Needs the RocksDB state store (``session.rocksdb_state``).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from logweave.functions.timecols import duration_us
from logweave.streaming.jobs import with_event_time


def step_runs(buckets: list[tuple[int, int]], lo: int, hi: int, length: int, slide: int) -> list[tuple[int, int, int]]:
    """(first window start, last window start, count) for the windows in [lo, hi) that hold any of ``buckets``."""
    diff: dict[int, int] = {}
    for b, n in buckets:
        for at, d in ((b - length + slide, n), (b + slide, -n)):
            at = min(max(at, lo), hi)
            diff[at] = diff.get(at, 0) + d
    out, total, points = [], 0, sorted(diff)
    for at, nxt in zip(points, points[1:]):
        total += diff[at]
        if total and nxt > at:
            out.append((at, nxt - slide, total))
    return out


class _Runs(StatefulProcessor):
    def __init__(self, length: int, slide: int):
        self.length, self.slide = length, slide

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", "starts array<long>, counts array<long>, done long")

    def _emit(self, key, fresh, timers):
        mark = timers.getCurrentWatermarkInMs() * 1000
        old, done = [], None
        if self.state.exists():
            starts, counts, done = self.state.get()
            old = list(zip(starts, counts))
        buckets = sorted(old + fresh)
        # Windows that start before ``upto`` end at or before the watermark.
        upto = mark // self.slide * self.slide - self.length + self.slide
        done = buckets[0][0] - self.length + self.slide if done is None and buckets else done
        runs = []
        if buckets and upto > done:
            runs = step_runs(buckets, done, upto, self.length, self.slide)
            done = upto
        open_ = [(b, n) for b, n in buckets if b >= done]
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t)
        if open_:
            self.state.update(([b for b, _ in open_], [n for _, n in open_], done))
            self.handle.registerTimer(timers.getCurrentWatermarkInMs() + 1)
        else:
            self.state.clear()
        if runs:
            yield pd.DataFrame([(key[0], *r) for r in runs], columns=["key", "first_us", "last_us", "count"])

    def handleInputRows(self, key, rows, timerValues):
        fresh = [(int(b), int(n)) for pdf in rows for b, n in zip(pdf["b"], pdf["n"])]
        yield from self._emit(key, fresh, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._emit(key, [], timerValues)

    def close(self) -> None:
        pass


def sliding_runs_stream(df: DataFrame, key: str, ts: str, length: str, slide: str, watermark: str) -> DataFrame:
    """Runs of windows with one count per key: key, first_start, last_start (timestamps of window starts), count.

    Append mode; a run comes once all its windows have closed.  NULL times are dropped.
    """
    size, step = duration_us(length), duration_us(slide)
    if size % step:
        raise ValueError("window length must be a multiple of the slide")
    e = with_event_time(df.where(F.col(ts).isNotNull()), ts, watermark)
    b = e.groupBy(F.window("event_time", slide).alias("b"), F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    b = b.select(F.window_time("b").alias("t"), F.unix_micros(F.col("b.start")).alias("b"), "key", "n")
    kind = df.schema[key].dataType.simpleString()
    runs = b.groupBy("key").transformWithStateInPandas(
        _Runs(size, step), f"key {kind}, first_us long, last_us long, count long", "Append", "EventTime")
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return runs.select(F.col("key").alias(key), at("first_us").alias("first_start"), at("last_us").alias("last_start"), "count")


def windows_of_runs(runs: DataFrame, length: str, slide: str) -> DataFrame:
    """One row per window, as ``windowed_counts`` gives: for readers that want every window spelled out."""
    step, size = F.expr(f"interval {slide}"), F.expr(f"interval {length}")
    rest = [c for c in runs.columns if c not in ("first_start", "last_start")]
    w = runs.select(F.explode(F.sequence("first_start", "last_start", step)).alias("window_start"), *rest)
    return w.select("window_start", (F.col("window_start") + size).alias("window_end"), *rest)


def top_k_runs(runs: DataFrame, key: str, k: int, length: str, slide: str) -> DataFrame:
    """The ``k`` highest counts (ties by key) of every window, as stretches of windows between changes.

    A stretch ends where any key's count changes.  Runs meet the stretches by pieces of
    ``length`` (a run is shorter than that, so it lies in two at most) and are ranked per stretch.
    """
    size, step = duration_us(length), duration_us(slide)
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    r = runs.select(key, "count", us("first_start").alias("_a"), (us("last_start") + step).alias("_z"))
    cell = lambda c: F.floor(F.col(c) / size)
    r = r.withColumn("_cell", F.explode(F.sequence(cell("_a"), F.floor((F.col("_z") - 1) / size))))
    # Edges of a cell: its runs' edges inside it and its own start; each edge opens a stretch up to the next one.
    lo, hi = F.col("_cell") * size, (F.col("_cell") + 1) * size
    r = r.withColumns({"_a": F.greatest("_a", lo), "_z": F.least("_z", hi)})
    edges = r.select("_cell", F.explode(F.array("_a", "_z")).alias("_p")).distinct()
    edges = edges.withColumn("_q", F.lead("_p").over(Window.partitionBy("_cell").orderBy("_p"))).where("_q is not null")
    s = r.join(edges, "_cell").where("_p >= _a and _p < _z")
    rank = F.row_number().over(Window.partitionBy("_cell", "_p").orderBy(F.desc("count"), F.asc(key)))
    s = s.withColumn("rank", rank).where(F.col("rank") <= k)
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return s.select(at(F.col("_p")).alias("first_start"), at(F.col("_q") - step).alias("last_start"), key, "count",
                    F.col("rank").cast("int").alias("rank"))
