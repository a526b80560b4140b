"""AL1-AL3 on a stream: error-ratio and no-data alarms with one clock, in keyed state.

Two streams meet by union: the classified requests and a heartbeat, one row a tick, so that
evaluations go on when the source is silent (``foreachBatch`` and stateful operators are not
called without data).  Requests are counted per tick inside each input batch before anything
is shuffled; one state holds the counts of the ticks inside the window (``window / tick``
of them), the last tick with data and the last alarm.  It lives in the query's own
checkpoint (RocksDB state store), so queries do not share it and a restart goes on from it.

Every tick that comes is evaluated once, in order, whatever the micro-batches: the error
ratio over the window that ends with it, then the time since data last came.  Requests whose
tick has been evaluated already count to the latest tick.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from logweave.functions.timecols import duration_us
from logweave.operators.alarms import MAX_ERROR_RATIO, MIN_ROWS, NO_DATA_TIMEOUT, QUIET_PERIOD

EVENTS = "at long, kind string, state string, success long, failure long, ratio double, last_data long"
_COUNTS = "tick long, s long, f long, n long"


def heartbeat(spark: SparkSession) -> DataFrame:
    """One row a second with the time ``at``, for as long as the query runs."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.col("timestamp").alias("at"))


def _per_tick(tick: int):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                at = pdf["at"] // tick * tick
                c = pd.DataFrame({"tick": at, "s": (pdf["class"] == "Success").astype("int64"),
                                  "f": (pdf["class"] == "Failure").astype("int64"), "n": pdf["data"].astype("int64")})
                yield c.groupby("tick", as_index=False).sum()
    return run


class _Clock(StatefulProcessor):
    def __init__(self, window, tick, min_rows, max_ratio, quiet, timeout):
        self.window, self.tick, self.min_rows = window, tick, min_rows
        self.max_ratio, self.quiet, self.timeout = max_ratio, quiet, timeout

    def init(self, handle) -> None:
        self.state = handle.getValueState(
            "clock", "ticks array<long>, success array<long>, failure array<long>, now long, data long, fired long")

    def handleInputRows(self, key, rows, timerValues):
        held, now, data, fired = {}, None, None, None
        if self.state.exists():
            t, s, f, now, data, fired = self.state.get()
            held = {k: (a, b) for k, a, b in zip(t, s, f)}
            fired = None if fired < 0 else fired
        fresh: dict[int, list[int]] = {}
        for pdf in rows:
            for at, s, f, n in zip(pdf["tick"], pdf["s"], pdf["f"], pdf["n"]):
                at = int(at)
                c = fresh.setdefault(at if now is None or at > now else now, [0, 0, 0])
                c[0], c[1], c[2] = c[0] + int(s), c[1] + int(f), c[2] + int(n)
        out = []
        for at in sorted(fresh):
            s, f, n = fresh[at]
            a, b = held.get(at, (0, 0))
            held[at] = (a + s, b + f)
            if at == now:  # evaluated before: only counted
                data = at if n else data
                continue
            now = at
            data = at if n or data is None else data
            held = {k: v for k, v in held.items() if k > at - self.window}
            ok, bad = sum(v[0] for v in held.values()), sum(v[1] for v in held.values())
            free = fired is None or at - fired > self.quiet
            if ok + bad > self.min_rows:
                ratio = bad / ok if ok else float("inf")
                state = "all clear" if not ratio > self.max_ratio else "fired" if free else "suppressed"
                out.append((at, "error_ratio", state, ok, bad, ratio, data))
                if state == "fired":
                    fired, free = at, False
            if not n and at - data > self.timeout and free:
                out.append((at, "no_data", "fired", ok, bad, None, data))
                fired = at
        ticks = sorted(held)
        self.state.update((ticks, [held[k][0] for k in ticks], [held[k][1] for k in ticks], now, data, -1 if fired is None else fired))
        if out:
            yield pd.DataFrame(out, columns=["at", "kind", "state", "success", "failure", "ratio", "last_data"]).astype(
                {"ratio": "float64"})

    def close(self) -> None:
        pass


def alarm_stream(classes: DataFrame, beats: DataFrame, at: str = "at", window: str = "300 seconds", tick: str = "1 second",
                 min_rows: int = MIN_ROWS, max_ratio: float = MAX_ERROR_RATIO, quiet: str = QUIET_PERIOD,
                 timeout: str = NO_DATA_TIMEOUT) -> DataFrame:
    """Alarm events: alarm_ts, kind, state (fired, suppressed, all clear), success, failure, ratio, last_data.

    ``classes``: class and the arrival time ``at``; ``beats``: the time ``at`` of every tick.
    The first tick seen starts the no-data clock.  Rows without a time are dropped.
    """
    us = F.unix_micros(F.col(at).cast("timestamp")).alias("at")
    both = classes.select(us, "class", F.lit(1).alias("data")).unionAll(
        beats.select(us, F.lit(None).cast("string").alias("class"), F.lit(0).alias("data"))).where("at is not null")
    step = duration_us(tick)
    counts = both.mapInPandas(_per_tick(step), _COUNTS).withColumn("monitor", F.lit(0))
    clock = _Clock(duration_us(window), step, min_rows, max_ratio, duration_us(quiet), duration_us(timeout))
    out = counts.groupBy("monitor").transformWithStateInPandas(clock, EVENTS, "Append", "None")
    ts = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return out.select(ts("at").alias("alarm_ts"), "kind", "state", "success", "failure", "ratio", ts("last_data").alias("last_data"))
