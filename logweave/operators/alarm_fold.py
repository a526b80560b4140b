"""One alarm clock over error-ratio and no-data candidates (AL2 + AL3), without a single-task scan.

Candidates are tick times, given as ranges ``[lo, hi]`` of ticks (a single time is a range of
one).  A candidate fires when it is more than ``quiet`` after the last fired one, whatever its
kind.  The only state of that rule is the earliest time the next alarm may fire, so a block
of candidates is a function from the state it is entered with to the state it leaves.  Each
range partition of the time line works out its function in one pass (as many pieces as there
are candidates within ``quiet`` of the ranges before it, ranges by arithmetic), the functions are composed in order on the
driver, which holds one number a partition, and a second pass emits what fires.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.functions.timecols import duration_us, epoch_us, from_epoch_us
from logweave.operators.alarms import MAX_ERROR_RATIO, MIN_ROWS, NO_DATA_TIMEOUT, QUIET_PERIOD, error_ratio
from logweave.operators.ordered import next_after
from logweave.operators.windows import status_class_totals
from logweave.session import cut

_START = -(1 << 62)


def fire(allowed: int, lo: int, hi: int, quiet: int, tick: int) -> tuple[int, int, int]:
    """(first fired, last fired, next allowed) in a range of ticks; first > last when nothing fires."""
    first = lo + max(0, -(-(allowed - lo) // tick)) * tick
    if first > hi:
        return first, first - 1, allowed
    step = (quiet // tick + 1) * tick  # the least number of ticks that is more than quiet
    last = first + (hi - first) // step * step
    return first, last, last + quiet + 1


class BlockFunction:
    """Entry state -> exit state of a block of ranges, fed in order of ``lo``.

    Entries not yet told apart are ``free``: they still map to themselves and are at least
    ``self.free``.  No entry is above ``most``, so that many at most are ever told apart.  The others are grouped by the state they have reached (a heap); groups
    that reach the same state become one.
    """

    def __init__(self, quiet: int, tick: int, most: int):
        self.quiet, self.tick, self.most = quiet, tick, most
        self.free = _START
        self.heap: list[int] = []
        self.entries: dict[int, list[tuple[int, int]]] = {}

    def _put(self, state: int, entries) -> None:
        if state not in self.entries:
            self.entries[state] = []
            heapq.heappush(self.heap, state)
        self.entries[state] += entries

    def feed(self, lo: int, hi: int) -> None:
        moved = []
        while self.heap and self.heap[0] <= hi:
            state = heapq.heappop(self.heap)
            moved.append((state, self.entries.pop(state)))
        at = lo
        while self.free <= self.most and at <= hi:
            if self.free <= at:
                moved.append((at, [(self.free, at + 1)]))
                self.free = at + 1
            at += self.tick
        for state, entries in moved:
            self._put(fire(state, lo, hi, self.quiet, self.tick)[2], entries)

    def pieces(self):
        """(entry from, entry before, exit); the exit is None where the entry itself is kept."""
        rows = [(a, b, s) for s, e in self.entries.items() for a, b in e]
        return sorted([*rows, (self.free, 1 << 62, None)], key=lambda r: r[0])


def fold_ranges(ranges: DataFrame, quiet: str, tick: str, partitions: int | None = None) -> DataFrame:
    """(lo, alarm): the fired times with the range each lies in; ``ranges`` has lo and hi (epoch microseconds).

    A range may hold single times of others; ranges longer than one tick must not overlap each other.
    """
    import pandas as pd

    spark = ranges.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    q, t = duration_us(quiet), duration_us(tick)
    # Written once: both passes must see the same blocks in the same order.
    s = cut(ranges.select("lo", "hi").repartitionByRange(p, "lo").sortWithinPartitions("lo", F.desc("hi"))
            .withColumn("pid", F.spark_partition_id()))

    # What a block can be entered with: the end of the ranges before it and the quiet period.
    most, end = {}, _START
    for r in s.groupBy("pid").agg(F.max("hi").alias("hi")).orderBy("pid").collect():  # one row a partition
        most[r.pid], end = end + q + 1, max(end, r.hi)

    def functions(batches):
        f, pid = None, None
        for pdf in batches:
            if f is None and len(pdf):
                f = BlockFunction(q, t, most[int(pdf["pid"].iloc[0])])
            for lo, hi in zip(pdf["lo"].tolist(), pdf["hi"].tolist()):
                f.feed(lo, hi)
            pid = int(pdf["pid"].iloc[0]) if len(pdf) else pid
        if pid is not None:
            rows = f.pieces()
            yield pd.DataFrame({"pid": pid, "a": [r[0] for r in rows], "exit": pd.array([r[2] for r in rows], dtype="Int64")})

    entry, state, here, starts, exits = {}, _START, None, [], []

    def leave():
        e = exits[bisect_right(starts, state) - 1]
        return state if e is None else e

    for r in s.mapInPandas(functions, "pid int, a long, exit long").orderBy("pid", "a").toLocalIterator():
        if r.pid != here:
            state = leave() if starts else state
            here, starts, exits = r.pid, [], []
            entry[r.pid] = state
        starts.append(r.a)
        exits.append(r.exit)

    def fired(batches):
        allowed = None
        for pdf in batches:
            out = []
            for lo, hi, pid in zip(pdf["lo"].tolist(), pdf["hi"].tolist(), pdf["pid"].tolist()):
                first, last, allowed = fire(entry[pid] if allowed is None else allowed, lo, hi, q, t)
                if first <= last:
                    out.append((lo, first, last))
            yield pd.DataFrame(out, columns=["lo", "first", "last"], dtype="int64")

    step = (q // t + 1) * t
    runs = s.mapInPandas(fired, "lo long, first long, last long")
    return runs.select("lo", F.explode(F.sequence("first", "last", F.lit(step))).alias("alarm"))


def data_gaps(data_times: DataFrame, ts: str, timeout: str, tick: str, start=None, until=None) -> DataFrame:
    """(last_us, next_us, lo, hi): ticks without data for more than ``timeout``, as ranges.

    ``start`` and ``until`` (timestamps) are the first and the last evaluated tick: silence
    before the first and after the last data counts too.
    """
    t, lim = duration_us(tick), duration_us(timeout)
    floor = lambda c: (F.floor(c / F.lit(t)) * F.lit(t)).cast("long")
    s = data_times.where(F.col(ts).isNotNull()).select(floor(epoch_us(ts)).alias("last_us")).distinct()
    if start is not None:  # counts as data, as the program's start does
        s = s.unionAll(s.sparkSession.range(1).select(floor(epoch_us(F.lit(start))))).distinct()
    g = next_after(s, "last_us", 0, max(lim, t)).withColumnRenamed("next", "next_us")
    end = F.col("next_us") - F.lit(t)
    if until is not None:
        end = F.coalesce(end, floor(epoch_us(F.lit(until))))
    g = g.withColumns({"lo": F.floor((F.col("last_us") + lim) / t).cast("long") * t + t, "hi": end})
    return g.where("lo <= hi")


def alarms_one_clock(classes: DataFrame, ts: str, window: str, tick: str, min_rows: int = MIN_ROWS,
                     max_ratio: float = MAX_ERROR_RATIO, quiet: str = QUIET_PERIOD, timeout: str = NO_DATA_TIMEOUT,
                     start=None, until=None) -> DataFrame:
    """AL1 + AL2 + AL3 with one clock: the fired alarms of both kinds.

    Every tick is an evaluation: over the window that ends with the tick, and on the time
    since data last came.  Returns ``alarm_ts`` (start of the tick), ``kind``, ``ratio``
    (error_ratio) and ``last_data`` (no_data).  An error alarm goes before one for no data.
    """
    t = duration_us(tick)
    classes = cut(classes.select(F.col(ts).alias("ts"), "class"))
    totals = status_class_totals(classes, "ts", window, tick)
    errors = totals.where((F.col("success") + F.col("failure") > min_rows) & (error_ratio("success", "failure") > max_ratio))
    errors = cut(errors.select((epoch_us("window_end") - t).alias("at"), error_ratio("success", "failure").alias("ratio")))
    if until is not None:
        errors = errors.where(F.col("at") <= epoch_us(F.lit(until)))
    gaps = cut(data_gaps(classes, "ts", timeout, tick, start, until))
    fired = fold_ranges(errors.select(F.col("at").alias("lo"), F.col("at").alias("hi")).unionAll(gaps.select("lo", "hi")), quiet, tick)
    return _labelled(fired, errors, gaps)


def _labelled(fired: DataFrame, errors: DataFrame, gaps: DataFrame) -> DataFrame:
    """A fired time is an error alarm if it is an error candidate, else it belongs to the gap it fired in."""
    out = fired.join(errors, F.col("alarm") == F.col("at"), "left")
    out = out.join(gaps.select(F.col("lo").alias("g"), "last_us"), F.col("lo") == F.col("g"), "left")
    error = F.col("at").isNotNull()
    return out.select(from_epoch_us("alarm").alias("alarm_ts"), F.when(error, "error_ratio").otherwise("no_data").alias("kind"),
                      "ratio", F.when(~error, from_epoch_us("last_us")).alias("last_data"))
