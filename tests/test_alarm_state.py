"""Alarms in keyed state: the program's loop tick by tick, restarts, two queries at once, and a silent source."""

import tempfile
import time
from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F
from test_alarm_fold import brute_clock, clock_data

from logweave import apps
from logweave.session import rocksdb_state
from logweave.streaming import alarm_state

T0 = datetime(2024, 1, 1)
END = 1200


def _dir():
    return tempfile.mkdtemp(prefix="logweave-test-")


def _land(spark, d, data, a, b):
    """Requests and heartbeats of the seconds [a, b) as one file each, for one micro-batch."""
    at = lambda s: T0 + timedelta(seconds=s)
    spark.createDataFrame([(at(s), c) for s, c in data if a <= s < b], "at timestamp_ntz, class string").coalesce(1).write.mode(
        "append").parquet(d + "/classes")
    spark.createDataFrame([(at(s),) for s in range(a, b)], "at timestamp_ntz").coalesce(1).write.mode("append").parquet(d + "/beats")
    time.sleep(0.05)


def _start(spark, d, **kw):
    read = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/{name}")
    events = alarm_state.alarm_stream(read("classes", "at timestamp_ntz, class string"), read("beats", "at timestamp_ntz"),
                                      window="30 seconds", **kw)
    with rocksdb_state(spark):
        return (events.writeStream.outputMode("append").format("parquet").option("path", d + "/out")
                .option("checkpointLocation", d + "/ck").trigger(availableNow=True).start())


def test_two_queries_with_restarts_follow_the_loop(spark):
    """Both queries stop after two of three batches and go on from their own checkpoints."""
    jobs = [(clock_data(1), dict(min_rows=8, max_ratio=1.0, quiet="60 seconds", timeout="50 seconds")),
            (clock_data(5), dict(min_rows=3, max_ratio=0.5, quiet="200 seconds", timeout="20 seconds"))]
    dirs = [_dir(), _dir()]
    for parts in (((0, 333), (333, 700)), ((700, END + 1),)):
        for d, (data, _) in zip(dirs, jobs):
            for a, b in parts:
                _land(spark, d, data, a, b)
        for q in [_start(spark, d, **kw) for d, (_, kw) in zip(dirs, jobs)]:
            q.awaitTermination()
    for d, (data, kw) in zip(dirs, jobs):
        out = spark.read.parquet(d + "/out")
        sec = {k: int(v.split()[0]) for k, v in kw.items() if isinstance(v, str)}
        want = brute_clock([(s, c) for s, c in data if s <= END], 30, kw["min_rows"], kw["max_ratio"], sec["quiet"], sec["timeout"], END)
        got = [(int((t - T0).total_seconds()), k) for t, k in rows(out.where("state = 'fired'"), "alarm_ts", "kind")]
        assert got == want and {k for _, k in want} == {"error_ratio", "no_data"}
        assert out.where("state = 'suppressed'").count() and out.where("state = 'all clear'").count()


def test_silent_source_raises_the_alarm(spark, capsys):
    """No request ever comes; the heartbeat alone drives the program, which prints the alarm."""
    d = _dir()
    spark.range(0).select(F.lit("x").alias("value")).write.text(d + "/in")
    lines = spark.readStream.text(d + "/in")
    seen = []
    q, health = apps.log_alarmer(spark, lines, d + "/ck", timeout="3 seconds",
                                 sink=lambda df, i: seen.extend(df.collect()))
    try:
        for _ in range(240):
            if any(r.kind == "no_data" for r in seen) or not q.isActive:
                break
            time.sleep(0.25)
    finally:
        q.stop()
        spark.streams.removeListener(health)
    alarm = next(r for r in seen if r.kind == "no_data")
    assert alarm.state == "fired" and (alarm.alarm_ts - alarm.last_data).total_seconds() > 3
    assert sum(r.kind == "no_data" for r in seen) == 1
