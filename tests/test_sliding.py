"""Difference counts: streams at a slide of 1 s equal the batch windows."""

import random
import tempfile
import time
from datetime import datetime, timedelta

from conftest import rows

from logweave.operators import windows
from logweave.session import rocksdb_state
from logweave.streaming import sliding

T0 = datetime(2024, 1, 1)


def _dir():
    return tempfile.mkdtemp(prefix="logweave-test-")


def test_step_runs_against_every_window():
    rnd = random.Random(1)
    for _ in range(200):
        length, slide = rnd.choice([(10, 1), (6, 2), (4, 4)])
        buckets = [(b, rnd.randint(1, 3)) for b in sorted(rnd.sample(range(0, 60, slide), rnd.randint(1, 8)))]
        lo, hi = sorted(rnd.sample(range(-20, 80, slide), 2))
        want = {w: c for w in range(lo, hi, slide) if (c := sum(n for b, n in buckets if w <= b < w + length))}
        got = {}
        for a, z, n in sliding.step_runs(buckets, lo, hi, length, slide):
            for w in range(a, z + 1, slide):
                assert w not in got
                got[w] = n
        assert got == want


def _replay(spark, d, batches, name, watermark="5 seconds"):
    """The batches as one file each, one a trigger; a last row far later closes all windows."""
    n = 0
    for b in batches + [[("end", 10**6)]]:
        data = [(k, None if s is None else T0 + timedelta(seconds=s)) for k, s in b]
        spark.createDataFrame(data, "k string, ts timestamp_ntz").coalesce(1).write.mode("append").parquet(d + "/in")
        time.sleep(0.05)
        n += 1
    src = spark.readStream.schema("k string, ts timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(d + "/in")
    with rocksdb_state(spark):
        runs = sliding.sliding_runs_stream(src, "k", "ts", "300 seconds", "1 second", watermark)
        q = (runs.writeStream.outputMode("append").format("parquet").option("path", d + "/out")
             .option("checkpointLocation", d + "/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(d + "/out"), q


def test_stream_at_one_second_equals_batch_windows(spark):
    d = _dir()
    rnd = random.Random(5)
    base, batches = 0, []
    for _ in range(3):
        base += 400
        batches.append([(rnd.choice("aaab") + rnd.choice(["", "x"]), base + rnd.random() * 300) for _ in range(60)]
                       + [(None, base + 7), ("a", None)])
    runs, q = _replay(spark, d, batches, "w2")
    plan = q._jsq.explainInternal(False)
    assert "Expand" not in plan
    flat = spark.createDataFrame([(k, None if s is None else T0 + timedelta(seconds=s)) for b in batches for k, s in b],
                                 "k string, ts timestamp_ntz")
    want = windows.windowed_counts(flat, "k", "ts", "300 seconds", "1 second")
    got = sliding.windows_of_runs(runs, "300 seconds", "1 second")
    cols = ["window_start", "window_end", "k", "count"]
    assert rows(got, *cols) == rows(want, *cols)
    assert runs.count() < 8 * flat.count()
    top = sliding.windows_of_runs(sliding.top_k_runs(runs, "k", 2, "300 seconds", "1 second"), "300 seconds", "1 second")
    best = windows.top_k_per_window(want, "k", 2)
    assert rows(top, *cols, "rank") == rows(best, *cols, "rank")
