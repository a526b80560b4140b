"""Two-stage sliding windows equal Spark's window() on raw rows, for both timestamp types."""

import random
from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from logweave.operators import windows


def _direct(df, ts, length, slide):
    w = F.window(ts, length, slide)
    return (df.groupBy(w.alias("w"), "k").agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "k", "count"))


def test_two_stage_equals_window(spark):
    rnd = random.Random(11)
    t0 = datetime(2024, 3, 1, 12, 0, 0)
    data = [(t0 + timedelta(seconds=rnd.randint(0, 4000), microseconds=rnd.randint(0, 999999)), rnd.choice("abc"))
            for _ in range(300)]
    for typ in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame(data, f"ts {typ}, k string")
        for length, slide in [("300 seconds", "60 seconds"), ("120 seconds", "1 second"), ("10 seconds", "10 seconds")]:
            got = rows(windows.windowed_counts(df, "k", "ts", length, slide))
            assert got == rows(_direct(df, "ts", length, slide)), (typ, length, slide)
            sums = windows.windowed_sums(df, {"a": F.col("k") == "a"}, "ts", length, slide)
            exp = _direct(df, "ts", length, slide).groupBy("window_start", "window_end").agg(
                F.sum(F.when(F.col("k") == "a", F.col("count")).otherwise(0)).alias("a"))
            assert rows(sums) == rows(exp), (typ, length, slide)
