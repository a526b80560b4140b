"""Windowed keyed counts and per-window top-k.

Sliding windows are computed in two stages so the expansion factor
(``length / slide`` windows per row) applies to pre-aggregated buckets, not rows:

1. ``groupBy(key, bucket)`` where ``bucket = window(ts, slide)`` (partial + final
   hash aggregate, so a hot key is combined map-side before the shuffle);
2. each bucket is placed in the ``length / slide`` windows that contain it
   (``explode(sequence(...))`` over epoch microseconds, the same epoch-aligned windows
   as ``window(ts, length, slide)``, whose ``Expand`` of hundreds of projections would
   not compile for 300 s / 1 s windows) and the bucket counts are summed.

The reference's DStream windows use arrival time; here the caller chooses the
time column (event time, or an ingest-time column for arrival-time semantics).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from logweave.functions.timecols import epoch_us, from_epoch_us


def _dur_seconds(d: str) -> int:
    n, unit = d.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
            "day": 86400, "days": 86400}[unit]
    return int(n) * mult


def windowed_counts(df: DataFrame, key: str | Column, ts: str = "ts", length: str = "300 seconds",
                    slide: str | None = None, count_col: str = "count") -> DataFrame:
    """Keyed counts per (sliding or tumbling) window.

    Returns ``window_start, window_end, <key>, <count_col>``; only non-zero counts.
    Rows with a NULL time belong to no window and are dropped.
    """
    slide = slide or length
    L, S = _dur_seconds(length), _dur_seconds(slide)
    if L % S:
        raise ValueError("window length must be a multiple of the slide")
    keycol = F.col(key) if isinstance(key, str) else key
    keyname = key if isinstance(key, str) else keycol._jc.toString()
    base = df.where(F.col(ts).isNotNull())
    if L == S:
        w = F.window(ts, length)
        out = base.groupBy(w.alias("w"), keycol.alias(keyname)).agg(F.count(F.lit(1)).alias(count_col))
    else:
        buckets = (base.groupBy(F.window(ts, slide).alias("b"), keycol.alias(keyname))
                   .agg(F.count(F.lit(1)).alias("_n")))
        expanded = _windows_of_buckets(buckets, df.schema[ts].dataType, L, S, [keyname, "_n"])
        out = expanded.groupBy("w", keyname).agg(F.sum("_n").alias(count_col))
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      keyname, count_col)


def _windows_of_buckets(buckets: DataFrame, ts_type, L: int, S: int, cols) -> DataFrame:
    """Each slide bucket ``b`` (struct start/end) -> one row per window containing it, as
    ``w`` struct(start, end) of the input's timestamp type."""
    ntz = isinstance(ts_type, TimestampNTZType)
    to_us = epoch_us if ntz else F.unix_micros
    from_us = from_epoch_us if ntz else F.timestamp_micros
    L_us, S_us = L * 1_000_000, S * 1_000_000
    b = to_us(F.col("b.start"))
    starts = F.explode(F.sequence(b - F.lit(L_us - S_us), b, F.lit(S_us))).alias("_ws")
    return buckets.select(starts, *cols).select(
        F.struct(from_us(F.col("_ws")).alias("start"), from_us(F.col("_ws") + F.lit(L_us)).alias("end")).alias("w"),
        *cols)


def top_k_per_window(counts: DataFrame, key: str, k: int = 5, count_col: str = "count",
                     window_col: str = "window_start") -> DataFrame:
    """The ``k`` highest counts in each window, ties broken by key ascending.

    ``row_number() <= k`` lets Spark insert a partial WindowGroupLimit before the
    shuffle, so each map task ships at most ``k`` rows per window.
    """
    w = Window.partitionBy(window_col).orderBy(F.col(count_col).desc(), F.col(key).asc())
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def windowed_sums(df: DataFrame, sums: dict, ts: str = "ts", length: str = "300 seconds",
                  slide: str | None = None) -> DataFrame:
    """Per window, ``{name: long column}`` summed over the rows in the window (two-stage,
    as ``windowed_counts``).  Returns ``window_start, window_end, <names>``."""
    slide = slide or length
    base = df.where(F.col(ts).isNotNull())
    buckets = base.groupBy(F.window(ts, slide).alias("b")).agg(
        *[F.sum(c.cast("long")).alias(n) for n, c in sums.items()])
    if length != slide:
        buckets = _windows_of_buckets(buckets, df.schema[ts].dataType, _dur_seconds(length), _dur_seconds(slide),
                                      list(sums))
    else:
        buckets = buckets.withColumnRenamed("b", "w")
    out = buckets.groupBy("w").agg(*[F.sum(n).alias(n) for n in sums])
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *[F.col(n).cast("long").alias(n) for n in sums])


def status_class_totals(classes: DataFrame, ts: str, length: str, slide: str | None = None) -> DataFrame:
    """W4 + A7 in one pass: successes and failures per sliding window."""
    return windowed_sums(classes, {"success": F.col("class") == "Success", "failure": F.col("class") == "Failure"},
                         ts, length, slide)


def class_totals(class_counts: DataFrame, count_col: str = "count") -> DataFrame:
    """Per window, successes and failures out of the class counts (one row per window)."""
    return (class_counts.groupBy("window_start", "window_end")
            .agg(F.coalesce(F.sum(F.when(F.col("class") == "Success", F.col(count_col))), F.lit(0))
                 .cast("long").alias("success"),
                 F.coalesce(F.sum(F.when(F.col("class") == "Failure", F.col(count_col))), F.lit(0))
                 .cast("long").alias("failure")))
