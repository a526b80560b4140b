"""Error-ratio and no-data alarms (AL1-AL3).

Batch form of the alarm job: every sliding window end is one evaluation
(the reference evaluates once per micro-batch).  The "at most one alarm per
``quiet`` period, measured from the last *fired* alarm" rule is the ordered fold
``ordered.suppress_repeats`` (pointer doubling, no single-task scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from logweave.session import cut
from logweave.functions.timecols import duration_us, epoch_us, from_epoch_us
from logweave.operators.ordered import suppress_repeats

# --- Fixed values: reference defaults ---------------------------------------------------------
MIN_ROWS = 100                 # alarm only when success + failure > 100
MAX_ERROR_RATIO = 0.5          # failure / success above this raises the alarm
QUIET_PERIOD = "30 minutes"    # at most one alarm per 30 minutes
NO_DATA_TIMEOUT = "600 seconds"
# --- end of fixed values ----------------------------------------------------------------------


def error_ratio(success, failure):
    """failure / success; infinity when there are no successes (the reference's double division)."""
    s, f = F.col(success), F.col(failure)
    return F.when(s == 0, F.lit(float("inf"))).otherwise(f.cast("double") / s.cast("double"))


def error_ratio_alarms(totals: DataFrame, min_rows: int = MIN_ROWS, max_ratio: float = MAX_ERROR_RATIO,
                       quiet: str = QUIET_PERIOD, time_col: str = "window_end") -> DataFrame:
    """AL1 + AL2 over per-window ``success``/``failure`` totals.

    Only windows with more than ``min_rows`` counted rows are evaluated.  ``state``
    is 'fired', 'suppressed' or 'all clear'.
    """
    # one row per evaluated window; the fold reads it several times
    ev = cut(totals.where((F.col("success") + F.col("failure")) > min_rows)
             .withColumn("ratio", error_ratio("success", "failure"))
             .withColumn("_t", epoch_us(time_col)))
    cands = ev.where(F.col("ratio") > max_ratio).select("_t")
    folded = suppress_repeats(cands, "_t", duration_us(quiet))
    out = ev.join(folded, on="_t", how="left")
    state = (F.when(F.col("ratio") <= max_ratio, F.lit("all clear"))
             .when(F.col("fired"), F.lit("fired")).otherwise(F.lit("suppressed")))
    return out.withColumn("state", state).drop("_t", "fired")


def no_data_alarms(data_times: DataFrame, ts: str = "ts", timeout: str = NO_DATA_TIMEOUT,
                   quiet: str = QUIET_PERIOD, tick: str = "1 second") -> DataFrame:
    """AL3: alarms for stretches with no data longer than ``timeout``.

    Data arrives in ``tick``-long batches.  After the last batch with data at ``s``,
    every empty batch later than ``s + timeout`` (and before the next data) is an
    alarm candidate; candidates pass the 30-minute suppression rule against the last
    *fired* no-data alarm.  Returns the fired alarms: ``last_data, next_data, alarm_ts``.

    The gaps are ranges of candidate ticks for ``alarm_fold.fold_ranges``: no gap, run of gaps
    or stretch of time is handled row by row in one task.
    """
    from logweave.operators.alarm_fold import data_gaps, fold_ranges

    gaps = cut(data_gaps(data_times, ts, timeout, tick).where("next_us is not null"))
    fired = fold_ranges(gaps, quiet, tick).withColumnRenamed("lo", "_lo")
    fired = fired.join(gaps, F.col("_lo") == F.col("lo"))
    return fired.select(from_epoch_us("last_us").alias("last_data"), from_epoch_us("next_us").alias("next_data"),
                        from_epoch_us("alarm").alias("alarm_ts"))
