"""AL1-AL3 edge cases (FIXTURES.md section 2: alarms)."""

from datetime import datetime, timedelta

from conftest import rows

from logweave.operators import alarms

T0 = datetime(2024, 1, 1)


def _totals(spark, spec):
    data = [(T0 + timedelta(minutes=m), T0 + timedelta(minutes=m + 5), s, f) for m, s, f in spec]
    return spark.createDataFrame(data, "window_start timestamp_ntz, window_end timestamp_ntz, success long, failure long")


def test_ratio_rules(spark):
    spec = [(0, 50, 50),      # 100 rows: not evaluated
            (100, 50, 51),    # 101 rows, ratio 1.02 -> fired
            (200, 101, 0),    # all clear
            (300, 80, 40),    # ratio exactly 0.5 -> all clear
            (400, 0, 101)]    # zero successes: infinity -> fired
    got = rows(alarms.error_ratio_alarms(_totals(spark, spec)), "window_start", "ratio", "state")
    assert [(s, r) for _, r, s in got] == [("fired", 51 / 50), ("all clear", 0.0), ("all clear", 0.5),
                                           ("fired", float("inf"))]


def test_quiet_period_from_last_fired(spark):
    # minutes: 0 fired; 29 and 30 suppressed; 31 fired; 45 suppressed; 60 suppressed (29 after 31);
    # 62 fired (31 after the fired one at 31, though only 17 after the suppressed one at 45)
    spec = [(m, 10, 200) for m in (0, 29, 30, 31, 45, 60, 62)]
    got = rows(alarms.error_ratio_alarms(_totals(spark, spec)), "window_start", "state")
    assert [s for _, s in got] == ["fired", "suppressed", "suppressed", "fired", "suppressed", "suppressed", "fired"]


def test_no_data_gaps(spark):
    secs = [0, 600, 1201, 5000]   # gaps of 600 s (no alarm), 601 s (no empty batch past 600 s), 3799 s
    df = spark.createDataFrame([(T0 + timedelta(seconds=s),) for s in secs], "ts timestamp_ntz")
    got = rows(alarms.no_data_alarms(df), "alarm_ts")
    # last data 1201: alarms at +601 and +601+1801 (before the next data at 5000)
    assert got == [(T0 + timedelta(seconds=1802),), (T0 + timedelta(seconds=3603),)]


def test_no_data_quiet_period_spans_gaps(spark):
    # gap 1: data at 0 and 2500 -> alarms at 601 and 2402; gap 2 starts (data at 2600) at 3201,
    # but 2402 + 1801 = 4203 is the first allowed time, inside gap 2 (next data 6000).
    secs = [0, 2500, 2600, 6000]
    df = spark.createDataFrame([(T0 + timedelta(seconds=s),) for s in secs], "ts timestamp_ntz")
    exp = [(T0 + timedelta(seconds=t),) for t in (601, 2402, 4203)]
    assert rows(alarms.no_data_alarms(df), "alarm_ts") == exp


def test_no_data_year_long_gap_and_runs(spark):
    # Data every 700 s for a while (runs of gaps), then a gap of a year.
    secs = [700 * i for i in range(60)] + [42_000 + 365 * 86_400]
    df = spark.createDataFrame([(T0 + timedelta(seconds=s),) for s in secs], "ts timestamp_ntz")
    exp, allowed = [], None
    for s, nxt in zip(secs, secs[1:]):
        t = s + 601 if allowed is None else max(s + 601, allowed)
        while t < nxt:
            exp.append((T0 + timedelta(seconds=t),))
            allowed = t = t + 1801
    assert rows(alarms.no_data_alarms(df), "alarm_ts") == sorted(exp)
