"""One alarm clock: block functions against a plain loop over every tick."""

import random
from datetime import datetime, timedelta

from conftest import rows

from logweave.operators import alarms
from logweave.operators.alarm_fold import BlockFunction, alarms_one_clock, fire, fold_ranges

T0 = datetime(2024, 1, 1)
S = 1_000_000


def _ranges(rnd, end):
    """Disjoint ranges with single times anywhere, ticks of 1."""
    out, at = [], rnd.randint(0, 9)
    while at < end:
        hi = at + rnd.choice([0, 3, 40, 200])
        out.append((at, hi))
        at = hi + rnd.randint(1, 60)
    return sorted(out + [(t, t) for t in rnd.sample(range(end), end // 8)])


def test_block_functions_equal_the_loop():
    rnd = random.Random(2)
    for _ in range(60):
        quiet, items = rnd.choice([0, 5, 30]), _ranges(rnd, 400)
        k = rnd.randint(0, len(items))
        most = max([hi for _, hi in items[:k]], default=-9) + quiet + 1
        f = BlockFunction(quiet, 1, most)
        for r in items[k:]:
            f.feed(*r)
        pieces = f.pieces()
        for entry in [-(1 << 62), *range(-3, most + 1)]:
            want = entry
            for lo, hi in items[k:]:
                want = fire(want, lo, hi, quiet, 1)[2]
            got = [s for a, b, s in pieces if a <= entry < b]
            assert len(got) == 1 and (entry if got[0] is None else got[0]) == want


def test_fold_over_partitions(spark):
    rnd = random.Random(7)
    for partitions in (1, 7):
        items = _ranges(rnd, 3000)
        ticks = sorted({t for lo, hi in items for t in range(lo, hi + 1)})
        want, last = [], None
        for t in ticks:
            if last is None or t - last > 25:
                want.append(t)
                last = t
        df = spark.createDataFrame([(lo * S, hi * S) for lo, hi in items], "lo long, hi long").repartition(3)
        got = fold_ranges(df, "25 seconds", "1 second", partitions)
        assert [r.alarm // S for r in got.orderBy("alarm").collect()] == want
    assert fold_ranges(df.limit(0), "25 seconds", "1 second").count() == 0


def test_data_every_700_s_over_a_year(spark):
    """45,000 gaps, one every 700 s, each too short for the quiet period to end by itself."""
    n = 365 * 86400 // 700
    df = spark.range(n).selectExpr("timestamp_ntz'2023-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 700) as ts")
    got = [r.alarm_ts for r in alarms.no_data_alarms(df).select("alarm_ts").orderBy("alarm_ts").collect()]
    want, last = [], None
    for i in range(n - 1):
        t = i * 700 + 601
        while t < (i + 1) * 700:
            if last is None or t - last > 1800:
                want.append(t)
                last = t
            t += 1
    assert [int((t - datetime(2023, 1, 1)).total_seconds()) for t in got] == want


def brute_clock(data, window, min_rows, max_ratio, quiet, timeout, until):
    """The program's loop: one evaluation a second from 0 to ``until``; data: [(second, class)]."""
    out, last_data, last_fired = [], 0, None
    for t in range(until + 1):
        now = [c for s, c in data if s == t]
        if now:
            last_data = t
        held = [c for s, c in data if t - window < s <= t]
        ok, bad = held.count("Success"), held.count("Failure")
        free = last_fired is None or t - last_fired > quiet
        if ok + bad > min_rows and (bad / ok if ok else float("inf")) > max_ratio and free:
            out.append((t, "error_ratio"))
            last_fired, free = t, False
        if not now and t - last_data > timeout and free:
            out.append((t, "no_data"))
            last_fired = t
    return out


def clock_data(seed):
    rnd = random.Random(seed)
    data, at = [], 4
    while at < 2500:
        for _ in range(rnd.randint(1, 30)):
            data.append((at, rnd.choice(["Success", "Failure", "Failure", "Other"])))
            at += rnd.randint(0, 3)
        at += rnd.choice([5, 90, 400])
    return data


def test_both_kinds_on_one_clock(spark):
    for seed in (1, 2):
        data = clock_data(seed)
        want = brute_clock(data, 30, 8, 1.0, 60, 50, 2600)
        assert {k for _, k in want} == {"error_ratio", "no_data"}
        df = spark.createDataFrame([(T0 + timedelta(seconds=s), c) for s, c in data], "ts timestamp_ntz, class string")
        got = alarms_one_clock(df, "ts", "30 seconds", "1 second", 8, 1.0, "60 seconds", "50 seconds", T0, T0 + timedelta(seconds=2600))
        assert [(int((t - T0).total_seconds()), k) for t, k in rows(got, "alarm_ts", "kind")] == want
