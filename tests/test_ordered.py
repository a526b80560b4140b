"""Distributed order helpers against brute force."""

import random

from conftest import rows

from logweave.operators.ordered import global_index, next_after, running_totals, suppress_repeats


def test_next_after(spark):
    rnd = random.Random(3)
    ts = sorted({rnd.randint(0, 10_000) for _ in range(300)})
    df = spark.createDataFrame([(t,) for t in ts], "t long")
    for off in (0, 50, 700):
        got = dict(rows(next_after(df, "t", off, 100)))
        exp = {t: next((u for u in ts if u > t + off), None) for t in ts}
        assert got == exp


def _fold(ts, quiet):
    fired, last = set(), None
    for t in sorted(ts):
        if last is None or t > last + quiet:
            fired.add(t)
            last = t
    return fired


def test_suppress_repeats(spark):
    ts = [0, 29, 30, 31, 45, 61, 62, 200, 229, 230, 231, 232, 262, 1000]
    df = spark.createDataFrame([(t,) for t in ts], "t long")
    exp = _fold(ts, 30)
    assert {r["t"] for r in suppress_repeats(df, "t", 30).where("fired").collect()} == exp


def test_suppress_repeats_keyed_random(spark):
    rnd = random.Random(5)
    data = [(k, rnd.randint(0, 5000)) for k in ("a", "b") for _ in range(200)]
    df = spark.createDataFrame(data, "k string, t long").distinct()
    got = {(r["k"], r["t"]) for r in suppress_repeats(df, "t", 40, key="k").where("fired").collect()}
    exp = {(k, t) for k in ("a", "b") for t in _fold({t for kk, t in data if kk == k}, 40)}
    assert got == exp


def test_global_index_and_running_totals(spark):
    data = [(i * 3 + 1, i % 7) for i in range(500)]
    df = spark.createDataFrame(data, "o long, v long")
    idx = dict(rows(global_index(df, ["o"], partitions=6), "o", "idx"))
    assert idx == {o: i for i, (o, _) in enumerate(data)}
    run = {r["o"]: (r["run_v"], r["runmax_v"]) for r in running_totals(df, "o", ["v"], ["v"], partitions=5).collect()}
    acc, mx = 0, None
    for o, v in data:
        acc += v
        mx = v if mx is None else max(mx, v)
        assert run[o] == (acc, mx)
