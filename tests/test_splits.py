"""SP1, SP2: folds disjoint and complete; holdout edges; cap."""

from collections import Counter

from conftest import rows

from logweave.operators import splits


def test_kfold_blocks(spark):
    n = 103                                   # not divisible by k
    df = spark.createDataFrame([(i * 2, i % 4) for i in range(n)], "key long, user long")
    got = dict(rows(splits.kfold_positional(df, ["key"], 5), "key", "fold"))
    assert len(got) == n
    assert all(got[i * 2] == (i * 5) // n for i in range(n))
    assert sorted(Counter(got.values())) == [0, 1, 2, 3, 4]


def test_user_holdout(spark):
    data = [(u, 100 * u + i) for u, cnt in [(1, 3), (2, 5), (3, 8)] for i in range(cnt)]
    df = spark.createDataFrame(data, "user long, pos long")
    got = {(u, p): t for u, p, t in rows(splits.user_holdout(df, "user", ["pos"], 4, 5), "user", "pos", "is_test")}
    assert [p for (u, p), t in sorted(got.items()) if t] == [203, 204, 303, 304]   # fewer / exactly / more than stop
    capped = splits.user_holdout(df, "user", ["pos"], 4, 5, max_test=3)
    assert sorted(r["pos"] for r in capped.where("is_test").collect()) == [203, 204, 303]


def test_kfold_plan_has_one_full_shuffle(spark):
    """Positions come from the sorted partitions; what else is exchanged has one row per partition."""
    df = spark.range(1000, numPartitions=3).selectExpr("(id * 7919) % 1000 as key")
    out = splits.kfold_positional(df, ["key"], 4)
    assert dict(rows(out, "key", "fold")) == {i: i * 4 // 1000 for i in range(1000)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.split("BroadcastExchange")[0] and "rangepartitioning" not in plan
