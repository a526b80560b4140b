"""The keyed table: upserts over several batches, repeated and out-of-order batches, only touched buckets rewritten."""

import os
import random
import tempfile

import pytest
from conftest import rows

from logweave.streaming import keyed


def _dir():
    return tempfile.mkdtemp(prefix="logweave-test-")


def test_upserts_keep_the_newest_row(spark):
    d, rnd, want = _dir(), random.Random(3), {}
    schema = "k string, at long, v string"
    for batch in range(4):
        data = [(rnd.choice(["a", "b", "c", None, f"x{rnd.randint(0, 30)}"]), rnd.randint(0, 500), f"{batch}-{i}") for i in range(40)]
        data = list({(k, at): (k, at, v) for k, at, v in data}.values())
        df = spark.createDataFrame(data, schema)
        for _ in range(2 if batch == 2 else 1):  # one batch runs twice
            keyed.upsert(df, d, "k", ["at"], batch, buckets=8)
        for k, at, v in data:
            if k not in want or at >= want[k][0]:
                want[k] = (at, v)
        assert rows(keyed.read_table(spark, d)) == sorted(((k, *x) for k, x in want.items()), key=lambda t: tuple((x is None, str(x)) for x in t))
    assert keyed._versions(spark, d) == [2, 3]


def test_only_touched_buckets_are_written(spark):
    d = _dir()
    many = spark.range(1000).selectExpr("id as k", "0L as at", "'old' as v")
    assert keyed.upsert(many, d, "k", ["at"], 0, buckets=16) == 16
    one = spark.createDataFrame([(7, 1, "new")], many.schema)
    assert keyed.upsert(one, d, "k", ["at"], 1, buckets=16) == 1
    assert len([x for x in os.listdir(d + "/data/v=1") if x.startswith("bucket=")]) == 1
    assert keyed.upsert(one.limit(0), d, "k", ["at"], 2, buckets=16) == 0
    t = keyed.read_table(spark, d)
    assert t.count() == 1000 and rows(t.where("v = 'new'")) == [(7, 1, "new")]
    with pytest.raises(ValueError):  # an older batch
        keyed.upsert(one, d, "k", ["at"], 1, buckets=16)
    with pytest.raises(ValueError):  # other buckets
        keyed.upsert(one, d, "k", ["at"], 3, buckets=4)
    assert keyed.read_table(spark, _dir()) is None
