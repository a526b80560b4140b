"""Session updates over micro-batches with carried rows equal the batch operator over all rows."""

import random
import tempfile
from datetime import datetime, timedelta

from conftest import rows

from logweave.operators import sessions
from logweave.streaming import session_fold

T0 = datetime(2024, 1, 1)
SCHEMA = "event_id long, ip string, ts timestamp_ntz, url string, status string"


def test_batches_with_a_hot_ip_and_a_repeated_batch(spark):
    d, rnd, out = tempfile.mkdtemp(prefix="logweave-test-"), random.Random(8), {}
    spec = sorted((s, ip) for ip, n in (("hot", 1500), ("a", 20), (None, 15), ("b", 3)) for s in rnd.sample(range(100_000), n))
    data = [(i, ip, T0 + timedelta(seconds=s), f"/{i}", rnd.choice(["200", "404", "x"])) for i, (s, ip) in enumerate(spec)]
    fn = session_fold.session_batches(d, lambda df, i: out.__setitem__(i, rows(df, *cols)), buckets=4)
    cols = ["event_id", "ip", "session_start", "sessionLength", "clickstream", "successCodes", "errorCodes"]
    edges = [0, 400, 401, 900, 900, len(data)]  # one batch of a single row, one empty
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        for _ in range(2 if i == 2 else 1):
            fn(spark.createDataFrame(data[a:b], SCHEMA), i)
    whole = spark.createDataFrame(data, SCHEMA)
    want = rows(sessions.session_updates(whole), *cols)
    assert sorted((r for b in out.values() for r in b), key=str) == sorted(want, key=str)
    last = data[-1][2]
    live = session_fold.live_table(spark, d, last_literal(last))
    cols = ["ip", "session_start", "session_end", "sessionLength", "clickstream", "successCodes", "errorCodes"]
    assert rows(live, *cols) == rows(sessions.live_sessions(sessions.sessions(whole), last_literal(last)), *cols)


def last_literal(t):
    from pyspark.sql import functions as F
    return F.lit(t).cast("timestamp_ntz")


def test_parts_of_several_files_are_one_batch_each(spark):
    """The replay lands and reads a part in parallel; the parts still follow each other in time order."""
    import glob

    from logweave.plans.queries import QUERIES
    from logweave.session import checkpoint_dir
    d, rnd = tempfile.mkdtemp(prefix="logweave-test-"), random.Random(5)
    data = [(i, T0 + timedelta(seconds=rnd.randrange(200_000)), rnd.randrange(6), "view", 1.0, '{"k": "%d"}' % (i % 99)) for i in range(800)]
    events = spark.createDataFrame(data, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.repartition(4).write.parquet(d + "/events.parquet")
    place = checkpoint_dir(spark) + "/queries/stream_session_running/*"
    before = set(glob.glob(place))
    got = QUERIES["stream_session_running"](spark, d)
    cols = ["event_id", "ip", "session_start", "sessionLength", "clickstream", "successCodes", "errorCodes"]
    assert rows(got, *cols) == rows(QUERIES["session_running"](spark, d), *cols)
    [base] = set(glob.glob(place)) - before
    assert len(glob.glob(base + "/in/*.parquet")) > 4 and len(glob.glob(base + "/out/batch=*")) == 4


def test_the_rows_of_a_batch_are_written_once(spark, monkeypatch):
    d, cuts = tempfile.mkdtemp(prefix="logweave-test-"), []
    monkeypatch.setattr(session_fold, "cut", lambda df: cuts.append(1) or df.checkpoint())
    fn = session_fold.session_batches(d, lambda df, i: df.count(), buckets=2)
    for i in range(2):
        fn(spark.createDataFrame([(i, "a", T0 + timedelta(seconds=i), "/x", "200")], SCHEMA), i)
    assert len(cuts) == 2
