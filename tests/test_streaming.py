"""Stream forms: batch/stream parity on file streams (availableNow), sinks, keyed state,
batch cap, alarm monitor and the health listener."""

import os
import tempfile
import time
from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

import __spark_entry__ as se
from logweave.operators import sessions
from logweave.sources import archive, streams
from logweave.sources.eventlog import access_log_lines
from logweave.sources.tables import table
from logweave.streaming import jobs, listener, sinks

SF = "/root/testdata/sf0.001"


def _dir():
    return tempfile.mkdtemp(prefix="logweave-test-")


def test_status_hourly_stream_equals_batch(spark):
    d = _dir()
    access_log_lines(table(spark, SF, "events")).select("value").repartition(3).write.text(d + "/in")
    stream = jobs.status_hourly_stream(streams.text_dir_stream(spark, d + "/in", max_files_per_trigger=1))
    q = (stream.writeStream.outputMode("complete").format("memory").queryName("hourly_parity")
         .option("checkpointLocation", d + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows(spark.table("hourly_parity")) == rows(se.queries()["status_hourly"](spark, SF))


T0 = datetime(2024, 1, 1)


def _session_input(spark, d):
    spec = [("a", 0, "/1", "200"), ("a", 100, "/2", "500"), ("b", 50, "/x", "302"),
            ("a", 2000, "/3", "200"), ("b", 1900, "/y", "404"), ("a", 2100, "/4", "200")]
    data = [(i, ip, T0 + timedelta(seconds=s), u, st) for i, (ip, s, u, st) in enumerate(spec)]
    df = spark.createDataFrame(data, "event_id long, ip string, ts timestamp_ntz, url string, status string")
    for i in range(3):    # three files -> three micro-batches
        df.where(F.floor(F.col("event_id") / 2) == i).coalesce(1).write.mode("append").parquet(d + "/in")
    return df


def test_keyed_state_sessions_equal_batch(spark):
    d = _dir()
    df = _session_input(spark, d)
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(d + "/in")
    out = jobs.session_updates_stream(src, watermark="10 hours")
    q = (out.writeStream.outputMode("append").format("memory").queryName("sess_state")
         .option("checkpointLocation", d + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = rows(spark.table("sess_state"), "ip", "sessionLength", "successCodes", "errorCodes")
    exp = rows(sessions.session_updates(df), "ip", "sessionLength", "successCodes", "errorCodes")
    # the stream sees rows in file order; this fixture's files keep per-ip time order
    assert len(got) == len(exp) == 6
    assert got == exp


def test_sinks_write_per_batch(spark):
    d = _dir()
    df = spark.createDataFrame([("u1", 200, "A"), ("u2", 404, "A"), ("u3", 200, "B")], "url string, status int, agent string")
    sinks.raw_and_counts_json(d)(df, 7)
    sinks.raw_and_counts_json(d)(df.limit(0), 8)            # empty batch: skipped
    assert sorted(os.listdir(d)) == ["agent_counts_7", "requests_7"]
    assert rows(spark.read.json(d + "/agent_counts_7"), "agent", "count") == [("A", 2), ("B", 1)]
    sinks.text_per_batch(d)(df.select("url"), 3)
    assert rows(spark.read.text(d + "/Tweets_0000000003")) == [("u1",), ("u2",), ("u3",)]
    latest = sinks.latest_per_key(df.withColumn("seq", F.monotonically_increasing_id()), "agent", ["seq"])
    assert rows(latest, "agent", "url") == [("A", "u2"), ("B", "u3")]
    got = []
    sinks.sql_per_batch("batch_view", "select count(*) as n from batch_view", collect_to=got)(df, 1)
    assert got[0][1].first()["n"] == 3


def test_batch_cap(spark):
    taken = []
    cap = jobs.BatchCap(spark, lambda df, i: taken.append((i, df.count())), cap=1000, name="cap-test-" + str(time.time()))
    for i, n in enumerate([600, 400, 0, 1, 5]):
        cap(spark.range(n), i)
    assert taken == [(0, 600), (1, 400), (3, 1)] and cap.done


def test_health_listener(spark):
    lst = listener.attach(spark, listener.HealthListener(printer=None))
    d = _dir()
    spark.range(5).write.parquet(d + "/in")
    q = (spark.readStream.schema("id long").parquet(d + "/in").writeStream.format("noop")
         .option("checkpointLocation", d + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    for _ in range(50):
        if any(k == "stopped" for k, _, _ in lst.events):
            break
        time.sleep(0.1)
    spark.streams.removeListener(lst)
    kinds = {k for k, _, _ in lst.events}
    assert "started" in kinds and "progress" in kinds and "stopped" in kinds


def test_live_session_snapshot_from_state(spark):
    d = _dir()
    df = _session_input(spark, d)
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(d + "/in")
    q = (jobs.session_updates_stream(src, watermark="10 hours").writeStream.outputMode("append")
         .format("noop").option("checkpointLocation", d + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    snap = rows(jobs.live_session_snapshot(spark, d + "/ck"), "ip", "session_start", "sessionLength", "clickstream")
    assert snap == [("a", T0 + timedelta(seconds=2000), 2, ["/3", "/4"]),
                    ("b", T0 + timedelta(seconds=1900), 1, ["/y"])]


def test_sliding_counts_stream_closed_windows_equal_batch(spark):
    from logweave.operators import windows
    d = _dir()
    data = [(T0 + timedelta(seconds=s), k) for s, k in [(1, "x"), (30, "y"), (61, "x"), (130, "x"), (400, "y"),
                                                         (1000, "x")]]
    df = spark.createDataFrame(data, "ts timestamp_ntz, k string")
    df.coalesce(1).write.parquet(d + "/in")
    src = spark.readStream.schema(df.schema).parquet(d + "/in")
    out = jobs.sliding_counts_stream(src, "k", "ts", "120 seconds", "60 seconds", watermark="0 seconds")
    q = (out.writeStream.outputMode("append").format("memory").queryName("slide_parity")
         .option("checkpointLocation", d + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = rows(spark.table("slide_parity").select(F.col("window_start").cast("timestamp_ntz"), "k", "count"))
    exp = rows(windows.windowed_counts(df, "k", "ts", "120 seconds", "60 seconds").select("window_start", "k", "count"))
    assert got and set(got) <= set(exp)          # closed windows only, each equal to the batch count
    assert len(got) >= len(exp) - 2


def test_stream_ml_and_word_counts(spark):
    import numpy as np

    from logweave.operators import ml
    km = jobs.StreamingKMeans(spark, ml.KMeansModel(np.array([[0.0, 0.0], [10.0, 10.0]]), np.zeros(2)),
                              name="km-" + str(time.time()))
    km.train(spark.createDataFrame([([0.0, 1.0],), ([10.0, 11.0],), ([1.0, 0.0],)], "features array<double>"), 0)
    assert np.allclose(km.model.centers, [[0.5, 0.5], [10.0, 11.0]])
    lr = jobs.StreamingRegression(spark, name="lr-" + str(time.time()))
    lr.train(spark.createDataFrame([(0.1, 0.2), (0.5, 0.9)], "x double, label double"), 0)
    assert lr.model.iterations > 0
    out = []
    jobs.word_counts_each_batch(lambda df, i: out.append(rows(df)))(
        spark.createDataFrame([("a A a",)], "value string"), 0)
    assert out == [[("A", 1), ("a", 2)]]


def test_print_and_console_sinks(spark, capsys):
    sinks.print_rows(2)(spark.range(5), 4)
    assert "batch 4" in capsys.readouterr().out
    w = sinks.console_complete(spark.readStream.format("rate").load().groupBy().count())
    assert w is not None


def test_delimited_readers(spark):
    d = _dir()
    open(d + "/r.tsv", "w").write("71\t908\t4\t1700000001\n72\t33\t2\t1700000502\n")
    open(d + "/u.txt", "w").write("71|40|X|gardener|00071\n72|19|Y|pilot|AB12C\n")
    open(d + "/g.txt", "w").write("space opera|4\nheist|9\n\n")
    assert rows(streams.ratings(spark, d + "/r.tsv")) == [(71, 908, 4, 1700000001), (72, 33, 2, 1700000502)]
    assert rows(streams.users(spark, d + "/u.txt"), "id", "zip") == [(71, "00071"), (72, "AB12C")]
    assert rows(streams.genres(spark, d + "/g.txt")) == [("heist", 9), ("space opera", 4)]


def test_archive_batches_order(spark):
    d = _dir()
    for name, lines in [("Tweets_2", ["c"]), ("Tweets_1", ["a", "b"]), ("Other_0", ["z"])]:
        os.makedirs(f"{d}/{name}")
        open(f"{d}/{name}/part-00000", "w").write("\n".join(lines) + "\n")
    open(f"{d}/Tweets_1/part-00001", "w").write("")          # empty file: no batch
    got = rows(streams.archive_batches(spark, d), "batch", "value")
    assert got == [(0, "a"), (0, "b"), (1, "c")]


def test_run_helper_requires_checkpoint_and_runs(spark):
    import pytest

    from logweave.streaming import run
    d = _dir()
    spark.range(3).write.parquet(d + "/in")
    src = spark.readStream.schema("id long").parquet(d + "/in")
    with pytest.raises(ValueError):
        run.start(src, "", fmt="noop")
    q = run.start(src, d + "/ck", fmt="parquet", path=d + "/out", available_now=True)
    q.awaitTermination()
    assert rows(spark.read.parquet(d + "/out")) == [(0,), (1,), (2,)]


def test_closed_sessions_stream_bounded_state(spark):
    d = _dir()
    df = _session_input(spark, d)
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(d + "/in")
    out = jobs.closed_sessions_stream(src, watermark="0 seconds")
    q = (out.writeStream.outputMode("append").format("memory").queryName("closed_sess")
         .option("checkpointLocation", d + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = rows(spark.table("closed_sess").select("ip", F.col("session_start").cast("timestamp_ntz"),
                                                 "sessionLength", "clickstream", "successCodes", "errorCodes"))
    batch = rows(sessions.sessions(df).select("ip", "session_start", "sessionLength", "clickstream",
                                              "successCodes", "errorCodes"))
    # sessions closed before the end of the input equal the batch ones; the last open ones may not be out yet
    assert got and all(g in batch for g in got)
    assert ("a", T0, 2, ["/1", "/2"], 1, 1) in got


def test_archive_stream_running_lengths(spark):
    d = _dir()
    texts = [["ab", "cde"], ["x"], ["hello world"]]
    for i, batch in enumerate(texts):          # written one after another: file order = time order
        os.makedirs(f"{d}/Tweets_{i}")
        open(f"{d}/Tweets_{i}/part-00000", "w").write("\n".join(batch) + "\n")
        time.sleep(0.05)
    totals = jobs.length_totals_stream(archive.replay(spark, d).withColumnRenamed("value", "text"))
    seen = []
    q = (totals.writeStream.outputMode("complete")
         .foreachBatch(lambda df, i: seen.append(tuple(df.first())))
         .option("checkpointLocation", d + "/ck").trigger(processingTime="200 milliseconds").start())
    q.processAllAvailable()
    q.stop()
    # (total_rows, total_chars, max_length, avg_length) after each one-file batch
    assert seen[:3] == [(2, 5, 3, 2), (3, 6, 3, 2), (4, 17, 11, 4)]


def test_stream_models_resume_after_restart(spark):
    import numpy as np

    from logweave.operators import ml
    name = "km-resume-" + str(time.time())
    km = jobs.StreamingKMeans(spark, ml.KMeansModel(np.array([[0.0, 0.0], [10.0, 10.0]]), np.zeros(2)), name=name)
    km.train(spark.createDataFrame([([0.0, 1.0],), ([10.0, 11.0],)], "features array<double>"), 0)
    fresh = jobs.StreamingKMeans(spark, ml.KMeansModel(np.zeros((2, 2)), np.zeros(2)), name=name)
    fresh.train(spark.createDataFrame([], "features array<double>"), 1)      # restarted at batch 1
    assert np.allclose(fresh.model.centers, km.model.centers)


def test_keyed_state_sessions_independent_of_session_time_zone(spark):
    def run_in(tz):
        old = spark.conf.get("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", tz)
        try:
            d = _dir()
            # one session for "a" spread over three batches (gaps under 30 minutes), then a far
            # row that moves the watermark past a's timeout
            spec = [(0, "a", 0), (1, "a", 1000), (2, "a", 1500), (3, "b", 10000)]
            data = [(i, ip, T0 + timedelta(seconds=t), f"/{i}", "200") for i, ip, t in spec]
            df = spark.createDataFrame(data, "event_id long, ip string, ts timestamp_ntz, url string, status string")
            for i in range(4):
                df.where(F.col("event_id") == i).coalesce(1).write.mode("append").parquet(d + "/in")
                time.sleep(0.05)
            src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(d + "/in")
            name = "tz_" + tz.replace("/", "_")
            q = (jobs.closed_sessions_stream(src, watermark="0 seconds").writeStream.outputMode("append")
                 .format("memory").queryName(name).option("checkpointLocation", d + "/ck")
                 .trigger(availableNow=True).start())
            q.awaitTermination()
            return rows(spark.table(name).select("ip", F.col("session_start").cast("timestamp_ntz"),
                                                 "sessionLength", "clickstream"))
        finally:
            spark.conf.set("spark.sql.session.timeZone", old)
    utc = run_in("UTC")
    assert utc == [("a", T0, 3, ["/0", "/1", "/2"])]
    assert run_in("America/Los_Angeles") == utc


def _hot_input(spark, d):
    """One ip with 25,000 shuffled rows (more than two Arrow chunks) in sessions of 50 rows, 250 rows of others."""
    import random
    rnd = random.Random(3)
    spec = [("hot", 7200 * (i // 50) + 10 * (i % 50)) for i in range(25_000)] + [(f"ip{i % 50}", 977 * i) for i in range(250)]
    rnd.shuffle(spec)
    data = [(i, ip, T0 + timedelta(seconds=s), f"/{s}", rnd.choice(["200", "404"])) for i, (ip, s) in enumerate(spec)]
    df = spark.createDataFrame(data, "event_id long, ip string, ts timestamp_ntz, url string, status string")
    df.coalesce(1).write.parquet(d + "/in")
    return spark.read.parquet(d + "/in")


def test_hot_ip_in_several_chunks(spark):
    d = _dir()
    df = _hot_input(spark, d)
    got = {}
    for name, job in (("hot_updates", jobs.session_updates_stream), ("hot_closed", jobs.closed_sessions_stream)):
        src = spark.readStream.schema(df.schema).parquet(d + "/in")
        q = (job(src, watermark="0 seconds").writeStream.outputMode("append").format("memory").queryName(name)
             .option("checkpointLocation", f"{d}/ck_{name}").trigger(availableNow=True).start())
        q.awaitTermination()
        got[name] = spark.table(name).withColumn("session_start", F.col("session_start").cast("timestamp_ntz"))
    cols = ["ip", "session_start", "sessionLength", "clickstream", "successCodes", "errorCodes"]
    assert rows(got["hot_updates"], "event_id", *cols) == rows(sessions.session_updates(df), "event_id", *cols)
    batch = rows(sessions.sessions(df), *cols)
    closed = rows(got["hot_closed"], *cols)
    # the last session is open: the watermark stands at its last row
    assert len(closed) == len(batch) - 1 and set(map(str, closed)) < set(map(str, batch))


def test_closed_sessions_join_rows_of_any_batch(spark):
    d = _dir()
    data = [(i, "a", T0 + timedelta(seconds=s), f"/{s}", "200") for i, s in enumerate([0, 3000, 1500, 9000, 20_000])]
    df = spark.createDataFrame(data, "event_id long, ip string, ts timestamp_ntz, url string, status string")
    for i in range(5):
        df.where(F.col("event_id") == i).coalesce(1).write.mode("append").parquet(d + "/in")
        time.sleep(0.05)
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(d + "/in")
    q = (jobs.closed_sessions_stream(src, watermark="1 hour").writeStream.outputMode("append").format("memory")
         .queryName("closed_any").option("checkpointLocation", d + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows(spark.table("closed_any"), "sessionLength", "clickstream") == [(1, ["/9000"]), (3, ["/0", "/1500", "/3000"])]


def test_stream_queries_emit_what_is_open_at_the_end(spark):
    from logweave.plans import queries, stream_queries
    sf = "/root/testdata/sf0.001"
    for name, batch in (("stream_closed_sessions", "sessions"), ("stream_top_referrers", "top_referrers")):
        got = stream_queries.STREAM_QUERIES[name](spark, sf)
        want = queries.QUERIES[batch](spark, sf)
        same = [c for c in ("ip", "session_start", "sessionLength", "window_start", "referer", "count", "rank")
                if c in got.columns and c in want.columns]
        assert len(same) > 2 and rows(got, *same) == rows(want, *same), name


def test_closed_sessions_of_many_ips_share_state_groups(spark):
    """The calls of the state function are bounded by ``buckets``, whatever the number of ips."""
    d = _dir()
    data = [(i, f"ip{i % 60}" if i % 60 else None, T0 + timedelta(seconds=601 * (i // 60) * (1 + i % 3)), f"/{i}", "200" if i % 7 else "x")
            for i in range(900)]
    df = spark.createDataFrame(data, "event_id long, ip string, ts timestamp_ntz, url string, status string")
    df.unionAll(spark.createDataFrame([(-2, "ip1", None, "/", "200")], df.schema)).repartition(3).write.parquet(d + "/in")
    time.sleep(0.05)
    last = spark.createDataFrame([(-1, "z", T0 + timedelta(days=9), "/", "200")], df.schema)
    last.coalesce(1).write.mode("append").parquet(d + "/in")
    src = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(d + "/in")
    q = (jobs.closed_sessions_stream(src, watermark="1 day", buckets=4).writeStream.outputMode("append").format("parquet")
         .option("path", d + "/out").option("checkpointLocation", d + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= 4
    cols = ["ip", "sessionLength", "clickstream", "successCodes", "errorCodes"]
    assert rows(spark.read.parquet(d + "/out"), *cols) == rows(sessions.sessions(df), *cols)
