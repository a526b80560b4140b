"""The program wiring in ``logweave.apps`` on file inputs (availableNow)."""

import os
import tempfile

from conftest import rows

from logweave import apps
from logweave.sources import streams
from logweave.sources.eventlog import access_log_lines
from logweave.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_log_sql_app_writes_batches(spark):
    d = tempfile.mkdtemp(prefix="logweave-app-")
    access_log_lines(table(spark, SF, "events")).select("value").coalesce(2).write.text(d + "/in")
    q = apps.log_sql(streams.text_dir_stream(spark, d + "/in", max_files_per_trigger=1), d + "/ck", d + "/out",
                     available_now=True)
    q.awaitTermination()
    outs = sorted(os.listdir(d + "/out"))
    assert any(o.startswith("requests_") for o in outs) and any(o.startswith("agent_counts_") for o in outs)
    total = spark.read.json(d + "/out/agent_counts_*").agg({"count": "sum"}).first()[0]
    assert total == spark.read.parquet(f"{SF}/events.parquet").count()


def test_sessionizer_and_strict_urls_apps_run(spark, capsys):
    d = tempfile.mkdtemp(prefix="logweave-app-")
    access_log_lines(table(spark, SF, "events")).select("value").coalesce(1).write.text(d + "/in")
    lines = streams.text_dir_stream(spark, d + "/in")
    apps.sessionizer(lines, d + "/ck1", available_now=True).awaitTermination()
    apps.strict_urls(lines, d + "/ck2", available_now=True).awaitTermination()
    out = capsys.readouterr().out
    assert "sessionLength" in out


def test_batch_programs(spark):
    d = tempfile.mkdtemp(prefix="logweave-app-")
    open(d + "/book.txt", "w").write("The cat the dog\nA cat\n")
    assert apps.line_count(spark, d + "/book.txt").first()[0] == 2
    assert rows(apps.word_count(spark, d + "/book.txt")) == [("a", 1), ("cat", 2), ("dog", 1), ("the", 2)]


def test_cli_word_count(capsys):
    from logweave.__main__ import main
    d = tempfile.mkdtemp(prefix="logweave-app-")
    open(d + "/t.txt", "w").write("x y x\n")
    assert main(["word-count", "--input", d + "/t.txt"]) == 0
    assert "x" in capsys.readouterr().out


def test_cli_stream_program(spark):
    from logweave.__main__ import main
    d = tempfile.mkdtemp(prefix="logweave-app-")
    access_log_lines(table(spark, SF, "events")).select("value").coalesce(1).write.text(d + "/in")
    assert main(["hourly-status", "--input", d + "/in", "--checkpoint", d + "/ck", "--available-now"]) == 0
    # the console sink prints from the JVM process; the checkpoint shows the committed batch
    assert os.path.exists(d + "/ck/commits/0") and os.path.exists(d + "/ck/state")


def _archive(d, texts):
    for i, t in enumerate(texts):
        os.makedirs(f"{d}/in/Tweets_{i}")
        with open(f"{d}/in/Tweets_{i}/part-00000", "w") as f:
            f.write(t)


def test_popular_words_by_window(spark):
    """Windows of arrival time: all words are counted once, in windows of one second, best first."""
    import time
    d, seen = tempfile.mkdtemp(prefix="logweave-app-"), []
    _archive(d, ["storm storm rain\n", "storm hail\n"])
    q = apps.popular_words(spark, d + "/in", d + "/ck", k=2, window="1 second", interval="200 milliseconds",
                           sink=lambda df, i: seen.extend(df.collect()))
    try:
        for _ in range(200):
            if sum(r["count"] for r in seen) >= 5 or not q.isActive:
                break
            time.sleep(0.25)
    finally:
        q.stop()
    total = {}
    for r in seen:
        total[r.word] = total.get(r.word, 0) + r["count"]
        assert (r.window_end - r.window_start).total_seconds() == 1 and r["rank"] <= 2
    assert total == {"storm": 3, "rain": 1, "hail": 1}


def test_text_lengths_prints_the_running_totals(spark, capsys):
    d = tempfile.mkdtemp(prefix="logweave-app-")
    _archive(d, ["ab\ncde\n", "x\n"])
    apps.text_lengths(spark, d + "/in", d + "/ck", available_now=True, interval="200 milliseconds")
    assert "|3         |6          |3         |2         |" in capsys.readouterr().out


def test_save_texts_stops_after_the_cap(spark):
    import json
    d = tempfile.mkdtemp(prefix="logweave-app-")
    for i in range(6):
        spark.createDataFrame([(json.dumps({"data": [{"text": f"t{i}-{j}"} for j in range(4)]}),)], "value string").coalesce(1).write.mode(
            "append").text(d + "/in")
    q, cap = apps.save_texts(spark, streams.text_dir_stream(spark, d + "/in", max_files_per_trigger=1), d + "/ck", d + "/out", cap=10,
                             interval="100 milliseconds")
    apps.stop_after_cap(q, cap)
    saved = spark.read.text(d + "/out/Tweets_*").count()
    assert saved == cap.total == 12 and not q.isActive
    assert sorted(os.listdir(d + "/out")) == [f"Tweets_{i:010d}" for i in range(3)]


def test_sessionizer_shows_the_live_sessions_after_every_batch(spark):
    """Four batches; a session past its gap (by the watermark) is gone from the snapshot, the others stay."""
    import time
    d, seen = tempfile.mkdtemp(prefix="logweave-app-"), []
    line = lambda ip, url: f'{ip} - - [01/Jan/2024:00:00:00 +0000] "GET {url} HTTP/1.1" 200 10 "-" "agent"'
    batches = [[("10.0.0.1", 0, "/a"), ("10.0.0.2", 60, "/b")], [("10.0.0.1", 600, "/c")], [("10.0.0.3", 9000, "/d")], [("10.0.0.3", 9100, "/e")]]
    for b in batches:
        rows_ = [(line(ip, u), "2024-01-01 00:00:00", s) for ip, s, u in b]
        spark.createDataFrame(rows_, "value string, t string, s long").selectExpr(
            "value", "cast(t as timestamp_ntz) + make_dt_interval(0, 0, 0, s) as at").coalesce(1).write.mode("append").parquet(d + "/in")
        time.sleep(0.05)
    lines = spark.readStream.schema("value string, at timestamp_ntz").option("maxFilesPerTrigger", 1).parquet(d + "/in")
    q = apps.sessionizer(lines, d + "/ck", time_col="at", watermark="0 seconds", collect_to=seen, available_now=True)
    q.awaitTermination()
    for _ in range(240):  # snapshots follow the commits
        if len(seen) >= 4 and seen[-1][1].where("ip = '10.0.0.1'").isEmpty():
            break
        time.sleep(0.25)
    assert [i for i, _ in seen] == list(range(len(seen)))
    got = [sorted((r.ip, r.sessionLength, list(r.clickstream)) for r in df.collect()) for _, df in seen]
    first, second = ("10.0.0.1", 1, ["/a"]), ("10.0.0.2", 1, ["/b"])
    both = ("10.0.0.1", 2, ["/a", "/c"])
    assert got[0] == [first, second] and got[1] == [both, second]
    assert got[2] == [both, second, ("10.0.0.3", 1, ["/d"])]
    assert got[-1] == [("10.0.0.3", 2, ["/d", "/e"])]
