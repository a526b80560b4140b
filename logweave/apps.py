"""

Each function wires a line source to the operators and a sink and returns the
started ``StreamingQuery`` (or the result frame for the batch programs).  Inputs
are any frame with a ``value`` column: a text folder stream (``--input DIR``) by
default, or a socket/Kafka/broker source built with ``logweave.sources.streams``.
Event time: the programs that window by time use the file arrival time
(``current_timestamp()`` at ingestion) unless ``time_col`` names an event-time column.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.operators import ml, parse, textstats, windows
from logweave.sources import archive, streams
from logweave.session import rocksdb_state
from logweave.streaming import alarm_state, jobs, keyed, listener, run, sinks, sliding


def _with_arrival(lines: DataFrame, time_col: str | None) -> DataFrame:
    return lines if time_col else lines.withColumn("arrival_ts", F.current_timestamp().cast("timestamp_ntz"))


def log_parser(lines: DataFrame, checkpoint: str, time_col: str | None = None, length: str = "300 seconds",
               slide: str = "1 second", k: int = 5, watermark: str = "1 minute", sink=None, **opts):
    """Top referrers and user agents over a sliding window (P3 W2 T1 SNK1)."""
    t = time_col or "arrival_ts"
    src = _with_arrival(lines, time_col)
    queries = []
    for field in ("referer", "agent"):
        f = parse.field_or_error(src, field, keep=[t])
        queries.append(_top_windows(f, field, t, length, slide, watermark, k, f"{checkpoint}/{field}", sink, opts))
    return queries


def _top_windows(df, key, t, length, slide, watermark, k, checkpoint, sink, opts):
    """Top ``k`` of every sliding window, as stretches of windows with the same ranking, to ``sink`` (default: print)."""
    def fn(runs, batch_id):
        (sink or sinks.print_rows(k))(sliding.top_k_runs(runs, key, k, length, slide), batch_id)
    with rocksdb_state(df.sparkSession):
        return run.start(sliding.sliding_runs_stream(df, key, t, length, slide, watermark), checkpoint, foreach_batch=fn, **opts)


def log_sql(lines: DataFrame, checkpoint: str, out: str, **opts):
    """Per batch: raw (url, status, agent) rows and agent counts as JSON (P4 A4 SNK2 F4)."""
    return run.start(parse.requests(lines), checkpoint, foreach_batch=sinks.raw_and_counts_json(out), **opts)


def log_alarmer(spark: SparkSession, lines: DataFrame, checkpoint: str, window: str = "300 seconds",
                max_ratio: float = 0.5, timeout: str = "600 seconds", sink=None, beats: DataFrame | None = None, **opts):
    """Error-ratio and no-data alarms with source health events (P9 W4 A7 AL1-AL4).

    Alarms go to ``sink`` per batch (default: printed); ``beats`` replaces the one-second heartbeat."""
    health = listener.attach(spark)
    classes = parse.status_classes(lines.withColumn("at", F.current_timestamp()), keep=["at"])
    beats = alarm_state.heartbeat(spark) if beats is None else beats
    events = alarm_state.alarm_stream(classes, beats, window=window, max_ratio=max_ratio, timeout=timeout)
    with rocksdb_state(spark):
        return run.start(events, checkpoint, foreach_batch=sink or sinks.print_rows(20), **opts), health


def sessionizer(lines: DataFrame, checkpoint: str, time_col: str | None = None, watermark: str = "1 hour",
                sql: str = "select * from sessionData", collect_to: list | None = None, **opts):
    """Per-ip session state; after every batch all live sessions, read from the state that the batch
    left in the query's checkpoint, are shown through SQL on ``sessionData`` (P6 ST1-ST3 SNK6)."""
    t = time_col or "arrival_ts"
    # ties on time are broken by a content hash (streams allow no row ids)
    src = _with_arrival(lines, time_col).withColumn("_seq", F.xxhash64("value"))
    rows = parse.session_requests(src, keep=[t, "_seq"])
    state = jobs.session_updates_stream(rows, ts=t, seq="_seq", watermark=watermark)
    name = f"sessions-{uuid.uuid4().hex}"
    show = sinks.sql_per_batch("sessionData", sql, collect_to=collect_to)
    after = listener.AfterBatch(name, lambda i: show(jobs.live_session_snapshot(lines.sparkSession, checkpoint, i), i))
    lines.sparkSession.streams.addListener(after)
    return run.start(state, checkpoint, fmt="noop", name=name, mode="append", **opts)


def hourly_status(lines: DataFrame, checkpoint: str, **opts):
    """Requests per status per hour, console in complete mode (P1 P2 P8 F1 W5 T2 SNK5)."""
    agg = jobs.status_hourly_stream(lines).orderBy("window_start")
    w = sinks.console_complete(agg).option("checkpointLocation", checkpoint)
    return w.trigger(availableNow=True).start() if opts.get("available_now") else w.start()


def keyed_store(lines: DataFrame, checkpoint: str, fmt: str, options: dict, **opts):
    """(ip, url, status, agent) rows upserted per batch into a keyed table (P5 SNK4): an external store by its
    connector, or with ``fmt="buckets"`` the versioned table of ``streaming.keyed`` at ``options["path"]``."""
    src = _with_arrival(lines, None).withColumn("_h", F.xxhash64("value"))
    rows = parse.keyed_requests(src, keep=["arrival_ts", "_h"])
    if fmt == "buckets":
        sink = keyed.keyed_upserts(options["path"], "ip", ["arrival_ts", "_h"], buckets=int(options.get("buckets", keyed.BUCKETS)))
    else:
        sink = sinks.keyed_table(fmt, options, "ip", ["arrival_ts", "_h"], ["ip", "url", "status", "agent"])
    return run.start(rows, checkpoint, foreach_batch=sink, **opts)


def strict_urls(lines: DataFrame, checkpoint: str, time_col: str | None = None, payload: str | None = None,
                length: str = "300 seconds", slide: str = "1 second", watermark: str = "1 minute", sink=None, **opts):
    """Custom-receiver / Kinesis / Flume programs: strict urls, sliding counts, top 10
    (P14 P7 W2 T1 SNK1).  ``payload`` names a binary column to decode first."""
    src = parse.decode_payload(lines, payload, keep=[c for c in lines.columns if c != payload]) if payload else lines
    t = time_col or "arrival_ts"
    src = _with_arrival(src, time_col)
    return _top_windows(parse.strict_urls(src, keep=[t]), "url", t, length, slide, watermark, 10, checkpoint, sink, opts)


def word_count_per_batch(lines: DataFrame, checkpoint: str, **opts):
    """Kafka program: word counts inside each batch (P11 A3 SNK1)."""
    return run.start(lines, checkpoint, foreach_batch=jobs.word_counts_each_batch(sinks.print_rows(10)),
                     interval=opts.pop("interval", "2 seconds"), **opts)


def popular_words(spark: SparkSession, root: str, checkpoint: str, k: int = 10, window: str = "10 seconds", sink=None,
                  beats: DataFrame | None = None, **opts):
    """Archived texts replayed one file per batch: cleaned words, top ``k`` per window of arrival time
    (SRC7 P12 F2 F3 W3 T1 SNK1).  ``beats`` (default: a row a second) keeps the time moving, so that
    windows close after the last file; they reach ``sink`` (default: printed) once closed."""
    texts = archive.replay(spark, root).withColumnRenamed("value", "text")
    words = textstats.clean_word_rows(texts).withColumn("at", F.current_timestamp())
    beats = alarm_state.heartbeat(spark) if beats is None else beats
    # A beat's word is empty, which no cleaned word is: a null would meet batches whose words cannot be null.
    both = words.select("at", "word").unionAll(beats.select("at", F.lit("").alias("word")))
    counts = (both.withWatermark("at", "0 seconds").groupBy(F.window("at", window).alias("w"), "word")
              .agg(F.count(F.lit(1)).alias("count"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "word", "count"))

    if opts.pop("available_now", False):
        raise ValueError("popular_words follows the clock: stop it when the windows wanted have been shown")

    def top(df, batch_id):
        best = windows.top_k_per_window(df.where("word != ''"), "word", k)
        (sink or sinks.print_rows(k))(best, batch_id)
    return run.start(counts, checkpoint, foreach_batch=top, **opts)


def text_lengths(spark: SparkSession, root: str, checkpoint: str, **opts):
    """Average and longest text over the replayed archive (SRC7 P13 A5 A6)."""
    totals = jobs.length_totals_stream(archive.replay(spark, root).withColumnRenamed("value", "text"))
    drain = opts.pop("available_now", False)  # that trigger would take a single file
    q = run.start(totals, checkpoint, foreach_batch=sinks.print_rows(1), mode="complete", **opts)
    if drain:
        q.processAllAvailable()
        q.stop()
    return q


def save_texts(spark: SparkSession, responses: DataFrame, checkpoint: str, out: str, cap: int = 1000, **opts):
    """JSON responses -> texts, one text folder per non-empty batch, stop past ``cap`` texts
    (SRC8 SNK3 A8 F4).  ``stop_after_cap`` ends the query once ``cap.done``."""
    cap_fn = jobs.BatchCap(spark, sinks.text_per_batch(out), cap=cap, folder=f"{checkpoint}/cap")
    q = run.start(streams.response_texts(responses).select("text"), checkpoint, foreach_batch=cap_fn, **opts)
    return q, cap_fn


def stop_after_cap(query, cap: jobs.BatchCap, poll: float = 0.5) -> None:
    """Waits until the query ends by itself or its batches have passed the cap, then stops it."""
    while query.isActive and not cap.done:
        query.awaitTermination(poll)
    query.stop()


def streaming_kmeans(spark: SparkSession, train: DataFrame, test: DataFrame, checkpoint: str, k: int = 5,
                     dim: int = 2, seed: int = 42, **opts):
    """Train on '[a,b]' lines, predict '(label,[a,b])' lines (SRC9 ML1 ML2)."""
    model = jobs.StreamingKMeans(spark, ml.KMeansModel.random(k, dim, 0.0, seed), folder=f"{checkpoint}/model")
    tq = run.start(train.select(streams.parse_vector("value").alias("features")), f"{checkpoint}/train",
                   foreach_batch=model.train, **opts)
    lp = test.select(streams.parse_labeled_point("value").alias("p")).select("p.label", "p.features")
    pq = run.start(lp, f"{checkpoint}/test",
                   foreach_batch=lambda df, i: sinks.print_rows(10)(model.predict(df), i), **opts)
    return tq, pq, model


def streaming_regression(spark: SparkSession, train: DataFrame, test: DataFrame, checkpoint: str, **opts):
    """Train on 'label,x' lines, predict with the known label carried (SRC9 ML3 ML4)."""
    model = jobs.StreamingRegression(spark, folder=f"{checkpoint}/model")

    def points(df):
        return (df.select(streams.parse_labeled_point("value").alias("p"))
                .select("p.label", F.element_at("p.features", 1).alias("x")))
    tq = run.start(points(train), f"{checkpoint}/train", foreach_batch=model.train, **opts)
    pq = run.start(points(test), f"{checkpoint}/test",
                   foreach_batch=lambda df, i: sinks.print_rows(10)(model.predict(df), i), **opts)
    return tq, pq, model


def word_count(spark: SparkSession, path: str, n: int = 20) -> DataFrame:
    """Batch word count of a text file, first 20 entries (SRC5 P11 A2 T3)."""
    return textstats.first_entries(textstats.word_counts(textstats.words(streams.text_file(spark, path))), n)


def line_count(spark: SparkSession, path: str) -> DataFrame:
    """Batch line count of a text file (SRC5 A1)."""
    return textstats.line_count(streams.text_file(spark, path))

