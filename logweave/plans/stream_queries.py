"""Named queries that run the streaming forms end to end over the test tables.

Input is landed by Spark from the table (text or parquet files in the shared
checkpoint folder), replayed as a file stream with ``availableNow``, and the
sink output is read back as the query result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.operators import parse, textstats
from logweave.session import rocksdb_state, scratch_path
from logweave.sources import archive, streams
from logweave.sources.eventlog import access_log_lines
from logweave.sources.tables import table
from logweave.streaming import alarm_state, jobs, keyed, session_fold, sliding


def _base(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"queries/{name}/{uuid.uuid4().hex}")


def q_stream_status_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC6 W1 W5 T2 SNK5-style complete output: hourly status counts from a text-file stream."""
    base = _base(spark, "stream_status_hourly")
    access_log_lines(table(spark, sf_dir, "events")).select("value").write.text(base + "/in")
    agg = jobs.status_hourly_stream(streams.text_dir_stream(spark, base + "/in", max_files_per_trigger=2))
    q = (agg.writeStream.outputMode("complete")
         .foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(base + "/out"))
         .option("checkpointLocation", base + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(base + "/out")


def q_stream_session_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2 keyed state (applyInPandasWithState): one updated session row per input row.

    Rows are processed in arrival order per key, as keyed state does, so the result
    depends on file arrival order; checked by row count."""
    base = _base(spark, "stream_session_updates")
    rows = parse.session_requests(access_log_lines(table(spark, sf_dir, "events"), with_ts=True),
                                  keep=["event_id", "arrival_ts"])
    rows.write.parquet(base + "/in")
    src = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(base + "/in")
    out = jobs.session_updates_stream(src, ts="arrival_ts", watermark="3650 days")
    q = (out.writeStream.outputMode("append").format("parquet").option("path", base + "/out")
         .option("checkpointLocation", base + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(base + "/out").select(
        "event_id", "ip", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        "sessionLength", "clickstream", "successCodes", "errorCodes")


def _referrer_stream(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """(referer, arrival_ts) from the access log as a text stream with one last line a day later."""
    (access_log_lines(table(spark, sf_dir, "events"), with_ts=True)
     .select(F.concat_ws("\t", F.date_format("arrival_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "value").alias("v"))
     .write.text(base + "/in"))
    at = spark.read.text(base + "/in").agg(F.max(F.to_timestamp_ntz(F.substring_index("value", "\t", 1))).alias("at")).where("at is not null")
    (at.select(F.concat(F.date_format(F.col("at") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("\t")).alias("v"))
     .write.mode("append").text(base + "/in"))
    # Files land unordered in time, so they are taken in one trigger: rows later than the
    # watermark across triggers would be dropped, as in any event-time stream.
    raw = streams.text_dir_stream(spark, base + "/in")
    lines = raw.select(F.to_timestamp_ntz(F.substring_index("value", "\t", 1)).alias("arrival_ts"),
                       F.expr("substring(value, instr(value, '\t') + 1)").alias("value"))
    return parse.field_or_error(lines, "referer", keep=["arrival_ts"])


def q_stream_top_referrers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC6 P3 W2 T1 on a stream: referer counts in 300 s windows sliding by 60 s as two
    chained streaming aggregates (append mode, watermark), top 5 per closed window ranked in
    ``foreachBatch``.  A last line far after the others moves the watermark past all windows,
    so that every window is emitted; its own stay open."""
    from logweave.operators import windows

    base = _base(spark, "stream_top_referrers")
    ref = _referrer_stream(spark, sf_dir, base)
    counts = jobs.sliding_counts_stream(ref, "referer", "arrival_ts", "300 seconds", "60 seconds",
                                        watermark="10 minutes")

    def rank(df, batch_id):
        # a replayed batch writes its own folder again
        windows.top_k_per_window(df, "referer", 5).write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    q = (counts.writeStream.outputMode("append").foreachBatch(rank)
         .option("checkpointLocation", base + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(base + "/out").select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "referer", "count", "rank")


def q_stream_top_referrers_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 at the reference's slide: referer counts in 300 s windows sliding by 1 s, by difference
    counts in keyed state, and the top 5 of every window.  A row stands for the windows that start
    in [first_start, last_start]; stretches end where a count changes or at a multiple of 300 s."""
    base = _base(spark, "stream_top_referrers_1s")
    ref = _referrer_stream(spark, sf_dir, base)

    def rank(df, batch_id):
        top = sliding.top_k_runs(df, "referer", 5, "300 seconds", "1 second")
        top.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    with rocksdb_state(spark):
        runs = sliding.sliding_runs_stream(ref, "referer", "arrival_ts", "300 seconds", "1 second", watermark="10 minutes")
        q = (runs.writeStream.outputMode("append").foreachBatch(rank)
             .option("checkpointLocation", base + "/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(base + "/out").drop("batch")


def q_stream_alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AL1-AL3 with one clock in keyed state: the fired alarms, from the request classes and a
    heartbeat every ten minutes between the first and the last request, each landed as files."""
    from logweave.plans import queries

    base = _base(spark, "stream_alarms")
    queries.status_classes_at(spark, sf_dir).select(F.col("arrival_ts").alias("at"), "class").write.parquet(base + "/classes")
    step = f"INTERVAL {queries.ALARM_SLIDE}"
    ends = spark.read.parquet(base + "/classes").select(F.min("at").alias("a"), F.max("at").alias("z")).where("a is not null")
    ends.select(F.explode(F.expr(f"sequence(a, z, {step})")).alias("at")).write.parquet(base + "/beats")
    read = lambda d, schema: spark.readStream.schema(schema).parquet(f"{base}/{d}")
    events = alarm_state.alarm_stream(read("classes", "at timestamp_ntz, class string"), read("beats", "at timestamp_ntz"),
                                      window=queries.ALARM_WINDOW, tick=queries.ALARM_SLIDE, max_ratio=queries.ALARM_MAX_RATIO,
                                      timeout=queries.ALARM_TIMEOUT)
    with rocksdb_state(spark):
        q = (events.writeStream.outputMode("append").format("parquet").option("path", base + "/out")
             .option("checkpointLocation", base + "/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    fired = spark.read.parquet(base + "/out").where("state = 'fired'")
    return fired.select("alarm_ts", "kind", "ratio", F.when(F.col("kind") == "no_data", F.col("last_data")).alias("last_data"))


def q_stream_closed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1 + T4 on a stream: keyed state with bounded per-ip state emits each session once the
    watermark has passed its end by 30 minutes.  A last row far after the others moves the
    watermark past all of them, so that every session is emitted; its own stays open."""
    base = _base(spark, "stream_closed_sessions")
    rows = parse.session_requests(access_log_lines(table(spark, sf_dir, "events"), with_ts=True),
                                  keep=["event_id", "arrival_ts"])
    rows.write.parquet(base + "/in")
    kinds = {f.name: f.dataType for f in rows.schema}
    end = spark.read.parquet(base + "/in").agg((F.max("arrival_ts") + F.expr("INTERVAL 1 DAY")).alias("at")).where("at is not null")
    end.select(*[(F.col("at") if c == "arrival_ts" else F.lit("") if c == "ip" else F.lit(None)).cast(kinds[c]).alias(c)
                 for c in rows.columns]).write.mode("append").parquet(base + "/in")
    src = spark.readStream.schema(rows.schema).parquet(base + "/in")
    out = jobs.closed_sessions_stream(src, ts="arrival_ts", watermark="1 hour")
    q = (out.writeStream.outputMode("append").format("parquet").option("path", base + "/out")
         .option("checkpointLocation", base + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(base + "/out").select(
        "ip", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_end").cast("timestamp_ntz").alias("session_end"),
        "sessionLength", "clickstream", "successCodes", "errorCodes")


def q_stream_session_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2 over micro-batches by DataFrame operators, with one carried row per ip in the versioned
    keyed table: the updated session of every request, from four parts in time order."""
    base = _base(spark, "stream_session_running")
    lines = access_log_lines(table(spark, sf_dir, "events"), with_ts=True)
    rows = parse.session_requests(lines, keep=["event_id", "arrival_ts"])
    ends = rows.select(F.min("arrival_ts").alias("a"), F.max("arrival_ts").alias("z"))
    # Stand-in stream: a folder whose files come part after part in time order
    share = F.least(F.lit(3), F.floor(4 * F.timestamp_diff("SECOND", "a", "arrival_ts") / F.greatest(F.timestamp_diff("SECOND", "a", "z"), F.lit(1))))
    a, z = ends.first()
    cuts = rows.withColumns({"a": F.lit(a), "z": F.lit(z)}).withColumn("part", share).drop("a", "z")
    cuts.write.partitionBy("part").parquet(base + "/all")

    def keep(df, batch_id):
        df.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    fold = session_fold.session_batches(base + "/state", keep, ts="arrival_ts", buckets=8)
    for i in range(4):  # a part's files, as many as its size gives, are one batch
        spark.read.parquet(f"{base}/all").where(F.col("part") == i).select(*rows.columns).write.mode("append").parquet(base + "/in")
        src = spark.readStream.schema(rows.schema).parquet(base + "/in")
        q = src.writeStream.foreachBatch(fold).option("checkpointLocation", base + "/ck").trigger(availableNow=True).start()
        q.awaitTermination()
    return spark.read.parquet(base + "/out").select(
        "event_id", "ip", "session_start", "sessionLength", "clickstream", "successCodes", "errorCodes")


def q_stream_keyed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5 + SNK4: keyed requests in several micro-batches, each merged into the versioned keyed table
    (newest row per ip by arrival), then the table read back."""
    base = _base(spark, "stream_keyed_latest")
    lines = access_log_lines(table(spark, sf_dir, "events"), with_ts=True)
    reqs = parse.keyed_requests(lines, keep=["event_id", "arrival_ts"])
    reqs.repartition(3).write.parquet(base + "/in")
    src = spark.readStream.schema(reqs.schema).option("maxFilesPerTrigger", 1).parquet(base + "/in")
    q = (src.writeStream.foreachBatch(keyed.keyed_upserts(base + "/table", "ip", ["arrival_ts", "event_id"], buckets=8))
         .option("checkpointLocation", base + "/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    return keyed.read_table(spark, base + "/table").select("ip", "url", "status", "agent")


def q_stream_archive_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC7 + SNK3 + A5 A6: conversation texts, one folder per turn, replayed as a stream in (folder,
    file) order, kept batch by batch by the committing sink, and read back with running count,
    characters, integer average and longest.
    As with any text file, a text holding line breaks comes back as several lines."""
    base = _base(spark, "stream_archive_replay")
    conv = table(spark, sf_dir, "conversations").select("turn", "text")
    # Stand-in archive: a folder of text files per turn
    (conv.withColumn("batch", F.format_string("turn_%05d", F.col("turn"))).select("batch", "text")
     .repartition("batch").write.partitionBy("batch").text(base + "/in"))
    lines = archive.replay(spark, base + "/in", dir_glob="batch=turn_*")
    q = (archive.text_batches(lines, base + "/saved").option("checkpointLocation", base + "/ck")
         .trigger(processingTime="100 milliseconds").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    saved = streams.archive_batches(spark, base + "/saved")
    return textstats.length_running(saved.withColumnRenamed("value", "text"), "batch").select(
        "batch", "rows", "chars", "total_rows", "total_chars", "avg_length", "max_length")


def q_archive_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK3 + SRC7 + A5 A6: conversation texts saved one folder per batch (turn), replayed in
    (folder, file) order with running count, characters, integer average and longest.
    As with any text file, a text holding line breaks comes back as several lines."""
    base = _base(spark, "archive_replay")
    conv = table(spark, sf_dir, "conversations").select("turn", "text")
    # SNK3 per batch: the batches here are the turns, landed by one partitioned write
    (conv.withColumn("batch", F.format_string("Tweets_%05d", F.col("turn"))).select("batch", "text")
     .repartition("batch").write.partitionBy("batch").text(base + "/landed"))   # one file per batch folder
    replay = streams.archive_batches(spark, base + "/landed", dir_glob="batch=Tweets_*")
    return textstats.length_running(replay.withColumnRenamed("value", "text"), "batch").select(
        "batch", "rows", "chars", "total_rows", "total_chars", "avg_length", "max_length")


STREAM_QUERIES = {
    "stream_status_hourly": q_stream_status_hourly,
    "stream_session_updates": q_stream_session_updates,
    "stream_top_referrers": q_stream_top_referrers,
    "stream_top_referrers_1s": q_stream_top_referrers_1s,
    "stream_alarms": q_stream_alarms,
    "stream_closed_sessions": q_stream_closed_sessions,
    "stream_session_running": q_stream_session_running,
    "stream_keyed_latest": q_stream_keyed_latest,
    "stream_archive_replay": q_stream_archive_replay,
    "archive_replay": q_archive_replay,
}
