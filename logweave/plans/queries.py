"""Named queries over the test tables: ``(spark, sf_dir) -> DataFrame``.

Each query wires table sources into the library operators with fixed parameters.
Every query reads whole tables; nothing is sampled or capped (limits appear only
where top-k is the feature).  Parameters are chosen for the density of the test
``events`` table (about 14 rows an hour at sf0.01), as the 1-second, 300-second
defaults of the reference would leave nearly every window with one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.operators import alarm_fold, alarms, ml, parse, sessions, splits, textstats, windows
from logweave.sources import streams
from logweave.sources.eventlog import access_log_lines
from logweave.sources.tables import table

# Query parameters (own choices for the test tables)
SLIDING_LENGTH, SLIDING_SLIDE = "300 seconds", "60 seconds"
ALARM_WINDOW, ALARM_SLIDE = "12 hours", "10 minutes"
ALARM_MAX_RATIO = 0.4
ALARM_TIMEOUT = "20 minutes"     # two ticks of ALARM_SLIDE
HOLDOUT_START, HOLDOUT_STOP = 11, 20


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def _lines(spark: SparkSession, sf_dir: str, with_ts: bool = False) -> DataFrame:
    return access_log_lines(_events(spark, sf_dir), with_ts=with_ts)


# ----------------------------------------------------------------------------- log jobs
def q_log_entries(spark, sf_dir):
    """Parsed, typed log entries of all valid lines."""
    return parse.log_entries(_lines(spark, sf_dir), keep=["event_id"])


def q_status_hourly(spark, sf_dir):
    """W5 + T2: requests per status per 1-hour tumbling window, ordered by window."""
    e = parse.log_entries(_lines(spark, sf_dir)).select("status", "ts")
    return windows.windowed_counts(e, "status", "ts", "1 hour").orderBy("window_start", "status")


def q_requests_by_agent(spark, sf_dir):
    """P4 + A4: rows per agent (bad lines count under 'error')."""
    r = parse.requests(_lines(spark, sf_dir))
    return r.groupBy("agent").agg(F.count(F.lit(1)).alias("count"))


def q_requests_keyed_latest(spark, sf_dir):
    """P5 + SNK4 upsert semantics: the last row written per ip key wins.

    ``max_by`` is a partial aggregate, so a hot ip is reduced map-side."""
    r = parse.keyed_requests(_lines(spark, sf_dir, with_ts=True), keep=["event_id", "arrival_ts"])
    last = F.max_by(F.struct("url", "status", "agent"), F.struct("arrival_ts", "event_id"))
    return r.groupBy("ip").agg(last.alias("r")).select("ip", "r.url", "r.status", "r.agent")


def _top_field(spark, sf_dir, field, k):
    f = parse.field_or_error(_lines(spark, sf_dir, with_ts=True), field, keep=["arrival_ts"])
    counts = windows.windowed_counts(f, field, "arrival_ts", SLIDING_LENGTH, SLIDING_SLIDE)
    return windows.top_k_per_window(counts, field, k)


def q_top_referrers(spark, sf_dir):
    """Top 5 referers per sliding window (arrival time)."""
    return _top_field(spark, sf_dir, "referer", 5)


def q_top_agents(spark, sf_dir):
    """Top 5 user agents per sliding window."""
    return _top_field(spark, sf_dir, "agent", 5)


def q_top_urls_strict(spark, sf_dir):
    """Lines arrive as bytes, strict url, top 10 per sliding window."""
    raw = _lines(spark, sf_dir, with_ts=True).select(F.encode("value", "UTF-8").alias("body"), "arrival_ts")
    urls = parse.strict_urls(parse.decode_payload(raw, keep=["arrival_ts"]), keep=["arrival_ts"])
    counts = windows.windowed_counts(urls, "url", "arrival_ts", SLIDING_LENGTH, SLIDING_SLIDE)
    return windows.top_k_per_window(counts, "url", 10)


def _class_totals(spark, sf_dir):
    return windows.status_class_totals(status_classes_at(spark, sf_dir), "arrival_ts", ALARM_WINDOW, ALARM_SLIDE)


def q_status_class_window(spark, sf_dir):
    """Successes and failures per sliding window."""
    return _class_totals(spark, sf_dir)


def q_error_ratio_alarms(spark, sf_dir):
    """AL1 AL2: windows with enough rows, their ratio and alarm state."""
    return alarms.error_ratio_alarms(_class_totals(spark, sf_dir), max_ratio=ALARM_MAX_RATIO)


def q_no_data_alarms(spark, sf_dir):
    """AL3: alarms for data gaps longer than 600 s (1-second batches)."""
    return alarms.no_data_alarms(_events(spark, sf_dir), ts="ts")


def status_classes_at(spark, sf_dir):
    return parse.status_classes(_lines(spark, sf_dir, with_ts=True), keep=["arrival_ts"])


def q_alarms_one_clock(spark, sf_dir):
    """AL1 AL2 AL3 with one clock: fired alarms of both kinds up to the last arrival."""
    c = status_classes_at(spark, sf_dir)
    last = c.select(F.max("arrival_ts")).scalar()
    return alarm_fold.alarms_one_clock(c, "arrival_ts", ALARM_WINDOW, ALARM_SLIDE, max_ratio=ALARM_MAX_RATIO,
                                       timeout=ALARM_TIMEOUT, until=last)


# ----------------------------------------------------------------------------- sessions
def _session_rows(spark, sf_dir):
    return parse.session_requests(_lines(spark, sf_dir, with_ts=True), keep=["event_id", "arrival_ts"])


def q_sessions(spark, sf_dir):
    """P6 P10 ST1 T4: sessions per ip (30-min idle gap), first 10 urls, success/error counts."""
    return sessions.sessions(_session_rows(spark, sf_dir), ts="arrival_ts")


def q_session_running(spark, sf_dir):
    """ST2: the session state emitted after every input row."""
    s = sessions.session_updates(_session_rows(spark, sf_dir), ts="arrival_ts")
    return s.select("event_id", "ip", "session_start", "sessionLength", "clickstream", "successCodes", "errorCodes")


def q_session_snapshot(spark, sf_dir):
    """ST3: sessions still live at the last arrival time."""
    rows = _session_rows(spark, sf_dir)
    last = rows.select(F.max("arrival_ts")).scalar()
    return sessions.live_sessions(sessions.sessions(rows, ts="arrival_ts"), last)


# ----------------------------------------------------------------------------- text jobs
def _doc_lines(spark, sf_dir):
    return textstats.lines_of(table(spark, sf_dir, "documents"))


def q_line_count(spark, sf_dir):
    """SRC5 A1: lines across all documents."""
    return textstats.line_count(_doc_lines(spark, sf_dir))


def q_word_count(spark, sf_dir):
    """Lower-cased space-split words over all document lines."""
    return textstats.word_counts(textstats.words(_doc_lines(spark, sf_dir)))


def q_word_count_by_batch(spark, sf_dir):
    """Per batch (conversation turn) word counts, no lower-casing."""
    conv = table(spark, sf_dir, "conversations")
    w = textstats.words(conv.withColumnRenamed("text", "value"), lower=False, keep=["turn"])
    return textstats.word_counts(w, by=["turn"])


def q_top_clean_words(spark, sf_dir):
    """Top 10 cleaned words per source."""
    docs = table(spark, sf_dir, "documents")
    return textstats.top_words(textstats.clean_word_rows(docs, keep=["source"]), "source", 10)


def q_event_type_10s(spark, sf_dir):
    """Event types per 10-second tumbling window."""
    return windows.windowed_counts(_events(spark, sf_dir), "event_type", "ts", "10 seconds")


def q_text_length_running(spark, sf_dir):
    """Running text count, characters, integer average and longest, batch = source."""
    return textstats.length_running(table(spark, sf_dir, "documents"), "source")


def q_take_batches_until(spark, sf_dir):
    """Conversation turns as batches, stop after the running count passes 1000."""
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return textstats.take_batches_until(conv, "turn")


def _responses(spark, sf_dir):
    """Conversation rows packed into API-like JSON responses, with malformed variants."""
    conv = table(spark, sf_dir, "conversations")
    ok = F.to_json(F.struct(F.array(F.struct(F.col("text").alias("text"))).alias("data")))
    no_text = F.to_json(F.struct(F.array(F.struct(F.col("role").alias("author"))).alias("data")))
    value = (F.when(F.col("turn") % 5 == 4, F.lit('{"meta": {"result_count": 0}}'))
             .when((F.col("conv_id") % 11 == 0) & (F.col("turn") == 0), no_text)
             .when((F.col("conv_id") % 13 == 0) & (F.col("turn") == 1), F.concat(F.lit('{"data": ['), F.col("text")))
             .otherwise(ok))
    return conv.select("conv_id", "turn", value.alias("value"))


def q_json_texts(spark, sf_dir):
    """SRC8: texts out of JSON responses (missing text -> '', bad JSON / no data -> no row)."""
    return streams.response_texts(_responses(spark, sf_dir), keep=["conv_id", "turn"]).drop("item_pos")


def q_labeled_points(spark, sf_dir):
    """SRC9: lineitem rows written as '(label,[f1,f2])' text and parsed back."""
    li = table(spark, sf_dir, "lineitem")
    txt = F.concat(F.lit("("), F.col("l_linenumber").cast("string"), F.lit(",["),
                   F.col("l_quantity").cast("decimal(18,2)").cast("string"), F.lit(","),
                   F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), F.lit("])"))
    lp = li.select("l_orderkey", "l_linenumber", streams.parse_labeled_point(txt).alias("p"))
    return lp.select("l_orderkey", "l_linenumber", F.col("p.label").alias("label"),
                     F.col("p.features").alias("features"))


# ----------------------------------------------------------------------------- splits
def q_kfold(spark, sf_dir):
    """SP1: 5 positional folds of orders in o_orderkey order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return splits.kfold_positional(o, ["o_orderkey"], 5)


def q_user_holdout(spark, sf_dir):
    """SP2: each customer's orders number 11..20 (in o_orderkey order) are test rows."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return splits.user_holdout(o, "o_custkey", ["o_orderkey"], HOLDOUT_START, HOLDOUT_STOP)


# ----------------------------------------------------------------------------- ML
def _kmeans_model(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return emb, ml.KMeansModel.from_rows(emb, "embedding", "vec_id", ml.KMEANS_K)


def q_kmeans_assign(spark, sf_dir):
    """ML2: nearest of the initial centers (first 5 vectors), known label carried."""
    emb, model = _kmeans_model(spark, sf_dir)
    return ml.kmeans_predict(emb.select("vec_id", "label", "embedding"), model, "embedding").drop("embedding")


def q_kmeans_step(spark, sf_dir):
    """ML1: the model after one streaming k-means batch over all embeddings."""
    emb, model = _kmeans_model(spark, sf_dir)
    return ml.kmeans_model_frame(spark, ml.kmeans_update(model, emb, "embedding"))


def q_kmeans_label_counts(spark, sf_dir):
    """ML2: (known label, predicted cluster) counts for the initial centers."""
    emb, model = _kmeans_model(spark, sf_dir)
    return ml.label_cluster_counts(ml.kmeans_predict(emb.select("label", "embedding"), model, "embedding"))


def _regression_frame(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    z = ml.zscore(li, ["l_quantity", "l_extendedprice"])
    return z.select("l_orderkey", "l_linenumber", F.col("l_quantity_z").alias("x"),
                    F.col("l_extendedprice_z").alias("label"))


def q_linreg_fit(spark, sf_dir):
    """ML3: streaming linear regression trained on one batch (z-scored quantity -> price)."""
    data = _regression_frame(spark, sf_dir)
    m = ml.linreg_update(ml.LinearModel(), data)
    return spark.createDataFrame([(round(m.weight, 6), round(m.intercept, 6), m.iterations)],
                                 "weight double, intercept double, iterations int")


def q_linreg_predict(spark, sf_dir):
    """ML4: predictions with the trained model, known label carried."""
    data = _regression_frame(spark, sf_dir)
    m = ml.linreg_update(ml.LinearModel(), data)
    return ml.linreg_predict(data, m).select("l_orderkey", "l_linenumber", F.round("label", 6).alias("label"),
                                             F.round("prediction", 6).alias("prediction"))


def q_linreg_rmse(spark, sf_dir):
    """ML4: RMSE of the trained model's predictions on the z-scored data."""
    data = _regression_frame(spark, sf_dir)
    m = ml.linreg_update(ml.LinearModel(), data)
    return ml.rmse(ml.linreg_predict(data, m)).select(F.round("rmse", 6).alias("rmse"), "n")


QUERIES = {
    "log_entries": q_log_entries,
    "status_hourly": q_status_hourly,
    "requests_by_agent": q_requests_by_agent,
    "requests_keyed_latest": q_requests_keyed_latest,
    "top_referrers": q_top_referrers,
    "top_agents": q_top_agents,
    "top_urls_strict": q_top_urls_strict,
    "status_class_window": q_status_class_window,
    "error_ratio_alarms": q_error_ratio_alarms,
    "no_data_alarms": q_no_data_alarms,
    "alarms_one_clock": q_alarms_one_clock,
    "sessions": q_sessions,
    "session_running": q_session_running,
    "session_snapshot": q_session_snapshot,
    "line_count": q_line_count,
    "word_count": q_word_count,
    "word_count_by_batch": q_word_count_by_batch,
    "top_clean_words": q_top_clean_words,
    "event_type_10s": q_event_type_10s,
    "text_length_running": q_text_length_running,
    "take_batches_until": q_take_batches_until,
    "json_texts": q_json_texts,
    "labeled_points": q_labeled_points,
    "kfold": q_kfold,
    "user_holdout": q_user_holdout,
    "kmeans_assign": q_kmeans_assign,
    "kmeans_step": q_kmeans_step,
    "linreg_fit": q_linreg_fit,
    "linreg_predict": q_linreg_predict,
    "kmeans_label_counts": q_kmeans_label_counts,
    "linreg_rmse": q_linreg_rmse,
}

from logweave.plans.stream_queries import STREAM_QUERIES  # noqa: E402

QUERIES.update(STREAM_QUERIES)
