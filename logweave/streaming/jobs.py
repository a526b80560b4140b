"""Structured Streaming forms of the jobs (W1-W5, ST1-ST3, A3, A5, A6, A8, ML1-ML4).

Event-time jobs take a watermark: rows later than it are dropped by Spark and
closed windows/sessions leave the state store.  Ranking (T1) and cross-batch
folds run inside ``foreachBatch`` on the (small) per-batch aggregate output.
State that must survive restarts and executor loss lives either in Spark's
state store (checkpointed) or in a small versioned table under the shared
query's checkpoint (``folder``), written per ``batch_id`` so a replayed batch rewrites the
same version.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from logweave.functions.timecols import duration_us
from logweave.operators import ml, parse, windows
from logweave.operators.sessions import CLICKSTREAM_LIMIT, SESSION_GAP
from logweave.session import scratch_path


def save_state(spark, path: str, values: dict) -> None:
    """Write a one-row state record (works on any Hadoop filesystem, e.g. HDFS or S3)."""
    spark.createDataFrame([(json.dumps(values),)], "state string").coalesce(1).write.mode("overwrite").text(path)


def load_state(spark, path: str) -> dict | None:
    """Read a record written by ``save_state``; None when there is none."""
    try:
        rows = spark.read.text(path).collect()
    except AnalysisException as e:  # only a missing path means "no state"; other failures are raised
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return json.loads(rows[0][0]) if rows else None


def save_version(spark, folder: str, batch_id: int, values: dict) -> None:
    """State after a batch as ``<folder>/v=<batch>``.  A batch may run again, so the version before stays; older ones go."""
    save_state(spark, f"{folder}/v={batch_id}", values)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/v={batch_id - 2}")
    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def with_event_time(df: DataFrame, ts: str, watermark: str, out: str = "event_time") -> DataFrame:
    """Event-time column as TIMESTAMP (watermarks reject TIMESTAMP_NTZ) plus the watermark."""
    return df.withColumn(out, F.col(ts).cast("timestamp")).withWatermark(out, watermark)


# ----------------------------------------------------------------------------- windows
def status_hourly_stream(lines: DataFrame, watermark: str = "2 hours") -> DataFrame:
    """SRC6 P1 P2 P8 F1 W5: requests per status per hour; run in complete mode with
    ``orderBy('window_start')`` (T2) or in append mode (closed hours only)."""
    e = with_event_time(parse.log_entries(lines).select("status", "ts"), "ts", watermark)
    return (e.groupBy(F.window("event_time", "1 hour").alias("w"), "status")
            .agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "status", "count"))


def sliding_counts_stream(df: DataFrame, key: str, ts: str, length: str, slide: str,
                          watermark: str) -> DataFrame:
    """Keyed sliding-window counts as two chained streaming aggregates
    (per-slide buckets, then buckets into windows), append mode."""
    e = with_event_time(df, ts, watermark)
    b = e.groupBy(F.window("event_time", slide).alias("b"), key).agg(F.count(F.lit(1)).alias("_n"))
    w = b.groupBy(F.window(F.window_time("b"), length, slide).alias("w"), key).agg(F.sum("_n").alias("count"))
    return w.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "count")


def top_k_each_batch(key: str, k: int, sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """T1 on a stream: rank the windows that closed in this batch, hand the top ``k`` to ``sink``."""
    def fn(df: DataFrame, batch_id: int) -> None:
        sink(windows.top_k_per_window(df, key, k), batch_id)
    return fn


# ----------------------------------------------------------------------------- sessions
SESSION_OUT = ("event_id long, ip string, ts timestamp, session_start timestamp, sessionLength long, "
               "clickstream array<string>, successCodes long, errorCodes long")
# epoch microseconds of the session's first and last rows
SESSION_STATE = "session_start long, last_ts long, n long, clicks string, ok long, err long"


def _to_ts(us: int, tz: str) -> pd.Timestamp:
    return pd.Timestamp(us, unit="us", tz="UTC").tz_convert(tz).tz_localize(None)


def _to_times(us, tz: str) -> np.ndarray:
    """``_to_ts`` of a whole column."""
    t = np.array(us, dtype="datetime64[us]").astype("datetime64[ns]")
    return t if tz == "UTC" else pd.DatetimeIndex(t, tz="UTC").tz_convert(tz).tz_localize(None).to_numpy()


def _session_update(gap_us: int, limit: int, tz: str = "UTC"):
    """Keyed-state function of ST2: per ip, the open session (start, last time, length, first
    ``limit`` urls, success and error counts) -- bounded state whatever the session length.
    Emits the updated session after every row; the rows of a micro-batch are taken in time order."""
    def to_us(x) -> int:
        # Spark hands pandas naive wall-clock times of the session time zone; the state
        # keeps epoch microseconds of the actual instants, so gaps, the event-time
        # timeout and restarts do not depend on any process's local zone.
        t = pd.Timestamp(x)
        t = t if t.tzinfo else t.tz_localize(tz, ambiguous=False, nonexistent="shift_forward")
        return t.value // 1000

    def fn(key, pdfs, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        if state.exists:
            start, last, n, clicks, okc, errc = state.get
            clicks = json.loads(clicks)
        else:
            start = last = None
            n = okc = errc = 0
            clicks = []
        out = []
        # Spark hands a key's rows over in several chunks (spark.sql.execution.arrow.maxRecordsPerBatch).
        chunks = list(pdfs)
        if chunks:
            for r in pd.concat(chunks, ignore_index=True).sort_values(["ts", "seq"]).itertuples(index=False):
                t = to_us(r.ts)
                if last is None or t > last + gap_us:
                    start, n, okc, errc, clicks = t, 0, 0, 0, []
                n += 1
                if len(clicks) < limit:
                    clicks.append(r.url)
                code = pd.to_numeric(r.status, errors="coerce")
                good = (not pd.isna(code)) and 200 <= int(code) < 400
                okc, errc = okc + int(good), errc + int(not good)
                last = t if last is None or t > last else last
                out.append((r.seq, key[0], _to_ts(t, tz), _to_ts(start, tz), n, list(clicks), okc, errc))
        if last is not None:
            state.update((start, last, n, json.dumps(clicks), okc, errc))
            state.setTimeoutTimestamp(last // 1000 + gap_us // 1000)
        if out:
            yield pd.DataFrame(out, columns=["event_id", "ip", "ts", "session_start", "sessionLength", "clickstream",
                                             "successCodes", "errorCodes"])
    return fn


# Open pieces of sessions as JSON: [[ip, start, last, rows, ok, err, [[time, seq, url], ...]], ...] in epoch microseconds
CLOSED_STATE = "pieces string"
#: State groups of closed_sessions_stream; with many more ips a group holds the open sessions of several.
CLOSED_BUCKETS = 1 << 12


@lru_cache(maxsize=4096)
def _is_good(status) -> bool:
    code = pd.to_numeric(status, errors="coerce")
    return bool(code >= 200) and bool(code < 400)


def _pieces(pdf: pd.DataFrame, gap_us: int, limit: int) -> list[list]:
    """Sessions within some rows of any ips, in any order."""
    code, ips = pd.factorize(pdf["ip"])
    ips = [*ips, None]  # null ips have code -1
    us, seq = pdf["us"].to_numpy(), pdf["seq"].to_numpy()
    order = np.lexsort((seq, us, code))
    us, code = us[order], code[order]
    url, status = pdf["url"].tolist(), pdf["status"].tolist()
    good = np.concatenate([[0], np.cumsum([_is_good(status[i]) for i in order.tolist()])])
    edge = np.concatenate([[0], np.flatnonzero((np.diff(us) > gap_us) | (code[1:] != code[:-1])) + 1, [len(us)]])
    oks, whose = np.diff(good[edge]).tolist(), code[edge[:-1]].tolist()
    # Plain numbers of whole columns at once: one row is the commonest session.
    at, us, edge, seq = order.tolist(), us.tolist(), edge.tolist(), seq[order].tolist()
    return [[ips[c], us[a], us[b - 1], b - a, ok, b - a - ok, [[us[i], seq[i], url[at[i]]] for i in range(a, min(b, a + limit))]]
            for a, b, ok, c in zip(edge, edge[1:], oks, whose)]


def _joined(pieces: list[list], gap_us: int, limit: int) -> list[list]:
    """Pieces of one ip that lie within ``gap_us`` of each other as one; the same for every order of arrival."""
    out: list[list] = []
    for p in sorted(pieces, key=lambda p: (p[0] is None, p[0] or "", p[1], p[2])):
        if out and p[0] == out[-1][0] and p[1] <= out[-1][2] + gap_us:
            q = out[-1]
            out[-1] = [q[0], q[1], max(q[2], p[2]), q[3] + p[3], q[4] + p[4], q[5] + p[5],
                       sorted(q[6] + p[6], key=lambda c: c[:2])[:limit]]
        else:
            out.append(p)
    return out


def _session_close(gap_us: int, limit: int, tz: str = "UTC"):
    """Keyed-state function of ST1: the open sessions of a group of ips as pieces that join in any
    order of rows; each is emitted once, when the watermark has passed its last row by ``gap``, so
    that no later row can belong to it."""
    def fn(key, pdfs, state: GroupState):
        open_ = json.loads(state.get[0]) if state.exists else []
        if not state.hasTimedOut:
            fresh: list[list] = []
            for pdf in pdfs:
                fresh += _pieces(pdf, gap_us, limit) if len(pdf) else []
                if len(fresh) > len(open_) + 10_000:
                    open_, fresh = _joined(open_ + fresh, gap_us, limit), []
            open_ = _joined(open_ + fresh, gap_us, limit)
        passed = state.getCurrentWatermarkMs() * 1000
        closed = [p for p in open_ if p[2] + gap_us < passed]
        open_ = [p for p in open_ if p[2] + gap_us >= passed]
        if open_:
            state.update((json.dumps(open_),))
            state.setTimeoutTimestamp((min(p[2] for p in open_) + gap_us) // 1000)
        elif state.exists:
            state.remove()
        if closed:
            ip, start, end, n, ok, err, clicks = zip(*closed)
            yield pd.DataFrame(dict(zip(CLOSED_COLUMNS, (
                pd.Series(ip, dtype=object), _to_times(start, tz), _to_times(end, tz), np.array(n, dtype=np.int64),
                pd.Series([[c[2] for c in first] for first in clicks], dtype=object),
                np.array(ok, dtype=np.int64), np.array(err, dtype=np.int64)))))
    return fn


CLOSED_COLUMNS = ["ip", "session_start", "session_end", "sessionLength", "clickstream", "successCodes", "errorCodes"]
CLOSED_OUT = ("ip string, session_start timestamp, session_end timestamp, sessionLength long, "
              "clickstream array<string>, successCodes long, errorCodes long")


def _session_tz(df: DataFrame) -> str:
    return df.sparkSession.conf.get("spark.sql.session.timeZone")


def closed_sessions_stream(rows: DataFrame, ts: str = "ts", seq: str = "event_id", gap: str = SESSION_GAP,
                           watermark: str = "1 hour", limit: int = CLICKSTREAM_LIMIT,
                           buckets: int = CLOSED_BUCKETS) -> DataFrame:
    """ST1 + T4 on a stream: one row per session once it has closed (append mode).

    Keyed state holds only the open sessions' counters and first ``limit`` urls, so a
    session of any length costs the same state.  A state group is one of ``buckets`` hash
    buckets of ips, since a call of the state function costs more than an ip's rows; an ip is
    in one bucket only, and the number, fixed for a checkpoint, bounds the calls of a batch.
    Rows may come in any order within the watermark; rows without a time are dropped, as in
    the batch form.  Input columns: ip, url, status, ``ts``, ``seq``."""
    e = (rows.select("ip", "url", "status", F.col(ts).cast("timestamp").alias("ts"), F.col(seq).alias("seq")).where("ts is not null")
         .withColumns({"us": F.unix_micros("ts"), "bucket": F.pmod(F.xxhash64("ip"), F.lit(buckets)).cast("int")})
         .withWatermark("ts", watermark))
    return e.groupBy("bucket").applyInPandasWithState(
        _session_close(duration_us(gap), limit, tz=_session_tz(rows)), CLOSED_OUT, CLOSED_STATE, "append",
        GroupStateTimeout.EventTimeTimeout)


def session_updates_stream(rows: DataFrame, ts: str = "ts", seq: str = "event_id", gap: str = SESSION_GAP,
                           watermark: str = "1 hour", limit: int = CLICKSTREAM_LIMIT) -> DataFrame:
    """ST2: per-ip keyed state, one output row per input row with the updated session;
    event-time timeout closes a session ``gap`` after its last row (state removed).
    Input columns: ip, url, status, ``ts``, ``seq``.  Run in update (or append) mode."""
    e = (rows.select("ip", "url", "status", F.col(ts).cast("timestamp").alias("ts"), F.col(seq).alias("seq"))
         .withWatermark("ts", watermark))
    return e.groupBy("ip").applyInPandasWithState(
        _session_update(duration_us(gap), limit, tz=_session_tz(rows)), SESSION_OUT, SESSION_STATE, "append",
        GroupStateTimeout.EventTimeTimeout)


def live_session_snapshot(spark, checkpoint_location: str, batch_id: int | None = None) -> DataFrame:
    """ST3 on a stream: every session held in the keyed state of ``session_updates_stream``,
    read from the query's checkpoint with Spark's state-store reader: after ``batch_id``, whose
    rows must have been computed, or after the latest committed batch.  Timed-out sessions have been removed from the state, so these are the live ones."""
    r = spark.read.format("statestore")
    st = (r if batch_id is None else r.option("batchId", batch_id)).load(checkpoint_location)
    v = F.col("value")["groupState"]     # Pandas keyed state: (groupState, timeoutTimestamp)
    return st.select(
        F.col("key")["ip"].alias("ip"),
        F.timestamp_micros(v["session_start"]).cast("timestamp_ntz").alias("session_start"),
        F.timestamp_micros(v["last_ts"]).cast("timestamp_ntz").alias("session_end"),
        v["n"].alias("sessionLength"),
        F.from_json(v["clicks"], "array<string>").alias("clickstream"),
        v["ok"].alias("successCodes"), v["err"].alias("errorCodes"))


# ----------------------------------------------------------------------------- running totals
def length_totals_stream(texts: DataFrame, text: str = "text") -> DataFrame:
    """A5 + A6 on a stream: running count, characters, integer average and longest text
    (one global aggregate; run in complete or update mode)."""
    ln = F.length(text).cast("long")
    agg = texts.agg(F.count(F.lit(1)).alias("total_rows"), F.sum(ln).alias("total_chars"),
                    F.max(ln).alias("max_length"))
    return agg.withColumn("avg_length", F.floor(F.col("total_chars") / F.col("total_rows")).cast("long"))


class BatchCap:
    """A8 on a stream: hand each non-empty batch to ``sink`` and stop the query after the
    batch that takes the running row count past ``cap``.  The count is kept in a
    versioned file per batch so a restarted query resumes it."""

    def __init__(self, spark, sink: Callable[[DataFrame, int], None], cap: int = 1000, name: str = "batch_cap",
                 folder: str | None = None):
        self.sink, self.cap = sink, cap
        self.dir = folder or scratch_path(spark, name)
        self.total = 0
        self.done = False   # the driver stops the query once set (not from inside the batch)

    def _read(self, spark, batch_id: int) -> int:
        st = load_state(spark, f"{self.dir}/v={batch_id - 1}") if batch_id > 0 else None
        return st["total"] if st else self.total

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        before = self._read(df.sparkSession, batch_id)
        if before > self.cap:  # saved again, so that a restart finds the newest version
            self.total, self.done = before, True
            save_version(df.sparkSession, self.dir, batch_id, {"total": self.total})
            return
        n = df.count()
        if n:
            self.sink(df, batch_id)
        self.total = before + n
        save_version(df.sparkSession, self.dir, batch_id, {"total": self.total})
        self.done = self.total > self.cap


def word_counts_each_batch(sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A3: word counts inside each batch, no carry-over (partial + final aggregate)."""
    def fn(df: DataFrame, batch_id: int) -> None:
        from logweave.operators.textstats import word_counts, words
        sink(word_counts(words(df, lower=False)), batch_id)
    return fn


# ----------------------------------------------------------------------------- ML
class StreamingKMeans:
    """ML1/ML2 on streams: ``train`` is a foreachBatch function updating the model, whose
    k centers are saved per batch so a restart resumes from the last batch."""

    def __init__(self, spark, model: ml.KMeansModel, features: str = "features", name: str = "kmeans",
                 folder: str | None = None):
        self.spark, self.model, self.features = spark, model, features
        self.dir = folder or scratch_path(spark, name)
        self._resumed = False

    def _resume(self, batch_id: int) -> None:
        """After a restart the stream continues at ``batch_id``: reload the model it left."""
        self._resumed = True
        st = load_state(self.spark, f"{self.dir}/v={batch_id - 1}") if batch_id > 0 else None
        if st:
            import numpy as np
            self.model = ml.KMeansModel(np.array(st["centers"]), np.array(st["weights"]), self.model.decay)

    def train(self, df: DataFrame, batch_id: int) -> None:
        if not self._resumed:
            self._resume(batch_id)
        df.persist()
        try:
            if df.count():  # whole batch computed once, reused by the update; an empty one saves the model it found
                self.model = ml.kmeans_update(self.model, df, self.features)
        finally:
            df.unpersist()
        save_version(self.spark, self.dir, batch_id,
                   {"centers": self.model.centers.tolist(), "weights": self.model.weights.tolist()})

    def predict(self, df: DataFrame) -> DataFrame:
        return ml.kmeans_predict(df, self.model, self.features)


class StreamingRegression:
    """ML3/ML4 on streams: full-batch SGD per micro-batch, weight carried across batches."""

    def __init__(self, spark, label: str = "label", feature: str = "x", name: str = "linreg",
                 folder: str | None = None):
        self.model = ml.LinearModel()
        self.label, self.feature = label, feature
        self.dir = folder or scratch_path(spark, name)
        self._resumed = False

    def train(self, df: DataFrame, batch_id: int) -> None:
        if not self._resumed:
            self._resumed = True
            st = load_state(df.sparkSession, f"{self.dir}/v={batch_id - 1}") if batch_id > 0 else None
            if st:
                self.model = ml.LinearModel(st["weight"], st["intercept"])
        df.persist()
        try:
            if df.count():
                self.model = ml.linreg_update(self.model, df, self.label, self.feature)
        finally:
            df.unpersist()
        save_version(df.sparkSession, self.dir, batch_id,
                   {"weight": self.model.weight, "intercept": self.model.intercept})

    def predict(self, df: DataFrame) -> DataFrame:
        return ml.linreg_predict(df, self.model, self.feature)

