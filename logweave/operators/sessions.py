"""Per-key sessions with an idle gap (ST1-ST3, T4, P10).

A session of a key (ip) is a run of rows where consecutive rows are at most
``gap`` apart; a row more than ``gap`` after the previous row of the same key
starts a new session (rows exactly ``gap`` apart stay together).

Skew: one ip may own a third of all rows, so no step orders a whole key's rows
in one task.  Time is cut into chunks no longer than ``gap``.  Two rows of one
chunk are less than ``gap`` apart, so a session can only start at the first row
of a chunk, and whether it does follows from a per-(key, chunk) summary alone:

1. ``summary``: per (key, chunk) first/last time, row and success counts --
   a partial (map-side combined) aggregate, one row per occupied key-chunk;
2. over the summary (ordered by chunk within a key, one row per occupied chunk,
   bounded by time span / chunk): a chunk starts a session when its first row is
   more than ``gap`` after the previous chunk's last row; ``session_start`` is
   carried forward from the last starting chunk;
3. session totals are sums of chunk summaries; the first 10 urls are the first 10
   rows of each chunk (``row_number() <= 10`` is limited map-side before the
   shuffle), then of each session.

Rows reach a shuffle only after map-side reduction (partial aggregates, partial
group limits); ST2's per-row running counts shuffle rows once, by (key, chunk).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.functions.accesslog import is_success_code
from logweave.functions.timecols import duration_us
from logweave.session import cut

# --- Fixed values: must equal the reference's session state ---------------------------------
SESSION_GAP = "30 minutes"
CLICKSTREAM_LIMIT = 10
# --- end of fixed values ----------------------------------------------------------------------

_K = "_skey"   # non-null surrogate of the key: NULL ips form their own key


def _surrogate(key: str) -> Column:
    # Provably non-null (coalesce with a literal), so joins on it infer no IS NOT NULL
    # filter that the optimizer would push down into the line parsing.
    return F.coalesce(F.concat(F.lit("1"), F.col(key).cast("string")), F.lit("0"))


def _chunk_len(gap: str, chunk: str | None) -> str:
    if chunk is None:
        return gap
    if duration_us(chunk) > duration_us(gap):
        raise ValueError("chunk must not be longer than the session gap")
    return chunk


def _prepare(rows: DataFrame, key: str, ts: str, status: str, gap: str, chunk: str | None) -> DataFrame:
    return (rows.where(F.col(ts).isNotNull())
            .withColumn(_K, _surrogate(key))
            .withColumn("_chunk", F.window(ts, _chunk_len(gap, chunk))["start"])
            .withColumn("_ok", is_success_code(F.col(status)).cast("long")))


def chunk_sessions(prepared: DataFrame, key: str, ts: str, gap: str, with_before: bool = True,
                   summary: DataFrame | None = None) -> DataFrame:
    """Per (key, chunk): session_start, chunk totals and (``with_before``) the session's
    totals in its earlier chunks.  ``summary`` (``_K, _chunk, key, _first, _last, _n, _s``)
    may be given when the caller already has it."""
    gap_us = duration_us(gap)
    summ = summary if summary is not None else prepared.groupBy(_K, "_chunk").agg(
        F.first(key).alias(key), F.min(ts).alias("_first"), F.max(ts).alias("_last"),
        F.count(F.lit(1)).alias("_n"), F.sum("_ok").alias("_s"))
    by_key = Window.partitionBy(_K).orderBy("_chunk")
    prev_last = F.lag("_last").over(by_key)
    starts = prev_last.isNull() | (F.col("_first") > F.timestamp_add("MICROSECOND", F.lit(gap_us), prev_last))
    summ = summ.withColumn("_start_here", F.when(starts, F.col("_first")))
    summ = summ.withColumn("session_start", F.last("_start_here", ignorenulls=True).over(
        by_key.rowsBetween(Window.unboundedPreceding, 0)))
    summ = summ.drop("_start_here")
    if not with_before:
        return summ
    before = Window.partitionBy(_K, "session_start").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return (summ.withColumn("_n_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
            .withColumn("_s_before", F.coalesce(F.sum("_s").over(before), F.lit(0))))


def _first_urls(prepared: DataFrame, chunks: DataFrame, ts: str, order: Sequence[str], url: str,
                limit: int, numbered: bool = False) -> DataFrame:
    """First ``limit`` urls per session.  ``numbered``: ``prepared`` already carries ``_rn``,
    the row number inside its (key, chunk) piece."""
    if numbered:
        head = prepared.where(F.col("_rn") <= limit)
    else:
        w_piece = Window.partitionBy(_K, "_chunk").orderBy(ts, *order)
        head = prepared.withColumn("_rn", F.row_number().over(w_piece)).where(F.col("_rn") <= limit)
    head = head.join(chunks.select(_K, "_chunk", "session_start"), on=[_K, "_chunk"])
    w_sess = Window.partitionBy(_K, "session_start").orderBy(ts, *order)
    top = head.withColumn("_rs", F.row_number().over(w_sess)).where(F.col("_rs") <= limit)
    return (top.groupBy(_K, "session_start")
            .agg(F.array_sort(F.collect_list(F.struct("_rs", F.col(url).alias("u")))).alias("_l"))
            .select(_K, "session_start", F.transform("_l", lambda x: x["u"]).alias("clickstream")))


def sessions(rows: DataFrame, key: str = "ip", ts: str = "ts", order: Sequence[str] = ("event_id",),
             url: str = "url", status: str = "status", gap: str = SESSION_GAP,
             limit: int = CLICKSTREAM_LIMIT, chunk: str | None = "15 minutes") -> DataFrame:
    """ST1 + T4: one row per session with length, first ``limit`` urls, success/error counts."""
    p = _prepare(rows, key, ts, status, gap, chunk)
    # one row per occupied (key, chunk); read twice below, so written once instead of
    # rescanning and reparsing the input for each reader
    chunks = cut(chunk_sessions(p, key, ts, gap, with_before=False))
    agg = chunks.groupBy(_K, "session_start").agg(
        F.first(key).alias(key), F.max("_last").alias("session_end"),
        F.sum("_n").alias("sessionLength"), F.sum("_s").alias("successCodes"))
    urls = _first_urls(p, chunks, ts, order, url, limit)
    return agg.join(urls, on=[_K, "session_start"]).select(
        key, "session_start", "session_end", "sessionLength", "clickstream", "successCodes",
        (F.col("sessionLength") - F.col("successCodes")).alias("errorCodes"))


def session_updates(rows: DataFrame, key: str = "ip", ts: str = "ts", order: Sequence[str] = ("event_id",),
                    url: str = "url", status: str = "status", gap: str = SESSION_GAP,
                    limit: int = CLICKSTREAM_LIMIT, chunk: str | None = "15 minutes") -> DataFrame:
    """ST2: the session state after each input row (what the keyed-state function emits).

    Rows are shuffled once, by (key, chunk): the running counts inside each piece, the
    piece summary (an aggregate on the same partitioning) and the first urls of each
    piece all come from that one windowed pass, checkpointed once; each row's counts
    are then offset by the same session's totals in earlier chunks."""
    p = _prepare(rows, key, ts, status, gap, chunk)
    w_run = Window.partitionBy(_K, "_chunk").orderBy(ts, *order).rowsBetween(Window.unboundedPreceding, 0)
    # Three consumers read this table; column pruning would give each its own scan, parse
    # and row shuffle, so it is written once (the checkpoint keeps the (key, chunk)
    # partitioning, and the summary below aggregates on it without a new shuffle).
    run = cut(p.withColumn("_rn", F.count(F.lit(1)).over(w_run)).withColumn("_rs", F.sum("_ok").over(w_run)))
    summary = run.groupBy(_K, "_chunk").agg(
        F.first(key).alias(key), F.min(ts).alias("_first"), F.max(ts).alias("_last"),
        F.max("_rn").alias("_n"), F.max("_rs").alias("_s"))
    chunks = chunk_sessions(p, key, ts, gap, summary=summary)
    s = run.join(chunks.select(_K, "_chunk", "session_start", "_n_before", "_s_before"), on=[_K, "_chunk"])
    s = s.join(_first_urls(run, chunks, ts, order, url, limit, numbered=True), on=[_K, "session_start"])
    length = F.col("_rn") + F.col("_n_before")
    success = F.col("_rs") + F.col("_s_before")
    return s.select(
        *[c for c in rows.columns if c != key], key, "session_start",
        length.alias("sessionLength"),
        F.slice("clickstream", 1, F.least(length, F.lit(limit)).cast("int")).alias("clickstream"),
        success.alias("successCodes"),
        (length - success).alias("errorCodes"))


def live_sessions(session_table: DataFrame, as_of, gap: str = SESSION_GAP) -> DataFrame:
    """ST3: sessions still open at ``as_of`` (last row no more than ``gap`` before it)."""
    return session_table.where(
        F.col("session_end") >= F.timestamp_add("MICROSECOND", F.lit(-duration_us(gap)), as_of))


def assign_sessions(rows: DataFrame, key: str = "ip", ts: str = "ts", gap: str = SESSION_GAP,
                    chunk: str | None = "15 minutes", status: str = "status") -> DataFrame:
    """Each row with its ``session_start``."""
    p = _prepare(rows, key, ts, status, gap, chunk)
    chunks = chunk_sessions(p, key, ts, gap, with_before=False).select(_K, "_chunk", "session_start")
    return p.join(chunks, on=[_K, "_chunk"]).drop(_K, "_chunk", "_ok")
