"""ST2 for hot keys: session updates of whole micro-batches by DataFrame operators.

Inside a micro-batch the batch operator cuts every key into time pieces, so a key with a third
of all rows is spread over tasks and no Python touches a row.  What a key carries from batch to
batch is one row (open session: start, end, counts, first urls) in the versioned keyed table of
``streaming.keyed``: a batch's first session of a key goes on with the carried one when it starts
within the gap of its end, and every key's last session is merged back.  A repeated batch starts
from the state before it.  No watermark is needed; a row older than the open session that comes
in a later batch counts to that session, as with keyed state.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.functions.timecols import duration_us
from logweave.operators.sessions import CLICKSTREAM_LIMIT, SESSION_GAP, live_sessions, session_updates
from logweave.session import cut
from logweave.streaming import keyed

_STATE = ["ip", "session_start", "session_end", "sessionLength", "clickstream", "successCodes", "errorCodes"]


def session_batches(root: str, sink: Callable[[DataFrame, int], None], ts: str = "ts", seq: str = "event_id",
                    gap: str = SESSION_GAP, limit: int = CLICKSTREAM_LIMIT, buckets: int = keyed.BUCKETS):
    """``foreachBatch`` function: (ip, url, status, ``ts``, ``seq``) rows to one updated session per row, given to
    ``sink`` (which must bear a repeated batch); the carried sessions live in the keyed table at ``root``.
    Rows without a time are dropped."""
    def fn(df: DataFrame, batch_id: int) -> None:
        rows = df.select("ip", "url", "status", ts, seq)
        out = session_updates(rows, "ip", ts, [seq], gap=gap, limit=limit)
        out = cut(out.select(seq, ts, *[c for c in _STATE if c != "session_end"]))
        held = keyed.read_table(df.sparkSession, root, before=batch_id)
        if held is not None:
            first = out.groupBy("ip").agg(F.min("session_start").alias("_first"))
            c = held.select(*[F.col(x).alias(f"c_{x}") for x in _STATE]).join(first, F.col("c_ip").eqNullSafe(F.col("ip"))).where(
                F.col("_first") <= F.timestamp_add("MICROSECOND", F.lit(duration_us(gap)), F.col("c_session_end"))).drop("ip")
            out = out.join(c, F.col("ip").eqNullSafe(F.col("c_ip")) & (F.col("session_start") == F.col("_first")), "left")
            plus = lambda x: (F.col(x) + F.coalesce(f"c_{x}", F.lit(0))).alias(x)
            urls = F.slice(F.concat(F.coalesce("c_clickstream", F.array().cast("array<string>")), "clickstream"), 1, limit)
            out = out.select(seq, ts, "ip", F.coalesce("c_session_start", "session_start").alias("session_start"), plus("sessionLength"),
                             urls.alias("clickstream"), plus("successCodes"), plus("errorCodes"), "c_session_end")
        else:
            out = out.withColumn("c_session_end", F.lit(None).cast(out.schema[ts].dataType))
        sink(out.drop("c_session_end"), batch_id)
        # The longest row of a key's last session has all its counts.  Which session is the last one comes from
        # an aggregate of plain times, so that only the rows of last sessions are sorted by key.
        kept = [c for c in _STATE if c not in ("ip", "session_end")]
        ends = out.groupBy("ip").agg(F.max("session_start").alias("_last"), F.greatest(F.max(ts), F.max("c_session_end")).alias("session_end"))
        at = F.col("ip").eqNullSafe(F.col("_ip")) & (F.col("session_start") == F.col("_last"))
        rest = out.select("ip", *kept).join(ends.withColumnRenamed("ip", "_ip"), at)
        last = rest.groupBy("ip").agg(F.max_by(F.struct(*kept), "sessionLength").alias("r"), F.first("session_end").alias("session_end"))
        state = last.select("ip", *[F.col(f"r.{c}").alias(c) for c in kept], "session_end").select(*_STATE)
        keyed.upsert(state, root, "ip", ["session_start", "sessionLength"], batch_id, buckets)
    return fn


def live_table(spark: SparkSession, root: str, as_of, gap: str = SESSION_GAP) -> DataFrame | None:
    """ST3: the carried sessions that are still open at ``as_of``, after the latest batch."""
    t = keyed.read_table(spark, root)
    return None if t is None else live_sessions(t, as_of, gap)
