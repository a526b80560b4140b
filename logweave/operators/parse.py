"""Line -> typed row operators.

Each takes a frame with a ``value`` string column (batch or streaming) and returns
a projected frame; extra columns listed in ``keep`` (e.g. an arrival time or an id)
pass through.  All are narrow: no shuffle, whole-stage codegen.

The log pattern runs once per line (``accesslog.log_rewrite`` emits all nine
groups from one regex pass, in a projection of its own); every field is then a
cheap array lookup.  Where
corrupt lines are dropped (F1), the drop is a generator over the parsed record,
so the optimizer cannot push a second copy of the regex into a filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions import accesslog as al

LOG_ENTRY_FIELDS = ("ip", "client", "user", "dateTime", "request", "status", "bytes", "referer", "agent")
_F = "_fields"


def _fields(lines: DataFrame, keep: Sequence[str], value: str, drop_bad: bool) -> DataFrame:
    # The rewrite gets its own projection: the optimizer keeps a non-trivial expression
    # that is used twice below in place rather than copying it, so the regex runs once.
    raw = lines.select(*keep, al.log_rewrite(value).alias("_raw"))
    f = al.fields_of_rewrite("_raw")
    if drop_bad:
        return raw.select(*keep, F.explode(F.when(f.isNotNull(), F.array(f))).alias(_F))
    return raw.select(*keep, f.alias(_F))


def _g(name: str) -> Column:
    return al.field(F.col(_F), name)


def _ok() -> Column:
    return F.col(_F).isNotNull()


def log_entries(lines: DataFrame, keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """P1 + P2 + P8 + F1: valid lines -> LogEntry columns plus ``ts`` (TIMESTAMP_NTZ).

    ``dateTime`` is the normalised 'yyyy-MM-dd HH:mm:ss.0' text, '' when the date
    does not parse (then ``ts`` is NULL); a missing ip is NULL.
    """
    p = _fields(lines, keep, value, drop_bad=True)
    p = p.select(*keep, _F, al.parse_log_time(_g("dateTime")).alias("ts"))
    cols = [F.nullif(_g("ip"), F.lit("")).alias("ip"), _g("client").alias("client"), _g("user").alias("user"),
            F.coalesce(al.java_timestamp_string(F.col("ts")), F.lit("")).alias("dateTime")]
    cols += [_g(f).alias(f) for f in ("request", "status", "bytes", "referer", "agent")]
    return p.select(*keep, *cols, "ts")


def field_or_error(lines: DataFrame, field: str, keep: Sequence[str] = (), value: str = "value",
                   alias: str | None = None) -> DataFrame:
    """One group per line, ``[error]`` for lines that do not match."""
    p = _fields(lines, keep, value, drop_bad=False)
    return p.select(*keep, F.coalesce(_g(field), F.lit(al.ERROR_SENTINEL)).alias(alias or field))


def requests(lines: DataFrame, keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """(url, status int, agent); bad line -> ('error', 0, 'error')."""
    p = _fields(lines, keep, value, drop_bad=False)
    return p.select(
        *keep,
        F.when(_ok(), al.url_of_request(_g("request"))).otherwise(F.lit("error")).alias("url"),
        F.when(_ok(), _g("status").cast("int")).otherwise(F.lit(0)).alias("status"),
        F.when(_ok(), _g("agent")).otherwise(F.lit("error")).alias("agent"),
    )


def keyed_requests(lines: DataFrame, keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """P5: (ip, url, status int, agent); bad line -> ('error', 'error', 0, 'error').

    A matching line without ip keeps a NULL ip, as the regex group is absent.
    """
    p = _fields(lines, keep, value, drop_bad=False)
    return p.select(
        *keep,
        F.when(_ok(), F.nullif(_g("ip"), F.lit(""))).otherwise(F.lit("error")).alias("ip"),
        F.when(_ok(), al.url_of_request(_g("request"))).otherwise(F.lit("error")).alias("url"),
        F.when(_ok(), _g("status").cast("int")).otherwise(F.lit(0)).alias("status"),
        F.when(_ok(), _g("agent")).otherwise(F.lit("error")).alias("agent"),
    )


def session_requests(lines: DataFrame, keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """(ip, url, status string); bad line -> ('error', 'error', '0')."""
    p = _fields(lines, keep, value, drop_bad=False)
    return p.select(
        *keep,
        F.when(_ok(), F.nullif(_g("ip"), F.lit(""))).otherwise(F.lit("error")).alias("ip"),
        F.when(_ok(), al.url_of_request(_g("request"))).otherwise(F.lit("error")).alias("url"),
        F.when(_ok(), _g("status")).otherwise(F.lit("0")).alias("status"),
    )


def strict_urls(lines: DataFrame, keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Url only for 3-token requests; anything else (bad line included) -> '[error]'.

    A bad line's request is the printed Unit value '()', a single token."""
    p = _fields(lines, keep, value, drop_bad=False)
    req = F.coalesce(_g("request"), F.lit("()"))
    return p.select(*keep, al.strict_url_of_request(req).alias("url"))


def status_classes(lines: DataFrame, keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """P3 (status) + P9: Success / Failure / Other per line."""
    p = _fields(lines, keep, value, drop_bad=False)
    status = F.coalesce(_g("status"), F.lit(al.ERROR_SENTINEL))
    return p.select(*keep, al.status_class(status).alias("class"))


def decode_payload(frames: DataFrame, body: str = "body", keep: Sequence[str] = ()) -> DataFrame:
    """Binary payload (Kinesis/Flume/Kafka bytes) -> ``value`` string."""
    return frames.select(*keep, al.bytes_to_string(F.col(body)).alias("value"))


def drop_corrupt(lines: DataFrame, value: str = "value") -> DataFrame:
    """keep only lines matching the log pattern."""
    return lines.where(al.log_matches(value))
