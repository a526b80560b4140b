"""Column functions for Apache access-log lines (built-in expressions only).

All functions return ``Column`` objects, so parsing stays inside whole-stage
codegen and Catalyst prunes the groups a query does not use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: must equal the reference's log format -------------------------------
# Nine groups, separated by single spaces: optional dotted-quad ip, client, user,
# [date], "request", 3-digit status, bytes, "referer", "agent".
LOG_PATTERN = (
    r'(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})? (\S+) (\S+) (\[.+?\]) "(.*?)" (\d{3}) (\S+) "(.*?)" "(.*?)"'
)
# Date text inside the brackets, up to the first space.
DATE_PATTERN = r"\[(.*?) .+]"
DATE_FORMAT = "dd/MMM/yyyy:HH:mm:ss"
ERROR_SENTINEL = "[error]"
# --- end of fixed values ------------------------------------------------------------------

GROUPS = {
    "ip": 1, "client": 2, "user": 3, "dateTime": 4, "request": 5,
    "status": 6, "bytes": 7, "referer": 8, "agent": 9,
}

# Java's Matcher.matches() is a whole-string match; rlike/regexp_extract search.
_ANCHORED = r"\A(?:" + LOG_PATTERN + r")\z"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# One regex pass per line: a matching line is rewritten to MARK + the nine groups joined by
# SEP; a line that does not match comes back without the leading MARK.  A SEP inside a line is
# escaped before the pass (ESC and a letter, which the pattern treats like any other character).
_SEP, _ESC = "\u0001", "\u0002"
_MARK = "\u0000LW" + _SEP
_REWRITE = _MARK + _SEP.join(f"${i}" for i in range(1, 10))


def log_rewrite(line="value") -> Column:
    """The single regex pass: a matching line becomes MARK + groups joined by SEP."""
    safe = F.replace(F.replace(_c(line), F.lit(_ESC), F.lit(_ESC + "b")), F.lit(_SEP), F.lit(_ESC + "a"))
    return F.regexp_replace(safe, _ANCHORED, _REWRITE)


def fields_of_rewrite(rewritten) -> Column:
    """``log_rewrite`` output -> ``array<string>`` of the nine groups (to be read by ``field``), NULL for a bad line."""
    out = _c(rewritten)
    return F.when(out.startswith(_MARK), F.split(F.substring(out, len(_MARK) + 1, 1 << 30), _SEP))


def log_fields(line="value") -> Column:
    """All nine groups of a line as ``array<string>`` for ``field``, or NULL when the line does
    not match."""
    return fields_of_rewrite(log_rewrite(line))


def field(fields: Column, name: str) -> Column:
    """One group out of ``log_fields``; '' for an absent optional group, NULL for a bad line."""
    return F.replace(F.replace(F.element_at(fields, GROUPS[name]), F.lit(_ESC + "a"), F.lit(_SEP)), F.lit(_ESC + "b"), F.lit(_ESC))


def log_matches(line="value") -> Column:
    """True when the whole line is a valid access-log line."""
    return _c(line).rlike(_ANCHORED)


def log_group(name: str, line="value") -> Column:
    """One regex group; '' when the line does not match or the group is absent."""
    return F.regexp_extract(_c(line), _ANCHORED, GROUPS[name])


def group_or_error(name: str, line="value", sentinel: str = ERROR_SENTINEL) -> Column:
    """The group when the line matches, else the sentinel."""
    return F.when(log_matches(line), log_group(name, line)).otherwise(F.lit(sentinel))


def request_tokens(request: Column) -> Column:
    """Split a request on single spaces the way Java's String.split does.

    Java drops trailing empty strings; Spark keeps them.  Right-trimming the spaces
    first gives the same tokens (an empty request stays one empty token).
    """
    return F.split(F.rtrim(request), " ")


def url_of_request(request: Column, sentinel: str = ERROR_SENTINEL) -> Column:
    """Second request token, or the sentinel when the request has fewer tokens."""
    return F.coalesce(F.try_element_at(request_tokens(request), F.lit(2)), F.lit(sentinel))


def strict_url_of_request(request: Column, sentinel: str = ERROR_SENTINEL) -> Column:
    """The url only when the request has exactly three tokens."""
    toks = request_tokens(request)
    return F.when(F.size(toks) == 3, F.element_at(toks, 2)).otherwise(F.lit(sentinel))


def parse_log_time(date_field: Column) -> Column:
    """P8: '[dd/MMM/yyyy:HH:mm:ss +zzzz]' -> TIMESTAMP_NTZ (offset dropped); bad date -> NULL.

    Read as an instant of UTC and counted from 1970 as wall-clock time, so the session time
    zone (its gaps and overlaps included) plays no part.
    """
    text = F.concat(F.regexp_extract(date_field, DATE_PATTERN, 1), F.lit(" +0000"))
    seconds = F.unix_seconds(F.try_to_timestamp(text, F.lit(DATE_FORMAT + " Z")))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def java_timestamp_string(ts: Column) -> Column:
    """java.sql.Timestamp.toString() of a whole-second time: 'yyyy-MM-dd HH:mm:ss.0'."""
    return F.concat(ts.cast("string"), F.lit(".0"))


def status_class(status: Column) -> Column:
    """200-299 Success, 500-599 Failure, else Other (non-numeric counts as 0)."""
    code = F.coalesce(status.try_cast("int"), F.lit(0))
    return (F.when(code.between(200, 299), F.lit("Success"))
            .when(code.between(500, 599), F.lit("Failure"))
            .otherwise(F.lit("Other")))


def is_success_code(status: Column) -> Column:
    """P10: 200 <= code < 400; anything else, non-numeric included, is an error."""
    return F.coalesce(status.try_cast("int"), F.lit(0)).between(200, 399)


def bytes_to_string(body: Column) -> Column:
    """Byte payload -> UTF-8 string."""
    return F.decode(body, "UTF-8")
