"""Access-log lines derived from the ``events`` table with column expressions.

The test tables hold typed events, not raw log text, so the log jobs read lines
built here: one line per event, a pure per-row projection (no shuffle), so the
line table grows exactly with ``events``.  The mapping deliberately produces the
edge cases the parsers must handle:

* ``event_id % 97 == 0``  -> corrupt line (does not match the log pattern)
* ``event_id % 89 == 0``  -> ip missing (line starts with a space)
* ``event_id % 101 == 0`` -> unknown month name (date does not parse)
* ``event_id % 53 == 0``  -> request without protocol (two tokens)
* status: error 500, signup 302, view with k >= 90 404, else 200; bytes '-' for signups
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Own test constants (not reference values): user agents picked by user_id % 6.
AGENTS = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) Firefox/121.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 13_5) Safari/605.1.15",
    "Mozilla/5.0 (X11; Linux x86_64) Chrome/120.0 Safari/537.36",
    "curl/8.4.0",
    "Googlebot/2.1 (+http://www.google.com/bot.html)",
    "python-requests/2.31",
)


def _ip(user_id: Column) -> Column:
    parts = [F.lit("10"), F.pmod(F.floor(user_id / 65536), F.lit(256)),
             F.pmod(F.floor(user_id / 256), F.lit(256)), F.pmod(user_id, F.lit(256))]
    return F.concat_ws(".", *[p.cast("string") for p in parts])


def access_log_lines(events: DataFrame, with_ts: bool = False) -> DataFrame:
    """``events`` -> ``value: string`` (plus ``event_id``, and ``ts`` when asked)."""
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    k = F.get_json_object(F.col("props"), "$.k")
    ki = k.try_cast("int")
    ip = F.when(eid % 89 == 0, F.lit("")).otherwise(_ip(uid))
    month = F.when(eid % 101 == 0, F.lit("Foo")).otherwise(F.date_format("ts", "MMM"))
    date = F.concat(F.lit("["), F.date_format("ts", "dd"), F.lit("/"), month, F.lit("/"),
                    F.date_format("ts", "yyyy:HH:mm:ss"), F.lit(" +0000]"))
    method = F.when(et.isin("purchase", "signup"), F.lit("POST")).otherwise(F.lit("GET"))
    url = F.concat(F.lit("/"), et, F.lit("/"), k)
    request = F.when(eid % 53 == 0, F.concat_ws(" ", method, url)).otherwise(
        F.concat_ws(" ", method, url, F.lit("HTTP/1.1")))
    status = (F.when(et == "error", F.lit("500")).when(et == "signup", F.lit("302"))
              .when((et == "view") & (ki >= 90), F.lit("404")).otherwise(F.lit("200")))
    nbytes = F.when(et == "signup", F.lit("-")).otherwise((F.pmod(eid * 7919, F.lit(50000))).cast("string"))
    referer = F.when(F.pmod(ki, F.lit(7)) == 0, F.lit("-")).otherwise(
        F.concat(F.lit("http://ref"), F.pmod(ki, F.lit(7)).cast("string"), F.lit(".example.com/"), et))
    agent = F.element_at(F.array(*[F.lit(a) for a in AGENTS]), (F.pmod(uid, F.lit(len(AGENTS))) + 1).cast("int"))
    q = F.lit('"')
    line = F.concat(ip, F.lit(" - - "), date, F.lit(" "), q, request, q, F.lit(" "), status, F.lit(" "),
                    nbytes, F.lit(" "), q, referer, q, F.lit(" "), q, agent, q)
    line = F.when(eid % 97 == 0, F.concat(F.lit("#corrupt "), eid.cast("string"))).otherwise(line)
    cols = [eid.alias("event_id"), line.alias("value")]
    if with_ts:
        cols.append(F.col("ts").alias("arrival_ts"))
    return events.select(*cols)


# The same mapping in DuckDB SQL, used only by the oracle (plans/oracle.py).
ORACLE_LINES_CTE = r"""
lines AS (
  SELECT event_id, ts AS arrival_ts,
    CASE WHEN event_id % 97 = 0 THEN '#corrupt ' || CAST(event_id AS VARCHAR) ELSE
      (CASE WHEN event_id % 89 = 0 THEN '' ELSE
         '10.' || CAST(((user_id // 65536) % 256) AS VARCHAR) || '.' || CAST(((user_id // 256) % 256) AS VARCHAR)
         || '.' || CAST((user_id % 256) AS VARCHAR) END)
      || ' - - [' || strftime(ts, '%d') || '/'
      || (CASE WHEN event_id % 101 = 0 THEN 'Foo' ELSE strftime(ts, '%b') END)
      || '/' || strftime(ts, '%Y:%H:%M:%S') || ' +0000] "'
      || (CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' ELSE 'GET' END) || ' /' || event_type || '/'
      || json_extract_string(props, '$.k')
      || (CASE WHEN event_id % 53 = 0 THEN '' ELSE ' HTTP/1.1' END) || '" '
      || (CASE WHEN event_type = 'error' THEN '500' WHEN event_type = 'signup' THEN '302'
               WHEN event_type = 'view' AND CAST(json_extract_string(props, '$.k') AS INTEGER) >= 90 THEN '404'
               ELSE '200' END) || ' '
      || (CASE WHEN event_type = 'signup' THEN '-' ELSE CAST((event_id * 7919) % 50000 AS VARCHAR) END) || ' "'
      || (CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 = 0 THEN '-'
               ELSE 'http://ref' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 AS VARCHAR)
                    || '.example.com/' || event_type END) || '" "'
      || (CASE user_id % 6
            WHEN 0 THEN 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) Firefox/121.0'
            WHEN 1 THEN 'Mozilla/5.0 (Macintosh; Intel Mac OS X 13_5) Safari/605.1.15'
            WHEN 2 THEN 'Mozilla/5.0 (X11; Linux x86_64) Chrome/120.0 Safari/537.36'
            WHEN 3 THEN 'curl/8.4.0'
            WHEN 4 THEN 'Googlebot/2.1 (+http://www.google.com/bot.html)'
            ELSE 'python-requests/2.31' END) || '"'
    END AS value
  FROM events
)"""
