"""DuckDB SQL for each named query (the correctness oracle).

The oracle rebuilds the access-log lines from ``events`` with its own SQL
mapping (``ORACLE_LINES_CTE``) and parses them with DuckDB's RE2 regexes, so
it shares only the fixed log pattern with the Spark code.
"""

from __future__ import annotations

from logweave.functions.accesslog import LOG_PATTERN
from logweave.functions.text import STOP_WORDS
from logweave.sources.eventlog import ORACLE_LINES_CTE

_FULL = "'^(?:" + LOG_PATTERN.replace("'", "''") + ")$'"


def _g(i: int) -> str:
    return f"regexp_extract(value, {_FULL}, {i})"


# lines -> parsed groups; ok = whole-line match
PARSED_CTE = ORACLE_LINES_CTE + f""",
parsed AS (
  SELECT event_id, arrival_ts, value, regexp_full_match(value, '{LOG_PATTERN.replace("'", "''")}') AS ok,
    {_g(1)} AS g1, {_g(2)} AS g2, {_g(3)} AS g3, {_g(4)} AS g4, {_g(5)} AS g5,
    {_g(6)} AS g6, {_g(7)} AS g7, {_g(8)} AS g8, {_g(9)} AS g9
  FROM lines
),
entries AS (
  SELECT event_id, NULLIF(g1, '') AS ip, g2 AS client, g3 AS "user",
    try_strptime(regexp_extract(g4, '\\[(.*?) .+]', 1), '%d/%b/%Y:%H:%M:%S') AS ts,
    g5 AS request, g6 AS status, g7 AS bytes, g8 AS referer, g9 AS agent
  FROM parsed WHERE ok
)"""

SQL = {}

SQL["log_entries"] = f"""WITH {PARSED_CTE}
SELECT event_id, ip, client, "user",
  COALESCE(strftime(ts, '%Y-%m-%d %H:%M:%S') || '.0', '') AS "dateTime",
  request, status, bytes, referer, agent, CAST(ts AS TIMESTAMP) AS ts
FROM entries"""

SQL["status_hourly"] = f"""WITH {PARSED_CTE}
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
  status, count(*) AS "count"
FROM entries WHERE ts IS NOT NULL
GROUP BY ALL ORDER BY window_start, status"""

# ----------------------------------------------------------------------------- log jobs
_REQ_TOKENS = "string_split(rtrim(g5, ' '), ' ')"
_URL = f"COALESCE({_REQ_TOKENS}[2], '[error]')"

SQL["requests_by_agent"] = f"""WITH {PARSED_CTE}
SELECT CASE WHEN ok THEN g9 ELSE 'error' END AS agent, count(*) AS "count" FROM parsed GROUP BY 1"""

SQL["requests_keyed_latest"] = f"""WITH {PARSED_CTE},
kr AS (
  SELECT event_id, arrival_ts,
    CASE WHEN ok THEN NULLIF(g1, '') ELSE 'error' END AS ip,
    CASE WHEN ok THEN {_URL} ELSE 'error' END AS url,
    CASE WHEN ok THEN CAST(g6 AS INTEGER) ELSE 0 END AS status,
    CASE WHEN ok THEN g9 ELSE 'error' END AS agent
  FROM parsed)
SELECT ip, url, status, agent FROM (
  SELECT *, row_number() OVER (PARTITION BY ip ORDER BY arrival_ts DESC, event_id DESC) AS rn FROM kr)
WHERE rn = 1"""


def _sliding_top(field_expr: str, name: str, k: int, length_s: int = 300, slide_s: int = 60) -> str:
    return f"""WITH {PARSED_CTE},
f AS (SELECT arrival_ts, {field_expr} AS "{name}" FROM parsed),
b AS (SELECT time_bucket(INTERVAL {slide_s} SECOND, arrival_ts, TIMESTAMP '1970-01-01') AS b, "{name}",
             count(*) AS n FROM f GROUP BY ALL),
w AS (SELECT b - to_seconds(m * {slide_s}) AS window_start, "{name}", n FROM b, range(0, {length_s // slide_s}) r(m)),
c AS (SELECT window_start, window_start + INTERVAL {length_s} SECOND AS window_end, "{name}",
             CAST(sum(n) AS BIGINT) AS "count" FROM w GROUP BY ALL)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY "count" DESC, "{name}") AS INTEGER) AS rank
  FROM c)
WHERE rank <= {k}"""


SQL["top_referrers"] = _sliding_top("CASE WHEN ok THEN g8 ELSE '[error]' END", "referer", 5)
SQL["stream_top_referrers"] = SQL["top_referrers"]  # the stream emits every window
# Stretches of window starts between changes: a bucket enters at b - 299 s and leaves at b + 1 s.
SQL["stream_top_referrers_1s"] = f"""WITH {PARSED_CTE},
b AS (SELECT epoch_us(arrival_ts) // 1000000 AS b, CASE WHEN ok THEN g8 ELSE '[error]' END AS referer, count(*) AS n
      FROM parsed WHERE arrival_ts IS NOT NULL GROUP BY ALL),
r AS (SELECT referer, n, b, b - 299 AS a, b + 1 AS z, unnest(range((b - 299) // 300, b // 300 + 1)) AS cell FROM b),
e AS (SELECT DISTINCT cell, unnest([greatest(a, cell * 300), least(z, cell * 300 + 300)]) AS p FROM r),
s AS (SELECT cell, p, lead(p) OVER (PARTITION BY cell ORDER BY p) AS q FROM e),
c AS (SELECT s.cell, p, q, referer, CAST(sum(n) AS BIGINT) AS "count" FROM s JOIN r ON s.cell = r.cell AND p >= a AND p < z
      WHERE q IS NOT NULL GROUP BY ALL)
SELECT * FROM (
  SELECT make_timestamp(p * 1000000) AS first_start, make_timestamp((q - 1) * 1000000) AS last_start, referer, "count",
         CAST(row_number() OVER (PARTITION BY cell, p ORDER BY "count" DESC, referer) AS INTEGER) AS rank FROM c)
WHERE rank <= 5"""
SQL["top_agents"] = _sliding_top("CASE WHEN ok THEN g9 ELSE '[error]' END", "agent", 5)
SQL["top_urls_strict"] = _sliding_top(
    f"CASE WHEN ok AND len({_REQ_TOKENS}) = 3 THEN {_REQ_TOKENS}[2] ELSE '[error]' END", "url", 10)

_CLASS_TOTALS = f"""cl AS (
  SELECT arrival_ts, CASE WHEN NOT ok THEN 'Other'
    WHEN CAST(g6 AS INTEGER) BETWEEN 200 AND 299 THEN 'Success'
    WHEN CAST(g6 AS INTEGER) BETWEEN 500 AND 599 THEN 'Failure' ELSE 'Other' END AS class
  FROM parsed),
cb AS (SELECT time_bucket(INTERVAL 10 MINUTE, arrival_ts, TIMESTAMP '1970-01-01') AS b, class, count(*) AS n
       FROM cl GROUP BY ALL),
cw AS (SELECT b - to_minutes(m * 10) AS window_start, class, n FROM cb, range(0, 72) r(m)),
tot AS (
  SELECT window_start, window_start + INTERVAL 12 HOUR AS window_end,
    CAST(COALESCE(sum(n) FILTER (WHERE class = 'Success'), 0) AS BIGINT) AS success,
    CAST(COALESCE(sum(n) FILTER (WHERE class = 'Failure'), 0) AS BIGINT) AS failure
  FROM cw GROUP BY ALL)"""

SQL["status_class_window"] = f"""WITH {PARSED_CTE},
{_CLASS_TOTALS}
SELECT * FROM tot"""


def _fold(cand_cte: str, quiet: str = "INTERVAL 30 MINUTE") -> str:
    """Recursive CTE ``fold(rn, t, last_fire, fired)`` over ``cand(t, rn)`` in time order."""
    return f"""{cand_cte},
fold(rn, t, last_fire, fired) AS (
  SELECT rn, t, t, TRUE FROM cand WHERE rn = 1
  UNION ALL
  SELECT c.rn, c.t,
    CASE WHEN c.t > f.last_fire + {quiet} THEN c.t ELSE f.last_fire END,
    c.t > f.last_fire + {quiet}
  FROM fold f JOIN cand c ON c.rn = f.rn + 1
)"""


SQL["error_ratio_alarms"] = f"""WITH RECURSIVE {PARSED_CTE},
{_CLASS_TOTALS},
ev AS (SELECT *, CASE WHEN success = 0 THEN CAST('Infinity' AS DOUBLE)
                      ELSE CAST(failure AS DOUBLE) / CAST(success AS DOUBLE) END AS ratio
       FROM tot WHERE success + failure > 100),
{_fold("cand AS (SELECT window_end AS t, row_number() OVER (ORDER BY window_end) AS rn FROM ev WHERE ratio > 0.4)")}
SELECT ev.window_start, ev.window_end, ev.success, ev.failure, ev.ratio,
  CASE WHEN ev.ratio <= 0.4 THEN 'all clear' WHEN fold.fired THEN 'fired' ELSE 'suppressed' END AS state
FROM ev LEFT JOIN fold ON fold.t = ev.window_end"""

SQL["no_data_alarms"] = """WITH RECURSIVE
act AS (SELECT DISTINCT CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS s FROM events),
g AS (SELECT s, lead(s) OVER (ORDER BY s) AS nx FROM act),
iv AS (SELECT s, nx, s + 601 AS a, nx - 1 AS b, row_number() OVER (ORDER BY s) AS rn
       FROM g WHERE nx IS NOT NULL AND s + 601 <= nx - 1),
walk(rn, e) AS (
  SELECT CAST(1 AS BIGINT), CAST(-9000000000000000000 AS BIGINT)
  UNION ALL
  SELECT w.rn + 1,
    CASE WHEN greatest(iv.a, w.e) <= iv.b
         THEN greatest(iv.a, w.e) + ((iv.b - greatest(iv.a, w.e)) // 1801) * 1801 + 1801
         ELSE w.e END
  FROM walk w JOIN iv ON iv.rn = w.rn),
fires AS (SELECT iv.s, iv.nx, unnest(generate_series(greatest(iv.a, w.e), iv.b, 1801)) AS t
          FROM iv JOIN walk w ON w.rn = iv.rn)
SELECT make_timestamp(s * 1000000) AS last_data, make_timestamp(nx * 1000000) AS next_data,
  make_timestamp(t * 1000000) AS alarm_ts
FROM fires"""

# ----------------------------------------------------------------------------- sessions
_SESSION_ROWS = f"""sr AS (
  SELECT event_id, arrival_ts,
    CASE WHEN ok THEN NULLIF(g1, '') ELSE 'error' END AS ip,
    CASE WHEN ok THEN {_URL} ELSE 'error' END AS url,
    CASE WHEN ok THEN g6 ELSE '0' END AS status
  FROM parsed),
st AS (SELECT *, lag(arrival_ts) OVER (PARTITION BY ip ORDER BY arrival_ts, event_id) AS prev,
              COALESCE(TRY_CAST(status AS INTEGER), 0) BETWEEN 200 AND 399 AS succ FROM sr),
st2 AS (SELECT *, max(CASE WHEN prev IS NULL OR arrival_ts > prev + INTERVAL 30 MINUTE THEN arrival_ts END)
                    OVER (PARTITION BY ip ORDER BY arrival_ts, event_id ROWS UNBOUNDED PRECEDING) AS session_start
        FROM st),
sess AS (
  SELECT ip, session_start, max(arrival_ts) AS session_end, count(*) AS "sessionLength",
    list(url ORDER BY arrival_ts, event_id)[1:10] AS clickstream,
    count(*) FILTER (WHERE succ) AS "successCodes", count(*) FILTER (WHERE NOT succ) AS "errorCodes"
  FROM st2 GROUP BY ip, session_start)"""

SQL["sessions"] = f"""WITH {PARSED_CTE},
{_SESSION_ROWS}
SELECT * FROM sess"""

SQL["session_running"] = f"""WITH {PARSED_CTE},
{_SESSION_ROWS},
run AS (
  SELECT event_id, ip, session_start,
    count(*) OVER w AS n,
    CAST(sum(CASE WHEN succ THEN 1 ELSE 0 END) OVER w AS BIGINT) AS s
  FROM st2
  WINDOW w AS (PARTITION BY ip, session_start ORDER BY arrival_ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT run.event_id, run.ip, run.session_start, run.n AS "sessionLength",
  list_slice(sess.clickstream, 1, least(run.n, 10)) AS clickstream,
  run.s AS "successCodes", run.n - run.s AS "errorCodes"
FROM run JOIN sess ON run.ip IS NOT DISTINCT FROM sess.ip AND run.session_start = sess.session_start"""

SQL["session_snapshot"] = f"""WITH {PARSED_CTE},
{_SESSION_ROWS}
SELECT * FROM sess WHERE session_end >= (SELECT max(arrival_ts) FROM sr) - INTERVAL 30 MINUTE"""

# ----------------------------------------------------------------------------- text jobs
_DOC_LINES = r"""dl AS (
  SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                     ELSE string_split_regex(regexp_replace(text, '(\r\n|\r|\n)$', ''), '\r\n|\r|\n') END) AS line
  FROM documents)"""


def _java_split(col: str) -> str:
    return (f"CASE WHEN {col} <> '' AND rtrim({col}, ' ') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({col}, ' '), ' ') END")


SQL["line_count"] = f"""WITH {_DOC_LINES}
SELECT count(*) AS n_lines FROM dl"""

SQL["word_count"] = f"""WITH {_DOC_LINES},
w AS (SELECT unnest({_java_split('line')}) AS word FROM dl)
SELECT lower(word) AS word, count(*) AS "count" FROM w GROUP BY 1"""

SQL["word_count_by_batch"] = f"""WITH w AS (SELECT turn, unnest({_java_split('text')}) AS word FROM conversations)
SELECT turn, word, count(*) AS "count" FROM w GROUP BY ALL"""

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

SQL["top_clean_words"] = rf"""WITH cw AS (
  SELECT source, unnest(string_split(trim(regexp_replace(regexp_replace(lower(text), '[^a-zA-Z0-9\s#@]', '', 'g'),
                                                         '\s+', ' ', 'g')), ' ')) AS word
  FROM documents),
c AS (SELECT source, word, count(*) AS "count" FROM cw WHERE length(word) > 2 AND word NOT IN ({_STOP})
      GROUP BY ALL)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY "count" DESC, word) AS INTEGER) AS rank FROM c)
WHERE rank <= 10"""

SQL["event_type_10s"] = """SELECT time_bucket(INTERVAL 10 SECOND, ts, TIMESTAMP '1970-01-01') AS window_start,
  time_bucket(INTERVAL 10 SECOND, ts, TIMESTAMP '1970-01-01') + INTERVAL 10 SECOND AS window_end,
  event_type, count(*) AS "count"
FROM events GROUP BY ALL"""

SQL["text_length_running"] = """WITH per AS (
  SELECT source, count(*) AS rows, CAST(sum(length(text)) AS BIGINT) AS chars,
    CAST(max(length(text)) AS BIGINT) AS longest
  FROM documents GROUP BY source)
SELECT source, rows, chars,
  CAST(sum(rows) OVER w AS BIGINT) AS total_rows, CAST(sum(chars) OVER w AS BIGINT) AS total_chars,
  CAST(floor(sum(chars) OVER w / sum(rows) OVER w) AS BIGINT) AS avg_length,
  max(longest) OVER w AS max_length
FROM per WINDOW w AS (ORDER BY source ROWS UNBOUNDED PRECEDING)"""

SQL["take_batches_until"] = """WITH per AS (SELECT turn, count(*) AS rows FROM conversations GROUP BY turn),
run AS (SELECT turn, sum(rows) OVER (ORDER BY turn) - rows AS before FROM per)
SELECT conv_id, turn, text FROM conversations WHERE turn IN (SELECT turn FROM run WHERE before <= 1000)"""

SQL["json_texts"] = """SELECT conv_id, turn, CASE WHEN conv_id % 11 = 0 AND turn = 0 THEN '' ELSE text END AS text
FROM conversations
WHERE turn % 5 <> 4 AND NOT (conv_id % 13 = 0 AND turn = 1)"""

SQL["labeled_points"] = """SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS DOUBLE) AS label,
  [CAST(CAST(l_quantity AS DECIMAL(18, 2)) AS DOUBLE), CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS DOUBLE)]
    AS features
FROM lineitem"""

# ----------------------------------------------------------------------------- splits
SQL["kfold"] = """SELECT o_orderkey, o_custkey,
  CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) * 5 / (SELECT count(*) FROM orders)) AS INTEGER) AS fold
FROM orders"""

SQL["user_holdout"] = """WITH r AS (
  SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders),
c AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS ti FROM r WHERE rn BETWEEN 11 AND 20)
SELECT r.o_orderkey, r.o_custkey, c.ti IS NOT NULL AS is_test
FROM r LEFT JOIN c USING (o_orderkey)"""

# ----------------------------------------------------------------------------- ML
_KMEANS_ASSIGN = """c AS (SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INTEGER) AS ci, embedding AS ce
      FROM (SELECT * FROM embeddings ORDER BY vec_id LIMIT 5)),
d AS (SELECT e.vec_id, e.label, e.embedding, c.ci,
        list_sum(list_transform(range(1, len(e.embedding) + 1),
                 lambda i: (CAST(e.embedding[i] AS DOUBLE) - CAST(c.ce[i] AS DOUBLE))
                    * (CAST(e.embedding[i] AS DOUBLE) - CAST(c.ce[i] AS DOUBLE)))) AS dist
      FROM embeddings e, c),
asg AS (SELECT vec_id, label, any_value(embedding) AS embedding, arg_min(ci, dist) AS cluster
        FROM d GROUP BY vec_id, label)"""

SQL["kmeans_assign"] = f"""WITH {_KMEANS_ASSIGN}
SELECT vec_id, label, cluster FROM asg"""

SQL["kmeans_step"] = f"""WITH {_KMEANS_ASSIGN},
a AS (SELECT cluster, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS i FROM asg),
m AS (SELECT cluster, i, avg(CAST(x AS DOUBLE)) AS v, count(*) AS n FROM a GROUP BY cluster, i)
SELECT cluster, CAST(max(n) AS DOUBLE) AS weight, list(round(v, 6) ORDER BY i) AS center FROM m GROUP BY cluster"""

SQL["kmeans_label_counts"] = f"""WITH {_KMEANS_ASSIGN}
SELECT label, cluster, count(*) AS "count" FROM asg GROUP BY ALL"""

_REGRESSION = """z AS (
  SELECT l_orderkey, l_linenumber,
    (l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER () AS x,
    (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_samp(l_extendedprice) OVER () AS y
  FROM lineitem),
s AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy FROM z),
it(i, w, b, done) AS (
  SELECT 0, CAST(0.0 AS DOUBLE), CAST(1.0 AS DOUBLE), FALSE
  UNION ALL
  SELECT i + 1, nw, nb,
    i >= 1 AND sqrt((nw - w) * (nw - w) + (nb - b) * (nb - b)) < 0.001 * greatest(sqrt(nw * nw + nb * nb), 1.0)
  FROM (SELECT it.i, it.w, it.b,
          it.w - 0.1 / sqrt(it.i + 1) * ((it.w * s.sxx + it.b * s.sx - s.sxy) / s.n) AS nw,
          it.b - 0.1 / sqrt(it.i + 1) * ((it.w * s.sx + it.b * s.n - s.sy) / s.n) AS nb
        FROM it, s WHERE NOT it.done AND it.i < 50) q),
model AS (SELECT w, b, i FROM it ORDER BY i DESC LIMIT 1)"""

SQL["linreg_fit"] = f"""WITH RECURSIVE {_REGRESSION}
SELECT round(w, 6) AS weight, round(b, 6) AS intercept, CAST(i AS INTEGER) AS iterations FROM model"""

SQL["linreg_predict"] = f"""WITH RECURSIVE {_REGRESSION}
SELECT l_orderkey, l_linenumber, round(y, 6) AS label, round(model.b + model.w * x, 6) AS prediction
FROM z, model"""

SQL["linreg_rmse"] = f"""WITH RECURSIVE {_REGRESSION}
SELECT round(sqrt(avg((model.b + model.w * x - y) * (model.b + model.w * x - y))), 6) AS rmse, count(*) AS n
FROM z, model"""

# ----------------------------------------------------------------------------- stream forms
SQL["stream_status_hourly"] = SQL["status_hourly"]

SQL["archive_replay"] = r"""WITH l AS (SELECT turn, unnest(string_split_regex(text, '\r\n|\r|\n')) AS line FROM conversations),
per AS (SELECT turn, count(*) AS rows, CAST(sum(length(line)) AS BIGINT) AS chars,
               CAST(max(length(line)) AS BIGINT) AS longest FROM l GROUP BY turn)
SELECT CAST(dense_rank() OVER (ORDER BY turn) - 1 AS INTEGER) AS batch, rows, chars,
  CAST(sum(rows) OVER w AS BIGINT) AS total_rows, CAST(sum(chars) OVER w AS BIGINT) AS total_chars,
  CAST(floor(sum(chars) OVER w / sum(rows) OVER w) AS BIGINT) AS avg_length,
  max(longest) OVER w AS max_length
FROM per WINDOW w AS (ORDER BY turn ROWS UNBOUNDED PRECEDING)"""
SQL["stream_closed_sessions"] = SQL["sessions"]  # the stream emits every session
SQL["alarms_one_clock"] = f"""WITH RECURSIVE {PARSED_CTE},
{_CLASS_TOTALS},
d AS (SELECT DISTINCT time_bucket(INTERVAL 10 MINUTE, arrival_ts, TIMESTAMP '1970-01-01') AS d FROM parsed WHERE arrival_ts IS NOT NULL),
tk AS (SELECT unnest(generate_series(min(d), max(d), INTERVAL 10 MINUTE)) AS t FROM d),
er AS (SELECT window_end - INTERVAL 10 MINUTE AS t, CASE WHEN success = 0 THEN CAST('Infinity' AS DOUBLE)
              ELSE CAST(failure AS DOUBLE) / CAST(success AS DOUBLE) END AS ratio FROM tot WHERE success + failure > 100),
every AS (SELECT tk.t, d.d, er.ratio FROM tk ASOF JOIN d ON tk.t >= d.d LEFT JOIN er ON er.t = tk.t AND er.ratio > 0.4),
{_fold("cand AS (SELECT *, row_number() OVER (ORDER BY t) AS rn FROM every WHERE ratio IS NOT NULL OR t > d + INTERVAL 20 MINUTE)")}
SELECT c.t AS alarm_ts, CASE WHEN ratio IS NULL THEN 'no_data' ELSE 'error_ratio' END AS kind, ratio,
       CASE WHEN ratio IS NULL THEN d END AS last_data
FROM fold f JOIN cand c ON c.rn = f.rn WHERE f.fired"""
SQL["stream_alarms"] = SQL["alarms_one_clock"]
SQL["stream_archive_replay"] = SQL["archive_replay"]
SQL["stream_keyed_latest"] = SQL["requests_keyed_latest"]
SQL["stream_session_running"] = SQL["session_running"]
