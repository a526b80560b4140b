"""DuckDB SQL of the training-data queries that SQL can express."""

SQL = {}

SQL["op2_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT h, min(page_id) AS first_id FROM d GROUP BY h)
SELECT d.page_id, n::BIGINT AS payload_bytes, d.h AS payload_digest,
       CASE WHEN n >= 100 AND d.page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND d.page_id <> first_id THEN first_id END AS refers_to
FROM d JOIN f USING (h)
"""

_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _ASCII_LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op4_decontaminate"] = f"""
WITH iw AS (SELECT item_id::VARCHAR AS item, {_WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
i AS (SELECT item, w, least(10, len(w)) AS span FROM iw WHERE len(w) > 0),
win AS (SELECT DISTINCT item, span, array_to_string(w[p0 + 1:p0 + span], ' ') AS key
        FROM (SELECT item, w, span, unnest(range(0, len(w) - span + 1)) AS p0 FROM i)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
run AS (SELECT r, p0, span, array_to_string(w[p0 + 1:p0 + span], ' ') AS key
        FROM (SELECT r, w, span, unnest(range(0, len(w) - span + 1)) AS p0 FROM d, (SELECT DISTINCT span FROM i)
              WHERE len(w) >= span)),
hit AS (SELECT DISTINCT r, p0, span, item FROM run JOIN win USING (span, key)),
n AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(p0, p0 + span)) AS p FROM hit) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN s USING (r)
"""

_SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

SQL["op9_mixing"] = f"""
WITH d AS (SELECT doc_id, source, {_SIZE}::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM s),
o AS (SELECT *, sum(source_size) OVER ()::BIGINT AS total,
             coalesce(sum(3 * source_size) OVER before, 0)::BIGINT AS full_before, sum(weight) OVER since::BIGINT AS w_left
      FROM (SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST) AS k FROM w)
      WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             since AS (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
cut AS (SELECT min(k) AS k FROM o WHERE weight::DOUBLE * (total - full_before) / w_left <= 3 * source_size),
lv AS (SELECT total - full_before AS rest, w_left FROM o WHERE k = (SELECT k FROM cut)),
t AS (SELECT source, source_size,
             CASE WHEN k >= (SELECT k FROM cut) THEN (weight * (SELECT rest FROM lv))::DOUBLE / (SELECT w_left FROM lv)::DOUBLE
                  ELSE (3 * source_size)::DOUBLE END AS target FROM o),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
             ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * (floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM r
"""

SQL["op10_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(string_split(text, chr(10)), []) AS s FROM documents),
l AS (SELECT r, doc_id, unnest(s) AS line, unnest(range(len(s))) AS line_no FROM d),
t AS (SELECT *, list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS toks FROM l),
c AS (SELECT toks, len(toks) AS n, min({'d': doc_id, 'l': line_no}) AS f, row_number() OVER () AS c
      FROM t WHERE len(toks) > 0 GROUP BY toks),
e AS (SELECT c, n, f, unnest(toks) AS tok FROM c WHERE n > 3),
q AS (SELECT tok, count(*) AS df FROM e GROUP BY tok),
p AS (SELECT c, n, f, tok FROM (SELECT e.*, row_number() OVER (PARTITION BY c ORDER BY df, tok) AS k FROM e JOIN q USING (tok))
      WHERE k <= n - ceil(0.8 * n) + 1),
pairs AS (SELECT DISTINCT a.c AS x, b.c AS y FROM p a JOIN p b USING (tok)
          WHERE a.f > b.f AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
late AS (SELECT DISTINCT x FROM (SELECT x, len(list_intersect(u.toks, v.toks)) AS o, u.n AS nx, v.n AS ny
         FROM pairs JOIN c u ON u.c = x JOIN c v ON v.c = y) WHERE 100 * o >= 80 * (nx + ny - o)),
z AS (SELECT t.r, t.line_no FROM t JOIN c ON t.toks = c.toks
      WHERE c.c IN (SELECT x FROM late) OR t.doc_id <> c.f.d OR t.line_no <> c.f.l),
g AS (SELECT l.r, string_agg(l.line, chr(10) ORDER BY l.line_no) AS kept, count(*) AS n_kept
      FROM l ANTI JOIN z ON l.r = z.r AND l.line_no = z.line_no GROUP BY l.r)
SELECT doc_id, len(s)::BIGINT AS n_lines, (len(s) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (r)
"""

SQL["op13_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
f AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
g AS (SELECT part, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
                    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
                    regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > first_id, false)] AS bad,
             EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND quality = 1) AS good,
             EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = f.doc_id AND toxic = 1) AS toxic
      FROM f),
c AS (SELECT part, bad, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM g GROUP BY ALL),
l AS (SELECT unnest(range(1, 6)) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS p FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT p, k, p[k] AS i FROM o, (SELECT i AS k FROM l)),
r AS (SELECT part, p, k, any_value(i) AS i,
             sum(n) FILTER (NOT before AND bad[i]) AS removed, sum(n) FILTER (before AND bad[i]) AS redundant,
             sum(n) FILTER (NOT before AND NOT bad[i]) AS kept, sum(n) FILTER (bad[i] AND alone) AS unique_fails,
             sum(n_good) FILTER (NOT before AND bad[i]) AS good_lost, sum(n_toxic) FILTER (NOT before AND bad[i]) AS toxic_lost
      FROM (SELECT c.*, p, k, i, list_bool_or([false] || [bad[j] FOR j IN p[1:k - 1]]) AS before,
                   len([x FOR x IN bad IF x]) = 1 AS alone FROM c, s)
      GROUP BY part, p, k)
SELECT part, array_to_string([substr('ABCDE', j, 1) FOR j IN p], '') AS filter_order, k::INTEGER AS step,
       coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
       coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, i))::BIGINT AS shapley
FROM r
"""

SQL["op12_collocations"] = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[.,;:!?\x0A-\x0D]')) AS s FROM documents),
w AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS w FROM p),
i AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k)),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, w[i:i + k - 1] AS w, count(*) AS f FROM i GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, w, f AS a FROM f WHERE k > 1 AND f >= 10),
cuts AS (SELECT c.lang, c.phrase, c.a, j AS cut, x.f AS l, y.f AS r,
                (1000000 * a::HUGEINT * a::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
         FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
         JOIN f x ON x.lang = c.lang AND x.k = j AND x.phrase = array_to_string(c.w[1:j], ' ')
         JOIN f y ON y.lang = c.lang AND y.k = c.k - j AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
held AS (SELECT lang, part, max(a) AS longer
         FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM c WHERE k = 3)
         GROUP BY lang, part),
kept AS (SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.part = b.phrase
         WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""

SQL["op11_chat_format"] = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, length(text) + len(regexp_extract_all(text, '<\\*(?:s>|/s>|<SYS>>|</SYS>>)|\[\\*(?:INST\]|/INST\])')) AS body FROM c),
m AS (SELECT *, body + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 16 + length(url_encode(role)) END AS whole FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(whole)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""
