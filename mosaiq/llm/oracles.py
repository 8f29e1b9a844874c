"""DuckDB SQL for the operators that SQL can express."""

WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP3 = rf"""
WITH w AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
 words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
 windows AS (SELECT doc_id, i, hash(array_to_string(ws[i:i + 19], ' ')) AS h, md5(array_to_string(ws[i:i + 19], ' ')) AS m FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
 seen AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h, m ORDER BY doc_id, i) AS r FROM windows),
 gone AS (SELECT DISTINCT doc_id, i + k AS i FROM seen, range(20) t(k) WHERE r > 1),
 kept AS (SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS text FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g ON w.doc_id = g.doc_id LEFT JOIN kept ON w.doc_id = kept.doc_id"""

OP4 = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
 p AS (SELECT doc_id, l, i, hash(b[i:i + l - 1]) AS h FROM (SELECT doc_id, b, l, unnest(range(1, n - l + 2)) AS i FROM d, (VALUES (400), (240)) t(l))),
 again AS (SELECT doc_id, l, i FROM (SELECT doc_id, l, i, count(*) OVER (PARTITION BY l, h) AS c FROM p) WHERE c > 1),
 runs AS (SELECT doc_id, l, i, sum(fresh) OVER (PARTITION BY doc_id, l ORDER BY i) AS k FROM (SELECT doc_id, l, i, CASE WHEN i > lag(i, 1, -1000) OVER (PARTITION BY doc_id, l ORDER BY i) + l THEN 1 ELSE 0 END AS fresh FROM again)),
 every AS (SELECT doc_id, l, min(i) AS a, max(i) + l - 1 AS z FROM runs GROUP BY doc_id, l, k),
 spans AS (SELECT doc_id, a, z FROM every WHERE l = 400),
 cuts AS (SELECT doc_id, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) + 1 AS lo, a - 1 AS hi FROM spans
   UNION ALL SELECT d.doc_id, coalesce(max(z), 0) + 1, any_value(n) FROM d LEFT JOIN spans ON d.doc_id = spans.doc_id GROUP BY d.doc_id),
 kept AS (SELECT d.doc_id, unhex(string_agg(hex(b[lo:hi]), '' ORDER BY lo)) AS b FROM cuts JOIN d ON cuts.doc_id = d.doc_id WHERE hi >= lo GROUP BY d.doc_id),
 sums AS (SELECT doc_id, l, sum(z - a + 1) AS r, count(*) AS s FROM every GROUP BY doc_id, l)
SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(t.r, 0)::BIGINT AS n_removed, coalesce(t.s, 0)::BIGINT AS n_spans, sha256(coalesce(kept.b, ''::BLOB)) AS kept_sha256,
 coalesce(u.s, 0)::BIGINT AS n_passages, coalesce(u.r, 0)::BIGINT AS n_passage_bytes
FROM d LEFT JOIN sums t ON d.doc_id = t.doc_id AND t.l = 400 LEFT JOIN sums u ON d.doc_id = u.doc_id AND u.l = 240 LEFT JOIN kept ON d.doc_id = kept.doc_id"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP7 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(text=_LOW)} AS ws FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 links AS (SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n na ON a.doc_id = na.doc_id JOIN n nb ON b.doc_id = nb.doc_id
   GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
 reach AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT x, v FROM reach JOIN links ON y = u)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, d.doc_id)::BIGINT AS component_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) r ON d.doc_id = r.x"""

OP9 = rf"""
WITH sized AS (SELECT doc_id, source, len({WORDS.format(text="coalesce(text, '')")}) AS size, ('0x' || substr(md5('17:' || doc_id || ':' || coalesce(text, '')), 1, 15))::BIGINT AS place FROM documents),
 placed AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM sized),
 sources AS (SELECT source, size, row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS i FROM (SELECT source, sum(size)::BIGINT AS size FROM sized GROUP BY source)),
 weighed AS (SELECT *, 1 + i % 3 AS w, sum(size) OVER () AS total FROM sources),
 -- Filled up to one level a weight: those of least bound a weight are full first.
 levels AS (SELECT *, 3.0::DOUBLE * size / w AS bound, (total - coalesce(sum(3 * size) OVER before, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level FROM weighed WINDOW before AS (ORDER BY 3.0::DOUBLE * size / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 goals AS (SELECT source, size, i, total, least(3.0::DOUBLE * size, w * (SELECT level FROM levels WHERE level <= bound ORDER BY bound, i LIMIT 1)) AS target FROM levels),
 seats AS (SELECT i, count(*) AS given FROM (SELECT i FROM (SELECT i, total, target, unnest(range(0, ceil(3 * size / 64.0)::BIGINT)) AS k FROM goals WHERE target > 0) ORDER BY target / (2 * k + 1) DESC, i LIMIT (SELECT ceil(any_value(total) / 64.0)::BIGINT FROM goals)) GROUP BY i),
 words AS (SELECT g.*, least(coalesce(given, 0) * 64, 3 * size)::BIGINT AS words FROM goals g LEFT JOIN seats s ON g.i = s.i),
 rests AS (SELECT *, CASE WHEN size > 0 THEN words // size ELSE 0 END AS rounds, CASE WHEN size > 0 THEN words % size ELSE 0 END AS rest FROM words),
 shards AS (SELECT r.i, rest, s, ceil(size / 64.0)::BIGINT // 16 + (CASE WHEN s < ceil(size / 64.0)::BIGINT % 16 THEN 1 ELSE 0 END) AS own FROM rests r, range(16) t(s)),
 turns AS (SELECT i, s, count(*) AS quota FROM (SELECT i, s, rest, row_number() OVER (PARTITION BY i ORDER BY own::DOUBLE / (2 * k + 1) DESC, s) AS r FROM (SELECT *, unnest(range(0, own)) AS k FROM shards)) WHERE r <= ceil(rest / 64.0) GROUP BY i, s),
 lasts AS (SELECT i, max(s + 16 * (quota - 1)) AS last FROM turns GROUP BY i),
 blocks AS (SELECT doc_id, source, start, size, unnest(range(start // 64, (start + size - 1) // 64 + 1)) AS j FROM placed WHERE size > 0),
 extra AS (SELECT doc_id, sum(greatest(0, least(b.start + b.size, j * 64 + CASE WHEN j = last THEN rest - 64 * (ceil(rest / 64.0)::BIGINT - 1) ELSE 64 END) - greatest(b.start, j * 64))) AS more
  FROM blocks b JOIN rests r ON b.source IS NOT DISTINCT FROM r.source JOIN turns t ON t.i = r.i AND t.s = j % 16 AND j // 16 < quota JOIN lasts l ON l.i = r.i GROUP BY doc_id),
 taken AS (SELECT p.doc_id, p.size, r.size AS source_size, round(target, 6) AS target, (rounds * p.size + coalesce(more, 0))::BIGINT AS taken, start FROM placed p JOIN rests r ON p.source IS NOT DISTINCT FROM r.source LEFT JOIN extra e ON p.doc_id = e.doc_id)
SELECT doc_id, size::BIGINT AS size, source_size, target, taken, CASE WHEN taken > 0 THEN (start // 64 % 16)::INTEGER ELSE -1 END AS shard FROM taken"""
