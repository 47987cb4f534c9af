"""SQL of an independent engine for the queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"

HOST_QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{WORD}') AS ws FROM d),
u AS (SELECT rid, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT rid, i, a, lead(a, 1) OVER p AS b, lead(a, 2) OVER p AS c FROM u WINDOW p AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM g WHERE c IS NOT NULL),
p AS (SELECT rid, count(DISTINCT i + k) AS n_repeat FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY rid),
l AS (SELECT rid, count(*) - count(DISTINCT s) AS n_dup FROM (SELECT rid, unnest(string_split(t, chr(10))) AS s FROM d)
      WHERE regexp_matches(s, '{WORD}') GROUP BY rid),
m AS (SELECT w.rid, doc_id, source, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
             coalesce(n_repeat, 0) AS n_repeat_words
      FROM w LEFT JOIN l ON w.rid = l.rid LEFT JOIN p ON w.rid = p.rid),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM j GROUP BY source),
q AS (SELECT avg(f / n) AS mean, var_pop(f / n) AS v, avg(1 / n) AS inv FROM h),
s AS (SELECT mean, greatest(mean * (1 - mean) / greatest(v - mean * (1 - mean) * inv, 1e-6) - 1, 1.0) AS s FROM q),
b AS (SELECT source, (f + mean * s) / (n + s) > 0.9 AS bad FROM h, s)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND NOT bad AS kept
FROM j JOIN b ON j.source IS NOT DISTINCT FROM b.source
"""

FAIR_MIX = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
c AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / w AS level FROM s),
k AS (SELECT *, coalesce(sum(cap) OVER b, 0) AS capped, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS left_w, sum(source_size) OVER () AS total
      FROM c WINDOW b AS (ORDER BY level, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT max((total * 1.5::DOUBLE - capped) / left_w) FILTER ((total * 1.5::DOUBLE - capped) / left_w <= level) AS fill FROM k),
t AS (SELECT source, source_size, least(cap, coalesce(fill * w, cap)) AS target FROM k, f),
r AS (SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY h) AS cum
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT source, size, h, epoch,
             floor(least((cum + epoch * source_size)::DOUBLE / target, 32768.0::DOUBLE) * 17592186044416.0::DOUBLE)::BIGINT AS time
      FROM r, (SELECT unnest([0, 1]) AS epoch) WHERE target > 0),
x AS (SELECT *, sum(size) OVER (ORDER BY time) AS used FROM e),
y AS (SELECT source, max(h) FILTER (epoch = 0) AS h0, max(h) FILTER (epoch = 1) AS h1 FROM x
      WHERE used <= (SELECT sum(size) * 1.5 FROM d) GROUP BY source)
SELECT doc_id, size, source_size, target, (size * (coalesce(h <= h0, false)::INT + coalesce(h <= h1, false)::INT))::BIGINT AS taken
FROM r LEFT JOIN y ON r.source IS NOT DISTINCT FROM y.source
"""

NGRAM_JOIN = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '{WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
e AS (SELECT a, b FROM o JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * o >= 75 * (x.n + y.n - o)),
r AS (SELECT doc_id, doc_id AS far FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.far = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.low AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN (SELECT doc_id, min(far) AS low FROM r GROUP BY doc_id) c ON d.doc_id = c.doc_id
"""

SUBSTRING_DEDUP = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
w AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d WHERE len(ws) >= 20)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM w),
c AS (SELECT DISTINCT doc_id, i + j AS i FROM r, (SELECT unnest(range(0, 20)) AS j) WHERE k > 1),
u AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
k AS (SELECT u.doc_id, count(c.i) AS n_removed, string_agg(word, ' ' ORDER BY u.i) FILTER (c.i IS NULL) AS kept
      FROM u LEFT JOIN c ON u.doc_id = c.doc_id AND u.i = c.i GROUP BY u.doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

COLLOCATIONS = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM p),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM i, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, k, g, count(*)::HUGEINT AS f FROM g GROUP BY lang, k, g),
n AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, f, string_split(g, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
u AS (SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS g, max(f) AS most
      FROM c, (SELECT unnest([1, 2, 3]) AS s), (SELECT unnest([2, 3]) AS m) WHERE m < k AND s + m - 1 <= k GROUP BY ALL),
o AS (SELECT c.* FROM c LEFT JOIN u ON c.lang = u.lang AND c.g = u.g WHERE u.most IS NULL OR 100 * u.most < 80 * c.f),
x AS (SELECT lang, g, f, w, k, unnest(range(1, k)) AS j FROM o),
y AS (SELECT x.lang, x.g, x.f, x.j, l.f AS l, r.f AS r, (2000000 * x.f) // (l.f + r.f) AS score
      FROM x JOIN f l ON l.lang = x.lang AND l.g = array_to_string(x.w[1:x.j], ' ') JOIN f r ON r.lang = x.lang AND r.g = array_to_string(x.w[x.j + 1:x.k], ' ')),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, j) AS low FROM y),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, g) AS rank FROM z WHERE low = 1)
SELECT q.lang, rank::INT AS rank, g AS phrase, f::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM q JOIN n ON q.lang = n.lang WHERE rank <= 2000
"""

STATEMENTS = {"op2_substring_dedup": SUBSTRING_DEDUP, "op1_ngram_join": NGRAM_JOIN, "op7_host_quality": HOST_QUALITY, "op9_fair_mix": FAIR_MIX, "op13_collocations": COLLOCATIONS}
