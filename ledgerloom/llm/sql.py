"""DuckDB statements for the queries that SQL can express."""

_WORDS = r"[^\x20\x09-\x0D]+"

_OP3 = rf"""
WITH docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0) AS size,
           md5('17:' || coalesce(doc_id::VARCHAR, '')) AS key1
    FROM documents
),
sources AS (
    SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w, sum(source_size) OVER () AS total
    FROM (SELECT source, sum(size) AS source_size FROM docs GROUP BY source)
),
ordered AS (
    SELECT *,
           coalesce(sum(source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2 AS capped_before,
           sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_onward
    FROM sources
),
judged AS (SELECT *, total * 3 - capped_before * 2 AS rest, (total * 3 - capped_before * 2) * w > source_size * 4 * w_onward AS capped FROM ordered),
level AS (SELECT rest AS level_rest, w_onward AS level_w FROM judged WHERE NOT capped ORDER BY w_onward DESC LIMIT 1),
goals AS (
    SELECT source, source_size, CASE WHEN capped THEN (source_size * 2)::DOUBLE ELSE (w * level_rest)::DOUBLE / (level_w * 2)::DOUBLE END AS target
    FROM judged LEFT JOIN level ON true
),
summed AS (
    SELECT doc_id, size, source, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM docs
),
placed AS (
    SELECT doc_id, size, before, source_size::BIGINT AS source_size, target, floor(target)::BIGINT AS goal,
           CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size::BIGINT ELSE 0 END AS whole
    FROM summed JOIN goals ON summed.source IS NOT DISTINCT FROM goals.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (whole * size + least(greatest(goal - whole * source_size - before, 0), size))::BIGINT AS taken
FROM placed
"""

_OP1 = """
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
split AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM docs),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM split
),
shared AS (SELECT key, min(doc_id) AS stays FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE doc_id > stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays IS NULL OR doc_id <= stays), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key)
GROUP BY doc_id
"""

_OP2 = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS words FROM documents
),
sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(words) = 0 THEN []
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingles
    FROM docs
),
posts AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM posts a JOIN posts b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(doc_id, other) AS (SELECT a, b FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT s.doc_id, len(shingles)::BIGINT AS n_shingles, least(s.doc_id, coalesce(other, s.doc_id)) AS component_id,
       least(s.doc_id, coalesce(other, s.doc_id)) = s.doc_id AS kept
FROM sets s LEFT JOIN least USING (doc_id)
"""

#: The unsigned crc32 of a list of bytes {bytes}: a byte goes in, then eight steps (-1) take a bit out each.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform({bytes}, lambda b: [b::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384::BIGINT * (c & 1)) END), 4294967295::BIGINT)"""
_UTF8 = "flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [195, unicode(c) - 64] END))"

_OP11 = f"""
WITH RECURSIVE found AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL
),
summed AS (SELECT run, c, {_CRC32.format(bytes=_UTF8.format(text="coalesce(doc_id::VARCHAR, '') || ':' || run"))} AS h FROM found),
cut AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, c FROM summed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
places AS (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words),
holes AS (SELECT word, n, left(word, i - 1) || chr(0) || substr(word, i + 1) AS hole, left(word, i - 1) || substr(word, i + 1) AS less FROM places),
near AS (
    SELECT a.word, b.word AS near, b.n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
    UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.less = w.word
    UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.less = w.word
),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n FROM near GROUP BY word),
forms AS (
    SELECT w.word, CASE WHEN near_n >= 2 * w.n THEN near END AS form, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
    FROM words w LEFT JOIN best b ON w.word = b.word
),
steps(word, root) AS (SELECT word, form FROM forms WHERE form IS NOT NULL UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON s.root = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT s.word, s.root FROM steps s JOIN forms f ON s.root = f.word WHERE f.form IS NULL)
SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n FROM forms f LEFT JOIN ends e ON f.word = e.word
"""

_OP12 = rf"""
WITH docs AS (
    SELECT doc_id, words, len(words) AS n, h, h // 10 AS g, (h // 10) % greatest(len(words), 1) AS a
    FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS words, {_CRC32.format(bytes="list_transform(string_split(doc_id::VARCHAR, ''), lambda c: unicode(c))")} AS h FROM documents)
),
numbered AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p, unnest(range(n)) AS i FROM docs),
read AS (SELECT doc_id, n, i, words[(CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END) + 1] AS word FROM numbered),
same AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM read x JOIN read y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i AND 2 * (y.i - x.i) <= x.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island HAVING count(*) >= q AND count(*) + q >= 12),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
told AS (
    SELECT doc_id, count(*) AS n_runs, first(struct_pack(start := start, length := length, period := period) ORDER BY length DESC, start, period) AS top,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
    FROM runs GROUP BY doc_id
),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT r.doc_id, string_agg(word, ' ' ORDER BY r.i) AS text FROM read r ANTI JOIN gone g ON r.doc_id = g.doc_id AND r.i = g.i GROUP BY r.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, top.start AS start, top.length AS length, top.period AS period, 1000 * top.length // top.period AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM docs d LEFT JOIN told t ON d.doc_id = t.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

SQL: dict[str, str] = {"op1_line_dedup": _OP1, "op2_near_dedup": _OP2, "op3_mix": _OP3, "op11_spelling_variants": _OP11, "op12_periodic_runs": _OP12}
