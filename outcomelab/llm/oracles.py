"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6 = rf"""
WITH item AS (
    SELECT item_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
phrase AS (
    SELECT DISTINCT item_id, array_to_string(w[k:k + 9], ' ') AS p, least(len(w), 10) AS n
    FROM item, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(k) WHERE len(w) > 0),
doc AS (
    SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
size AS (SELECT DISTINCT n FROM phrase),
place AS (
    SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS p
    FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS k FROM doc, size WHERE len(w) >= n)),
found AS (SELECT doc_id, k, n, item_id FROM place JOIN phrase USING (p, n)),
hit AS (SELECT doc_id, count(DISTINCT k + j) AS n_hit FROM found, unnest(range(0, n)) AS r(j) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP8 = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
place AS (
    SELECT doc_id, k, array_to_string(w[k:k + 34], ' ') AS p
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS k FROM doc WHERE len(w) >= 35)),
again AS (SELECT p FROM place GROUP BY p HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, k + j AS pos FROM place JOIN again USING (p), unnest(range(0, 35)) AS r(j)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS pos FROM doc),
kept AS (
    SELECT doc_id, string_agg(x, ' ' ORDER BY pos) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, pos)
    GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""

OP9 = rf"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s, least(len(w), 5) AS n
    FROM doc, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(k) WHERE len(w) > 0),
size AS (SELECT doc_id, count(*) AS c FROM shingle GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.n = b.n AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
    SELECT x, y FROM common JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
    WHERE 100 * common.c >= 85 * (p.c + q.c - common.c)),
way AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT DISTINCT x AS a, x AS b FROM way UNION SELECT a, y FROM reach JOIN way ON b = x),
least_of AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, coalesce(c, 0)::BIGINT AS n_shingles, coalesce(m, doc_id) AS component_id,
       coalesce(m, doc_id) = doc_id AS kept
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN least_of USING (doc_id)
"""

OP11 = rf"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents),
term AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        coalesce({_LOWER}, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
    FROM benchmark),
total AS (SELECT count(*)::BIGINT AS n_all, sum(len(w))::BIGINT AS l_all FROM doc WHERE len(w) > 0),
tf AS (
    SELECT doc_id, n, t, count(*)::BIGINT AS tf
    FROM (SELECT doc_id, len(w)::BIGINT AS n, unnest(w) AS t FROM doc) SEMI JOIN term USING (t) GROUP BY ALL),
weight AS (
    SELECT t, floor(1000 * ln((2 * n_all + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM tf, total GROUP BY t, n_all),
score AS (
    SELECT item_id, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_all) // l_all))))::BIGINT AS score
    FROM tf JOIN weight USING (t) JOIN term USING (t), total GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM score WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""

_LOWER_RUN = "translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = rf"""
WITH RECURSIVE step AS (
    SELECT b, b::BIGINT AS v, 0 AS k FROM range(256) AS r(b)
    UNION ALL
    SELECT b, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM step WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS c FROM step WHERE k = 8),
run AS (
    SELECT doc_id, {_LOWER_RUN} AS run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= 6 GROUP BY ALL),
byte AS (SELECT doc_id, run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM run),
hashed AS (
    SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(
        range(1, length(x)::BIGINT, 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
        lambda h, b: xor(h // 256, c[xor(h % 256, b) + 1])), 4294967295) AS h
    FROM byte, crc),
slipped AS (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
    FROM hashed),
word AS (
    SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (
    SELECT DISTINCT word, n, left(word, k - 1) || substr(word, k + 1) AS rest
    FROM word, unnest(range(1, length(word) + 1)) AS r(k)),
pair AS (
    SELECT a.word, b.word AS other FROM cut a JOIN word b ON a.rest = b.word
    UNION SELECT b.word, a.word FROM cut a JOIN word b ON a.rest = b.word
    UNION SELECT a.word, b.word FROM cut a JOIN cut b USING (rest)
    WHERE a.word <> b.word AND len(list_filter(range(1, length(a.word) + 1),
        lambda k: substr(a.word, k, 1) <> substr(b.word, k, 1))) = 1),
near AS (
    SELECT p.word, count(*)::BIGINT AS n_near, max(o.n) AS best_n, arg_min(other, (-o.n, other)) AS best
    FROM pair p JOIN word o ON o.word = p.other GROUP BY p.word),
formed AS (
    SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 5 * n THEN best END AS form,
           CASE WHEN best_n >= 5 * n THEN best_n END AS form_n
    FROM word LEFT JOIN near USING (word)),
way AS (
    SELECT word, word AS root, form AS next FROM formed
    UNION ALL
    SELECT way.word, f.word, f.form FROM way JOIN formed f ON f.word = way.next)
SELECT f.word, f.form, way.root, f.n, f.n_near, f.form_n
FROM formed f JOIN way ON way.word = f.word AND way.next IS NULL
"""
