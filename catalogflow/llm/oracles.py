"""SQL of the queries whose rows SQL can compute, where it is long."""

# fixed values: the reflected CRC-32 polynomial and its all-ones start. The
# checksum is linear over xor: byte i of L adds what it leaves after L-1-i zero
# bytes, the start adds what it leaves after L.
CRC = """
bits(b, c, k) AS (SELECT b, b, 0 FROM (SELECT unnest(range(256)) AS b)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT b, c FROM bits WHERE k = 8),
left_by(k, b, c) AS (SELECT 0, b, c FROM tab
  UNION ALL SELECT k + 1, l.b, xor(l.c >> 8, tab.c) FROM left_by l JOIN tab ON tab.b = l.c & 255
    WHERE k < (SELECT max(n) FROM messages)),
start(k, c) AS (SELECT 0, 4294967295
  UNION ALL SELECT k + 1, xor(s.c >> 8, tab.c) FROM start s JOIN tab ON tab.b = s.c & 255
    WHERE k < (SELECT max(n) FROM messages)),
crc AS (SELECT m.id, xor(xor(m.x, start.c), 4294967295) AS h FROM
  (SELECT m.id, m.n, bit_xor(l.c) AS x FROM message_bytes m JOIN left_by l ON l.k = m.n - 1 - m.i AND l.b = m.b GROUP BY m.id, m.n) m
  JOIN start ON start.k = m.n)"""

CUCKOO = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS size,
  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
r AS (SELECT *, row_number() OVER w AS k, first_value(doc_id) OVER w AS keep_id,
  count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t
  WINDOW w AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, k = 1 AS kept, text_sha256 FROM r
"""

TRIE = f"""
WITH RECURSIVE convs AS (SELECT DISTINCT conv_id AS id FROM conversations WHERE conv_id IS NOT NULL),
messages AS (SELECT id, length(id::varchar) AS n FROM convs),
message_bytes AS (SELECT id, n, i, ascii(substr(id::varchar, i::int + 1, 1)) AS b FROM messages, unnest(range(n)) AS u(i)),
{CRC},
own AS (SELECT conv_id AS id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations WHERE conv_id IS NOT NULL),
takes AS (SELECT id, id - id % 5 AS donor, h % 9 AS h FROM crc),
turns AS (SELECT t.id, 0 AS part, o.pos, o.role, o.text FROM takes t JOIN own o ON o.id = t.donor AND o.pos <= t.h
  UNION ALL SELECT t.id, 1, o.pos, o.role, o.text FROM takes t JOIN own o ON o.id = t.id AND o.pos > t.h),
named AS (SELECT *, dense_rank() OVER (ORDER BY role, text) AS name FROM turns),
prefix AS (SELECT id, row_number() OVER w AS d, string_agg(name::varchar, ',') OVER w AS key, strlen(text) AS size
  FROM named WINDOW w AS (PARTITION BY id ORDER BY part, pos)
  UNION ALL SELECT id, 0, '', 0 FROM convs),
ended AS (SELECT id, max(d) AS n FROM prefix GROUP BY id),
node AS (SELECT p.key, p.d, min(p.id) AS conv_id, count(*) AS n_convs, max(p.size) AS size,
  sha256(coalesce(string_agg(p.id::varchar, ',' ORDER BY p.id) FILTER (WHERE e.n = p.d), '')) AS ends_sha256
  FROM prefix p JOIN ended e ON e.id = p.id GROUP BY p.key, p.d),
up AS (SELECT n.key, p.key AS parent FROM node n JOIN prefix p ON p.id = n.conv_id AND p.d = n.d - 1),
child AS (SELECT parent AS key, count(*) AS n_children FROM up GROUP BY parent),
full_node AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM node n LEFT JOIN child c ON c.key = n.key),
below AS (SELECT p.key, sum((n.n_convs - 1) * n.size)::bigint AS saved_tokens, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves
  FROM full_node n JOIN prefix p ON p.id = n.conv_id AND p.d <= n.d GROUP BY p.key)
SELECT n.conv_id, n.d AS depth, q.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
FROM full_node n JOIN below b ON b.key = n.key LEFT JOIN up u ON u.key = n.key LEFT JOIN node q ON q.key = u.parent
"""

SPELLING = rf"""
WITH RECURSIVE runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
found AS (SELECT doc_id, run, count(*) AS n, row_number() OVER () AS id FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
written AS (SELECT id, coalesce(doc_id::varchar, '') || ':' || run AS m FROM found),
code AS (SELECT id, i, unicode(substr(m, i::int + 1, 1)) AS c FROM written, unnest(range(length(m))) AS u(i)),
byte AS (SELECT id, i * 2 AS place, CASE WHEN c < 128 THEN c ELSE 192 + (c >> 6) END AS b FROM code
  UNION ALL SELECT id, i * 2 + 1, 128 + (c & 63) FROM code WHERE c >= 128),
message_bytes AS (SELECT id, b, row_number() OVER (PARTITION BY id ORDER BY place) - 1 AS i, count(*) OVER (PARTITION BY id) AS n FROM byte),
messages AS (SELECT DISTINCT id, n FROM message_bytes),
{CRC},
spelled AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) ELSE run END AS word, n
  FROM found JOIN crc ON crc.id = found.id),
words AS (SELECT word, sum(n)::bigint AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (SELECT word, n, i, substr(word, 1, i::int) || substr(word, i::int + 2) AS rest FROM words, unnest(range(length(word))) AS u(i)),
replaced AS (SELECT a.word, b.word AS near, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word),
inserted AS (SELECT DISTINCT cut.word AS long_word, words.word AS short_word, cut.n AS long_n, words.n AS short_n
  FROM cut JOIN words ON words.word = cut.rest),
near AS (SELECT word, near, m FROM replaced UNION SELECT long_word, short_word, short_n FROM inserted
  UNION SELECT short_word, long_word, long_n FROM inserted),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY m DESC, near) AS near, max(m) AS m FROM near GROUP BY word),
formed AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 10 * w.n THEN b.near END AS form,
  CASE WHEN b.m >= 10 * w.n THEN b.m END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
chain(word, last) AS (SELECT word, word FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.last WHERE f.form IS NOT NULL),
root AS (SELECT c.word, c.last AS root FROM chain c JOIN formed f ON f.word = c.last WHERE f.form IS NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM formed f JOIN root r ON r.word = f.word
"""
