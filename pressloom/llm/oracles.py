"""SQL twins of the queries that SQL can express as a whole."""

BLANK_WORD = r"[^\x20\x09-\x0D]+"
LETTER_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _low(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_low('text')}, '{LETTER_WORD}') AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS m FROM (SELECT item_id, regexp_extract_all({_low('text')}, '{LETTER_WORD}') AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM b)),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)),
hit AS (SELECT DISTINCT doc_id, m, i, item_id FROM dw JOIN bw USING (m, g)),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, range(13) r(k) WHERE k < m GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

ARCHIVES = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
coded AS (SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> s) & 31) + 1, 1), '' ORDER BY g, s DESC) AS payload_digest
  FROM (SELECT hex, g, CAST('0x' || substr(hex, CAST(5 * g + 1 AS INTEGER), 5) AS INTEGER) AS v FROM (SELECT DISTINCT hex FROM p), range(8) r(g)), (VALUES (0), (5), (10), (15)) t(s)
  GROUP BY hex),
best AS (SELECT body, max(page_id) AS best FROM p GROUP BY body)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> best THEN best END AS refers_to
FROM p JOIN coded USING (hex) JOIN best USING (body)"""

NEAR_GROUPS = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_low('text')}, '{BLANK_WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, least(4, len(w)) AS k FROM d WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT x AS a, y AS b FROM (SELECT p.doc_id AS x, q.doc_id AS y, count(*) AS shared FROM s p JOIN s q USING (g) WHERE p.doc_id <> q.doc_id GROUP BY 1, 2)
  JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * shared >= 80 * (nx.n + ny.n - shared)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
roots AS (SELECT a AS doc_id, min(b) AS root FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(root, doc_id)) AS component_id, doc_id <= coalesce(root, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN roots USING (doc_id)"""

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{BLANK_WORD}') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
three AS (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS g FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM three WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{BLANK_WORD}') GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, coalesce(lines.dup, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
  coalesce(lines.n, 0) AS n_lines, length(t) - length(replace(t, '!', '')) AS n_marks, length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) AS n_capitals
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
    OR 5 * n_marks > n_words OR 10 * n_capitals > 3 * word_chars) AS kept FROM j"""


def _codebooks(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Product quantisation with one round per pair of steps; positions count from 0."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label, embedding
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
x AS MATERIALIZED (
  SELECT r, i // (len(embedding) // {parts}) AS part, i % (len(embedding) // {parts}) AS place,
         floor(4096 * embedding[i + 1]::DOUBLE)::BIGINT AS x
  FROM (SELECT *, unnest(range(len(embedding))) AS i FROM kept)),
book0 AS (SELECT part, r AS entry, place, x AS c FROM x WHERE r < {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
near{i} AS MATERIALIZED (
  SELECT r, part, min(struct_pack(d := d, entry := entry)) AS best
  FROM (SELECT r, part, entry, sum((x - c) * (x - c))::BIGINT AS d FROM x JOIN book{i} USING (part, place) GROUP BY ALL)
  GROUP BY ALL)""")
        if i < rounds:
            steps.append(f"""
book{i + 1} AS MATERIALIZED (
  SELECT part, entry, place, coalesce(m, c) AS c FROM book{i} LEFT JOIN (
    SELECT part, best.entry AS entry, place, ((s - ((s % n) + n) % n) // n)::BIGINT AS m
    FROM (SELECT part, best, place, sum(x)::HUGEINT AS s, count(*) AS n FROM (
            SELECT part, struct_pack(entry := best.entry) AS best, place, x FROM x JOIN near{i} USING (r, part)) GROUP BY ALL))
  USING (part, entry, place))""")
    steps.append(f"""
coded AS (
  SELECT r, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
  FROM near{rounds} GROUP BY r),
digest AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) AS h FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (r), digest""")
    return "WITH" + ",".join(steps[:-1]) + "," + steps[-1]


CODEBOOKS = _codebooks()
