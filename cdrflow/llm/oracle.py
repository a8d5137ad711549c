"""DuckDB SQL for the operators' queries that SQL can express.

Written from the contract of each query, not from its method: windows,
shingles and vectors are compared by brute force.  Components are the
transitive closure of the links.
"""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_SUBSTRING = f"""
WITH texts AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
windows AS (
  SELECT doc_id, s, array_to_string(ws[s : s + 19], ' ') AS k
  FROM texts, unnest(range(1, len(ws) - 18)) AS t(s)
),
firsts AS (SELECT k, min(struct_pack(d := doc_id, s := s)) AS f FROM windows GROUP BY k),
covered AS (
  SELECT DISTINCT doc_id, p
  FROM (SELECT w.doc_id, unnest(range(w.s, w.s + 20)) AS p
        FROM windows w JOIN firsts f ON w.k = f.k WHERE struct_pack(d := w.doc_id, s := w.s) > f.f)
),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM texts),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.p) AS text, count(*) AS n
  FROM words w ANTI JOIN covered c ON w.doc_id = c.doc_id AND w.p = c.p GROUP BY w.doc_id
)
SELECT t.doc_id, CAST(len(t.ws) AS BIGINT) AS n_words, CAST(len(t.ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id"""

_CLOSURE = """
reach AS (
  SELECT a AS id, b AS other FROM links
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
),
parts AS (SELECT id, least(id, min(other)) AS component FROM reach GROUP BY id)"""

_JACCARD = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, {_WORDS.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')")} AS ws FROM documents
),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(ws[s : s + 2], ' ') AS g
  FROM texts, unnest(range(1, greatest(len(ws) - 1, 2))) AS t(s) WHERE len(ws) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id
),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes p ON p.doc_id = s.a JOIN sizes q ON q.doc_id = s.b
  WHERE 100 * s.common >= 90 * (p.n + q.n - s.common)
),{_CLOSURE}
SELECT t.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, coalesce(p.component, t.doc_id) AS component_id
FROM texts t LEFT JOIN sizes s ON t.doc_id = s.doc_id LEFT JOIN parts p ON t.doc_id = p.id"""

_VECTORS = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
  ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  AND list_cosine_similarity(x.v, y.v) >= 0.93
),{_CLOSURE},
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, coalesce(p.component, e.vec_id) AS component_id,
  coalesce(p.component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counts c ON e.vec_id = c.a LEFT JOIN parts p ON e.vec_id = p.id"""

# The pages link within their host only, so trust and distrust stay on the seeds;
# the propagation itself is tested against a plain iteration.
_URLS = f"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN contains(coalesce(url, ''), '://')
         THEN translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '{_UPPER}', '{_UPPER.lower()}') ELSE '' END AS host,
    CASE WHEN contains(coalesce(url, ''), '://') THEN regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
),
rules(rule_host, rule_path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
ruled AS (
  SELECT p.page_id, p.host, p.path, r.rule_host || r.rule_path AS rule, r.verdict
  FROM parts p LEFT JOIN LATERAL (
    SELECT * FROM rules WHERE (p.host = rule_host OR suffix(p.host, '.' || rule_host)) AND prefix(p.path, rule_path)
    ORDER BY length(rule_host || rule_path) DESC LIMIT 1) r ON true
),
seeds AS (
  SELECT host, count(*) FILTER (verdict = 'allow') AS trusted, count(*) FILTER (verdict = 'block') AS blocked
  FROM ruled WHERE verdict IS NOT NULL GROUP BY host
),
hosts AS (
  SELECT host, CASE WHEN blocked / (SELECT CAST(greatest(sum(blocked), 1) AS DOUBLE) FROM seeds)
                       > trusted / (SELECT CAST(greatest(sum(trusted), 1) AS DOUBLE) FROM seeds)
                    THEN 'block' ELSE 'allow' END AS verdict
  FROM seeds
)
SELECT r.page_id, r.host, r.path, r.rule, coalesce(r.verdict, h.verdict, 'allow') AS verdict
FROM ruled r LEFT JOIN hosts h ON r.host = h.host"""


# The unsigned CRC-32 of a text's UTF-8 bytes: the table of the reflected polynomial, then byte by byte.
_CRC_TABLE = """
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS UBIGINT), [CAST(k AS UBIGINT) FOR k IN range(8)]),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS r(i))"""
_CRC = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS UBIGINT),
                 [CAST('0x' || substr(hex(encode({x})), 2 * k + 1, 2) AS UBIGINT) FOR k IN range(strlen({x}))]),
    lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS BIGINT)])))"""

_VARIANTS = f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
runs AS (
  SELECT id, run, count(*) AS times FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
           unnest(regexp_extract_all(translate(text, '{_UPPER}', lower('{_UPPER}')), '[A-Za-z\u00C0-\u00FF]+')) AS run
    FROM documents)
  GROUP BY ALL
),
hashed AS (SELECT run, times, {_CRC.format(x="(id || ':' || run)")} AS h FROM runs, crc),
words AS MATERIALIZED (
  SELECT word, CAST(sum(times) AS BIGINT) AS n
  FROM (SELECT times, CASE WHEN h % 97 = 0
          THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
          ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
),
holes AS MATERIALIZED (
  SELECT word, n, k, substr(word, 1, k) || substr(word, k + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS k FROM words)
),
pairs AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b USING (rest, k) WHERE a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.rest = w.word
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.rest = w.word
),
best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(m := -other_n, w := other)) AS top FROM pairs GROUP BY word
),
forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN -b.top.m >= 2 * w.n THEN b.top.w END AS form, CASE WHEN -b.top.m >= 2 * w.n THEN -b.top.m END AS form_n
  FROM words w LEFT JOIN best b USING (word)
),
ways AS (
  SELECT word, word AS at FROM forms UNION ALL SELECT y.word, f.form FROM ways y JOIN forms f ON f.word = y.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, y.at AS root
FROM forms f JOIN ways y ON y.word = f.word JOIN forms g ON g.word = y.at AND g.form IS NULL"""


def _lloyd_rounds(n: int) -> str:
    """CTEs of ``n`` rounds over all pairs of a part and an entry, then the last assignment."""
    steps = []
    for k in range(n + 1):
        steps.append(f"""
found{k} AS MATERIALIZED (
  SELECT row_id, part, min(struct_pack(d := d, entry := entry)) AS best
  FROM (SELECT c.row_id, c.part, b.entry, sum((c.v - b.v) * (c.v - b.v)) AS d
        FROM comps c JOIN book{k} b ON c.part = b.part AND c.pos = b.pos GROUP BY ALL)
  GROUP BY ALL
)""")
        if k < n:
            steps.append(f"""
book{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.pos, CASE WHEN m.n IS NULL THEN b.v ELSE (m.s - (((m.s % m.n) + m.n) % m.n)) // m.n END AS v
  FROM book{k} b LEFT JOIN (
    SELECT f.part, f.best.entry AS entry, c.pos, CAST(sum(c.v) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n
    FROM found{k} f JOIN comps c ON f.row_id = c.row_id AND f.part = c.part GROUP BY ALL
  ) m ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos
)""")
    return ",".join(steps)


_LLOYD = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS row_id, vec_id, label, embedding
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
comps AS MATERIALIZED (
  SELECT row_id, k // (n // 4) AS part, k % (n // 4) AS pos, CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT) AS v
  FROM (SELECT row_id, len(embedding) AS n, unnest(range(len(embedding))) AS k, unnest(embedding) AS x FROM kept)
),
book0 AS MATERIALIZED (SELECT part, row_id - 1 AS entry, pos, v FROM comps WHERE row_id <= 256),{_lloyd_rounds(4)},
books AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, pos)) AS digest FROM book4),
coded AS (
  SELECT row_id, string_agg(printf('%02x', CAST(best.entry AS INTEGER)), '' ORDER BY part) AS code,
         CAST(sum(best.d) AS BIGINT) AS error
  FROM found4 GROUP BY row_id
)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       b.digest AS codebooks_sha256
FROM kept k JOIN coded c ON k.row_id = c.row_id, books b"""

ORACLE_SQL = {
    "op4_substring_dedup": _SUBSTRING.strip(),
    "op5_ngram_join": _JACCARD.strip(),
    "op8_cover_tree": _VECTORS.strip(),
    "op10_url_filters": _URLS.strip(),
    "op11_gram_variants": _VARIANTS.strip(),
    "op13_cover_lloyd": _LLOYD.strip(),
}
