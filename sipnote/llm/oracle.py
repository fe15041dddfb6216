"""The same results as SQL, where SQL can express them."""

ORACLE: dict[str, str] = {}

ORACLE["op9_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""

ORACLE["op6_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
           lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 90 * (p.n + q.n - k)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON x = d.doc_id
"""


def _spans(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    """SQL for the list of a rule's spans in column t: what matches, and the text between."""
    quoted = pattern.replace("'", "''")
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{quoted}', 0)) + 1), lambda i: {{
        'start': CAST(coalesce(list_sum(list_transform(string_split_regex(t, '{quoted}')[1:i], lambda x: length(x))), 0)
          + coalesce(list_sum(list_transform(regexp_extract_all(t, '{quoted}', 0)[1:i-1], lambda x: length(x))), 0) AS BIGINT),
        'place': {order}, 'kind': '{kind}',
        'size': length(regexp_extract_all(t, '{quoted}', 0)[i]),
        'counted': length(regexp_extract_all(t, '{quoted}', {group})[i])}}), lambda s: s.counted >= {max(least, 1)})"""


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + f"|{_either_case('api')}_?{_either_case('key')}"
_JOINED = "array_to_string(list_transform({}, lambda s: s.kind || ':' || s.start || ':' || (s.start + s.size)), ',')"
_BASE = [
    ("assign", rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
]
_MORE = [
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("google", "AIza[A-Za-z0-9_-]{35}", 0, 1),
    ("payment", "[rs]k_live_[A-Za-z0-9]{16,}", 0, 1),
    ("webtoken", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("private_key", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 1),
]
# Runs of hex are looked for only where one is long enough; short runs are in every word.
_HEX = rf"CASE WHEN regexp_matches(t, '[0-9a-f]{{24}}') THEN {_spans('hex', 2, '[0-9a-f]{24,}', 0, 24)} ELSE [] END"

ORACLE["op2_secret_scans"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS (
  SELECT doc_id, {_spans('assign', 0, *_BASE[0][1:])} AS assign, {_spans('access', 1, *_BASE[1][1:])} AS access, {_HEX} AS hex,
         {', '.join(f"{_spans(k, 3 + i, p, g, n)} AS {k}" for i, (k, p, g, n) in enumerate(_MORE))}
  FROM d),
joined AS (
  SELECT doc_id, len(assign) AS n_assign, len(access) AS n_access, len(hex) AS n_hex,
         list_sort(assign || access || hex) AS base,
         list_sort(assign || access || hex || {' || '.join(k for k, *_ in _MORE)}) AS every
  FROM found)
SELECT doc_id, n_assign, n_access, n_hex, sha256({_JOINED.format('base')}) AS base_sha256, {_JOINED.format('every')} AS spans
FROM joined
"""

ORACLE["op11_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || doc_id) AS h
  FROM documents),
numbers AS (
  SELECT doc_id, t, u, len(u) AS n,
         [CAST('0x' || h[8 * i + 1 : 8 * i + 8] AS BIGINT) FOR i IN range(4)] AS h FROM d),
cuts AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
              WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
sections AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a+1:b], '') AS m, array_to_string(u[b+1:n], '') AS s
  FROM cuts)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM sections
"""

ORACLE["op12_vector_join"] = """
WITH RECURSIVE kept AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS n
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM kept a JOIN kept b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.9),
counts AS (SELECT x, count(*) AS n_links FROM links GROUP BY x),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(y, vec_id)) AS component_id,
       vec_id <= coalesce(y, vec_id) AS kept
FROM embeddings LEFT JOIN counts c ON c.x = vec_id LEFT JOIN least_of l ON l.x = vec_id
"""


def _assigned(name: str, book: str) -> str:
    """SQL for the nearest entry of each part by a codebook (part, entry, c)."""
    return f"""{name} AS MATERIALIZED (
  SELECT vec_id, part, x, min(s).e AS entry, min(s).d AS d
  FROM (SELECT p.vec_id, p.part, p.x,
               {{'d': list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': b.entry}} AS s
        FROM parts p JOIN {book} b USING (part))
  GROUP BY ALL)"""


def _improved(name: str, book: str, found: str) -> str:
    """SQL for a codebook after a round of assignments."""
    return f"""{name} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM {book} b LEFT JOIN (
    SELECT part, entry, list(CAST(floor(total / n) AS BIGINT) ORDER BY j) AS c
    FROM (SELECT part, entry, j, CAST(sum(v) AS BIGINT) AS total, count(*) AS n
          FROM (SELECT part, entry, unnest(x) AS v, unnest(range(len(x))) AS j FROM {found}) GROUP BY ALL)
    GROUP BY ALL) m USING (part, entry))"""


ORACLE["op13_vector_codes"] = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, CAST(part AS INT) AS part, v[part * len(v) // 16 + 1 : (part + 1) * len(v) // 16] AS x
  FROM kept, range(16) r(part)),
begun AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 64),
book0 AS MATERIALIZED (SELECT part, entry, x AS c FROM parts JOIN begun USING (vec_id)),
{_assigned('found1', 'book0')},
{_improved('book1', 'book0', 'found1')},
{_assigned('found2', 'book1')},
{_improved('book2', 'book1', 'found2')},
{_assigned('found3', 'book2')},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM found3 GROUP BY vec_id)
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       sha256((SELECT string_agg(array_to_string(c, ','), ',' ORDER BY part, entry) FROM book2)) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""
