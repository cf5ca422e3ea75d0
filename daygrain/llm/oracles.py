"""DuckDB SQL of the operators that it can state, over the whole tables."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CODE_WORDS = f"regexp_extract_all({_LOWER.format('text')}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
_BLANK = "'[^\\x20\\x09-\\x0D]+'"

DECONTAMINATE = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_CODE_WORDS} AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item, m, array_to_string(ws[i : i + m - 1], ' ') AS k
  FROM (SELECT item, ws, least(13, len(ws)) AS m, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i
        FROM items WHERE len(ws) > 0)),
docs AS (SELECT doc_id, coalesce({_CODE_WORDS}, []) AS ws FROM documents),
hits AS (
  SELECT d.doc_id, d.i, d.m, w.item
  FROM (SELECT doc_id, i, m, array_to_string(ws[i : i + m - 1], ' ') AS k
        FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
              FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(ws) >= m)) d
  JOIN windows w USING (m, k)),
words AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(found.n, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(words.n > 0 AND 20 * words.n >= len(ws), false) AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_COMPONENTS = """
both_ AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(x, root) AS (SELECT x, x FROM both_ UNION SELECT b.y, r.root FROM reach r JOIN both_ b ON b.x = r.x),
component AS (SELECT x, min(root) AS root FROM reach GROUP BY x)
"""

EMBEDDING_DEDUP = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id < b.vec_id
  WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
{_COMPONENTS},
counts AS (SELECT x, count(*) AS n FROM both_ GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN component c ON c.x = vec_id LEFT JOIN counts k ON k.x = vec_id
"""

SUBSTRING_DEDUP = f"""
WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(text, {_BLANK}), []) AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i : i + 19], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM docs)),
late AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM windows)
  WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM late),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM docs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id)
"""

JACCARD_JOIN = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format('text')}, {_BLANK}), []) AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM docs WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * shared.n >= 80 * (a.n + b.n - shared.n)),
{_COMPONENTS}
SELECT docs.doc_id, coalesce(sizes.n, 0) AS n_shingles, coalesce(root, docs.doc_id) AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN component c ON c.x = docs.doc_id
"""

#: Bytes as pairs of hexadecimal digits; windows are told apart by their MD5.
SUFFIX_DEDUP = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n
  FROM documents),
windows AS (
  SELECT doc_id, i, md5_number(h[2 * i - 1 : 2 * i + 798]) AS k
  FROM (SELECT doc_id, h, unnest(range(1, n - 398)) AS i FROM docs)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS c FROM windows) WHERE c > 1),
spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 399 AS b
  FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span
        FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 400 THEN 0 ELSE 1 END AS new
              FROM twice))
  GROUP BY doc_id, span),
cuts AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS was FROM spans),
kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a + 1) AS n_removed, max(b) AS last,
    string_agg(h[2 * was + 1 : 2 * a - 2], '' ORDER BY a) AS head
  FROM cuts JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || h[2 * coalesce(last, 0) + 1 : 2 * n])) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


_EXACT = "list_dot_product({}, {})"  # of whole numbers in doubles, far below 2^53


def _code_rounds(rounds: int) -> str:
    """CTEs a0 to a{rounds} (assignments) and b1 to b{rounds} (codebooks)."""
    out = []
    for r in range(rounds + 1):
        distance = f"{_EXACT.format('p.v', 'p.v')} - 2 * {_EXACT.format('p.v', 'b.v')} + {_EXACT.format('b.v', 'b.v')}"
        out.append(f"""
a{r} AS MATERIALIZED (
  SELECT p.n, p.pos, any_value(p.v) AS v, min(struct_pack(d := {distance}, e := b.entry)) AS best
  FROM parts p JOIN b{r} b ON b.pos = p.pos GROUP BY p.n, p.pos)""")
        if r < rounds:
            out.append(f"""
s{r} AS (SELECT pos, best.e AS entry, i, floor(sum(x) / count(*)) AS x
  FROM (SELECT pos, best, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM a{r}) GROUP BY ALL),
b{r + 1} AS MATERIALIZED (
  SELECT b.pos, b.entry, coalesce(m.v, b.v) AS v
  FROM b{r} b LEFT JOIN (SELECT pos, entry, list(x ORDER BY i) AS v FROM s{r} GROUP BY pos, entry) m USING (pos, entry))""")
    return ",".join(out)


#: Means are floors of quotients of whole numbers below 2^53: a double's quotient is then below the next whole number.
CODE_LLOYD = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, label,
    list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
parts AS MATERIALIZED (
  SELECT n, pos, v[pos * len(v) // 4 + 1 : (pos + 1) * len(v) // 4] AS v FROM kept, (SELECT unnest(range(4)) AS pos)),
b0 AS MATERIALIZED (SELECT pos, n - 1 AS entry, v FROM parts WHERE n <= 256),
{_code_rounds(4)},
books AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY pos, entry, i)) AS sha
  FROM (SELECT pos, entry, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS i FROM b4)),
codes AS (
  SELECT n, string_agg(lower(printf('%02x', CAST(best.e AS INTEGER))), '' ORDER BY pos) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a4 GROUP BY n)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256
FROM kept JOIN codes USING (n), books
"""
