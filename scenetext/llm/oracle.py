"""The training-data queries in DuckDB's SQL, as far as SQL can express them."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The running number of a document decides its copies, so order and arithmetic are those of the operator.
MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS k,
    md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':0') AS mark
  FROM documents
), s AS (
  SELECT k, any_value(source) AS source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY k
), w AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) AS lim,
    CAST(CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight
  FROM s
), r AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(lim) OVER b, 0) AS free,
    sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS free_weight
  FROM w
  WINDOW b AS (ORDER BY lim / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), f AS (
  SELECT *, lim / weight <= free / free_weight AS is_full FROM r
), t AS (
  SELECT *, CASE WHEN is_full THEN lim ELSE weight * (
    SELECT free / free_weight FROM f WHERE NOT is_full ORDER BY lim / weight, free / free_weight DESC LIMIT 1
  ) END AS target FROM f
), e AS (
  SELECT k, source_size, target,
    CAST(least(CASE WHEN source_size > 0 THEN floor(target / source_size * 1000000000) ELSE 0 END, 3000000000) AS HUGEINT) AS e,
    CAST(floor(CAST(CAST('0x' || substr(md5('0:' || k), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296 * 1000000000) AS HUGEINT) AS u
  FROM t
), n AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY size, mark, doc_id IS NULL, doc_id) AS i FROM d
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(((i * e + u) // 1000000000 - ((i - 1) * e + u) // 1000000000) * size AS BIGINT) AS taken
FROM n JOIN e USING (k)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, x FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS x
    FROM d
  )
), n AS MATERIALIZED (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), both_have AS MATERIALIZED (
  SELECT a.doc_id AS p, b.doc_id AS q, count(*) AS c FROM sh a JOIN sh b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT p, q FROM both_have JOIN n np ON np.doc_id = p JOIN n nq ON nq.doc_id = q WHERE 100 * c >= 80 * (np.n + nq.n - c)
), reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT links.p, reach.c FROM reach JOIN links ON links.q = reach.doc_id
), least_id AS (
  SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN least_id USING (doc_id) LEFT JOIN n USING (doc_id)
"""

# Every phrase of two to five words of every piece is counted, without any candidates.
COLLOCATIONS = rf"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece
), n AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), f AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS c FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase
    FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k
  ) GROUP BY ALL HAVING count(*) >= 100
), cut AS (
  SELECT lang, phrase, k AS words, c AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS first FROM f WHERE k > 1
), part AS (
  SELECT cut.*, x.c AS l, y.c AS r, n, CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(x.c AS HUGEINT) * y.c) AS BIGINT) AS score
  FROM cut JOIN n USING (lang)
  JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(list_slice(w, 1, first), ' ')
  JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(list_slice(w, first + 1, words), ' ')
), least_cut AS (
  SELECT * FROM part QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, first) = 1
), alone AS (
  SELECT * FROM least_cut m WHERE NOT EXISTS (
    SELECT 1 FROM f WHERE f.lang = m.lang AND f.k > m.words AND f.c >= m.a AND contains(' ' || f.phrase || ' ', ' ' || m.phrase || ' ')
  )
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM alone) WHERE rank <= 2000
"""

# crc32 by its table, which is made from the polynomial; near words share what is left without one letter.
SPELLING = rf"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(CAST(b AS BIGINT), range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)
), run AS (
  SELECT x, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || x)) AS hx
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS x FROM documents)
  WHERE length(x) >= 7
), marked AS (
  SELECT x, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(hx) // 2), lambda i: CAST('0x' || hx[2 * i + 1:2 * i + 2] AS BIGINT))),
    lambda c, v: xor(c >> 8, t[xor(c & 255, v) + 1])
  )) AS h
  FROM run, crc
), w AS MATERIALIZED (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(x, 1, h % length(x)) || substr(x, h % length(x) + 2) ELSE x END AS word FROM marked
  ) WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), hole AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)
), pair AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM hole a JOIN hole b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT hole.word, hole.n, w.word, w.n FROM hole JOIN w ON w.word = rest
  UNION
  SELECT w.word, w.n, hole.word, hole.n FROM hole JOIN w ON w.word = rest
), best AS (
  SELECT word, n, count(*) AS n_near, max(near_n) AS top_n, arg_min(near, struct_pack(m := -near_n, near := near)) AS top FROM pair GROUP BY word, n
), v AS MATERIALIZED (
  SELECT w.word, w.n, CASE WHEN top_n >= 10 * w.n THEN top END AS form, CASE WHEN top_n >= 10 * w.n THEN top_n END AS form_n, coalesce(n_near, 0) AS n_near
  FROM w LEFT JOIN best USING (word)
), way AS (
  SELECT word, word AS reached, form AS further FROM v
  UNION ALL
  SELECT way.word, v.word, v.form FROM way JOIN v ON v.word = way.further
)
SELECT v.word, form, reached AS root, n, n_near, form_n FROM v JOIN way USING (word) WHERE further IS NULL
"""


def url_filters(rules: tuple[tuple[str, str], ...]) -> str:
    """Judging by ``rules`` (key with a path, action) and the hosts that carry tracking parameters."""
    values = ", ".join(f"('{key}', '{action}')" for key, action in rules)
    return rf"""
WITH p AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), h AS (
  SELECT row_number() OVER () AS row_no, page_id, url,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM p
), rules AS (
  SELECT key, action, split_part(key, '/', 1) AS rule_host, substr(key, instr(key, '/')) AS rule_path
  FROM (VALUES {values}) AS v(key, action)
), listed AS (
  SELECT host AS key FROM h WHERE host <> '' GROUP BY host
  HAVING count(*) >= 20
    AND sum(CASE WHEN regexp_matches(url, '[?&](?:utm_[a-z]+|ref|fbclid|gclid)=') THEN 1 ELSE 0 END) >= CAST(0.4 AS DOUBLE) * count(*)
), by_rule AS (
  SELECT row_no, max(struct_pack(n := length(key), key := key, action := action)) AS best
  FROM h JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY row_no
), by_host AS (
  SELECT row_no, max(struct_pack(n := length(key), key := key)) AS best
  FROM h JOIN listed ON host = key OR ends_with(host, '.' || key)
  GROUP BY row_no
)
SELECT page_id, host, path, by_rule.best.key AS rule,
  CASE WHEN by_rule.best.action IS NOT NULL THEN by_rule.best.action WHEN by_host.best.key IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  by_host.best.key AS listed_host
FROM h LEFT JOIN by_rule USING (row_no) LEFT JOIN by_host USING (row_no)
"""
