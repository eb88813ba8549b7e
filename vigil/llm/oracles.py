"""DuckDB SQL for the operators that SQL can express, written from their contracts."""

from __future__ import annotations

from vigil.llm.chat import END, TURN

SPACED = r"[^\x20\x09-\x0D]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _escaped(c: str) -> str:
    return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')"


CHAT = f"""WITH t AS (
    SELECT CAST(conv_id AS BIGINT) conv_id, turn, coalesce(role, '') r, coalesce(text, '') x FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
  g AS (SELECT conv_id, count(*) AS n_turns, string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn, r, x) AS turns,
      coalesce(string_agg(x, '' ORDER BY turn, r, x) FILTER (WHERE r = 'assistant'), '') AS loss,
      CAST(sum({len(TURN) + 1 + len(END)} + length(replace({_escaped('r')}, chr(10), '&#10;')) + length({_escaped('x')})) AS BIGINT)
        AS formatted_chars
    FROM t GROUP BY conv_id)
  SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
    formatted_chars FROM g"""

FACTORS = rf"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w FROM documents),
  win AS (SELECT doc_id, p, list_slice(w, p, p + 19) AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
  dup AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS n FROM win) WHERE n > 1),
  gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM dup),
  kept AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS t
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) x
    ANTI JOIN gone USING (doc_id, p) GROUP BY x.doc_id),
  n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
  SELECT d.doc_id, len(d.w) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
  FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""

NEAR = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{SPACED}') AS w FROM documents),
  s AS (SELECT doc_id, CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || chr(10) || w[i + 1]))
      WHEN len(w) = 1 THEN w ELSE [] END AS k FROM d),
  e AS (SELECT doc_id, len(k) AS n, unnest(k) AS x FROM s),
  c AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS an, b.n AS bn, count(*) AS both_n FROM e a JOIN e b
    ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n GROUP BY ALL),
  l AS (SELECT a, b FROM c WHERE 100 * both_n >= 80 * (an + bn - both_n)),
  m AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
  r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, m.b FROM r JOIN m ON r.b = m.a)
  SELECT s.doc_id, len(s.k) AS n_shingles, min(r.b) AS component_id, min(r.b) = s.doc_id AS kept
  FROM s JOIN r ON r.a = s.doc_id GROUP BY s.doc_id, len(s.k)"""

_NORMAL = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LEAKS = f"""WITH d AS (SELECT doc_id, {_NORMAL} AS w FROM documents),
  i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_NORMAL} AS w FROM benchmark),
  k AS (SELECT DISTINCT item_id, list_slice(w, p, p + n - 1) AS k, n
    FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
  dw AS (SELECT doc_id, p, n, list_slice(w, p, p + n - 1) AS k
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM k) WHERE len(w) >= n)),
  hit AS (SELECT doc_id, p, n, item_id FROM dw JOIN k USING (k, n)),
  words AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) FROM hit) GROUP BY doc_id),
  items AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
  SELECT d.doc_id, len(d.w) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
    sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
  FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

DIVERGENCE = rf"""WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
  o AS (SELECT i, lang, source, unnest(w) AS term FROM d),
  kept AS (SELECT lang, term, count(*) AS c FROM o GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
  own AS (SELECT lang, source, term, count(*) AS c FROM o GROUP BY ALL),
  grid AS (SELECT g.lang, g.source, k.term, k.c AS lc, coalesce(own.c, 0) AS c
    FROM (SELECT DISTINCT lang, source FROM d) g JOIN kept k USING (lang) LEFT JOIN own USING (lang, source, term)),
  p AS (SELECT *, 1 + (1000000000::HUGEINT * (c + 1)) // (sum(c) OVER s + count(*) OVER s) AS p,
      1 + (1000000000::HUGEINT * (lc + 1)) // (sum(lc) OVER s + count(*) OVER s) AS q
    FROM grid WINDOW s AS (PARTITION BY lang, source)),
  pair AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS v
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
  every AS (SELECT a.lang, a.source, b.source AS item, coalesce(pair.v, 0) AS v
    FROM (SELECT DISTINCT lang, source FROM d) a JOIN (SELECT DISTINCT lang, source FROM d) b
      ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
  found AS (SELECT lang, source, 'pair' AS part, item, v FROM every
    UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE c > 0 AND p > q),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY v DESC, encode(item)) AS r FROM found)
  SELECT lang, source, part, item, CAST(v AS BIGINT) AS value, CAST(r AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR r <= 200"""

COLLOCATIONS = rf"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
  f AS (SELECT lang, k, array_to_string(g, ' ') AS phrase, count(*) AS a
    FROM (SELECT lang, k, list_slice(w, p, p + k - 1) AS g
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM w, (VALUES (1), (2), (3), (4)) s(k) WHERE len(w) >= k))
    GROUP BY ALL),
  n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
  c AS (SELECT lang, k AS size, phrase, a, string_split(phrase, ' ') AS g FROM f WHERE k > 1 AND a >= 30),
  cut AS (SELECT lang, phrase, a, k, array_to_string(list_slice(g, 1, k), ' ') AS lp, array_to_string(list_slice(g, k + 1, size), ' ') AS rp
    FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
  s AS (SELECT cut.lang, cut.phrase, cut.a, cut.k, x.a AS l, y.a AS r, (2000000::HUGEINT * cut.a) // (x.a + y.a) AS score
    FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = lp JOIN f y ON y.lang = cut.lang AND y.phrase = rp),
  best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS i FROM s) WHERE i = 1),
  inside AS (SELECT lang, array_to_string(list_slice(g, p, p + m - 1), ' ') AS phrase, max(a) AS longer
    FROM (SELECT *, unnest(range(1, size - m + 2)) AS p FROM (SELECT *, unnest(range(2, size)) AS m FROM c)) GROUP BY ALL),
  kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
  SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""
