"""The same results in SQL for DuckDB, where SQL can express a query whole."""

WORD = r"[^\x20\x09-\x0D]+"

OP2_VECTORS = """
WITH RECURSIVE vectors AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
sound AS (
  SELECT * FROM vectors WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
),
reach AS (
  SELECT vec_id AS node, vec_id AS root FROM vectors
  UNION
  SELECT p.b, r.root FROM reach r JOIN pairs p ON r.node = p.a WHERE r.root < p.b
),
links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a), least AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, root AS component_id, vec_id = root AS kept
FROM vectors LEFT JOIN links ON a = vec_id LEFT JOIN least ON node = vec_id
"""

OP9_MIXING = rf"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
    ('0x' || substr(md5('11:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents
),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighted AS (SELECT *, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::DOUBLE AS weight, 3.0::DOUBLE * source_size AS cap FROM sizes),
ordered AS (
  SELECT *, cap / weight AS top, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free, sum(source_size) OVER () AS total
  FROM weighted
),
level AS (SELECT first((total - capped) / free ORDER BY top, source NULLS LAST) FILTER (WHERE (total - capped) / free <= top) AS level FROM ordered),
targets AS (SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, weight * level) END AS target FROM ordered, level),
plans AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-9) ELSE 0 END::BIGINT AS whole,
    greatest(0.0, target - CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-9) ELSE 0 END * source_size) AS rest
  FROM targets
),
running AS (SELECT source, h, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS taken FROM docs GROUP BY source, h),
choices AS (
  SELECT p.source, r.h, abs(r.taken - p.rest) AS miss FROM plans p JOIN running r ON r.source IS NOT DISTINCT FROM p.source WHERE p.rest > 0
  UNION ALL SELECT source, -1, rest FROM plans WHERE rest > 0
),
best AS (SELECT source, arg_min(h, (miss, h)) AS threshold FROM choices GROUP BY source)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN h <= threshold THEN 1 ELSE 0 END))::BIGINT AS taken
FROM docs d JOIN plans p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN best b ON b.source IS NOT DISTINCT FROM d.source
"""

OP12_PHRASES = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, w FROM (
    SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents))
  WHERE len(w) > 0
),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4)) s(k) WHERE len(w) >= k) GROUP BY ALL HAVING count(*) >= 30
),
cuts AS (
  SELECT g.lang, g.phrase, g.f AS a, c, l.f AS l, r.f AS r, (2000000::HUGEINT * g.f) // (l.f + r.f) AS score
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS c FROM grams WHERE k > 1) g
  JOIN grams l ON l.lang = g.lang AND l.phrase = array_to_string(g.w[1:c], ' ') JOIN grams r ON r.lang = g.lang AND r.phrase = array_to_string(g.w[c + 1:g.k], ' ')
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
covers AS (
  SELECT lang, array_to_string(w[i:i + j - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - j + 2)) AS i FROM (SELECT lang, string_split(phrase, ' ') AS w, f AS a, k, unnest(range(2, k)) AS j FROM grams WHERE k > 2)) GROUP BY ALL
),
kept AS (SELECT b.* FROM best b LEFT JOIN covers c ON c.lang = b.lang AND c.phrase = b.phrase WHERE NOT coalesce(100 * longer >= 80 * a, false)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

OP13_EXACT = r"""
WITH texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
groups AS (SELECT t, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM texts GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM texts JOIN groups USING (t)
"""

SQL = {"op2_vectors": OP2_VECTORS, "op9_mixing": OP9_MIXING, "op12_phrases": OP12_PHRASES, "op13_exact": OP13_EXACT}
