"""DuckDB SQL for those operators that SQL can express on whole tables."""

from __future__ import annotations

from rowproof.llm import divergence, exactdedup, mixing

WORD = r"'[^\x20\x09-\x0D]+'"

SUPERKMERS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) AS w FROM documents),
  p AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
  k AS (SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS g FROM p),
  again AS (SELECT doc_id, i FROM k QUALIFY count(*) OVER (PARTITION BY g) > 1),
  gone AS (SELECT DISTINCT doc_id, i + j AS pos FROM again, range(35) AS t(j)),
  words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
  kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS n
    FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORD}) AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
      WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END) AS g FROM d),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
  l AS (SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
  e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
  r(x, y) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
  m AS (SELECT x, min(y) AS component FROM r GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.x = doc_id
"""

VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE len(list_filter(embedding, lambda a: a IS NULL OR NOT isfinite(a))) = 0
      AND len(list_filter(embedding, lambda a: a <> 0)) > 0),
  l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
  r(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
  m AS (SELECT x, min(y) AS component FROM r GROUP BY x),
  n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
  vec_id = coalesce(component, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.x = vec_id LEFT JOIN m ON m.x = vec_id
"""

PERIODS = rf"""
WITH c AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) AS w,
    xor(list_reduce(flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''),
        lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END,
      CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM documents),
  b AS (SELECT *, len(w) AS n, h // 10 AS g FROM c),
  f AS (SELECT *, g % n AS a FROM b WHERE n > 0),
  k AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS q FROM f),
  d AS (SELECT id, doc_id, n, CASE WHEN h % 10 = 0
      THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i >= a THEN a + (i - a) % q ELSE i END]) ELSE w END AS w FROM k),
  words AS (SELECT id, unnest(w) AS word, unnest(range(n)) AS i FROM d),
  tried AS (SELECT id, p, unnest(range(0, n - 3 * p + 1, p)) AS i FROM (SELECT id, n, unnest(range(1, n // 4 + 1)) AS p FROM d)),
  alike AS (SELECT t.id, p, t.i FROM tried t JOIN words x ON x.id = t.id AND x.i = t.i
    JOIN words y ON y.id = t.id AND y.i = t.i + p AND y.word = x.word),
  inside AS (SELECT id, p, i FROM alike JOIN d USING (id) WHERE w[i + 1 : i + 2 * p] = w[i + p + 1 : i + 3 * p]),
  differ AS (SELECT id, p, j FROM (SELECT id, p, w, unnest(range(n - p)) AS j FROM (SELECT DISTINCT id, p FROM inside) JOIN d USING (id))
    WHERE w[j + 1] <> w[j + p + 1]),
  bounds AS (SELECT id, p, i, coalesce(max(j) FILTER (j < i) + 1, 0) AS s, coalesce(min(j) FILTER (j >= i), any_value(n) - p) + p AS e
    FROM inside JOIN d USING (id) LEFT JOIN differ USING (id, p) GROUP BY id, p, i),
  runs AS (SELECT id, s, e - s AS m, min(p) AS p FROM bounds WHERE e - s >= greatest(6, 4 * p) GROUP BY id, s, e),
  listed AS (SELECT id, count(*) AS n_runs, string_agg(s || ',' || m || ',' || p || chr(10), '' ORDER BY s, p) AS t,
    max(struct_pack(m := m, s := -s, p := -p)) AS best FROM runs GROUP BY id),
  gone AS (SELECT DISTINCT id, unnest(range(s + p, s + m)) AS i FROM runs),
  kept AS (SELECT id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (id, i) GROUP BY id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -best.s AS start, CAST(best.m AS BIGINT) AS length, -best.p AS period,
  1000 * best.m // -best.p AS exponent_milli, sha256(coalesce(listed.t, '')) AS runs_sha256,
  sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM c LEFT JOIN listed USING (id) LEFT JOIN kept USING (id)
"""

ORACLES = {
    "op3_vector_dedup": VECTORS,
    "op6_jaccard_join": JACCARD,
    "op7_mixing": mixing.ORACLE,
    "op9_exact_dedup": exactdedup.ORACLE,
    "op10_superkmer_dedup": SUPERKMERS,
    "op11_periodic_runs": PERIODS,
    "op12_source_divergence": divergence.ORACLE,
}
