"""The queries that SQL can express, for DuckDB over the same tables."""

STATEMENTS = {
    "op7_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 9) AS mark FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [1, 2, 3][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight, 3 * source_size AS cap FROM sums),
spread AS (
  SELECT *, cap::DOUBLE / weight AS full_at,
    ((SELECT sum(source_size) FROM sums) - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level_here
  FROM weighed),
aims AS (
  SELECT source, source_size, CASE WHEN full_at <= level THEN cap::DOUBLE ELSE weight * level END AS target
  FROM spread, (SELECT max(level_here) AS level FROM spread WHERE level_here <= full_at)),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS rounds FROM aims),
cells AS (SELECT source, mark, sum(size)::BIGINT AS words FROM sized GROUP BY source, mark),
reached AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY mark) AS upto FROM cells),
chosen AS (
  SELECT r.source, r.mark,
    upto <= target - rounds * source_size
      OR (upto - words <= target - rounds * source_size
        AND upto - (target - rounds * source_size) < (target - rounds * source_size) - (upto - words)) AS extra
  FROM reached r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, size * (rounds + extra::BIGINT) AS taken
FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
JOIN chosen c ON s.source IS NOT DISTINCT FROM c.source AND s.mark = c.mark
""",
    "op10_binary_topk": """
WITH codes AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x > 0) AS code FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
away AS (
  SELECT q.vec_id AS query_id, c.vec_id, len(list_filter(list_zip(q.code, c.code), lambda x: x[1] <> x[2]))::INT AS distance
  FROM codes q JOIN codes c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id))::INT AS rank, vec_id, distance
FROM away QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) <= 10
""",
    "op11_phrases": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece_id,
    regexp_extract_all(unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words
  FROM documents),
starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces),
grams AS (SELECT lang, words[i:i + k - 1] AS words FROM starts, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE i + k - 1 <= len(words)),
counts AS (SELECT lang, words, len(words) AS k, count(*) AS f FROM grams GROUP BY lang, words),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM counts WHERE k BETWEEN 2 AND 4 AND f >= 30),
cuts AS (SELECT lang, words, f, unnest(range(1, k)) AS cut FROM candidates),
scored AS (
  SELECT c.lang, c.words, c.f, c.cut, x.f AS l, y.f AS r, (2000000::HUGEINT * c.f // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.words = c.words[1:cut] JOIN counts y ON y.lang = c.lang AND y.words = c.words[cut + 1:]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1),
inner_parts AS (
  SELECT DISTINCT lang, words[i:i + m - 1] AS words, f FROM candidates, (VALUES (2), (3)) AS sizes(m), (VALUES (1), (2), (3)) AS places(i)
  WHERE m < k AND i + m - 1 <= k),
around AS (SELECT lang, words, max(f) AS longer FROM inner_parts GROUP BY lang, words),
kept AS (
  SELECT b.*, array_to_string(b.words, ' ') AS phrase FROM best b LEFT JOIN around a ON a.lang = b.lang AND a.words = b.words
  WHERE a.longer IS NULL OR 100::HUGEINT * a.longer < 80::HUGEINT * b.f)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank, phrase, f::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
""",
}
