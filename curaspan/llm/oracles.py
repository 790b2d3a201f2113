"""SQL counterparts, where SQL can express a query on whole tables."""

from __future__ import annotations

OP3 = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
  FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""

OP12 = r"""
WITH doc_terms AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), totals AS (
  SELECT count(*) AS all_docs, CAST(sum(len(terms)) AS BIGINT) AS all_terms FROM doc_terms WHERE len(terms) > 0
), counted AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM doc_terms) GROUP BY ALL
), weighted AS (
  SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counted, totals GROUP BY term, all_docs
), scored AS (
  SELECT item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms)))) AS BIGINT) AS score
  FROM item_terms JOIN counted USING (term) JOIN weighted USING (term), totals GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
  FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""

OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), runs AS (
  SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS start
  FROM split, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(words) >= size
), counted AS (
  SELECT lang, size, array_to_string(words[start:start + size - 1], ' ') AS phrase, count(*) AS f FROM runs GROUP BY ALL
), frequent AS (
  SELECT lang, size, phrase, f, string_split(phrase, ' ') AS words FROM counted WHERE f >= 30
), inside AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, f, array_to_string(words[1:size - 1], ' ') AS phrase FROM frequent WHERE size > 2
    UNION ALL SELECT lang, f, array_to_string(words[2:size], ' ') FROM frequent WHERE size > 2
    UNION ALL SELECT lang, f, array_to_string(words[i:i + 1], ' ')
      FROM frequent, (SELECT unnest([1, 2, 3]) AS i) WHERE size = 4
  ) GROUP BY ALL
), kept AS (
  SELECT frequent.* FROM frequent LEFT JOIN inside USING (lang, phrase)
  WHERE size > 1 AND CAST(100 AS HUGEINT) * coalesce(longer, 0) < CAST(80 AS HUGEINT) * f
), cut AS (
  SELECT lang, phrase, f AS a, k, array_to_string(words[1:k], ' ') AS head, array_to_string(words[k + 1:size], ' ') AS rest
  FROM kept, (SELECT unnest([1, 2, 3]) AS k) WHERE k < size
), scored AS (
  SELECT c.lang, c.phrase, a, k, h.f AS l, t.f AS r, CAST((CAST(2000000 AS HUGEINT) * a) // (h.f + t.f) AS BIGINT) AS score
  FROM cut c JOIN frequent h ON h.lang = c.lang AND h.phrase = c.head JOIN frequent t ON t.lang = c.lang AND t.phrase = c.rest
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut_place FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS place
  FROM lowest WHERE cut_place = 1
), sizes AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang
)
SELECT lang, place AS rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE place <= 2000
"""

ORACLES: dict[str, str] = {
    "op3_exact_top_k": OP3,
    "op11_phrase_collocations": OP11,
    "op12_ranked_search": OP12,
}
