"""Registered queries of the operators on texts, and the DuckDB SQL of those SQL can express."""

from civiclens.llm.bpe import op7_forced_boundaries
from civiclens.llm.collocations import op12_three_way_suffixes
from civiclens.llm.conversations import op13_interval_repair
from civiclens.llm.embeddings import op10_nn_descent
from civiclens.llm.fingerprints import op3_one_permutation
from civiclens.llm.language import op1_subword_softmax
from civiclens.llm.minhash import op8_minhash_stars
from civiclens.llm.packing import op6_exact_complements
from civiclens.llm.secret_scan import op11_keyword_automaton
from civiclens.llm.sharding import op2_vector_packing
from civiclens.llm.suffixes import op4_prefix_doubling
from civiclens.llm.toxicity import op9_compression_distance
from civiclens.llm.warc import op5_arc_converter

QUERIES = {
    "op1_subword_softmax": op1_subword_softmax,
    "op3_one_permutation": op3_one_permutation,
    "op4_prefix_doubling": op4_prefix_doubling,
    "op5_arc_converter": op5_arc_converter,
    "op6_exact_complements": op6_exact_complements,
    "op7_forced_boundaries": op7_forced_boundaries,
    "op2_vector_packing": op2_vector_packing,
    "op8_minhash_stars": op8_minhash_stars,
    "op9_compression_distance": op9_compression_distance,
    "op10_nn_descent": op10_nn_descent,
    "op11_keyword_automaton": op11_keyword_automaton,
    "op12_three_way_suffixes": op12_three_way_suffixes,
    "op13_interval_repair": op13_interval_repair,
}

_COLLOCATIONS = r"""WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
  grams AS (
    SELECT lang, 1 AS k, unnest(w) AS phrase FROM words
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
    UNION ALL SELECT lang, 3, unnest(list_transform(
      range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words),
  counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
  totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
  candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
  cuts AS (
    SELECT c.lang, c.k, c.phrase, c.a, c.w, cut, x.f AS l, y.f AS r,
      1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f) AS score
    FROM candidates c JOIN (VALUES (1), (2)) cuts(cut) ON cut < c.k
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:], ' ')),
  scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
  within AS (
    SELECT lang, phrase, max(a) AS longer FROM (
      SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidates WHERE k = 3
      UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE k = 3)
    GROUP BY ALL),
  kept AS (
    SELECT s.* FROM scored s LEFT JOIN within i ON i.lang = s.lang AND i.phrase = s.phrase
    WHERE i.longer IS NULL OR 100 * i.longer < 50 * s.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000"""

# The smallest id that links reach, from a CTE links(a, b) that has both directions.
_REACHED = """reached AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
  component AS (SELECT a AS id, least(a, min(b)) AS component_id FROM reached GROUP BY a)"""

_ARCHIVES = """WITH payloads AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages),
  firsts AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_page FROM payloads)
SELECT page_id, strlen(html) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((('0x' || substr(digest, 1 + 10 * (i // 8), 10))::UBIGINT >> (35 - 5 * (i % 8))::UBIGINT) & 31) AS INTEGER),
    1)), '') AS payload_digest,
  CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_page THEN first_page END AS refers_to, url, '2020-01-01T00:00:00Z' AS warc_date
FROM firsts"""

_NEAR_TEXTS = rf"""WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
  sets AS (
    SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 1 THEN w
      ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS shingle FROM words),
  sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
  shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sets x
    JOIN sets y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
  links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * k >= 80 * (x.n + y.n - k)),
  {_REACHED}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
  coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN component c ON c.id = d.doc_id"""

_NEAR_VECTORS = f"""WITH RECURSIVE vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS v, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS size
    FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
  links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y
    ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v) AND x.size > 0 AND y.size > 0
    AND list_dot_product(x.v, y.v) / (x.size * y.size) >= 0.95),
  {_REACHED},
  counts AS (SELECT a AS id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
  coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN counts n ON n.id = vec_id LEFT JOIN component c ON c.id = vec_id"""

ORACLES = {
    "op5_arc_converter": _ARCHIVES,
    "op8_minhash_stars": _NEAR_TEXTS,
    "op10_nn_descent": _NEAR_VECTORS,
    "op12_three_way_suffixes": _COLLOCATIONS,
}
