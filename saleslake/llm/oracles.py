"""Results of the queries in DuckDB SQL."""

OP3 = r"""
WITH item_words AS (
  SELECT item_id::VARCHAR AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), patterns AS (
  SELECT DISTINCT item, least(len(w), 13) AS k,
         array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS passage
  FROM item_words, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i)
  WHERE len(w) > 0
), doc_words AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), windows AS (
  SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS passage
  FROM doc_words, (SELECT DISTINCT k FROM patterns) AS ks, unnest(range(1, len(w) - k + 2)) AS t(i)
), hits AS (
  SELECT w.doc_id, w.i, w.k, p.item FROM windows AS w JOIN patterns AS p ON w.k = p.k AND w.passage = p.passage
), hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM hits, unnest(range(i, i + k)) AS t(j) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
       sha256(coalesce(m.ids, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(d.w) AS contaminated
FROM doc_words AS d LEFT JOIN hit_words AS h USING (doc_id) LEFT JOIN hit_items AS m USING (doc_id)
"""

OP5 = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 2), ' ') AS win
  FROM base, unnest(range(1, len(w) - 1)) AS t(i)
), repeats AS (
  SELECT doc_id, count(DISTINCT j) AS n
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows), unnest(range(i, i + 3)) AS t(j)
  WHERE n > 1 GROUP BY doc_id
), judged AS (
  SELECT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
         len(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
         right(regexp_replace(line, '[\x20\x09-\x0D]+$', ''), 1) AS last,
         len(regexp_extract_all(line, '[#*$%&|<>]')) AS marks
  FROM base, unnest(lines) AS t(line)
), failing AS (
  SELECT *, words = 0
    OR ((last = '' OR instr('.!?…:;"''”’»)', last) = 0) AND words < 10)
    OR 4 * marks > words
    OR (NOT regexp_matches(line, '[a-z]') AND len(regexp_extract_all(line, '[A-Z]')) >= 10)
    OR (words < 30 AND regexp_matches(lower(line), 'cookie|javascript|privacy policy|terms of use|terms of service|all rights reserved|click here|subscribe|sign in|sign up|log in|read more|powered by|share on')) AS fails
  FROM judged
), by_doc AS (
  SELECT doc_id, sum(chars)::BIGINT AS word_chars, sum(marks)::BIGINT AS n_symbols, count(*) AS n_lines,
         count(*) FILTER (WHERE words > 0) - count(DISTINCT line) FILTER (WHERE words > 0) AS n_dup_lines,
         count(*) FILTER (WHERE fails) AS n_removed_lines,
         coalesce(sum(chars) FILTER (WHERE fails), 0)::BIGINT AS lost_chars
  FROM failing GROUP BY doc_id
), all_counts AS (
  SELECT b.doc_id, len(b.w)::BIGINT AS n_words, d.word_chars, d.n_symbols, d.n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words, d.n_lines, d.n_removed_lines, d.lost_chars
  FROM base AS b JOIN by_doc AS d USING (doc_id) LEFT JOIN repeats AS r USING (doc_id)
), failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM all_counts
)
SELECT *, NOT base_failed AND 100 * lost_chars <= 50 * word_chars AS kept FROM failed
"""

OP8 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS size, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (
  SELECT *, CASE WHEN size >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first_id FROM p
)
SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM f
"""

OP11 = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    coalesce(list_sum([a.v[i] * b.v[i] FOR i IN range(1, least(len(a.v), len(b.v)) + 1)]), 0)::BIGINT AS score
  FROM rows AS a JOIN rows AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), negatives AS (
  SELECT p.*, other_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank
  FROM positives AS p JOIN scores AS s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""

# The checksum is a fold over the bytes of a word, with its table of 256 entries made by the rule.
OP13 = r"""
WITH crc_table AS (
  SELECT list(c ORDER BY b) AS entries
  FROM (SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c
        FROM range(256) AS t(b))
), doc_words AS (
  SELECT doc_id, w.word AS word FROM documents,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w(word)
), item_words AS (
  SELECT w.word AS word FROM benchmark,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w(word)
), spelled AS (
  SELECT word, hex(encode(word)) AS digits FROM (SELECT word FROM doc_words UNION SELECT word FROM item_words)
), buckets AS (
  SELECT word, xor(list_reduce(
      [('0x' || substr(digits, 2 * i + 1, 2))::BIGINT FOR i IN range(length(digits) // 2)],
      lambda c, b: xor(entries[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM spelled, crc_table
), corpus AS (
  SELECT bucket, count(*) AS s FROM doc_words JOIN buckets USING (word) GROUP BY bucket
), target AS (
  SELECT bucket, count(*) AS t FROM item_words JOIN buckets USING (word) GROUP BY bucket
), totals AS (
  SELECT (SELECT count(*) FROM doc_words) AS ss, (SELECT count(*) FROM item_words) AS tt
), gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (ss::DOUBLE + 10000)
                                 / ((s::DOUBLE + 1) * (tt::DOUBLE + 10000))))::BIGINT AS gain
  FROM corpus LEFT JOIN target USING (bucket), totals
), weights AS (
  SELECT doc_id, count(*) AS n, sum(gain) AS total
  FROM doc_words JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features,
    coalesce(floor(total::DOUBLE / n), 0)::BIGINT AS weight,
    coalesce(floor(total::DOUBLE / n), 0)::BIGINT + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents AS d LEFT JOIN weights AS w USING (doc_id)
), ordered AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS size
  FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * size // 100 THEN place END AS rank
FROM scored LEFT JOIN ordered USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op3_decontamination": OP3,
    "op5_quality_rules": OP5,
    "op8_warc": OP8,
    "op11_hard_negatives": OP11,
    "op13_importance_resampling": OP13,
}
