"""SQL over the same tables, where SQL can express an operator's result."""

OP3 = r"""
WITH parts AS (
  SELECT vec_id, generate_subscripts(embedding, 1) AS k, unnest(embedding) AS x, len(embedding) AS dim
  FROM embeddings WHERE vec_id IS NOT NULL
), good AS (
  SELECT vec_id FROM parts GROUP BY vec_id HAVING count(*) = count(x) AND bool_and(isfinite(x))
), ints AS (
  SELECT vec_id, k, dim, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS c FROM parts SEMI JOIN good USING (vec_id)
), scores AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(sum(q.c * v.c) AS BIGINT) AS score
  FROM ints q JOIN ints v ON q.k = v.k AND q.dim = v.dim AND q.vec_id <> v.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY ALL
)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scores
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5
"""

OP5 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), grams AS (
  SELECT DISTINCT doc_id, words[i : i + 4] AS g
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN sizes s ON s.doc_id = x.doc_id JOIN sizes t ON t.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, s.n, t.n HAVING 100 * count(*) >= 75 * (s.n + t.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS other FROM w UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM w LEFT JOIN sizes USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

OP7 = r"""
WITH RECURSIVE n AS (
  SELECT source, CAST(count(*) AS BIGINT) AS n, CAST(ceil(count(*) / 8.0) AS BIGINT) AS blocks, power(CAST(count(*) AS DOUBLE), 0.5) AS w
  FROM documents GROUP BY source
), c AS (
  SELECT source, blocks, CAST(greatest(round(greatest(w / sum(w) OVER (), 0.25 / greatest(sum(blocks) OVER (), 1000)) * 1073741824), 1) AS BIGINT) AS v,
    row_number() OVER (ORDER BY source NULLS FIRST) AS i
  FROM n
), a AS (
  SELECT list(v ORDER BY i) AS v, CAST(sum(v) AS BIGINT) AS d FROM c
), s AS (
  SELECT a.v, d, CAST(ceil(greatest(min(blocks * CAST(d AS DOUBLE) / c.v), max(CAST(d AS DOUBLE) / c.v)) / 1000) AS BIGINT) * 1000 AS slots FROM c, a GROUP BY a.v, d
), run AS (
  SELECT CAST(-1 AS BIGINT) AS slot, list_transform(v, lambda x: CAST(0 AS BIGINT)) AS done, CAST(0 AS BIGINT) AS chosen FROM s
  UNION ALL
  SELECT slot + 1, list_transform(done, lambda x, i: x + CASE WHEN i = pick THEN 1 ELSE 0 END), pick
  FROM (
    SELECT slot, done, CAST(list_min(list_transform(range(1, len(v) + 1), lambda i:
      CASE WHEN (done[i] * d) // v[i] <= slot + 1
      THEN ((done[i] + 1) * d + v[i] - 1) // v[i] * 1000000 + i END)) % 1000000 AS BIGINT) AS pick
    FROM run, s WHERE slot + 1 < slots
  )
), turns AS (
  SELECT chosen AS i, slot AS spot, row_number() OVER (PARTITION BY chosen ORDER BY slot) - 1 AS turn FROM run WHERE slot >= 0
), held AS (
  SELECT i, count(*) AS held FROM turns GROUP BY i
), ranked AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), ''))) - 1 AS r
  FROM documents
), placed AS (
  SELECT doc_id, r.source, r, r // 8 AS j, (r // 8) % held AS turn, (r // 8) // held * slots AS start, c.v, c.i, d
  FROM ranked r JOIN c ON r.source IS NOT DISTINCT FROM c.source JOIN held h ON c.i = h.i, s
)
SELECT doc_id, source, j AS mix_block, CAST(start + p.turn * d // v AS BIGINT) AS mix_release, CAST(start + ((p.turn + 1) * d + v - 1) // v AS BIGINT) AS mix_deadline,
  CAST(start + spot AS BIGINT) AS mix_slot, CAST((start + spot) * 8 + r % 8 AS BIGINT) AS mix_position
FROM placed p JOIN turns t ON p.i = t.i AND t.turn = p.turn
"""

OP10 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role,
    replace(replace(coalesce(text, ''), '<|im_start|>', '<| im_start |>'), '<|im_end|>', '<| im_end |>') AS text, CAST(coalesce(floor(turn / 64), -1) AS BIGINT) AS chunk
  FROM conversations
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, chunk ORDER BY turn NULLS FIRST, role, text) - 1 AS place FROM t
), people AS (
  SELECT DISTINCT conv_id AS c, role AS perspective FROM t
), shown AS (
  SELECT conv_id, perspective, chunk, place // 64 AS piece, place, role = perspective AS own,
    CASE WHEN role = perspective THEN '<|im_start|>assistant' ELSE '<|im_start|>user name=' ||
      replace(replace(translate(role, chr(13) || chr(10), '  '), '<|im_start|>', '<| im_start |>'), '<|im_end|>', '<| im_end |>') END || chr(10) AS head,
    text || '<|im_end|>' AS body
  FROM placed JOIN people ON conv_id IS NOT DISTINCT FROM c
), spans AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
    PARTITION BY conv_id, perspective, chunk, piece ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS spot
  FROM shown
)
SELECT conv_id, perspective, chunk, piece, CAST(count(*) AS INTEGER) AS n_turns, CAST(count(*) FILTER (own) AS INTEGER) AS n_assistant,
  string_agg(head || body || chr(10), '' ORDER BY place) AS text,
  coalesce(string_agg(CASE WHEN own THEN CAST(spot AS BIGINT) || '-' || CAST(spot + length(body) AS BIGINT) END, ',' ORDER BY place), '') AS mask
FROM spans GROUP BY conv_id, perspective, chunk, piece
"""

OP12 = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), marked AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
  FROM t LEFT JOIN marked USING (doc_id)
), cells AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY part, mask
), letters AS (
  SELECT substr('ABCDE', i, 1) AS f, 1 << (i - 1) AS b FROM (SELECT unnest([1, 2, 3, 4, 5]) AS i)
), orders AS (
  SELECT v.f || w.f || x.f || y.f || z.f AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bits
  FROM letters v, letters w, letters x, letters y, letters z WHERE v.b + w.b + x.b + y.b + z.b = 31 AND v.b | w.b | x.b | y.b | z.b = 31
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS b, coalesce(list_sum(bits[1 : step - 1]), 0) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), counted AS (
  SELECT part, filter_order, step, b,
    CAST(coalesce(sum(n) FILTER (mask & (earlier + b)::INTEGER = 0), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (mask & b <> 0 AND mask & earlier::INTEGER = 0), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (mask & b <> 0 AND mask & earlier::INTEGER <> 0), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (mask = b), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (mask & b <> 0 AND mask & earlier::INTEGER = 0), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (mask & b <> 0 AND mask & earlier::INTEGER = 0), 0) AS BIGINT) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, b
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, b) AS BIGINT) AS shapley
FROM counted
"""

OP13_ASSIGNED = r"""assigned{n} AS (
  SELECT vec_id, p, split_part(best, ':', 2)::INTEGER AS e, split_part(best, ':', 1)::BIGINT AS d
  FROM (
    SELECT vec_id, p, min(lpad(d::VARCHAR, 18, '0') || ':' || lpad(e::VARCHAR, 2, '0')) AS best
    FROM (SELECT vec_id, p, e, sum((x - c) * (x - c)) AS d FROM ints JOIN book{n} USING (p, i) GROUP BY vec_id, p, e)
    GROUP BY vec_id, p
  )
)"""
OP13_MOVED = r"""book{m} AS (
  SELECT p, e, i, coalesce((s - ((s % n) + n) % n) // n, c)::BIGINT AS c
  FROM book{n} LEFT JOIN (
    SELECT p, e, i, sum(x) AS s, count(*) AS n FROM ints JOIN assigned{n} USING (vec_id, p) GROUP BY p, e, i
  ) USING (p, e, i)
)"""
OP13 = (
    r"""
WITH flat AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS k, unnest(embedding) AS x, len(embedding) AS dim FROM embeddings
), good AS (
  SELECT vec_id FROM flat GROUP BY vec_id HAVING count(*) = count(x) AND bool_and(isfinite(x))
), ints AS (
  SELECT vec_id, label, k // (dim // 16) AS p, k % (dim // 16) AS i, floor(256 * x::DOUBLE)::BIGINT AS x FROM flat SEMI JOIN good USING (vec_id)
), firsts AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM good QUALIFY e < 64
), book0 AS (
  SELECT p, e, i, x AS c FROM ints JOIN firsts USING (vec_id)
), """
    + ", ".join(
        [OP13_ASSIGNED.format(n=0), OP13_MOVED.format(n=0, m=1), OP13_ASSIGNED.format(n=1), OP13_MOVED.format(n=1, m=2), OP13_ASSIGNED.format(n=2)]
    )
    + r""", coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM assigned2 JOIN (SELECT vec_id, any_value(label) AS label FROM ints GROUP BY vec_id) USING (vec_id) GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, i)) FROM book2) AS codebooks_sha256
FROM coded
"""
)

ORACLE_SQL: dict[str, str] = {"op12_filter_audit": OP12, "op13_vector_codes": OP13, "op3_topk_search": OP3, "op5_ngram_join": OP5, "op7_mixing": OP7, "op10_chat_formatting": OP10}
