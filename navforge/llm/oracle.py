"""DuckDB SQL for the operators that SQL can express on whole tables."""

from __future__ import annotations

#: Words: runs of characters other than space and 0x09-0x0D.
_SPLIT = "list_filter(regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
     d AS (SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
                  sha1(body) AS hex FROM p),
     b AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
             substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((
               CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT)
               >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest
           FROM d),
     w AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < top THEN top END AS refers_to
FROM w"""

OP2 = f"""
WITH d AS (SELECT doc_id, {_SPLIT.format("coalesce(text, '')")} AS w FROM documents),
     s AS (SELECT doc_id, p, array_to_string(w[p + 1:p + 20], ' ') AS k
           FROM (SELECT doc_id, w, unnest(range(len(w) - 19)) AS p FROM d WHERE len(w) >= 20)),
     gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS pos
              FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS n
                    FROM s) WHERE n > 1),
     words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
     kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text
              FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
     n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""

#: Smallest node that links reach.
_REACH = """reach AS (SELECT a AS node, a AS low FROM links UNION
           SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.node),
     low AS (SELECT node, min(low) AS component FROM reach GROUP BY node)"""

OP5 = f"""
WITH RECURSIVE v AS (
       SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
       WHERE len(embedding) > 0
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
     links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y
               ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.95),
     {_REACH},
     degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(degree.n, 0) AS n_links,
       coalesce(low.component, e.vec_id) AS component_id,
       coalesce(low.component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN degree ON degree.a = e.vec_id LEFT JOIN low ON low.node = e.vec_id"""

OP8 = f"""
WITH RECURSIVE d AS (
       SELECT doc_id, {_SPLIT.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
       FROM documents),
     s AS (SELECT DISTINCT doc_id, k FROM (
             SELECT doc_id, array_to_string(w[p + 1:p + 2], ' ') AS k
             FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 1, 1))) AS p
                   FROM d WHERE len(w) > 0))),
     size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
                FROM s x JOIN s y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY ALL),
     half AS (SELECT a, b FROM common JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
              WHERE 100 * shared >= 80 * (p.n + q.n - shared)),
     links AS (SELECT a, b FROM half UNION SELECT b, a FROM half),
     {_REACH}
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles,
       coalesce(low.component, d.doc_id) AS component_id,
       coalesce(low.component, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN size USING (doc_id) LEFT JOIN low ON low.node = d.doc_id"""

OP9 = """
WITH v AS (
       SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
       FROM embeddings
       WHERE embedding IS NOT NULL
         AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10"""

#: A-Z only.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Buckets of all words of a table, by the reflected CRC-32 of their bytes, bit by bit.
_WORDS = f"""SELECT {{}}unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
          FROM {{}}"""
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
            list_transform(range(octet_length(encode(word))),
              lambda i: CAST('0x' || substr(hex(encode(word)), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
          lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT) for i in range(8)]),
            lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END))))"""

OP12 = f"""
WITH w AS ({_WORDS.format("doc_id, ", "documents")}), v AS ({_WORDS.format("", "benchmark")}),
     crc AS (SELECT word, {_CRC} % 10000 AS bucket
             FROM (SELECT word FROM w UNION SELECT word FROM v)),
     s AS (SELECT bucket, count(*) AS n FROM w JOIN crc USING (word) GROUP BY bucket),
     t AS (SELECT bucket, count(*) AS n FROM v JOIN crc USING (word) GROUP BY bucket),
     total AS (SELECT coalesce((SELECT sum(n) FROM s), 0) AS s, coalesce((SELECT sum(n) FROM t), 0) AS t),
     gain AS (SELECT s.bucket, CAST(floor(1000 * ln(
                CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST(total.s + 10000 AS DOUBLE)
                / (CAST(s.n + 1 AS DOUBLE) * CAST(total.t + 10000 AS DOUBLE)))) AS BIGINT) AS gain
              FROM s LEFT JOIN t USING (bucket), total),
     f AS (SELECT doc_id, count(*) AS n, sum(gain) AS weight
           FROM w JOIN crc USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
     d AS (SELECT doc_id, CAST(coalesce(f.n, 0) AS BIGINT) AS n_features,
                  CAST(coalesce(f.weight, 0) AS BIGINT) AS weight,
                  CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h
           FROM documents LEFT JOIN f USING (doc_id)),
     x AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln(
                  (h + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM d),
     r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank,
                  count(*) OVER () AS n FROM x WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank
FROM x LEFT JOIN r USING (doc_id)"""

OP13 = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
                  {_SPLIT.format("coalesce(text, '')")} AS w FROM documents),
     l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                  max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
     f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                  CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
                  || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
                  || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t)
                          THEN 'C' ELSE '' END
                  || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
                  || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
           FROM t LEFT JOIN l USING (doc_id)),
     cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
               FROM f GROUP BY part, fails),
     letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
     orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
                FROM letters a, letters b, letters c, letters d, letters e
                WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
     steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS filter,
                      substr(filter_order, 1, step - 1) AS before
               FROM orders, (SELECT unnest(range(1, 6)) AS step)),
     counted AS (
       SELECT part, filter_order, step, filter,
              sum(CASE WHEN translate(fails, before || filter, '') = fails THEN n ELSE 0 END) AS kept,
              sum(CASE WHEN removes THEN n ELSE 0 END) AS removed,
              sum(CASE WHEN contains(fails, filter) AND NOT removes THEN n ELSE 0 END) AS redundant,
              sum(CASE WHEN fails = filter THEN n ELSE 0 END) AS unique_fails,
              sum(CASE WHEN removes THEN good ELSE 0 END) AS good_lost,
              sum(CASE WHEN removes THEN toxic ELSE 0 END) AS toxic_lost
       FROM (SELECT *, contains(fails, filter) AND translate(fails, before, '') = fails AS removes
             FROM cells, steps) GROUP BY part, filter_order, step, filter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM counted"""

SQL = {"op1_warc": OP1, "op2_substring_dedup": OP2, "op5_embedding_dedup": OP5,
       "op8_minhash_dedup": OP8, "op9_exact_topk": OP9, "op12_importance_resampling": OP12,
       "op13_filter_audit": OP13}
