"""SQL for the queries that SQL can express."""

_COMPONENTS = """
    reach(node, low) AS (
        SELECT a, b FROM links
        UNION
        SELECT reach.node, links.b FROM reach JOIN links ON reach.low = links.a
    )"""

ORACLES: dict[str, str] = {}

ORACLES["op1_decontaminate"] = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item AS (
    SELECT item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), wanted AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + 12], ' ') AS grams
    FROM item, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS u(i)
    WHERE len(w) > 0
), size AS (SELECT DISTINCT n FROM wanted
), place AS (
    SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS grams
    FROM doc CROSS JOIN size, unnest(range(1, len(w) - n + 2)) AS u(i)
), hit AS (SELECT r, i, place.n, item_id FROM place JOIN wanted USING (n, grams)
), covered AS (
    SELECT r, count(DISTINCT k) AS n_hit
    FROM (SELECT DISTINCT r, i, n FROM hit), unnest(range(i, i + n)) AS u(k) GROUP BY r
), named AS (
    SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM hit) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""

ORACLES["op2_substring_dedup"] = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), place AS (
    SELECT r, doc_id, i, hash(w[i:i + 49]) AS h, md5(array_to_string(w[i:i + 49], ' ')) AS m
    FROM doc, unnest(range(1, len(w) - 48)) AS u(i)
), gone AS (
    SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY h, m) AS earliest
                      FROM place) WHERE earliest < doc_id
), covered AS (
    SELECT r, list(DISTINCT k) AS k FROM gone, unnest(range(i, i + 50)) AS u(k) GROUP BY r
), word AS (
    SELECT r, i, w[i] AS word, list_contains(coalesce(k, []), i) AS removed
    FROM doc LEFT JOIN covered USING (r), unnest(range(1, len(w) + 1)) AS u(i)
), kept AS (
    SELECT r, count_if(removed) AS n_removed,
           string_agg(word, ' ' ORDER BY i) FILTER (NOT removed) AS text FROM word GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""

ORACLES["op6_vector_dedup"] = f"""
WITH RECURSIVE vector AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM vector x JOIN vector y
    ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.95
),{_COMPONENTS}
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM vector
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
LEFT JOIN (SELECT node AS vec_id, min(low) AS low FROM reach GROUP BY node) USING (vec_id)
"""

ORACLES["op11_line_dedup"] = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l
    FROM documents
), line AS (
    SELECT r, doc_id, i, l[i] AS line,
           translate(trim(l[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM doc, unnest(range(1, len(l) + 1)) AS u(i)
), common AS (
    SELECT key, max(doc_id) AS last
    FROM (SELECT DISTINCT r, doc_id, key FROM line WHERE length(key) >= 20)
    GROUP BY key HAVING count(*) >= 3
), kept AS (
    SELECT r, i, line, common.key IS NULL OR doc_id IS NOT DISTINCT FROM last AS stays
    FROM line LEFT JOIN common USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE stays), ''))
           AS kept_sha256
FROM kept JOIN doc USING (r) GROUP BY r
"""

ORACLES["op13_ranked_search"] = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), size AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM doc WHERE len(w) > 0
), posting AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM doc) GROUP BY r, term
), item AS (
    SELECT row_number() OVER () AS q, item_id,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT * FROM benchmark)
), wanted AS (SELECT item_id, q, term, count(*) AS n FROM item GROUP BY item_id, q, term
), weight AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM posting, size GROUP BY term, docs
), impact AS (
    SELECT r, term, (1000000000 * tf)
        // (1000 * tf + 8 * (25 + (75 * len(doc.w)::BIGINT * docs) // terms)) AS x
    FROM posting JOIN doc USING (r), size
), score AS (
    SELECT item_id, q, r, sum(n * w * x)::BIGINT AS score
    FROM wanted JOIN weight USING (term) JOIN impact USING (term) GROUP BY item_id, q, r
), placed AS (
    SELECT item_id, doc_id, score,
           row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank
    FROM score JOIN doc USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""
