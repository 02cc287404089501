"""DuckDB SQL for the queries that SQL can express; the others have brute-force tests."""

ORACLES = {
    # Exact similarities over an inverted index, and groups by the closure of the links.
    "op2_ngram_jaccard_join": r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(text, '') AS text, [x FOR x IN string_split_regex(coalesce(text, ''), '\s+') IF x <> ''] AS words FROM documents),
runs AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 5 THEN [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)]
                                        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS run FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM runs x JOIN runs y ON x.run = y.run AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 5 * shared.n >= 4 * (x.n + y.n - shared.n)
    UNION SELECT x.doc_id, y.doc_id FROM texts x JOIN texts y ON x.text = y.text AND x.doc_id <> y.doc_id),
reached AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT links.b, root FROM reached JOIN links ON links.a = reached.node)
SELECT node AS doc_id, min(root) AS class_id, coalesce(any_value(n), 0) AS n_links
FROM reached LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON c.a = node GROUP BY node""",
    # All rows ranked: what the search finds where it visits every partition, as it does in small tables.
    "op5_nearest_neighbours": """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
scored AS (SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.e, r.e) AS score FROM v q, v r WHERE q.vec_id % 20 = 0 AND r.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20""",
    "edited_texts": """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
o AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS following FROM t WINDOW w AS (ORDER BY doc_id DESC))
SELECT doc_id, n AS n_chars, sha256(substr(text, 1, n - n // 2) || substr(following, 1, n // 2)) AS edited_sha256 FROM o""",
    "base_secrets": r"""
SELECT doc_id, len([x FOR x IN regexp_extract_all(text, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) IF len(x) >= 8]) AS n_assign,
       len([x FOR x IN regexp_extract_all(text, 'AKIA[A-Z0-9]+') IF len(x) >= 16]) AS n_access,
       len([x FOR x IN regexp_extract_all(text, '[0-9a-f]+') IF len(x) >= 32]) AS n_hex
FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) d""",
    # The level at which sources fill: sources in the order of what a unit of weight gets them to, each filled while the level reaches it.
    "mix_targets": r"""
WITH sized AS (SELECT source, CAST(sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))) AS BIGINT) AS source_size FROM documents GROUP BY source),
weighed AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM sized),
levels AS (
    SELECT a.source, (1.5 * (SELECT sum(source_size) FROM sized) - coalesce(sum(2 * b.source_size) FILTER (2 * b.source_size / b.w < 2 * a.source_size / a.w), 0))
           / sum(b.w) FILTER (2 * b.source_size / b.w >= 2 * a.source_size / a.w) AS level, any_value(2 * a.source_size / a.w) AS fills
    FROM weighed a, weighed b GROUP BY a.source),
common AS (SELECT min_by(level, fills) AS level FROM levels WHERE level <= fills)
SELECT source, source_size, round(least(2.0 * source_size, coalesce(level * w, 2.0 * source_size)) + 1e-9, 3) AS target, TRUE AS near FROM weighed, common""",
    "vector_deviations": """
WITH x AS (
    SELECT vec_id, [CAST(floor(CAST(64 AS DOUBLE) * CAST(c AS DOUBLE)) AS HUGEINT) + 1000000 FOR c IN embedding] AS x FROM embeddings
    WHERE len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0 AND len(embedding) > 0),
cells AS (SELECT vec_id, unnest(x) AS x, generate_subscripts(x, 1) AS d FROM x),
sums AS (SELECT d, sum(x) AS s, count(*) AS n FROM cells GROUP BY d)
SELECT vec_id, n, CAST(sum((n * x - s) * (n * x - s)) AS BIGINT) AS deviation, least(32, count(*)) AS components, TRUE AS white
FROM cells JOIN sums USING (d) GROUP BY vec_id, n""",
    # Whole numbers but for the logarithm in a term's weight.
    "op13_ranked_lexical_search": r"""
WITH words AS (
    SELECT doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents),
counts AS (SELECT id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM counts, corpus WHERE term IN (SELECT term FROM asked) GROUP BY term),
scored AS (
    SELECT item_id, id AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (id), corpus GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10""",
}
