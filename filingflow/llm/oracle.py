"""The same results in DuckDB's SQL, where it can express them."""

ORACLE: dict[str, str] = {
    "op3_poisson_mixing": """
        WITH sizes AS (SELECT source AS src, count(*) AS n FROM documents GROUP BY 1),
        rates AS (
            SELECT src, sqrt(n) / sum(sqrt(n)) OVER () * CAST(sum(n) OVER () AS DOUBLE) / n AS rate FROM sizes
        ),
        parts AS (SELECT src, rate, greatest(ceil(rate / 16.0), 1) AS parts FROM rates),
        cdf AS (
            SELECT src, k, sum(exp(k * ln(rate / parts) - rate / parts - lgamma(k + 1.0)))
                OVER (PARTITION BY src ORDER BY k) AS c
            FROM parts, range(0, 90) AS steps(k)
        ),
        draws AS (
            SELECT d.doc_id, p.src, part,
                CAST('0x' || substr(md5('17:' || d.doc_id || ':' || part), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
            FROM (SELECT DISTINCT doc_id, source FROM documents) d
            JOIN parts p ON p.src IS NOT DISTINCT FROM d.source, range(1, 100) AS r(part)
            WHERE part <= p.parts
        ),
        counts AS (
            SELECT x.doc_id, x.src, count(*) AS n FROM draws x JOIN cdf ON cdf.src IS NOT DISTINCT FROM x.src
            WHERE cdf.c <= x.u AND cdf.c < 1 - 1e-15 GROUP BY ALL
        )
        SELECT d.*, p.rate, CAST(i AS INTEGER) AS copy,
            CAST('0x' || substr(md5('17-order:' || d.doc_id || ':' || i), 1, 13) AS BIGINT) AS shuffle_key
        FROM documents d JOIN counts c ON c.doc_id = d.doc_id AND c.src IS NOT DISTINCT FROM d.source
        JOIN parts p ON p.src IS NOT DISTINCT FROM d.source, range(1, 400) AS r(i) WHERE i <= c.n""",
    "op13_phrases": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]'
            )) AS piece FROM documents
        ),
        texts AS (SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^ \t]+') AS words FROM pieces),
        w AS (
            SELECT lang, p, w1, i, lead(w1, 1) OVER places AS w2, lead(w1, 2) OVER places AS w3, lead(w1, 3) OVER places AS w4
            FROM (SELECT lang, p, unnest(words) AS w1, unnest(range(len(words))) AS i FROM texts) WINDOW places AS (PARTITION BY p ORDER BY i)
        ),
        f AS (
            SELECT lang, [w1] AS x, count(*) AS f FROM w GROUP BY ALL
            UNION ALL SELECT lang, [w1, w2], count(*) FROM w WHERE w2 IS NOT NULL GROUP BY ALL
            UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM w WHERE w3 IS NOT NULL GROUP BY ALL
            UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM w WHERE w4 IS NOT NULL GROUP BY ALL
        ),
        often AS (SELECT * FROM f WHERE f >= 30),
        cuts AS (
            SELECT c.lang, c.x, c.f AS a, k, first.f AS l, rest.f AS r, CAST(2000000::HUGEINT * c.f // (first.f + rest.f) AS BIGINT) AS score
            FROM (SELECT *, unnest(range(1, len(x))) AS k FROM often WHERE len(x) > 1) c
            JOIN often first ON first.lang = c.lang AND first.x = c.x[:k] JOIN often rest ON rest.lang = c.lang AND rest.x = c.x[k + 1:]
        ),
        covered AS (
            SELECT s.lang, s.x FROM (SELECT lang, f, unnest([x[:-2], x[2:]]) AS x FROM often WHERE len(x) > 2) b
            JOIN often s ON s.lang = b.lang AND s.x = b.x AND 100 * b.f >= 80 * s.f
        ),
        best AS (SELECT * FROM cuts ANTI JOIN covered USING (lang, x) QUALIFY row_number() OVER (PARTITION BY lang, x ORDER BY score, k) = 1)
        SELECT lang, rank, phrase, a, l, r, n, score FROM (
            SELECT *, array_to_string(x, ' ') AS phrase, row_number() OVER (
                PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(x, ' ')
            ) AS rank FROM best
        ) JOIN (SELECT lang, count(*) AS n FROM w GROUP BY lang) USING (lang) WHERE rank <= 2000""",
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scores AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
            FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
        ),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
            AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER best <= 10""",
}
