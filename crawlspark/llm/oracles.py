"""SQL for the queries whose results SQL can express, as DuckDB runs it on whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH = f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents),
    lengths AS (SELECT row, doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
    total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
    tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) AS u GROUP BY row, term),
    asked AS (SELECT DISTINCT item, item_id, unnest(terms) AS term FROM (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS terms FROM benchmark) AS b),
    weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, total GROUP BY term, docs),
    scored AS (SELECT item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words)))) AS score
      FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN lengths USING (row), total GROUP BY ALL),
    placed AS (SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM scored WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 50"""

PHRASES = rf"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    f AS MATERIALIZED (SELECT lang, size, p, count(*) AS f FROM (
        SELECT lang, 1 AS size, unnest(w) AS p FROM split
        UNION ALL SELECT lang, 2, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) FROM split
        UNION ALL SELECT lang, 3, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) FROM split) AS g GROUP BY ALL),
    totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
    cand AS (SELECT *, string_split(p, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
    parts AS MATERIALIZED (SELECT lang, p, f, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
      FROM (SELECT *, 1 AS k FROM cand UNION ALL SELECT *, 2 FROM cand WHERE size = 3) AS c),
    cuts AS (SELECT c.lang, c.p, c.f AS a, k, x.f AS l, y.f AS r, 1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f) AS score
      FROM parts AS c JOIN f AS x ON x.lang = c.lang AND x.p = c.head JOIN f AS y ON y.lang = c.lang AND y.p = c.tail),
    lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
    covered AS (SELECT lang, p, max(f) AS f FROM (SELECT lang, array_to_string(w[1:2], ' ') AS p, f FROM cand WHERE size = 3
      UNION ALL SELECT lang, array_to_string(w[2:3], ' '), f FROM cand WHERE size = 3) AS u GROUP BY ALL),
    kept AS (SELECT o.* FROM lowest o LEFT JOIN covered c ON c.lang = o.lang AND c.p = o.p WHERE c.f IS NULL OR 100 * c.f < 50 * o.a),
    placed AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score
      FROM kept JOIN totals USING (lang))
    SELECT * FROM placed WHERE rank <= 2000"""

ORACLES = {"op11_impact_ranges": SEARCH, "op12_tiled_phrases": PHRASES}
