"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from scriptorium.llm.license_texts import TEMPLATES

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {WORDS} AS words FROM documents
),
grams AS (
    SELECT r, p, list_slice(words, p, p + 4) AS gram FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS p FROM docs)
),
repeated AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, gram) AS n FROM grams) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + 5)) AS q FROM repeated) GROUP BY r),
dup_lines AS (
    SELECT r, count(*) - count(DISTINCT line) AS n
    FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
),
counted AS (
    SELECT docs.r, doc_id, source, len(words) AS n_words, coalesce(list_sum([length(w) for w in words]), 0)::BIGINT AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(dup_lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
    FROM docs LEFT JOIN dup_lines ON docs.r = dup_lines.r LEFT JOIN covered ON docs.r = covered.r
),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
hosts AS (
    SELECT source, count(*) AS n_docs, sum(base_failed::INT) AS n_failed, sum(base_failed::INT) / count(*) AS rate
    FROM judged WHERE source IS NOT NULL GROUP BY source
),
moments AS (
    SELECT mean, CASE WHEN spread > 1e-12 THEN greatest(0, mean * (1 - mean) / spread - 1) END AS weight FROM (
        SELECT mean, square - mean * mean - mean * (1 - mean) * chance AS spread
        FROM (SELECT avg(rate) AS mean, avg(rate * rate) AS square, avg(1 / n_docs) AS chance FROM hosts)
    )
),
bad AS (
    SELECT source AS bad_source FROM hosts, moments
    WHERE CASE WHEN weight IS NULL THEN mean ELSE (n_failed + mean * weight) / (n_docs + weight) END > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND bad_source IS NULL AS kept
FROM judged LEFT JOIN bad ON source = bad_source
"""

MIXING_SQL = """
WITH sizes AS (SELECT source, sum(coalesce(length(text), 0)) AS size FROM documents GROUP BY source),
means AS (
    SELECT source, (1.0::DOUBLE / count(*) OVER ()) * sum(size) OVER () / size AS mean FROM sizes WHERE size > 0
),
draws AS (SELECT source, mean, greatest(1, ceil(mean / 32))::INT AS draws FROM means),
rates AS (SELECT source, draws, mean / draws AS one, ceil(mean / draws + 12 * sqrt(mean / draws) + 20)::INT AS last FROM draws),
tables AS (
    SELECT source, draws, [
        list_sum([exp(j * ln(one) - one - lgamma(j + 1)) for j in range(0, k + 1)]) for k in range(0, last + 1)] AS cumulative
    FROM rates
),
drawn AS (
    SELECT doc_id, d.source, text, cumulative, draws, coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) AS identity
    FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source
),
counted AS (
    SELECT *, list_sum([len([c for c in cumulative if
        c <= CAST('0x' || substr(md5('17:' || identity || ':' || i), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE]) for i in range(1, draws + 1)]) AS copies
    FROM drawn
)
SELECT doc_id, source, text, copy, md5('shuffle 17:' || identity || ':' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, copies::BIGINT + 1))::INT AS copy FROM counted)
"""

SUBSTRING_SQL = rf"""
WITH docs AS (SELECT doc_id, {WORDS} AS words FROM documents),
grams AS (
    SELECT doc_id, p, md5(array_to_string(list_slice(words, p, p + 19), ' ')) AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS p FROM docs)
),
again AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY gram ORDER BY doc_id, p) AS n FROM grams) WHERE n > 1),
gone AS (SELECT doc_id, list(DISTINCT q) AS qs FROM (SELECT doc_id, unnest(range(p, p + 20)) AS q FROM again) GROUP BY doc_id),
kept AS (
    SELECT d.doc_id, list(word ORDER BY q) AS words
    FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS q FROM docs) d
    LEFT JOIN (SELECT doc_id, unnest(qs) AS gone_q FROM gone) g ON d.doc_id = g.doc_id AND d.q = g.gone_q
    WHERE gone_q IS NULL GROUP BY d.doc_id
)
SELECT docs.doc_id, len(docs.words) AS n_words, coalesce(len(qs), 0) AS n_removed,
    sha256(coalesce(array_to_string(kept.words, ' '), '')) AS kept_sha256
FROM docs LEFT JOIN gone ON docs.doc_id = gone.doc_id LEFT JOIN kept ON docs.doc_id = kept.doc_id
"""

JACCARD_SQL = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ') ELSE array_to_string(list_slice(words, p, p + 4), ' ') END AS s
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS p FROM docs WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
    SELECT x, y FROM pairs JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)
),
reached AS (SELECT doc_id AS x, doc_id AS y FROM docs UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
SELECT docs.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM docs LEFT JOIN sizes ON docs.doc_id = sizes.doc_id JOIN (SELECT x, min(y) AS component_id FROM reached GROUP BY x) ON docs.doc_id = x
"""

_TEMPLATE_ROWS = ", ".join(f"('{name}', {i}, '{text}')" for i, (name, text) in enumerate(TEMPLATES))
LICENSE_PATHS = """
    SELECT doc_id, concat_ws('/', source, CASE WHEN doc_id % 7 > 0 THEN doc_id // 500 END, CASE WHEN doc_id % 7 > 1 THEN doc_id // 125 END,
        CASE WHEN doc_id % 7 > 2 THEN doc_id // 25 END) AS dir, coalesce(text, '') AS text FROM documents
"""

LICENSE_SQL = f"""
WITH templates AS (SELECT * FROM (VALUES {_TEMPLATE_ROWS}) AS t(license, template, notice)),
template_terms AS (
    SELECT license, template, term, count(*) AS tf
    FROM (SELECT license, template, unnest(regexp_extract_all(lower(notice), '[a-z0-9]+')) AS term FROM templates) GROUP BY ALL
),
files AS (SELECT *, dir || '/file_' || doc_id AS path FROM ({LICENSE_PATHS})),
units AS (
    SELECT doc_id, 0 AS kind, unnest(string_split(text, chr(10))) AS unit, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM files
    UNION ALL SELECT doc_id, 1, unnest(string_split_regex(text, '\\n[^A-Za-z0-9\\n]*\\n')),
        generate_subscripts(string_split_regex(text, '\\n[^A-Za-z0-9\\n]*\\n'), 1) FROM files
    UNION ALL SELECT doc_id, 2, CASE WHEN first_other IS NULL THEN text ELSE array_to_string(list_slice(lines, 1, first_other - 1), chr(10)) END, 1
    FROM (
        SELECT doc_id, text, lines, nullif(list_position(list_transform(lines, lambda l: regexp_matches(l, '^[ \\t\\r]*(\\z|#|//|/\\*|\\*|--|;|%)')), false), 0) AS first_other
        FROM (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM files))
    UNION ALL SELECT doc_id, 3, text, 1 FROM files
),
full_units AS (
    SELECT * FROM (SELECT doc_id, kind, place, regexp_extract_all(lower(unit), '[a-z0-9]+') AS terms FROM units) WHERE len(terms) > 0
),
size AS (SELECT count(*) AS n FROM full_units WHERE kind = 0),
counts AS (SELECT doc_id, kind, place, term, count(*) AS tf FROM (SELECT doc_id, kind, place, unnest(terms) AS term FROM full_units) GROUP BY ALL),
idf AS (
    SELECT term, ln((1 + (SELECT n FROM size)) / (1 + count(c.doc_id))) + 1 AS idf
    FROM (SELECT DISTINCT term FROM template_terms) LEFT JOIN (SELECT * FROM counts WHERE kind = 0) c USING (term) GROUP BY term
),
raw AS (SELECT license, template, term, tf * idf AS w FROM template_terms JOIN idf USING (term)),
weights AS (SELECT license, template, term, w / sqrt(sum(w * w) OVER (PARTITION BY template)) AS share FROM raw),
weighted AS (
    SELECT doc_id, kind, place, term, tf * coalesce(idf, ln((1 + (SELECT n FROM size)) / 2) + 1) AS w FROM counts LEFT JOIN idf USING (term)
),
squares AS (SELECT doc_id, kind, place, sum(w * w) AS square FROM weighted GROUP BY ALL),
dots AS (SELECT doc_id, kind, place, license, template, sum(w * share) AS dot FROM weighted JOIN weights USING (term) GROUP BY ALL),
scored AS (SELECT doc_id, kind, place, license, round(dot / sqrt(square), 6) AS score FROM dots JOIN squares USING (doc_id, kind, place)),
best_units AS (
    SELECT * FROM scored WHERE score >= 0.8 QUALIFY row_number() OVER (PARTITION BY doc_id, kind, place ORDER BY score DESC, license) = 1
),
held AS (
    SELECT doc_id, max(held) AS held FROM (
        SELECT doc_id, kind, sum(len(terms)) AS held FROM best_units JOIN full_units USING (doc_id, kind, place) GROUP BY ALL) GROUP BY doc_id
),
own AS (SELECT * FROM best_units QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license, kind, place) = 1),
totals AS (SELECT doc_id, len(terms) AS terms FROM full_units WHERE kind = 3),
rules AS (
    SELECT dir AS from_dir, license AS dir_license, score AS dir_score
    FROM own JOIN held USING (doc_id) JOIN totals USING (doc_id) JOIN files USING (doc_id) WHERE held >= 0.05 * terms
    QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, path, license) = 1
),
above AS (
    SELECT dir, array_to_string(list_slice(string_split(dir, '/'), 1, k), '/') AS from_dir, k
    FROM (SELECT DISTINCT dir, unnest(range(0, len(string_split(dir, '/')) + 1)) AS k FROM files)
),
inherited AS (SELECT * FROM above JOIN rules USING (from_dir) QUALIFY row_number() OVER (PARTITION BY dir ORDER BY k DESC) = 1)
SELECT doc_id, path, coalesce(license, dir_license) AS license, coalesce(score, dir_score) AS score,
    CASE WHEN license IS NOT NULL THEN 'header' WHEN dir_license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
    CASE WHEN license IS NULL THEN from_dir END AS from_dir
FROM files LEFT JOIN own USING (doc_id) LEFT JOIN inherited USING (dir)
"""
