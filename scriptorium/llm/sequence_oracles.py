"""DuckDB SQL for periodic runs, collocations and repeated bytes."""

from __future__ import annotations

from scriptorium.llm.oracles import WORDS

# CRC-32 of a decimal number, bit by bit: a step of 0 … 255 takes a byte in, a step of -1 shifts by one bit.
_STEPS = "flatten([[ascii(substr(doc_id::VARCHAR, i, 1)), -1, -1, -1, -1, -1, -1, -1, -1] for i in range(1, length(doc_id::VARCHAR) + 1)])"
CRC32 = f"""xor(4294967295, list_reduce(list_prepend(4294967295, {_STEPS}::BIGINT[]), lambda c, x:
    CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""

PERIODS_SQL = rf"""
WITH hashed AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS words, {CRC32} AS h FROM documents),
placed AS (SELECT *, len(words) AS n, CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a FROM hashed),
docs AS (
    SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
        [CASE WHEN i < a THEN words[i + 1] ELSE words[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] END for i in range(0, n)]
        ELSE words END AS words
    FROM placed
),
grams AS (
    SELECT r, n, i, words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3] AS gram
    FROM (SELECT r, n, words, unnest(range(0, n - 2)) AS i FROM docs)
),
equal AS (
    SELECT x.r, y.i - x.i AS q, x.i FROM grams x JOIN grams y ON x.r = y.r AND x.gram = y.gram AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
),
stretches AS (
    SELECT r, q, min(i) AS start, max(i) + 3 + q - min(i) AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM equal) GROUP BY r, q, island
),
long AS (SELECT * FROM stretches WHERE length >= greatest(6, 4 * q)),
runs AS (
    SELECT * FROM long x WHERE NOT EXISTS (
        SELECT 1 FROM long y WHERE y.r = x.r AND y.q < x.q AND y.start <= x.start AND y.start + y.length >= x.start + x.length)
),
listed AS (
    SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines,
        first(start ORDER BY length DESC, start, q) AS start, first(length ORDER BY length DESC, start, q) AS length,
        first(q ORDER BY length DESC, start, q) AS period
    FROM runs GROUP BY r
),
dropped AS (SELECT DISTINCT r, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (
    SELECT w.r, string_agg(w.word, ' ' ORDER BY w.i) AS text
    FROM (SELECT r, unnest(words) AS word, unnest(range(0, n)) AS i FROM docs) w ANTI JOIN dropped d ON w.r = d.r AND w.i = d.i GROUP BY w.r
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, (1000 * length) // period AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed ON docs.r = listed.r LEFT JOIN kept ON docs.r = kept.r
"""

COLLOCATIONS_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS r,
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
    FROM documents
),
split AS (SELECT lang, r, unnest(pieces) AS piece, unnest(range(0, len(pieces))) AS k FROM pieces),
lists AS (SELECT lang, r, k, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM split),
places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM lists),
grams AS (SELECT lang, words[i] AS one, words[i + 1] AS two, words[i + 2] AS three FROM places),
totals AS (SELECT lang, count(*) AS n FROM grams GROUP BY lang),
ones AS (SELECT lang, one, count(*) AS f FROM grams GROUP BY lang, one),
twos AS (SELECT lang, one, two, count(*) AS f FROM grams WHERE two IS NOT NULL GROUP BY lang, one, two HAVING count(*) >= 10),
threes AS (SELECT lang, one, two, three, count(*) AS f FROM grams WHERE three IS NOT NULL GROUP BY lang, one, two, three HAVING count(*) >= 10),
over AS (
    SELECT lang, one, two, max(f) AS f FROM (
        SELECT lang, one, two, f FROM threes UNION ALL SELECT lang, two, three, f FROM threes) GROUP BY lang, one, two
),
cuts AS (
    SELECT t.lang, t.one || ' ' || t.two AS phrase, t.f AS a, 1 AS k, x.f AS l, y.f AS r
    FROM twos t JOIN ones x ON x.lang = t.lang AND x.one = t.one JOIN ones y ON y.lang = t.lang AND y.one = t.two
    LEFT JOIN over o ON o.lang = t.lang AND o.one = t.one AND o.two = t.two
    WHERE o.f IS NULL OR 100 * o.f < 50 * t.f
    UNION ALL
    SELECT t.lang, t.one || ' ' || t.two || ' ' || t.three, t.f, 1, x.f, y.f
    FROM threes t JOIN ones x ON x.lang = t.lang AND x.one = t.one JOIN twos y ON y.lang = t.lang AND y.one = t.two AND y.two = t.three
    UNION ALL
    SELECT t.lang, t.one || ' ' || t.two || ' ' || t.three, t.f, 2, x.f, y.f
    FROM threes t JOIN twos x ON x.lang = t.lang AND x.one = t.one AND x.two = t.two JOIN ones y ON y.lang = t.lang AND y.one = t.three
),
scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
lowest AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored) WHERE nth = 1
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals ON ranked.lang = totals.lang WHERE rank <= 2000
"""

BYTE_REPEATS_SQL = """
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS key, hex(encode(coalesce(text, ''))) AS hex FROM documents
),
bytes AS (SELECT *, strlen(hex) // 2 AS n_bytes FROM docs),
chunks AS (
    SELECT r, key, 500 * j AS base, hex[1000 * j + 1 : 1000 * j + 1098] AS hex
    FROM (SELECT r, key, hex, unnest(range(0, (n_bytes + 499) // 500)) AS j FROM bytes)
),
windows AS (
    SELECT r, key, base + i AS i, hex[2 * i + 1 : 2 * i + 100] AS gram
    FROM (SELECT *, unnest(range(0, least(500, strlen(hex) // 2 - 49))) AS i FROM chunks)
),
least AS (SELECT gram, min(key) AS least FROM windows GROUP BY gram HAVING count(*) > 1),
again AS (SELECT r, i FROM windows JOIN least ON windows.gram = least.gram WHERE key > least),
spans AS (
    SELECT r, min(i) AS start, max(i) + 50 AS stop FROM (
        SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS span FROM (
            SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM again))
    GROUP BY r, span
),
parts AS (
    SELECT r, start, stop, coalesce(lag(stop) OVER (PARTITION BY r ORDER BY start), 0) AS begin,
        lead(start) OVER (PARTITION BY r ORDER BY start) IS NULL AS last
    FROM spans
),
cut AS (
    SELECT parts.r, sum(stop - start) AS n_removed, count(*) AS n_spans,
        string_agg(hex[2 * begin + 1 : 2 * start] || CASE WHEN last THEN hex[2 * stop + 1 :] ELSE '' END, '' ORDER BY start) AS kept
    FROM parts JOIN bytes ON parts.r = bytes.r GROUP BY parts.r
)
SELECT doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept, hex))) AS kept_sha256
FROM bytes LEFT JOIN cut ON bytes.r = cut.r
"""
