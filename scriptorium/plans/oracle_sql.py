"""The derived tables and text rules once more, as DuckDB SQL written from their definitions."""

from __future__ import annotations

from scriptorium.functions.profiles import ARABIC
from scriptorium.operators.reshape import GENERATION_METHODS, SOURCE_COLUMNS, SOURCES
from scriptorium.plans import tables

BLANKS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def with_ctes(select: str, *ctes: str) -> str:
    return f"WITH {', '.join(ctes)} {select}"


def to_arabic(text: str) -> str:
    out = f"lower({text})"
    for word, script in tables.WORD_MAP:
        out = f"replace({out}, '{word}', '{script}')"
    return f"translate({out}, '{tables.LETTERS}', '{tables.SCRIPT}')"


def strip_diacritics(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '[\\x{{064B}}-\\x{{0652}}]', '', 'g')"


def strip_tatweel(x: str) -> str:
    return f"replace(coalesce({x}, ''), chr(1600), '')"


def fold_letters(x: str) -> str:
    out = strip_tatweel(x)
    for source, target in ARABIC.folds:
        out = f"replace({out}, '{source}', '{target}')"
    return out


def keep_script_range(x: str) -> str:
    spaced = f"regexp_replace(coalesce({x}, ''), '[^\\x{{0600}}-\\x{{06FF}}\\s]', ' ', 'g')"
    return f"trim(regexp_replace({spaced}, '\\s+', ' ', 'g'))"


def words(x: str) -> str:
    return f"list_filter(string_split_regex(coalesce({x}, ''), '{BLANKS}+'), lambda w: w <> '')"


def remove_stopwords(x: str) -> str:
    return f"coalesce(array_to_string(list_filter({words(x)}, lambda w: w NOT IN ({quoted(ARABIC.stopwords)})), ' '), '')"


def preprocess(x: str) -> str:
    return remove_stopwords(keep_script_range(fold_letters(strip_diacritics(x))))


def word_count(x: str) -> str:
    return f"CAST(len(string_split_regex({x}, '\\s+')) AS INTEGER)"


def count_diacritics(x: str) -> str:
    pattern = "[^\\x{064B}-\\x{0655}\\x{0670}]"
    return f"CAST(length(regexp_replace(coalesce({x}, ''), '{pattern}', '', 'g')) AS INTEGER)"


def count_colons(x: str) -> str:
    return f"CAST(length(regexp_replace(coalesce({x}, ''), '[^:\\x{{FF1A}}]', '', 'g')) AS INTEGER)"


def count_particles(x: str) -> str:
    return f"CAST(len(list_filter({words(strip_diacritics(x))}, lambda w: w IN ({quoted(ARABIC.particles)}))) AS INTEGER)"


def count_first_person(x: str) -> str:
    folded = f"regexp_replace({strip_diacritics(x)}, '[إأآ]', 'ا', 'g')"
    suffixes = " OR ".join(f"w LIKE '%{s}'" for s in ARABIC.person_suffixes)
    test = f"w IN ({quoted(ARABIC.pronouns)}) OR (length(w) >= 4 AND ({suffixes}))"
    return f"CAST(len(list_filter({words(folded)}, lambda w: {test})) AS INTEGER)"


def ml_tokens(x: str) -> str:
    kept = f"regexp_replace(lower({x}), '[\\s\\x0b]+$', '')"
    return f"CASE WHEN {x} <> '' AND {kept} = '' THEN []::VARCHAR[] ELSE string_split_regex({kept}, '[\\s\\x0b]') END"


def hash32(x: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({x} AS VARCHAR)), 1, 8) AS BIGINT)"


def murmur32(word: str, seed: int = 42) -> str:
    """Murmur3 of the UTF-8 bytes of a word as an unsigned number of 32 bits, step by step as published."""
    size = f"(strlen(hex(encode({word}))) // 2)"

    def times(x: str, factor: int) -> str:
        return f"(({x})::HUGEINT * {factor} % 4294967296)::BIGINT"

    def turned(x: str, bits: int) -> str:
        return f"((({x}) << {bits}) % 4294967296 + (({x}) >> {32 - bits}))"

    def byte(place: str) -> str:
        return f"CAST('0x' || substr(hex(encode({word})), 2 * ({place}) + 1, 2) AS BIGINT)"

    def spread(x: str) -> str:
        return times(turned(times(x, 0xCC9E2D51), 15), 0x1B873593)

    whole = " + ".join(f"{byte(f'4 * b + {i}')} * {256**i}" for i in range(4))
    blocks = f"[{spread(f'({whole})')} for b in range(0, {size} // 4)]"
    mixed = turned("xor(h, k)", 13)
    body = f"list_reduce(list_prepend({seed}::BIGINT, {blocks}::BIGINT[]), lambda h, k: ({times(mixed, 5)} + 3864292196) % 4294967296)"
    rest = " + ".join(f"CASE WHEN {size} % 4 > {i} THEN {byte(f'{size} // 4 * 4 + {i}')} * {256**i} ELSE 0 END" for i in range(3))
    tail = f"CASE WHEN {size} % 4 > 0 THEN {spread(f'({rest})')} ELSE 0 END"
    steps = [f"xor(xor({body}, {tail}), {size})"]
    return (
        "(SELECT xor(h3, h3 >> 16) FROM (SELECT "
        + times("xor(h2, h2 >> 13)", 0xC2B2AE35)
        + " AS h3 FROM (SELECT "
        + times("xor(h1, h1 >> 16)", 0x85EBCA6B)
        + f" AS h2 FROM (SELECT {steps[0]} AS h1))))"
    )


def hash_slot(word: str, slots: int) -> str:
    """The slot of a hashed term: the remainder of the signed hash, made positive."""
    signed = f"(h - CASE WHEN h >= 2147483648 THEN 4294967296 ELSE 0 END)"
    return f"(SELECT (({signed} % {slots}) + {slots}) % {slots} FROM (SELECT {murmur32(word)} AS h))"


def _case(position: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {position} {whens} END"


ARABIC_DOCS = f"arabic AS (SELECT doc_id, {to_arabic('text')} AS text FROM documents)"
_TAGS = (
    f"CASE WHEN doc_id % 5 = 0 THEN 0 ELSE 1 END AS label, {_case('doc_id % 5', SOURCES)} AS source, "
    f"{_case('(doc_id // 5) % 3', GENERATION_METHODS)} AS generation_method"
)
LONG = f"{ARABIC_DOCS}, long AS (SELECT doc_id, text, {_TAGS} FROM arabic)"
WIDE = (
    f"{ARABIC_DOCS}, wide AS (SELECT doc_id // 5 AS row_id, "
    + ", ".join(f"max(CASE WHEN doc_id % 5 = {i} THEN text END) AS {c}" for i, (c, _) in enumerate(SOURCE_COLUMNS))
    + f", {_case('(doc_id // 5) % 3', GENERATION_METHODS)} AS generation_method FROM arabic GROUP BY ALL)"
)


def _cleaned(source: str, columns: str) -> str:
    return (
        f"(SELECT *, CAST(length(text_clean) AS INTEGER) AS char_count, {word_count('text_clean')} AS word_count "
        f"FROM (SELECT {columns}, {preprocess('text')} AS text_clean FROM {source} "
        f"WHERE text IS NOT NULL AND length(text) > 10) WHERE length(text_clean) > 20)"
    )


CLEAN = f"{LONG}, clean AS {_cleaned('long', '*')}"
STYLE = ", ".join(
    f"{fn('text')} AS {name}"
    for fn, name in (
        (count_diacritics, "f_diacritics"),
        (count_colons, "f_colons"),
        (count_particles, "f_particles"),
        (count_first_person, "f_first_person"),
    )
)
STYLED = f"{CLEAN}, styled AS (SELECT *, {STYLE} FROM clean)"
FEATURES = (
    f"{ARABIC_DOCS}, joined AS (SELECT doc_id, text, quality AS label FROM arabic LEFT JOIN labels USING (doc_id)), "
    f"features AS (SELECT *, {STYLE} FROM {_cleaned('joined', '*')})"
)
SCORED = (
    "scored AS (SELECT doc_id, quality AS label, CAST(length(text) % 97 AS DOUBLE) AS score, "
    "CASE WHEN length(text) % 97 >= 48 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction "
    "FROM documents JOIN labels USING (doc_id))"
)
CLEAN_WORDS = f"{CLEAN}, words AS (SELECT doc_id, source, unnest({words('text_clean')}) AS word FROM clean)"
WORD_VECTORS = (
    f"{CLEAN_WORDS}, word_vectors AS (SELECT word, embedding FROM (SELECT DISTINCT word FROM words) "
    f"JOIN embeddings ON vec_id = {hash32('word')} % ((SELECT max(vec_id) FROM embeddings) + 1))"
)


def token_variance(counted: str, key: str, name: str = "variances") -> str:
    """Variance of similarity over all pairs of known tokens, from (key, word, n), pair of words by pair of words."""
    return (
        f"{name}_known AS (SELECT {key}, word, n, embedding::DOUBLE[] AS e FROM {counted} JOIN word_vectors USING (word)), "
        f"{name}_pairs AS (SELECT a.{key} AS {key}, a.n * b.n AS c, list_cosine_similarity(a.e, b.e) AS s FROM {name}_known a "
        f"JOIN {name}_known b ON a.{key} = b.{key} AND a.word < b.word UNION ALL SELECT {key}, n * (n - 1) / 2, 1 FROM {name}_known WHERE n > 1), "
        f"{name} AS (SELECT {key}, CAST(greatest(sum(c * s * s) / sum(c) - (sum(c * s) / sum(c)) ** 2, 0) AS FLOAT) AS f_embed_variance "
        f"FROM {name}_pairs GROUP BY {key})"
    )


TOKEN_VARIANCE = (
    f"{WORD_VECTORS}, counted AS (SELECT doc_id, word, count(*) AS n FROM "
    f"(SELECT doc_id, unnest({ml_tokens('text_clean')}) AS word FROM clean) GROUP BY ALL), {token_variance('counted', 'doc_id')}, "
    f"full_style AS (SELECT styled.*, coalesce(f_embed_variance, CAST(0 AS FLOAT)) AS f_embed_variance "
    f"FROM (SELECT *, {STYLE} FROM clean) styled LEFT JOIN variances USING (doc_id))"
)
MESSAGES = (
    f"{LONG}, messages AS ("
    f"SELECT doc_id AS id, text, CASE WHEN label = 0 THEN 'human' ELSE 'ai' END AS true_source, "
    f"CAST(doc_id + {tables.EPOCH} AS DOUBLE) AS timestamp, doc_id + {tables.EPOCH} AS ingest_seconds FROM long "
    f"UNION ALL SELECT NULL, NULL, NULL, NULL, doc_id + {tables.EPOCH} FROM long WHERE doc_id % 50 = 0 "
    f"UNION ALL SELECT NULL, text, CASE WHEN label = 0 THEN 'human' ELSE 'ai' END, NULL, doc_id + {tables.EPOCH} "
    "FROM long WHERE doc_id % 50 = 1)"
)
_MESSAGES_ALONE = MESSAGES.removeprefix(f"{LONG}, ")
MESSAGE_VECTORS = (
    f"{WORD_VECTORS}, {_MESSAGES_ALONE}, vector_messages AS (SELECT row_number() OVER () AS m, coalesce(id, -1) AS id, ingest_seconds, "
    f"CAST({tables.VECTOR_DIMS} AS INTEGER) AS n_dims, {preprocess('text')} AS text_clean FROM messages), "
    f"message_tokens AS (SELECT m, unnest({ml_tokens('text_clean')}) AS word FROM vector_messages), "
    f"message_words AS (SELECT m, word, count(*) AS n FROM message_tokens GROUP BY ALL), {token_variance('message_words', 'm')}, "
    "means AS (SELECT m, sum(n * list_sum(embedding::DOUBLE[])) / (SELECT sum(n) FROM message_words a WHERE a.m = w.m) AS total "
    "FROM message_words w JOIN word_vectors USING (word) GROUP BY m)"
)
