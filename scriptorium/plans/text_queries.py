"""Registered queries: reshape, filters, text normalisation and stylometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions import stylometry, text
from scriptorium.functions.messages import message_json, message_struct, predicted_class
from scriptorium.operators import reshape
from scriptorium.operators.reshape import GENERATION_METHODS, SOURCE_COLUMNS
from scriptorium.plans import oracle_sql as o
from scriptorium.plans import tables as t
from scriptorium.plans.catalog import query

_WIDE_COLUMNS = ", ".join(c for c, _ in SOURCE_COLUMNS)


@query(
    "tag_generation_method",
    "SELECT doc_id, source, 'by_polishing' AS generation_method FROM documents",
)
def tag_generation_method(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents").select("doc_id", "source")
    return reshape.tag_generation_method(docs, "by_polishing")


def tagged_splits(spark, sf_dir):
    return [reshape.tag_generation_method(t.wide_split(spark, sf_dir, m), m) for m in GENERATION_METHODS]


@query("union_splits", o.with_ctes(f"SELECT row_id, {_WIDE_COLUMNS}, generation_method FROM wide", o.WIDE))
def union_splits(spark, sf_dir):
    return reshape.union_splits(tagged_splits(spark, sf_dir))


@query("union_positional", o.with_ctes("SELECT doc_id, text, label FROM long", o.LONG))
def union_positional(spark, sf_dir):
    docs = t.long_corpus(spark, sf_dir).select("doc_id", "text", "label")
    human = reshape.source_filter(docs, "label", 0)
    machine = reshape.source_filter(docs, "label", 1)
    return reshape.union_positional([human, machine.toDF("id", "body", "class")])


@query("wide_to_long", o.with_ctes("SELECT text, label, source, generation_method FROM long", o.LONG))
def wide_to_long(spark, sf_dir):
    return reshape.wide_to_long(t.wide_corpus(spark, sf_dir))


@query("drop_null_short_text", "SELECT conv_id, turn, text FROM conversations WHERE text IS NOT NULL AND length(text) > 10")
def drop_null_short_text(spark, sf_dir):
    return reshape.drop_null_short_text(t.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))


@query("min_clean_length_filter", o.with_ctes("SELECT doc_id, char_count FROM clean", o.CLEAN))
def min_clean_length_filter(spark, sf_dir):
    long = reshape.drop_null_short_text(t.long_corpus(spark, sf_dir))
    return reshape.min_clean_length_filter(stylometry.with_clean_text(long)).select("doc_id", "char_count")


@query(
    "nonempty_clean_filter",
    o.with_ctes(
        f"SELECT conv_id, turn, text_clean FROM (SELECT conv_id, turn, {o.preprocess(o.to_arabic('text'))} AS text_clean "
        "FROM conversations) WHERE text_clean <> ''",
        o.ARABIC_DOCS,
    ),
)
def nonempty_clean_filter(spark, sf_dir):
    turns = t.table(spark, sf_dir, "conversations")
    clean = text.preprocess_text(t.to_arabic("text")).alias("text_clean")
    return reshape.nonempty_clean_filter(turns.select("conv_id", "turn", clean))


@query("source_filter", o.with_ctes("SELECT doc_id, source, label FROM long WHERE source <> 'human'", o.LONG))
def source_filter(spark, sf_dir):
    docs = t.corpus_tags(spark, sf_dir).select("doc_id", "source", "label")
    return reshape.source_filter(docs, "source", "human", equal=False)


_SCORES_WITH_GAPS = (
    "scores AS (SELECT doc_id, CASE WHEN quality IS NULL THEN NULL ELSE CAST(quality AS DOUBLE) END AS prediction "
    "FROM documents LEFT JOIN labels USING (doc_id))"
)


def _scores_with_gaps(spark, sf_dir):
    labels = t.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("prediction"))
    return t.table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left")


@query(
    "prediction_class_case",
    o.with_ctes(
        "SELECT doc_id, prediction, CASE WHEN prediction = 0 THEN 'human' ELSE 'ai' END AS predicted_class FROM scores",
        _SCORES_WITH_GAPS,
    ),
)
def prediction_class_case(spark, sf_dir):
    return _scores_with_gaps(spark, sf_dir).withColumn("predicted_class", predicted_class(F.col("prediction")))


@query("text_preview", o.with_ctes("SELECT doc_id, substr(text, 1, 80) AS text_preview FROM arabic", o.ARABIC_DOCS))
def text_preview(spark, sf_dir):
    return t.arabic_documents(spark, sf_dir).select("doc_id", text.text_preview("text").alias("text_preview"))


@query(
    "cast_prediction",
    o.with_ctes("SELECT doc_id, coalesce(CAST(prediction AS INTEGER), -1) AS predicted_label FROM scores", _SCORES_WITH_GAPS),
)
def cast_prediction(spark, sf_dir):
    label = F.coalesce(F.col("prediction").cast("int"), F.lit(-1))
    return _scores_with_gaps(spark, sf_dir).select("doc_id", label.alias("predicted_label"))


@query(
    "project_rename_drop",
    o.with_ctes("SELECT text AS body, label, source, generation_method FROM long", o.LONG),
)
def project_rename_drop(spark, sf_dir):
    return t.long_corpus(spark, sf_dir).withColumnRenamed("text", "body").drop("doc_id")


@query("expand_struct", "SELECT doc_id, lang, n_chars FROM documents")
def expand_struct(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents")
    return docs.select(F.struct("doc_id", "lang", "n_chars").alias("data")).select("data.*")


@query(
    "row_limit",
    "SELECT doc_id, source, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 100",
)
def row_limit(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return reshape.row_limit(docs, 100, F.desc("n_chars"), "doc_id")


PAYLOAD = (
    f"payload AS (SELECT row_number() OVER (ORDER BY row_id) - 1 AS id, text, 'human' AS true_source, "
    f"CAST({t.EPOCH} + row_id AS DOUBLE) AS timestamp FROM (SELECT row_id, "
    f"regexp_replace(original_abstract, '^{o.BLANKS}+|{o.BLANKS}+$', '', 'g') AS text FROM wide) WHERE text <> '')"
)


def payload(spark, sf_dir):
    wide = t.wide_corpus(spark, sf_dir)
    return reshape.payload_rows(wide, "original_abstract", "row_id", F.col("row_id") + F.lit(t.EPOCH))


@query("payload_rows", o.with_ctes("SELECT id, text, true_source, timestamp FROM payload", o.WIDE, PAYLOAD))
def payload_rows(spark, sf_dir):
    return payload(spark, sf_dir)


def _text_query(name: str, make, sql: str, output: str = "result"):
    """A query that applies one text function to every document."""

    @query(name, o.with_ctes(f"SELECT doc_id, {sql} AS {output} FROM arabic", o.ARABIC_DOCS))
    def run(spark, sf_dir):
        return t.arabic_documents(spark, sf_dir).select("doc_id", make("text").alias(output))

    return run


_text_query("strip_diacritics", text.strip_diacritics, o.strip_diacritics("text"))
_text_query("strip_tatweel", text.strip_tatweel, o.strip_tatweel("text"))
_text_query("fold_letters", text.fold_letters, o.fold_letters("text"))
_text_query("keep_script_range", text.keep_script_range, o.keep_script_range("text"))
_text_query("remove_stopwords", text.remove_stopwords, o.remove_stopwords("text"))
_text_query("preprocess_text", text.preprocess_text, o.preprocess("text"), "text_clean")
_text_query("count_diacritics", stylometry.count_diacritics, o.count_diacritics("text"), "f_diacritics")
_text_query("count_colons", stylometry.count_colons, o.count_colons("text"), "f_colons")
_text_query("count_particles", stylometry.count_particles, o.count_particles("text"), "f_particles")
_text_query("count_first_person", stylometry.count_first_person, o.count_first_person("text"), "f_first_person")


@query("char_count", o.with_ctes("SELECT doc_id, char_count FROM clean", o.CLEAN))
def char_count(spark, sf_dir):
    return t.clean_corpus(spark, sf_dir).select("doc_id", text.char_count("text_clean").alias("char_count"))


@query("word_count", o.with_ctes("SELECT doc_id, word_count FROM clean", o.CLEAN))
def word_count(spark, sf_dir):
    return t.clean_corpus(spark, sf_dir).select("doc_id", text.word_count("text_clean").alias("word_count"))


@query(
    "tokenize_whitespace",
    o.with_ctes(
        f"SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS word "
        f"FROM (SELECT doc_id, {o.words('text_clean')} AS w FROM clean)",
        o.CLEAN,
    ),
)
def tokenize_whitespace(spark, sf_dir):
    clean = t.clean_corpus(spark, sf_dir)
    return clean.select("doc_id", F.posexplode(text.clean_words("text_clean")).alias("pos", "word"))


@query(
    "ml_tokenize",
    f"SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, '|') AS tokens "
    f"FROM (SELECT doc_id, {o.ml_tokens('text')} AS tokens FROM documents)",
)
def ml_tokenize(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents").select("doc_id", text.ml_tokenize("text").alias("tokens"))
    return docs.select("doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", "|").alias("tokens"))


@query(
    "bigrams",
    o.with_ctes(
        "SELECT doc_id, CAST(greatest(len(tokens) - 1, 0) AS INTEGER) AS n_bigrams, coalesce(array_to_string("
        "list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]), '|'), '') AS bigrams "
        f"FROM (SELECT doc_id, {o.ml_tokens('text_clean')} AS tokens FROM clean)",
        o.CLEAN,
    ),
)
def bigrams(spark, sf_dir):
    tokens = t.clean_corpus(spark, sf_dir).select("doc_id", text.ml_tokenize("text_clean").alias("tokens"))
    pairs = tokens.select("doc_id", text.bigrams("tokens").alias("bigrams"))
    return pairs.select("doc_id", F.size("bigrams").alias("n_bigrams"), F.array_join("bigrams", "|").alias("bigrams"))


@query(
    "parse_json_message",
    o.with_ctes("SELECT coalesce(id, -1) AS id, text, true_source, timestamp, ingest_seconds FROM messages", o.MESSAGES),
)
def parse_json_message(spark, sf_dir):
    messages = t.envelopes(spark, sf_dir)
    parsed = messages.select(message_struct(F.col("value")).alias("data"), F.unix_seconds("timestamp").alias("ingest_seconds"))
    return parsed.select("data.*", "ingest_seconds").withColumn("id", F.coalesce("id", F.lit(-1)))


@query(
    "build_json_message",
    o.with_ctes(
        f"SELECT CAST(doc_id AS VARCHAR) AS id, text, source AS true_source, CAST(doc_id + {t.EPOCH} AS VARCHAR) AS seconds FROM long",
        o.LONG,
    ),
)
def build_json_message(spark, sf_dir):
    docs = t.long_corpus(spark, sf_dir)
    built = docs.select(
        message_json(F.col("doc_id"), F.col("text"), F.col("source"), F.col("doc_id") + F.lit(t.EPOCH)).alias("json")
    )
    field = {name: F.get_json_object("json", f"$.{name}") for name in ("id", "text", "true_source", "timestamp")}
    return built.select(
        field["id"].alias("id"),
        field["text"].alias("text"),
        field["true_source"].alias("true_source"),
        field["timestamp"].cast("double").cast("bigint").cast("string").alias("seconds"),
    )


@query(
    "stylometric_features",
    o.with_ctes(
        "SELECT doc_id, char_count, word_count, f_diacritics, f_colons, f_particles, f_first_person FROM styled",
        o.STYLED,
    ),
)
def stylometric_features(spark, sf_dir):
    return t.styled_corpus(spark, sf_dir).select(
        "doc_id", "char_count", "word_count", *stylometry.COUNT_COLUMNS
    )
