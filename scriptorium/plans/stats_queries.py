"""Registered queries: corpus statistics, samples, splits and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.functions.text import ml_tokenize
from scriptorium.operators import corpus_stats as stats
from scriptorium.operators import metrics, sampling
from scriptorium.operators import partial_states as states
from scriptorium.operators.reshape import GENERATION_METHODS, SOURCE_COLUMNS
from scriptorium.operators.similarity import group_similarity_variance
from scriptorium.operators.word_moments import with_word_moments, word_table
from scriptorium.plans import oracle_sql as o
from scriptorium.plans import tables as t
from scriptorium.plans.catalog import built_once, query
from scriptorium.session import new_path, through_table

_COLUMNS = tuple(c for c, _ in SOURCE_COLUMNS)


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "split_row_counts",
    o.with_ctes(
        "SELECT coalesce(generation_method, 'TOTAL') AS split, count(*) AS n_rows FROM wide "
        "GROUP BY ROLLUP (generation_method)",
        o.WIDE,
    ),
)
def split_row_counts(spark, sf_dir):
    return stats.split_row_counts(t.wide_tags(spark, sf_dir))


@query(
    "null_counts",
    "SELECT count(*) - count(doc_id) AS doc_id, count(*) - count(text) AS text, count(*) - count(quality) AS quality, "
    "count(*) - count(toxic) AS toxic FROM documents LEFT JOIN labels USING (doc_id)",
)
def null_counts(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents").select("doc_id", "text")
    return stats.null_counts(docs.join(t.table(spark, sf_dir, "labels"), "doc_id", "left"))


@query(
    "avg_length_per_column",
    o.with_ctes(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, round(avg(length({c})), 6) AS avg_chars FROM wide HAVING avg(length({c})) > 0"
            for c in _COLUMNS
        ),
        o.WIDE,
    ),
)
def avg_length_per_column(spark, sf_dir):
    return _rounded(stats.avg_length_per_column(t.wide_corpus(spark, sf_dir), _COLUMNS), "avg_chars")


@query(
    "class_balance",
    o.with_ctes(
        "SELECT label, CASE WHEN label = 0 THEN 'human' ELSE 'ai' END AS class, count(*) AS n_rows, "
        "round(count(*) * 100 / sum(count(*)) OVER (), 6) AS percent FROM long GROUP BY label",
        o.LONG,
    ),
)
def class_balance(spark, sf_dir):
    return _rounded(stats.class_balance(t.corpus_tags(spark, sf_dir)), "percent")


def _count_query(name: str, column: str, relation: str, cte: str, source):
    @query(name, o.with_ctes(f"SELECT {column}, count(*) AS n_rows FROM {relation} GROUP BY {column} ORDER BY {column}", cte))
    def run(spark, sf_dir):
        return stats.count_by(source(spark, sf_dir), column)

    return run


_count_query("rows_per_method", "generation_method", "wide", o.WIDE, t.wide_tags)
_count_query("label_distribution", "label", "long", o.LONG, t.corpus_tags)
_count_query("source_distribution", "source", "long", o.LONG, t.corpus_tags)


@query(
    "word_count_stats",
    o.with_ctes(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, round(avg(n), 6) AS avg_words, min(n) AS min_words, max(n) AS max_words "
            f"FROM (SELECT coalesce({o.word_count(c)}, -1) AS n FROM wide)"
            for c in _COLUMNS
        ),
        o.WIDE,
    ),
)
def word_count_stats(spark, sf_dir):
    return _rounded(stats.word_count_stats(t.wide_corpus(spark, sf_dir), _COLUMNS), "avg_words")


_RICHNESS = "count(*) AS total_words, count(DISTINCT word) AS unique_words, round(count(DISTINCT word) / count(*), 6) AS ttr"


@query(
    "vocabulary_richness",
    o.with_ctes(f"SELECT source, {_RICHNESS} FROM words GROUP BY source", o.CLEAN_WORDS),
)
def vocabulary_richness(spark, sf_dir):
    return _rounded(stats.vocabulary_richness(t.clean_corpus(spark, sf_dir)), "ttr")


@query(
    "vocabulary_stats",
    o.with_ctes(
        f"SELECT * FROM (SELECT source, {_RICHNESS} FROM words GROUP BY source) JOIN (SELECT source, "
        "round(avg(word_count), 6) AS avg_words_per_abstract FROM clean GROUP BY source) USING (source)",
        o.CLEAN_WORDS,
    ),
)
def vocabulary_stats(spark, sf_dir):
    return _rounded(stats.vocabulary_stats(t.clean_corpus(spark, sf_dir)), "ttr", "avg_words_per_abstract")


def merged_states(spark, sf_dir):
    """The path of the partial states of the corpus, stored split by split; each step reads its own split alone."""

    def build():
        path = new_path(spark, "partial-states")
        for method in GENERATION_METHODS:
            wide, long = (make(spark, sf_dir).filter(F.col("generation_method") == method) for make in (t.wide_corpus, t.clean_corpus))
            states.store_split(path, method, wide, long, _COLUMNS)
        return path

    return built_once(spark, sf_dir, "partial states", build)


@query(
    "merged_split_counts",
    o.with_ctes("SELECT coalesce(generation_method, 'TOTAL') AS split, CAST(count(*) AS BIGINT) AS n_rows FROM wide GROUP BY ROLLUP (generation_method)", o.WIDE),
)
def merged_split_counts(spark, sf_dir):
    return states.split_row_counts(spark, merged_states(spark, sf_dir))


@query(
    "merged_column_statistics",
    o.with_ctes(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS n_null, round(avg(length({c})), 6) AS avg_chars, "
            f"round(avg(coalesce({o.word_count(c)}, -1)), 6) AS avg_words, min(coalesce({o.word_count(c)}, -1)) AS min_words, "
            f"max(coalesce({o.word_count(c)}, -1)) AS max_words FROM wide"
            for c in _COLUMNS
        ),
        o.WIDE,
    ),
)
def merged_column_statistics(spark, sf_dir):
    return _rounded(states.column_statistics(spark, merged_states(spark, sf_dir)), "avg_chars", "avg_words")


@query(
    "merged_text_counts",
    o.with_ctes(
        "SELECT source, label, CAST(count(*) AS BIGINT) AS n_rows FROM clean GROUP BY source, label",
        o.CLEAN,
    ),
)
def merged_text_counts(spark, sf_dir):
    return states.text_counts(spark, merged_states(spark, sf_dir), "source", "label")


@query(
    "merged_vocabulary_stats",
    o.with_ctes(
        f"SELECT source, CAST(total_words AS BIGINT) AS total_words, unique_words, ttr, avg_words_per_abstract FROM "
        f"(SELECT source, {_RICHNESS} FROM words GROUP BY source) JOIN (SELECT source, "
        "round(avg(word_count), 6) AS avg_words_per_abstract FROM clean GROUP BY source) USING (source)",
        o.CLEAN_WORDS,
    ),
)
def merged_vocabulary_stats(spark, sf_dir):
    return _rounded(states.vocabulary_stats(spark, merged_states(spark, sf_dir)), "ttr", "avg_words_per_abstract")


@query("merged_word_frequency", o.with_ctes("SELECT word, CAST(count(*) AS BIGINT) AS n FROM words GROUP BY word", o.CLEAN_WORDS))
def merged_word_frequency(spark, sf_dir):
    return states.word_frequency(spark, merged_states(spark, sf_dir))


@query("word_frequency", o.with_ctes("SELECT word, count(*) AS n FROM words GROUP BY word", o.CLEAN_WORDS))
def word_frequency(spark, sf_dir):
    return stats.word_frequency(t.clean_corpus(spark, sf_dir))


@query(
    "top_words",
    o.with_ctes("SELECT word, count(*) AS n FROM words GROUP BY word ORDER BY n DESC, word LIMIT 20", o.CLEAN_WORDS),
)
def top_words(spark, sf_dir):
    return stats.top_words(t.clean_corpus(spark, sf_dir))


@query(
    "top_bigrams",
    o.with_ctes(
        "SELECT bigram, count(*) AS n FROM (SELECT unnest(list_transform(range(1, len(w)), "
        "lambda i: w[i] || ' ' || w[i + 1])) AS bigram FROM "
        f"(SELECT {o.ml_tokens('text_clean')} AS w FROM clean)) GROUP BY bigram ORDER BY n DESC, bigram LIMIT 10",
        o.CLEAN,
    ),
)
def top_bigrams(spark, sf_dir):
    return stats.top_bigrams(t.clean_corpus(spark, sf_dir))


@query(
    "word_count_crosscheck",
    o.with_ctes("SELECT count(DISTINCT word) AS n_words, CAST(0 AS BIGINT) AS n_mismatches FROM words", o.CLEAN_WORDS),
)
def word_count_crosscheck(spark, sf_dir):
    clean = t.clean_corpus(spark, sf_dir)
    exported = clean.select("source", "label", "generation_method", "char_count", "text_clean")
    return stats.word_count_crosscheck(stats.word_frequency(clean), stats.delimited_word_count(exported))


@query(
    "class_word_weights",
    o.with_ctes(
        "SELECT class, word, n, rank, round(n / max(n) OVER (PARTITION BY class), 6) AS weight FROM ("
        "SELECT class, word, n, CAST(row_number() OVER (PARTITION BY class ORDER BY n DESC, word) AS INTEGER) AS rank "
        "FROM (SELECT CASE WHEN source = 'human' THEN 'human' ELSE 'ai' END AS class, word, count(*) AS n "
        "FROM words GROUP BY ALL)) WHERE rank <= 200",
        o.CLEAN_WORDS,
    ),
)
def class_word_weights(spark, sf_dir):
    return _rounded(stats.class_word_weights(t.clean_corpus(spark, sf_dir)), "weight")


def _summary_query(name, by, features, statistics, relation, cte, source):
    make = {"avg": "avg", "min": "min", "max": "max", "stddev": "stddev_samp"}
    exact = {"min", "max"}
    columns = [
        (f"{s}_{alias}", f"{make[s]}({c})", s in exact and c != "f_embed_variance")
        for alias, c in features.items()
        for s in statistics
    ]
    selected = ", ".join(
        f"{call} AS {n}" if whole else f"round(CAST({call} AS DOUBLE), 6) AS {n}" for n, call, whole in columns
    )

    @query(name, o.with_ctes(f"SELECT {by}, {selected} FROM {relation} GROUP BY {by} ORDER BY {by}", cte))
    def run(spark, sf_dir):
        summary = stats.feature_summary(source(spark, sf_dir), by, features, statistics)
        return summary.withColumns(
            {n: F.round(F.col(n).cast("double"), 6) for n, _, whole in columns if not whole}
        )

    return run


_summary_query("diacritics_by_source", "source", {"diacritics": "f_diacritics"}, ("avg", "min", "max"), "styled", o.STYLED, t.styled_corpus)
_summary_query("colons_by_source", "source", {"colons": "f_colons"}, ("avg",), "styled", o.STYLED, t.styled_corpus)
_summary_query("particles_by_source", "source", {"particles": "f_particles"}, ("avg",), "styled", o.STYLED, t.styled_corpus)
_summary_query("first_person_by_source", "source", {"first_person": "f_first_person"}, ("avg",), "styled", o.STYLED, t.styled_corpus)
_FOUR = {
    "diacritics": "f_diacritics",
    "colons": "f_colons",
    "particles": "f_particles",
    "first_person": "f_first_person",
}
_summary_query("stylometry_by_label", "label", _FOUR, ("avg",), "styled", o.STYLED, t.styled_corpus)


@query(
    "embedding_similarity_variance",
    "SELECT label, round(var_pop(s), 6) AS f_embed_variance FROM (SELECT a.label, "
    "list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS s FROM embeddings a JOIN embeddings b "
    "ON a.label = b.label AND a.vec_id < b.vec_id) GROUP BY label",
)
def embedding_similarity_variance(spark, sf_dir):
    vectors = t.table(spark, sf_dir, "embeddings")
    variance = group_similarity_variance(vectors, "label", "embedding", t.VECTOR_DIMS)
    return variance.select("label", F.round(F.col("f_embed_variance").cast("double"), 6).alias("f_embed_variance"))


def style_with_variance(spark, sf_dir):
    """The styled corpus with the similarity variance of each document's own words, stored once."""

    def build():
        styled = through_table(t.styled_corpus(spark, sf_dir).drop("text"), "styled-corpus")
        words = word_table(t.word_vectors(spark, sf_dir, styled))
        tokenized = styled.withColumn("tokens", ml_tokenize("text_clean")).drop("text_clean")
        made = with_word_moments(tokenized, "tokens", words, t.VECTOR_DIMS)
        return through_table(made.drop("tokens", "w2v_features"), "style-and-variance")

    return built_once(spark, sf_dir, "style with variance", build)


@query(
    "document_similarity_variance",
    o.with_ctes("SELECT doc_id, round(CAST(f_embed_variance AS DOUBLE), 6) AS f_embed_variance FROM full_style", o.TOKEN_VARIANCE),
)
def document_similarity_variance(spark, sf_dir):
    variance = F.round(F.col("f_embed_variance").cast("double"), 6).alias("f_embed_variance")
    return style_with_variance(spark, sf_dir).select("doc_id", variance)


_VARIANCE = {"variance": "f_embed_variance"}
_summary_query("embed_variance_by_source", "source", _VARIANCE, ("avg", "stddev"), "full_style", o.TOKEN_VARIANCE, style_with_variance)
_summary_query("embed_variance_by_label", "label", _VARIANCE, ("avg", "min", "max"), "full_style", o.TOKEN_VARIANCE, style_with_variance)
_summary_query(
    "stylometry_summary", "label", {**_FOUR, "embed_variance": "f_embed_variance"}, ("avg",), "full_style", o.TOKEN_VARIANCE, style_with_variance
)


@query(
    "vocabulary_size",
    o.with_ctes(
        "SELECT count(*) AS vocabulary_size FROM (SELECT word FROM words GROUP BY word HAVING count(*) >= 3)", o.CLEAN_WORDS
    ),
)
def vocabulary_size(spark, sf_dir):
    return stats.vocabulary_size(t.clean_corpus(spark, sf_dir))


_BUCKET = f"{o.hash32('doc_id')} % 100"
_SPLIT = f"CASE WHEN {_BUCKET} < 70 THEN 'train' WHEN {_BUCKET} < 85 THEN 'validation' ELSE 'test' END"


@query("stratified_split", o.with_ctes(f"SELECT doc_id, label, {_SPLIT} AS split FROM long", o.LONG))
def stratified_split(spark, sf_dir):
    return sampling.stratified_split(t.corpus_tags(spark, sf_dir).select("doc_id", "label"), "doc_id")


@query(
    "split_class_counts",
    o.with_ctes(
        f"SELECT {_SPLIT} AS split, count(*) AS n_rows, count(*) FILTER (label = 0) AS n_human, "
        "count(*) FILTER (label = 1) AS n_ai FROM long GROUP BY 1 ORDER BY 1",
        o.LONG,
    ),
)
def split_class_counts(spark, sf_dir):
    return stats.split_class_counts(sampling.stratified_split(t.corpus_tags(spark, sf_dir), "doc_id"))


@query("random_stratified_split", o.with_ctes("SELECT doc_id, label, CAST(1 AS BIGINT) AS n_splits FROM long", o.LONG))
def random_stratified_split(spark, sf_dir):
    """In how many of the three parts each document is."""
    parts = sampling.random_stratified_split(t.corpus_tags(spark, sf_dir).select("doc_id", "label"), "label")
    named = [part.withColumn("split", F.lit(n)) for part, n in zip(parts, ("train", "validation", "test"))]
    whole = named[0].union(named[1]).union(named[2])
    return whole.groupBy("doc_id", "label").agg(F.count("split").alias("n_splits"))


@query("fraction_sample", o.with_ctes(f"SELECT doc_id, label FROM long WHERE {_BUCKET} < 25", o.LONG))
def fraction_sample(spark, sf_dir):
    return sampling.fraction_sample_by_key(t.corpus_tags(spark, sf_dir).select("doc_id", "label"), "doc_id", 25)


@query("bernoulli_sample")
def bernoulli_sample(spark, sf_dir):
    return sampling.fraction_sample(t.corpus_tags(spark, sf_dir).select("doc_id", "label"), 0.25)


@query(
    "bernoulli_sample_shares",
    o.with_ctes("SELECT label, count(*) AS n_rows, CAST(1 AS INTEGER) AS plausible, CAST(0 AS BIGINT) AS n_foreign FROM long GROUP BY label", o.LONG),
)
def bernoulli_sample_shares(spark, sf_dir):
    """Per class the rows, whether the sample's share is within six standard deviations, and sampled rows not in the corpus."""
    corpus = t.corpus_tags(spark, sf_dir).select("doc_id", "label")
    drawn = bernoulli_sample(spark, sf_dir).groupBy("doc_id", "label").agg(F.count("*").alias("times"))
    both = corpus.withColumn("own", F.lit(1)).join(drawn, ["doc_id", "label"], "full")
    n, times = F.count("own"), F.coalesce(F.sum("times"), F.lit(0))
    near = F.abs(times - 0.25 * n) <= 6 * F.sqrt(0.1875 * n)
    foreign = F.count(F.when(F.col("own").isNull() | (F.col("times") > 1), 1))
    return both.groupBy("label").agg(n.alias("n_rows"), near.cast("int").alias("plausible"), foreign.alias("n_foreign"))


SAMPLE_SIZES = {0: 400, 1: 1600}
_SAMPLE = (
    "sample AS (SELECT doc_id, label FROM (SELECT doc_id, label, row_number() OVER (PARTITION BY label "
    f"ORDER BY {o.hash32('doc_id')}, doc_id) AS place FROM long) WHERE place <= CASE label WHEN 0 THEN 400 ELSE 1600 END)"
)


def fixed_sample(spark, sf_dir):
    docs = t.corpus_tags(spark, sf_dir).select("doc_id", "label")
    return sampling.stratified_fixed_sample(docs, "label", "doc_id", SAMPLE_SIZES)


@query("stratified_fixed_sample", o.with_ctes("SELECT doc_id, label FROM sample", o.LONG, _SAMPLE))
def stratified_fixed_sample(spark, sf_dir):
    return fixed_sample(spark, sf_dir).select("doc_id", "label")


@query(
    "sample_label_counts",
    o.with_ctes("SELECT label, count(*) AS n_rows FROM sample GROUP BY label ORDER BY label", o.LONG, _SAMPLE),
)
def sample_label_counts(spark, sf_dir):
    return stats.count_by(fixed_sample(spark, sf_dir), "label")


@query(
    "stratified_holdout",
    o.with_ctes(
        "SELECT doc_id, label, CASE WHEN place <= floor(n * 70 / 100) THEN 'train' ELSE 'test' END AS split FROM ("
        f"SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY {o.hash32('doc_id')}, doc_id) AS place, "
        "count(*) OVER (PARTITION BY label) AS n FROM long)",
        o.LONG,
    ),
)
def stratified_holdout(spark, sf_dir):
    docs = t.corpus_tags(spark, sf_dir).select("doc_id", "label")
    return sampling.stratified_holdout(docs, "label", "doc_id").select("doc_id", "label", "split")


_CELLS = (
    "cells AS (SELECT CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp, "
    "CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp, "
    "CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn, "
    "CAST(count(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn FROM scored)"
)


@query(
    "accuracy",
    o.with_ctes("SELECT round(avg(CASE WHEN label = prediction THEN 1 ELSE 0 END), 6) AS accuracy FROM scored", o.SCORED),
)
def accuracy(spark, sf_dir):
    return _rounded(metrics.accuracy(t.scored_documents(spark, sf_dir)), "accuracy")


@query(
    "weighted_f1",
    o.with_ctes(
        "SELECT round((2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fn + fp) * (tn + fp)) "
        "/ (tp + fp + fn + tn), 6) AS weighted_f1 FROM cells",
        o.SCORED,
        _CELLS,
    ),
)
def weighted_f1(spark, sf_dir):
    return _rounded(metrics.weighted_f1(t.scored_documents(spark, sf_dir)), "weighted_f1")


@query(
    "positive_f1",
    o.with_ctes("SELECT round(2 * tp / (2 * tp + fp + fn), 6) AS positive_f1 FROM cells", o.SCORED, _CELLS),
)
def positive_f1(spark, sf_dir):
    return _rounded(metrics.positive_f1(t.scored_documents(spark, sf_dir)), "positive_f1")


@query(
    "class_recall",
    o.with_ctes(
        "SELECT round(tp / (tp + fn), 6) AS ai_recall, round(tn / (tn + fp), 6) AS human_recall FROM cells", o.SCORED, _CELLS
    ),
)
def class_recall(spark, sf_dir):
    return _rounded(metrics.class_recall(t.scored_documents(spark, sf_dir)), "ai_recall", "human_recall")


@query(
    "confusion_matrix",
    o.with_ctes(
        "SELECT label, count(*) FILTER (prediction = 0) AS predicted_0, count(*) FILTER (prediction = 1) AS predicted_1 "
        "FROM scored GROUP BY label",
        o.SCORED,
    ),
)
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(t.scored_documents(spark, sf_dir))


@query(
    "roc_auc",
    o.with_ctes(
        "SELECT round(avg(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END), 6) AS roc_auc "
        "FROM (SELECT score FROM scored WHERE label = 1) p, (SELECT score FROM scored WHERE label = 0) n",
        o.SCORED,
    ),
)
def roc_auc(spark, sf_dir):
    return _rounded(metrics.roc_auc(t.scored_documents(spark, sf_dir)), "roc_auc")


@query(
    "roc_points",
    o.with_ctes(
        "SELECT DISTINCT score AS threshold, round(count(*) FILTER (label = 0) OVER w / count(*) FILTER (label = 0) OVER (), 6) AS fpr, "
        "round(count(*) FILTER (label = 1) OVER w / count(*) FILTER (label = 1) OVER (), 6) AS tpr "
        "FROM scored WINDOW w AS (ORDER BY score DESC)",
        o.SCORED,
    ),
)
def roc_points(spark, sf_dir):
    return _rounded(metrics.roc_points(t.scored_documents(spark, sf_dir)), "fpr", "tpr")
