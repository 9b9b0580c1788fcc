"""Registered queries: feature vectors, fitted models and their comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from scriptorium.functions.text import ml_tokenize
from scriptorium.operators import classifiers as c
from scriptorium.operators import sampling, vectors
from scriptorium.operators.projected_vectors import context_weights, projected_sums
from scriptorium.operators.word_moments import word_table
from scriptorium.plans import oracle_sql as o
from scriptorium.plans import tables as t
from scriptorium.plans.catalog import built_once, query
from scriptorium.session import new_path, through_table
from scriptorium.sources import models as store


def stored_corpus(spark, sf_dir):
    """(doc_id, text_clean) of the cleaned corpus as a table, since fitting reads it several times."""

    def build():
        return through_table(t.clean_corpus(spark, sf_dir).select("doc_id", "text_clean"), "clean-corpus")

    return built_once(spark, sf_dir, "clean corpus", build)


def stored_styles(spark, sf_dir):
    """(doc_id, text_clean, …) of the cleaned corpus with its style counts, stored: texts are cleaned once for both."""

    def build():
        return through_table(t.styled_corpus(spark, sf_dir).select("doc_id", "text_clean", *_SCALARS), "styled-corpus")

    return built_once(spark, sf_dir, "styled corpus", build)


def _tokenized(clean):
    return clean.select("doc_id", ml_tokenize("text_clean").alias("tokens"))


def tokenized_corpus(spark, sf_dir):
    return _tokenized(stored_corpus(spark, sf_dir))


def corpus_word_model(spark, sf_dir):
    tokens = tokenized_corpus(spark, sf_dir)
    return built_once(spark, sf_dir, "corpus words", lambda: vectors.word2vec_fit(tokens, "tokens"))


def feature_table(spark, sf_dir):
    """All documents with all features, stored, and the term model, word model and word table behind them."""

    def build():
        styled = t.feature_documents(spark, sf_dir).drop("text")
        complete, terms, model, words = vectors.full_feature_table(styled)
        tagged = sampling.stratified_split(complete.drop("text_clean"), "doc_id")
        return through_table(tagged, "features"), terms, model, words

    return built_once(spark, sf_dir, "features", build)


def split_of(spark, sf_dir, name):
    """The labelled rows of a split: classifiers are fitted and judged on these alone."""
    return feature_table(spark, sf_dir)[0].filter((F.col("split") == name) & F.col("label").isNotNull())


def fitted(spark, sf_dir, name):
    estimator = c.default_estimators()[name]
    return built_once(spark, sf_dir, name, lambda: c.train(split_of(spark, sf_dir, "train"), estimator))


def _judged(df, *columns):
    """Each row's key and label, and whether its prediction follows from a score between 0 and 1."""
    decided = (F.col("prediction") == (F.col("score") > 0.5).cast("double")) & F.col("score").between(0, 1)
    return c.with_positive_score(df).select(*columns, decided.cast("int").alias("decided"))


_SPLIT = f"{o.hash32('doc_id')} % 100"
_FEATURES = (
    f"{o.FEATURES}, split_features AS (SELECT *, CASE WHEN {_SPLIT} < 70 THEN 'train' WHEN {_SPLIT} < 85 THEN 'validation' "
    "ELSE 'test' END AS split FROM features)"
)
_VALIDATED = o.with_ctes(
    "SELECT doc_id, label, CAST(1 AS INTEGER) AS decided FROM split_features WHERE split = 'validation' AND label IS NOT NULL", _FEATURES
)


_TERM_TOKENS = f"tokens AS (SELECT doc_id, unnest({o.ml_tokens('text_clean')}) AS word FROM clean)"


@query(
    "word2vec_fit",
    o.with_ctes(
        "SELECT count(*) AS vocabulary_size, 100 AS vector_size FROM "
        "(SELECT word FROM tokens GROUP BY word HAVING count(*) >= 3)",
        o.CLEAN,
        _TERM_TOKENS,
    ),
)
def word2vec_fit(spark, sf_dir):
    model = corpus_word_model(spark, sf_dir)
    size = F.lit(model.getVectorSize()).alias("vector_size")
    return model.getVectors().agg(F.count("word").alias("vocabulary_size")).select("vocabulary_size", size)


@query(
    "word2vec_vectors",
    o.with_ctes(
        "SELECT word, 100 AS n_dims FROM tokens GROUP BY word HAVING count(*) >= 3", o.CLEAN, _TERM_TOKENS
    ),
)
def word2vec_vectors(spark, sf_dir):
    words = corpus_word_model(spark, sf_dir).getVectors()
    return words.select("word", F.size(vector_to_array("vector")).alias("n_dims"))


_PROJECTED = (
    "placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS i FROM "
    f"(SELECT doc_id, {o.ml_tokens('text_clean')} AS words FROM clean)), "
    "often AS (SELECT word FROM placed GROUP BY word HAVING count(*) >= 5), kept AS (SELECT * FROM placed SEMI JOIN often USING (word)), "
    "near AS (SELECT x.word AS a, y.word AS b, count(*) AS n FROM kept x JOIN kept y ON x.doc_id = y.doc_id AND x.i <> y.i AND abs(x.i - y.i) <= 2 GROUP BY ALL), "
    "margins AS (SELECT a, sum(n) AS margin FROM near GROUP BY a), "
    "shares AS (SELECT near.a, near.b, n::DOUBLE * (SELECT sum(margin) FROM margins)::DOUBLE / (x.margin::DOUBLE * y.margin::DOUBLE) AS share "
    "FROM near JOIN margins x ON x.a = near.a JOIN margins y ON y.a = near.b), "
    "weights AS (SELECT a AS word, b AS context, floor(ln(share) * 65536)::BIGINT AS weight FROM shares WHERE share > 1), "
    "signs AS (SELECT context, CAST('0x' || substr(md5('42:' || context || ':0'), 1, 8) AS BIGINT) AS bits FROM (SELECT DISTINCT context FROM weights)), "
    "sums AS (SELECT word, j, sum(CASE WHEN (bits >> j) % 2 = 1 THEN -weight ELSE weight END)::BIGINT AS total "
    "FROM weights JOIN signs USING (context), unnest(range(0, 32)) AS r(j) GROUP BY ALL)"
)


@query(
    "projected_word_vectors",
    o.with_ctes("SELECT word, CAST(j AS INTEGER) AS pos, total FROM sums", o.CLEAN, _PROJECTED),
)
def projected_word_vectors(spark, sf_dir):
    """Vectors of 32 dimensions from co-occurrence within two places, as whole sums."""
    weights = context_weights(tokenized_corpus(spark, sf_dir), "tokens", window=2, min_count=5)
    return projected_sums(weights, dims=32).select("word", F.posexplode("sums").alias("pos", "total"))


_DOC_VECTORS = (
    "counted AS (SELECT doc_id, word, count(*) AS n FROM tokens GROUP BY ALL), "
    "sums AS (SELECT doc_id, i - 1 AS pos, sum(n * CAST(embedding[i] AS DOUBLE)) AS total "
    f"FROM counted JOIN word_vectors USING (word), unnest(range(1, {t.VECTOR_DIMS + 1})) AS r(i) GROUP BY ALL), "
    "doc_vectors AS (SELECT d.doc_id, n_tokens, CAST(p.pos AS INTEGER) AS pos, coalesce(total, 0) / n_tokens AS value "
    "FROM (SELECT doc_id, count(*) AS n_tokens FROM tokens GROUP BY doc_id) d "
    f"CROSS JOIN (SELECT unnest(range(0, {t.VECTOR_DIMS})) AS pos) p LEFT JOIN sums s ON s.doc_id = d.doc_id AND s.pos = p.pos)"
)


def document_vectors(spark, sf_dir, clean):
    """(doc_id, n_tokens, mean_vector) of a stored cleaned corpus over the word vectors derived from the embeddings table."""
    words = word_table(t.word_vectors(spark, sf_dir, clean))
    return vectors.mean_word_vector(_tokenized(clean), "doc_id", "tokens", words, t.VECTOR_DIMS)


@query(
    "word2vec_document",
    o.with_ctes(
        "SELECT doc_id, n_tokens, pos, round(value, 6) AS value FROM doc_vectors", o.WORD_VECTORS, _TERM_TOKENS, _DOC_VECTORS
    ),
)
def word2vec_document(spark, sf_dir):
    return (
        document_vectors(spark, sf_dir, stored_corpus(spark, sf_dir))
        .select("doc_id", "n_tokens", F.posexplode("mean_vector").alias("pos", "value"))
        .withColumn("value", F.round("value", 6))
    )


_SLOTS = (
    f"slots AS (SELECT word, CAST({o.hash_slot('word', 10_000)} AS INTEGER) AS slot FROM (SELECT DISTINCT word FROM tokens)), "
    "slot_counts AS (SELECT doc_id, slot, count(*)::DOUBLE AS tf FROM tokens JOIN slots USING (word) GROUP BY ALL)"
)


def _entries(df, column, *names):
    """One row per entry of a sparse vector that is not zero; the vector is never written out in full."""
    stored = F.unwrap_udt(column)
    entries = F.explode(F.arrays_zip(stored.getField("indices").alias("slot"), stored.getField("values").alias("value")))
    return df.select(*names, entries.alias("entry")).select(*names, F.col("entry.slot").alias("slot"), F.col("entry.value").alias("value"))


@query("hashing_tf", o.with_ctes("SELECT doc_id, slot, tf FROM slot_counts", o.CLEAN, _TERM_TOKENS, _SLOTS))
def hashing_tf(spark, sf_dir):
    counted = vectors.hashing_tf(tokenized_corpus(spark, sf_dir), "tokens")
    return _entries(counted, "raw_features", "doc_id").withColumnRenamed("value", "tf")


_IDF = (
    "counts AS (SELECT doc_id, word, count(*) AS tf FROM tokens GROUP BY ALL), "
    "weights AS (SELECT word, count(*) AS doc_freq, CASE WHEN count(*) >= 5 THEN "
    "ln(((SELECT count(*) FROM clean) + 1) / (count(*) + 1)) ELSE 0.0::DOUBLE END AS idf FROM counts GROUP BY word)"
)


@query(
    "idf",
    o.with_ctes("SELECT word, doc_freq, round(idf, 6) AS idf FROM weights", o.CLEAN, _TERM_TOKENS, _IDF),
)
def idf(spark, sf_dir):
    docs = tokenized_corpus(spark, sf_dir)
    counts = vectors.word_counts_per_document(docs, "doc_id", "tokens")
    return vectors.term_idf(counts, F.lit(docs.count())).withColumn("idf", F.round("idf", 6))


@query(
    "tfidf_terms",
    o.with_ctes(
        "SELECT doc_id, word, tf, round(idf, 6) AS idf, round(tf * idf, 6) AS tfidf FROM counts JOIN weights USING (word)",
        o.CLEAN,
        _TERM_TOKENS,
        _IDF,
    ),
)
def tfidf_terms(spark, sf_dir):
    terms = vectors.tfidf_terms(tokenized_corpus(spark, sf_dir), "doc_id", "tokens")
    return terms.withColumns({name: F.round(name, 6) for name in ("idf", "tfidf")})


@query(
    "tfidf_fit",
    o.with_ctes(
        "SELECT doc_id, slot, round(tf * CASE WHEN n_docs >= 5 THEN ln(((SELECT count(*) FROM clean) + 1) / (n_docs + 1)) ELSE 0 END, 6) AS weight "
        "FROM (SELECT *, count(*) OVER (PARTITION BY slot) AS n_docs FROM slot_counts)",
        o.CLEAN,
        _TERM_TOKENS,
        _SLOTS,
    ),
)
def tfidf_fit(spark, sf_dir):
    """Tokenizer, hashing and IDF fitted together; the weight of every slot that a document's terms fall into."""
    weighted = vectors.tfidf_fit_transform(stored_corpus(spark, sf_dir))[0]
    return _entries(weighted, "tfidf_features", "doc_id").select("doc_id", "slot", F.round("value", 6).alias("weight"))


_SCALARS = ("f_diacritics", "f_colons", "f_particles", "f_first_person", "char_count", "word_count")


@query(
    "assemble_features",
    o.with_ctes(
        f"SELECT doc_id, CAST({len(_SCALARS) + t.VECTOR_DIMS} AS INTEGER) AS n_dims, "
        + ", ".join(f"CAST({s} AS DOUBLE) AS {s}" for s in _SCALARS)
        + ", round(vector_total, 6) AS vector_total FROM styled JOIN "
        "(SELECT doc_id, sum(value) AS vector_total FROM doc_vectors GROUP BY doc_id) USING (doc_id)",
        o.WORD_VECTORS,
        f"styled AS (SELECT *, {o.STYLE} FROM clean)",
        _TERM_TOKENS,
        _DOC_VECTORS,
    ),
)
def assemble_features(spark, sf_dir):
    """Scalars and a document vector in one vector; the parts are read out of it again.

    The assembler is told the vector's size; else it would find it by a run over all documents.
    """
    styled = stored_styles(spark, sf_dir)
    means = document_vectors(spark, sf_dir, styled).select("doc_id", array_to_vector("mean_vector").alias("mean_vector"))
    inputs = styled.select("doc_id", *_SCALARS).join(means, "doc_id")
    sized = VectorSizeHint(inputCol="mean_vector", size=t.VECTOR_DIMS).transform(inputs)
    assembled = vectors.assembler((*_SCALARS, "mean_vector")).transform(sized)
    row = assembled.select("doc_id", vector_to_array("features_raw").alias("v"))
    tail = F.slice("v", len(_SCALARS) + 1, t.VECTOR_DIMS)
    return row.select(
        "doc_id",
        F.size("v").alias("n_dims"),
        *(F.get("v", F.lit(i)).alias(s) for i, s in enumerate(_SCALARS)),
        F.round(F.aggregate(tail, F.lit(0.0), lambda a, x: a + x), 6).alias("vector_total"),
    )


@query(
    "standard_scale",
    o.with_ctes(
        "SELECT doc_id, "
        + ", ".join(
            f"round(CASE WHEN stddev_samp({s}) OVER () > 0 THEN {s} / stddev_samp({s}) OVER () ELSE 0 END, 6) AS scaled_{s}"
            for s in _SCALARS
        )
        + " FROM styled",
        o.STYLED,
    ),
)
def standard_scale(spark, sf_dir):
    styled = t.styled_corpus(spark, sf_dir).select("doc_id", *_SCALARS)
    scaled = vectors.standard_scale(styled, _SCALARS)
    return scaled.select("doc_id", *(F.round(f"scaled_{s}", 6).alias(f"scaled_{s}") for s in _SCALARS))


@query(
    "embedding_features",
    "SELECT doc_id, CAST(64 AS INTEGER) AS n_dims, round(CASE WHEN length(text) >= 5 AND embedding IS NOT NULL "
    "THEN list_sum(embedding::DOUBLE[]) ELSE 0 END, 6) AS total FROM documents LEFT JOIN embeddings ON vec_id = doc_id",
)
def embedding_features(spark, sf_dir):
    given = t.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    docs = t.table(spark, sf_dir, "documents").select("doc_id", "text").join(given, "doc_id", "left")
    features = vectors.embedding_features(docs, "embedding", "text", t.VECTOR_DIMS)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return features.select("doc_id", F.size("embedding").alias("n_dims"), F.round(total, 6).alias("total"))


@query(
    "full_feature_table",
    o.with_ctes(
        f"SELECT doc_id, label, split, {', '.join(_SCALARS)}, CAST(100 AS INTEGER) AS w2v_dims, CAST(10000 AS INTEGER) AS tfidf_dims, "
        "CAST(1 AS INTEGER) AS bounded FROM split_features",
        _FEATURES,
    ),
)
def full_feature_table(spark, sf_dir):
    """All columns that SQL can repeat; `bounded` tells that the variance lies between 0 and 1, as cosines allow."""
    features = feature_table(spark, sf_dir)[0]
    return features.select(
        "doc_id",
        "label",
        "split",
        *_SCALARS,
        F.size(vector_to_array("w2v_features")).alias("w2v_dims"),
        F.unwrap_udt("tfidf_features").getField("size").alias("tfidf_dims"),
        F.col("f_embed_variance").between(0, 1).cast("int").alias("bounded"),
    )


@query("train_logistic_regression", _VALIDATED)
def train_logistic_regression(spark, sf_dir):
    return _judged(c.batch_score(fitted(spark, sf_dir, c.LOGISTIC_REGRESSION), split_of(spark, sf_dir, "validation")), "doc_id", "label")


@query("train_random_forest", _VALIDATED)
def train_random_forest(spark, sf_dir):
    return _judged(c.batch_score(fitted(spark, sf_dir, c.RANDOM_FOREST), split_of(spark, sf_dir, "validation")), "doc_id", "label")


@query("train_gbt", _VALIDATED)
def train_gbt(spark, sf_dir):
    return _judged(c.batch_score(fitted(spark, sf_dir, c.GRADIENT_BOOSTED), split_of(spark, sf_dir, "validation")), "doc_id", "label")


@query("batch_score", o.with_ctes("SELECT doc_id, label, CAST(1 AS INTEGER) AS decided FROM features", o.FEATURES))
def batch_score(spark, sf_dir):
    """Every document is scored, whether it has a label or not."""
    return _judged(c.batch_score(fitted(spark, sf_dir, c.RANDOM_FOREST), feature_table(spark, sf_dir)[0]), "doc_id", "label")


def embedding_model(spark, sf_dir):
    """Forest over the given vectors (upper against lower labels) with its training and test rows."""

    def build():
        given = t.table(spark, sf_dir, "embeddings").withColumn("label", (F.col("label") >= 5).cast("int"))
        split = sampling.stratified_holdout(given, "label", "vec_id")
        model, features = c.train_on_embeddings(split.filter(F.col("split") == "train"))
        return model, features, split.filter(F.col("split") == "test")

    return built_once(spark, sf_dir, "embedding forest", build)


def _embedding_test_scores(spark, sf_dir):
    model, _, test = embedding_model(spark, sf_dir)
    return c.batch_score(model, test.withColumn("features", array_to_vector("embedding")))


@query(
    "train_on_embeddings",
    f"SELECT vec_id, label, CAST(1 AS INTEGER) AS decided FROM (SELECT vec_id, CAST(label >= 5 AS INTEGER) AS label, "
    f"row_number() OVER (PARTITION BY label >= 5 ORDER BY {o.hash32('vec_id')}, vec_id) AS place, "
    "count(*) OVER (PARTITION BY label >= 5) AS n FROM embeddings) WHERE place > n * 70 // 100",
)
def train_on_embeddings(spark, sf_dir):
    return _judged(_embedding_test_scores(spark, sf_dir), "vec_id", "label")


def comparison(spark, sf_dir):
    models = {name: fitted(spark, sf_dir, name) for name in c.default_estimators()}
    build = lambda: c.model_comparison(models, split_of(spark, sf_dir, "validation"), split_of(spark, sf_dir, "test"))
    return built_once(spark, sf_dir, "comparison", build)


@query("model_comparison")
def model_comparison(spark, sf_dir):
    return comparison(spark, sf_dir)


@query("feature_importance_topk")
def feature_importance_topk(spark, sf_dir):
    return c.feature_importance_topk(spark, fitted(spark, sf_dir, c.RANDOM_FOREST))


@query("select_best_model")
def select_best_model(spark, sf_dir):
    table = comparison(spark, sf_dir)
    return table.filter(F.col("model") == c.select_best_model(table))


@query("embedding_comparison")
def embedding_comparison(spark, sf_dir):
    forest = fitted(spark, sf_dir, c.RANDOM_FOREST)
    own = c.quality(c.batch_score(forest, split_of(spark, sf_dir, "test")))
    given = c.quality(_embedding_test_scores(spark, sf_dir), positive_only=True)
    return c.embedding_comparison(
        spark,
        [
            ("trained word vectors, weighted F1", own, split_of(spark, sf_dir, "train").count()),
            ("precomputed vectors, F1 of class 1", given, embedding_model(spark, sf_dir)[1].count()),
        ],
    )


_MEASURES = ("accuracy", "f1", "auc")


@query(
    "model_comparison_bounds",
    o.with_ctes(
        "SELECT model, count(*) FILTER (split = 'validation') AS n_validation, count(*) FILTER (split = 'test') AS n_test, "
        "CAST(1 AS INTEGER) AS bounded FROM split_features, "
        f"(SELECT unnest([{o.quoted((c.LOGISTIC_REGRESSION, c.RANDOM_FOREST, c.GRADIENT_BOOSTED))}]) AS model) WHERE label IS NOT NULL GROUP BY model",
        _FEATURES,
    ),
)
def model_comparison_bounds(spark, sf_dir):
    """Every model that is compared, the rows it is judged on, and whether all its measures lie between 0 and 1."""
    sizes = {name: split_of(spark, sf_dir, name).count() for name in ("validation", "test")}
    measures = [F.col(f"{part}_{m}").between(0, 1) for part in ("val", "test") for m in _MEASURES]
    bounded = reduce(lambda a, b: a & b, measures).cast("int").alias("bounded")
    counts = (F.lit(n).cast("bigint").alias(f"n_{name}") for name, n in sizes.items())
    return comparison(spark, sf_dir).select("model", *counts, bounded)


@query(
    "embedding_comparison_bounds",
    o.with_ctes(
        "SELECT 'trained word vectors, weighted F1' AS embedding, count(*) AS train_rows, CAST(1 AS INTEGER) AS bounded "
        "FROM split_features WHERE split = 'train' AND label IS NOT NULL UNION ALL "
        "SELECT 'precomputed vectors, F1 of class 1', sum(n * 70 // 100)::BIGINT, 1 "
        "FROM (SELECT count(*) AS n FROM embeddings GROUP BY label >= 5)",
        _FEATURES,
    ),
)
def embedding_comparison_bounds(spark, sf_dir):
    """The feature families with their training rows, and whether their measures lie between 0 and 1."""
    measures = [F.col(f"test_{m}").between(0, 1) for m in _MEASURES]
    bounded = reduce(lambda a, b: a & b, measures).cast("int").alias("bounded")
    return embedding_comparison(spark, sf_dir).select("embedding", "train_rows", bounded)


@query("training_scale_sweep")
def training_scale_sweep(spark, sf_dir):
    return c.training_scale_sweep(feature_table(spark, sf_dir)[0].filter(F.col("label").isNotNull()))


def stored_models(spark, sf_dir):
    """Paths of the saved word model and forest, and the stored word table."""

    def build():
        _, _, model, words = feature_table(spark, sf_dir)
        saved = store.save_model(model, new_path(spark, "word-model"))
        forest = store.save_model(fitted(spark, sf_dir, c.RANDOM_FOREST), new_path(spark, "forest"))
        return saved, forest, words

    return built_once(spark, sf_dir, "stored models", build)


@query(
    "fitted_model_store",
    o.with_ctes("SELECT doc_id, CAST(1 AS INTEGER) AS same FROM features", o.FEATURES),
)
def fitted_model_store(spark, sf_dir):
    """Whether each document gets the same prediction from the model before saving and after loading."""
    features = feature_table(spark, sf_dir)[0]
    again = store.load_pipeline(stored_models(spark, sf_dir)[1])
    before = c.batch_score(fitted(spark, sf_dir, c.RANDOM_FOREST), features).select("doc_id", F.col("probability").alias("p"))
    after = c.batch_score(again, features).select("doc_id", F.col("probability").alias("q"))
    return before.join(after, "doc_id").select(
        "doc_id", (vector_to_array("p") == vector_to_array("q")).cast("int").alias("same")
    )
