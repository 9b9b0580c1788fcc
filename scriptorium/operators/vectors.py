"""Feature vectors: word vectors, term weights, assembly and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    StandardScaler,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.text import ml_tokenize
from scriptorium.operators.reshape import nonempty_clean_filter
from scriptorium.operators.word_moments import with_word_moments, word_table
from scriptorium.operators.word_training import WordVectors, train_word_vectors
from scriptorium.plans.bounds import WORD_BYTES, join_words
from scriptorium.session import through_table

# The sizes and column order of the feature vector.
STYLE_COLUMNS = (
    "f_diacritics",
    "f_colons",
    "f_particles",
    "f_first_person",
    "f_embed_variance",
    "char_count",
    "word_count",
)
VECTOR_SIZE = 100
MIN_COUNT = 3
HASH_FEATURES = 10_000
MIN_DOC_FREQ = 5
SEED = 42
# Our own choice: how many tokens one task trains on. Every task sends the vectors of all words that it
# met, which are nearly as many for few tokens as for many; so beyond a dozen tasks each gets as much as bounds that.
TOKENS_PER_TASK = 500_000
FEW_TASKS = 12
MOST_TOKENS_PER_TASK = 24_000_000


def training_tasks(tokens: int) -> int:
    """Tasks that train on a corpus: up to `FEW_TASKS` of `TOKENS_PER_TASK` each, then as few as `MOST_TOKENS_PER_TASK` allows."""
    return max(1, min(-(-tokens // TOKENS_PER_TASK), FEW_TASKS), -(-tokens // MOST_TOKENS_PER_TASK))


def word2vec_fit(
    docs: DataFrame,
    tokens: str,
    output: str = "w2v_features",
    vector_size: int = VECTOR_SIZE,
    min_count: int = MIN_COUNT,
    partitions: int | None = None,
    seed: int = SEED,
) -> WordVectors:
    """Fit word vectors. `partitions` tasks train side by side and are averaged.

    Unless given, their number follows the tokens of the corpus (`training_tasks`), and texts are dealt out and ordered by their
    content, so the vectors do not depend on the cluster. No process holds the vocabulary; see `word_training`.
    """
    texts = docs.select(tokens)
    if not partitions:
        total = texts.agg(F.sum(F.size(tokens).cast("bigint"))).first()[0] or 0
        partitions = training_tasks(total)
    table = train_word_vectors(texts, tokens, vector_size, min_count, partitions, seed)
    return WordVectors(table, tokens, output, vectorSize=vector_size, minCount=min_count, numPartitions=partitions, seed=seed)


def word_counts_per_document(docs: DataFrame, key: str, tokens: str) -> DataFrame:
    """(key, word, n); a document without tokens keeps one row with a NULL word and n = 0."""
    return (
        docs.select(key, F.explode_outer(tokens).alias("word"))
        .groupBy(key, "word")
        .agg(F.count("word").alias("n"))
    )


def mean_word_vector(docs: DataFrame, key: str, tokens: str, words: DataFrame, dims: int) -> DataFrame:
    """(key, n_tokens, mean_vector) of every row: vectors of known tokens summed, divided by the count of all tokens.

    `words` is a stored table (word, vector); see `with_word_moments`.
    """
    counted = docs.select(key, tokens, F.coalesce(F.size(tokens), F.lit(0)).cast("bigint").alias("n_tokens"))
    moments = with_word_moments(counted, tokens, words, dims, mean="mean_vector", variance=None, keep_tokens=False)
    return moments.select(key, "n_tokens", vector_to_array("mean_vector").alias("mean_vector"))


def hashing_tf(
    docs: DataFrame, tokens: str, output: str = "raw_features", features: int = HASH_FEATURES
) -> DataFrame:
    return HashingTF(inputCol=tokens, outputCol=output, numFeatures=features).transform(docs)


def term_idf(counts: DataFrame, documents: Column, min_doc_freq: int = MIN_DOC_FREQ) -> DataFrame:
    """(word, doc_freq, idf) from (key, word, n); terms in too few documents weigh nothing."""
    doc_freq = F.col("doc_freq")
    return (
        counts.filter(F.col("word").isNotNull())
        .groupBy("word")
        .agg(F.count("*").alias("doc_freq"))
        .withColumn(
            "idf",
            F.when(doc_freq >= min_doc_freq, F.ln((documents + 1) / (doc_freq + 1))).otherwise(F.lit(0.0)),
        )
    )


def tfidf_terms(docs: DataFrame, key: str, tokens: str, min_doc_freq: int = MIN_DOC_FREQ) -> DataFrame:
    """(key, word, tf, idf, tfidf): term weights without hashing. The counts are stored and read twice."""
    counted = word_counts_per_document(docs, key, tokens)
    counts = through_table(counted, "term-counts")
    documents = F.lit(docs.count())
    counts = counts.filter(F.col("word").isNotNull())
    idf = through_table(term_idf(counts, documents, min_doc_freq).select("word", "idf"), "idf")
    weighted = join_words(counts, idf, 8 + WORD_BYTES)
    return weighted.select(key, "word", F.col("n").alias("tf"), "idf", (F.col("n") * F.col("idf")).alias("tfidf"))


def _tfidf_stages(text: str) -> list:
    return [
        Tokenizer(inputCol=text, outputCol="words"),
        HashingTF(inputCol="words", outputCol="raw_features", numFeatures=HASH_FEATURES),
        IDF(inputCol="raw_features", outputCol="tfidf_features", minDocFreq=MIN_DOC_FREQ),
    ]


def tfidf_fit(docs: DataFrame, text: str = "text_clean") -> PipelineModel:
    """Tokenizer, hashed term counts and inverse document frequency, fitted together."""
    return Pipeline(stages=_tfidf_stages(text)).fit(docs)


def tfidf_fit_transform(docs: DataFrame, text: str = "text_clean") -> tuple[DataFrame, PipelineModel]:
    """The rows with `tfidf_features` in place of their text, and the model of `tfidf_fit`. Texts are split and hashed once."""
    *counting, weighing = _tfidf_stages(text)
    counted = PipelineModel(counting).transform(docs).drop(text, "words")
    counted = through_table(counted, "term-vectors")
    weights = weighing.fit(counted)
    return weights.transform(counted).drop("raw_features"), PipelineModel([*counting, weights])


def assembler(
    columns: Sequence[str] = (*STYLE_COLUMNS, "w2v_features"), output: str = "features_raw"
) -> VectorAssembler:
    """Scalars and vectors side by side; a NULL input raises."""
    return VectorAssembler(inputCols=list(columns), outputCol=output)


def scaler(source: str = "features_raw", output: str = "features") -> StandardScaler:
    """Divide by the sample standard deviation, no centring."""
    return StandardScaler(inputCol=source, outputCol=output, withMean=False, withStd=True)


def standard_scale(df: DataFrame, columns: Sequence[str], prefix: str = "scaled_") -> DataFrame:
    """The same scaling on plain columns; a constant column becomes zero."""
    spread = df.agg(*(F.stddev_samp(c).alias(c) for c in columns)).first()

    def scaled(c: str) -> Column:
        return F.col(c) / F.lit(float(spread[c])) if spread[c] else F.lit(0.0)

    return df.withColumns({f"{prefix}{c}": scaled(c) for c in columns})


def embedding_features(
    df: DataFrame, embedding: str, text: str, dims: int, output: str | None = None, shortest: int = 5
) -> DataFrame:
    """Precomputed vectors as features; a missing or very short text gets the zero vector."""
    zero = F.array_repeat(F.lit(0.0).cast("float"), dims)
    usable = F.coalesce(F.length(text) >= shortest, F.lit(False)) & F.col(embedding).isNotNull()
    return df.withColumn(output or embedding, F.when(usable, F.col(embedding)).otherwise(zero))


def full_feature_table(
    styled: DataFrame, partitions: int | None = None
) -> tuple[DataFrame, PipelineModel, WordVectors, DataFrame]:
    """Style columns to the full feature table, with the term model, the word model and the stored word table.

    Word vectors are fitted once and serve both the document vectors and the variance feature. The
    cleaned rows are stored first, as every fit reads them again. Rows need no label.
    """
    docs = through_table(nonempty_clean_filter(styled), "styled")
    tokenized = docs.withColumn("tokens_w2v", ml_tokenize("text_clean"))
    word_model = word2vec_fit(tokenized, "tokens_w2v", partitions=partitions)
    words = word_table(word_model.getVectors())
    complete = with_word_moments(tokenized, "tokens_w2v", words, word_model.getVectorSize(), keep_tokens=False)
    tfidf = tfidf_fit(docs)
    return tfidf.transform(complete).drop("words", "raw_features"), tfidf, word_model, words
