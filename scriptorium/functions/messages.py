"""The JSON message that carries one text, and the record written per prediction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scriptorium.functions.text import text_preview

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("true_source", T.StringType()),
        T.StructField("timestamp", T.DoubleType()),
    ]
)
# What is kept of a scored message.
PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("true_source", T.StringType()),
        T.StructField("text_preview", T.StringType()),
        T.StructField("predicted_label", T.IntegerType()),
        T.StructField("predicted_class", T.StringType()),
        T.StructField("ingest_time", T.TimestampType()),
    ]
)
# What a message source delivers: the subset of the Kafka columns that is read.
ENVELOPE_SCHEMA = T.StructType(
    [T.StructField("value", T.BinaryType()), T.StructField("timestamp", T.TimestampType())]
)


def message_json(id_: Column, text: Column, true_source: Column, timestamp: Column) -> Column:
    """One message as JSON text; characters outside ASCII are written as they are."""
    return F.to_json(
        F.struct(
            id_.cast("bigint").alias("id"),
            text.alias("text"),
            true_source.alias("true_source"),
            timestamp.cast("double").alias("timestamp"),
        )
    )


def message_struct(value: Column) -> Column:
    """Bytes to struct. What cannot be parsed becomes NULL fields; the row is kept."""
    return F.from_json(value.cast("string"), MESSAGE_SCHEMA)


def parse_messages(envelopes: DataFrame, drop_malformed: bool = False) -> DataFrame:
    """Envelopes to (id, text, true_source, timestamp, ingest_time), for tables and streams alike."""
    parsed = envelopes.select(
        message_struct(F.col("value")).alias("data"), F.col("timestamp").alias("ingest_time")
    ).select("data.*", "ingest_time")
    return parsed.filter(F.col("text").isNotNull()) if drop_malformed else parsed


def predicted_class(prediction: Column) -> Column:
    """0 is human; every other value, NULL included, is ai."""
    return F.when(prediction == 0, F.lit("human")).otherwise(F.lit("ai"))


def prediction_record(scored: DataFrame) -> DataFrame:
    """The columns of PREDICTION_SCHEMA from a scored message."""
    prediction = F.col("prediction")
    return scored.select(
        "id",
        "true_source",
        text_preview("text").alias("text_preview"),
        prediction.cast("int").alias("predicted_label"),
        predicted_class(prediction).alias("predicted_class"),
        "ingest_time",
    )
