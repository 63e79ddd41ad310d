"""Declared schemas; nothing in this package infers one from JSON."""

from pyspark.sql import types as T

# Field names and types of one message on the event topic.
RAW_EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("account_id", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("mrr", T.DoubleType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("event_body", T.StringType()),
        T.StructField("csat_score", T.IntegerType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

# The four fields the early screen reads.
SHORT_EVENT = T.StructType([RAW_EVENT[n] for n in ("account_id", "mrr", "event_body", "csat_score")])

TICKET_LIBRARY = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("support_text", T.StringType()),
        T.StructField("suggested_csat", T.IntegerType()),
    ]
)

KNOWLEDGE_BASE = T.StructType(
    [
        T.StructField("sop_id", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)
