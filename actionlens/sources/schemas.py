"""Declared input schemas. Readers never infer types."""

from __future__ import annotations

from pyspark.sql import types as T

FEED_ACTIONS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("action", T.StringType()),
    ]
)

FIRST_SEEN = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("first_time", T.TimestampNTZType()),
    ]
)

MESSAGE_ACTIONS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("time", T.TimestampNTZType()),
    ]
)

# Column order follows the landed files: time first, key second.
REGISTRATIONS = T.StructType(
    [
        T.StructField("reg_ts", T.LongType()),
        T.StructField("uid", T.LongType()),
    ]
)

SESSIONS = T.StructType(
    [
        T.StructField("auth_ts", T.LongType()),
        T.StructField("uid", T.LongType()),
    ]
)

EXPERIMENT = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("testgroup", T.StringType()),
    ]
)

UNIT_REPORTS = T.StructType(
    [
        T.StructField("dwarf_id", T.LongType()),
        T.StructField("hired_date", T.DateType()),
        T.StructField("reported_date", T.DateType()),
        T.StructField("gold_mined", T.DoubleType()),
        T.StructField("hammer_date", T.StringType()),
    ]
)
