"""Schemas of the tables the two jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

LOG_RECORD = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)

LOG_LINES = T.StructType(
    [
        T.StructField("log_ts", T.TimestampType()),
        T.StructField("thread_name", T.StringType()),
        T.StructField("request_key", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

# What is remembered of the bodies of one exchange; see operators/bodies.py.
BODY_CHAIN = T.StructType(
    [
        T.StructField("n", T.IntegerType()),
        T.StructField("first_ts", T.TimestampType()),
        T.StructField("first_text", T.StringType()),
        T.StructField("second_ts", T.TimestampType()),
        T.StructField("last_ts", T.TimestampType()),
        T.StructField("last_text", T.StringType()),
        T.StructField("last_down", T.BooleanType()),
        T.StructField("kept_text", T.StringType()),
    ]
)

# One row per request key: the lines that still matter, payloads not yet cut out of them.
EXCHANGE = T.StructType(
    [
        T.StructField("request_key", T.StringType()),
        T.StructField("first_ts", T.TimestampType()),
        T.StructField(
            "start",
            T.StructType(
                [
                    T.StructField("ts", T.TimestampType()),
                    T.StructField("content", T.StringType()),
                ]
            ),
        ),
        T.StructField("caller_thread", T.StringType()),
        T.StructField("event_id_line", T.StringType()),
        T.StructField("event_type_line", T.StringType()),
        T.StructField("event_code_line", T.StringType()),
        T.StructField("event_platform_line", T.StringType()),
        T.StructField("event_sequence_line", T.StringType()),
        T.StructField("server_profile_line", T.StringType()),
        T.StructField("request_end_ts", T.TimestampType()),
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField("ts", T.TimestampType()),
                    T.StructField("content", T.StringType()),
                ]
            ),
        ),
        T.StructField("end_ts", T.TimestampType()),
        T.StructField("bodies", BODY_CHAIN),
    ]
)

# Other log text of an exchange, a row for each piece of it.
TEXTS = T.StructType(
    [
        T.StructField("request_key", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("piece", T.LongType()),
        T.StructField("other_log", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("request_key", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("method", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("server", T.StringType()),
        T.StructField("server_profile", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_code", T.StringType()),
        T.StructField("event_platform", T.StringType()),
        T.StructField("event_sequence", T.StringType()),
        T.StructField("request_body", T.StringType()),
        T.StructField("request_end_time", T.TimestampType()),
        T.StructField("response_body", T.StringType()),
        T.StructField("http_status", T.StringType()),
        T.StructField("duration_ms", T.IntegerType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("other_log", T.StringType()),
        T.StructField("client", T.StringType()),
        T.StructField("client_profile", T.StringType()),
        T.StructField("response_start_time", T.TimestampType()),
    ]
)

# Emitted rows: an event, what became of it, and the day it belongs to.
EMITTED = T.StructType(
    EVENTS.fields
    + [T.StructField("status", T.StringType()), T.StructField("event_day", T.DateType())]
)

MEMBER_CSV = T.StructType(
    [
        T.StructField("partner_member_card", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("partner_member_id", T.StringType()),
        T.StructField("mobile_phone", T.StringType()),
        T.StructField("partner_point", T.LongType()),
        T.StructField("partner_change", T.StringType()),
    ]
)

MEMBER_TABLE = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("partner_code", T.StringType()),
        T.StructField("generation_time", T.TimestampType()),
        T.StructField("partner_member_card", T.StringType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("partner_member_id", T.StringType()),
        T.StructField("mobile_phone", T.StringType()),
        T.StructField("partner_point", T.LongType(), False),
        T.StructField("point", T.LongType(), False),
        T.StructField("partner_change", T.StringType(), False),
        T.StructField("idcard_no", T.StringType()),
        T.StructField("unionId", T.StringType()),
        T.StructField("convert_status", T.LongType()),
    ]
)
