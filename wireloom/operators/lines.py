"""From log records to classified log lines: one narrow projection, no shuffle.

A record is ``(topic, partition, offset, value)``. A well-formed value reads
``date time thread key t4 t5 content...`` with single spaces between the words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireloom.functions.clock import parse_log_time
from wireloom.functions.text import (
    client_of,
    client_profile_of,
    duration_of,
    header_value,
    method_of,
    pool_name,
    server_profile_of,
    status_of,
    url_of,
)

# The twelve kinds of line.
REQUEST_START = "request_start"
EVENT_ID = "event_id"
EVENT_TYPE = "event_type"
EVENT_CODE = "event_code"
EVENT_PLATFORM = "event_platform"
EVENT_SEQUENCE = "event_sequence"
BODY = "body"
REQUEST_END = "request_end"
SERVER_PROFILE = "server_profile"
RESPONSE_START = "response_start"
RESPONSE_END = "response_end"
OTHER = "other"

# Event headers and the only two spellings each is known by.
EVENT_HEADERS = {
    EVENT_ID: ("x-event-id", "X-Event-Id"),
    EVENT_TYPE: ("x-event-type", "X-Event-Type"),
    EVENT_CODE: ("x-event-code", "X-Event-Code"),
    EVENT_PLATFORM: ("x-event-platform", "X-Event-Platform"),
    EVENT_SEQUENCE: ("x-event-sequence", "X-Event-Sequence"),
}
CONTEXT_HEADER = ("x-application-context", "X-Application-Context")

LINE_COLUMNS = [
    "log_ts",
    "thread_name",
    "request_key",
    "content",
    "topic",
    "partition",
    "offset",
]


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` for a costly value that later filters and projections share.

    A filter on a computed column is pushed below the projection, with a second copy of the
    computation; it is not pushed below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _cut(records: DataFrame) -> DataFrame:
    def word(index: int) -> Column:
        return F.get("words", F.lit(index))

    cut = computed_once(records, "words", F.split(F.rtrim("value"), " ", 7))
    cut = computed_once(cut, "log_ts", parse_log_time(word(0), word(1)))
    return cut.select(
        "topic",
        "partition",
        "offset",
        "value",
        "log_ts",
        word(2).alias("thread_name"),
        word(3).alias("request_key"),
        word(6).alias("content"),
    )


def parse_records(records: DataFrame) -> DataFrame:
    """All records cut into line columns; those that are no line have a ``reason``.

    ``value`` is kept for the latter only, so that the result can be staged once for both.
    """
    reason = (
        F.when(F.col("value").isNull(), "no value")
        .when(F.col("request_key").isNull(), "too few words")
        .when(F.col("log_ts").isNull(), "bad time")
    )
    cut = _cut(records).withColumn("reason", reason)
    bad_value = F.when(F.col("reason").isNotNull(), F.col("value")).alias("value")
    return cut.select(*LINE_COLUMNS, bad_value, "reason")


def well_formed(parsed: DataFrame) -> DataFrame:
    """The log lines among parsed records; ``content`` is null where a line has none."""
    return parsed.filter(F.col("reason").isNull()).drop("value", "reason")


def malformed(parsed: DataFrame) -> DataFrame:
    """The parsed records that are no lines, each with the reason."""
    rows = parsed.filter(F.col("reason").isNotNull())
    return rows.select("topic", "partition", "offset", "value", "reason")


def classified_records(parsed: DataFrame) -> DataFrame:
    """All parsed records with the ``kind`` of the lines; those that are no line have no key."""
    key = F.when(F.col("reason").isNull(), F.col("request_key"))
    return classify(parsed.withColumn("request_key", key))


def parse_lines(records: DataFrame) -> DataFrame:
    return well_formed(parse_records(records))


def malformed_lines(records: DataFrame) -> DataFrame:
    return malformed(parse_records(records))


def _spelled(content: Column, spellings: tuple[str, str]) -> Column:
    lower, title = spellings
    return F.contains(content, F.lit(":")) & (
        content.startswith(lower) | content.startswith(title)
    )


def kind_of(content: Column) -> Column:
    """Kind of a line. The order matters: a brace makes a body of most later kinds."""
    kind = F.when(
        content.startswith("--->")
        & ~content.startswith("---> END")
        & ~content.startswith("---> RETRYING"),
        REQUEST_START,
    )
    for header, spellings in EVENT_HEADERS.items():
        kind = kind.when(_spelled(content, spellings), header)
    return (
        kind.when(
            F.contains(content, F.lit("{")) | F.contains(content, F.lit("<xml>")), BODY
        )
        .when(content.startswith("---> END"), REQUEST_END)
        .when(_spelled(content, CONTEXT_HEADER), SERVER_PROFILE)
        .when(content.startswith("<--- END"), RESPONSE_END)
        .when(content.startswith("<---"), RESPONSE_START)
        .otherwise(OTHER)
    )


def classify(lines: DataFrame) -> DataFrame:
    """Log lines with their ``kind``; the payload stays in ``content``.

    Assembly works on this form: it cuts payloads only out of the lines that win, once per
    event instead of once per line.
    """
    return lines.withColumn("kind", kind_of(F.col("content")))


def fragments(lines: DataFrame) -> DataFrame:
    """Classified lines with every payload in a column of its own."""
    kind, content, thread = F.col("kind"), F.col("content"), F.col("thread_name")
    named = kind.isin(REQUEST_START, OTHER)
    pooled = computed_once(classify(lines), "pool", F.when(named, pool_name(thread)))
    return pooled.select(
        "request_key",
        "kind",
        "log_ts",
        "topic",
        "partition",
        "offset",
        F.when(kind == REQUEST_START, method_of(content)).alias("method"),
        F.when(kind == REQUEST_START, url_of(content)).alias("url"),
        F.when(named, client_of(thread, F.col("pool"))).alias("client"),
        F.when(named, client_profile_of(thread, F.col("pool"))).alias(
            "client_profile"
        ),
        F.when(kind.isin(*EVENT_HEADERS), header_value(content)).alias("header_value"),
        F.when(kind == BODY, content).alias("body"),
        F.when(kind == RESPONSE_START, duration_of(content)).alias("duration_ms"),
        F.when(kind == RESPONSE_START, status_of(content)).alias("http_status"),
        F.when(kind == SERVER_PROFILE, server_profile_of(content)).alias("server_profile"),
        F.when(kind == OTHER, F.coalesce(content, F.lit(""))).alias("other_log"),
    )
