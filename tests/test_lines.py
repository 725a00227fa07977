"""Golden rows of parsing, classification and payload extraction."""

import pytest
from pyspark.sql import functions as F

from wireloom.functions.clock import log_day
from wireloom.functions.text import (
    client_of,
    client_profile_of,
    duration_of,
    header_value,
    server_of,
    server_profile_of,
)
from wireloom.operators.lines import fragments, kind_of, malformed_lines, parse_lines
from wireloom.schema import LOG_RECORD

HEAD = "2018-01-02 10:00:00,000 hystrix-grp-svc3:dev:8081-0 r1 DEBUG c.f.Client"


def records(spark, values):
    rows = [("t", 0, i, value) for i, value in enumerate(values)]
    return spark.createDataFrame(rows, LOG_RECORD)


def column_of(spark, values, build):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [row[0] for row in df.orderBy("i").select(build(F.col("v"))).collect()]


@pytest.mark.parametrize(
    "thread, client, profile",
    [
        ("hystrix-points-crm-service:dev:8080-3", "crm-service", "dev8080"),
        ("hystrix-grp-svc3:dev:8081-0", "svc3", "dev8081"),
        ("http-nio-8080-exec-1", "http-nio-8080-exec-1", ""),
        (":x-a-b-c", ":x-a-b-c", ""),
        ("a:b", "", ""),
        ("a-b-:-1", "a-b-:-1", ""),
        ("a-b-c:d--", "", ""),
        ("a:b-c-d-1", "d", ""),
        ("a-b-svc:-1", "svc", ""),
        ("a-b-::x-9", "", "x"),
    ],
)
def test_thread_names(spark, thread, client, profile):
    assert column_of(spark, [thread], client_of) == [client]
    assert column_of(spark, [thread], client_profile_of) == [profile]


def test_header_values(spark):
    lines = ["x-event-id: a:b", "x-event-id:", "x-event-id::b", "X-Event-Id:\tE2", "x: \x01 v \x02"]
    assert column_of(spark, lines, header_value) == ["a", None, "", "E2", "v"]


def test_server_profile_keeps_blanks(spark):
    assert column_of(spark, ["X-Application-Context: points:dev:8080"], server_profile_of) == [
        " pointsdev8080"
    ]


def test_durations(spark):
    ends = ["(123ms)", "[-5ms]", "ms", "(x)", "(99999999999ms)"]
    lines = [f"<--- HTTP/1.1 200 OK {end}" for end in ends]
    assert column_of(spark, lines, duration_of) == [123, -5, None, None, None]


def test_servers(spark):
    urls = ["http://points:8080/v2/x", "/x", "http://host", "http://h/a//b", None]
    assert column_of(spark, urls, server_of) == ["points:8080", None, "host", "h", None]


def test_kinds(spark):
    expected = {
        "---> POST http://points:8080/v2/x HTTP/1.1": "request_start",
        "--->": "request_start",
        "---> END HTTP (7-byte body)": "request_end",
        "---> RETRYING": "other",
        "---> RETRYING {": "body",
        "---> END {": "body",
        "---> GET http://h/{id} HTTP/1.1": "request_start",
        "x-event-id: a:b": "event_id",
        "X-Event-Id: {": "event_id",
        "X-EVENT-ID: 1": "other",
        "x-event-id 1": "other",
        "X-Event-Type: pay": "event_type",
        "x-event-code: 1": "event_code",
        "x-event-platform: 1": "event_platform",
        "X-Event-Sequence: 1": "event_sequence",
        '{"q":1}': "body",
        "a <xml> b": "body",
        "X-Application-Context: points:dev:8080": "server_profile",
        "x-application-context: {": "body",
        "<--- HTTP/1.1 200 OK (47ms)": "response_start",
        "<--- HTTP/1.1 200 OK {x} (5ms)": "body",
        "<--- END HTTP (7-byte body)": "response_end",
        "<--- END {": "body",
        "Accept: application/json": "other",
        " ---> GET": "other",
        "": "other",
    }
    assert column_of(spark, expected, kind_of) == list(expected.values())
    assert column_of(spark, [None], kind_of) == ["other"]


def test_lines_and_malformed(spark):
    values = [
        f"{HEAD} ---> GET http://h/x HTTP/1.1   ",
        f"{HEAD}  ---> GET http://h/x HTTP/1.1",
        f"{HEAD}",
        "2018-01-02 10:00:00,000 th k",
        "2018-01-02 10:00:00,000 th",
        "",
        None,
        "2018-13-02 10:00:00,000 th k a b c",
        "2018-01-02 10:00:00,5 th k a b c",
        "2018-01-02 25:00:00,000 th k a b c",
        f"{HEAD} a  b   c",
    ]
    df = records(spark, values)
    got = {r.offset: r for r in parse_lines(df).collect()}
    assert sorted(got) == [0, 1, 2, 3, 10]
    assert got[0].content == "---> GET http://h/x HTTP/1.1"
    assert got[1].content == " ---> GET http://h/x HTTP/1.1"
    assert got[2].content is None and got[3].content is None
    assert got[10].content == "a  b   c"
    times = parse_lines(df).select(F.unix_millis("log_ts")).distinct().collect()
    assert [t[0] for t in times] == [1514858400000]
    reasons = {r.offset: r.reason for r in malformed_lines(df).collect()}
    assert reasons == {
        4: "too few words",
        5: "too few words",
        6: "no value",
        7: "bad time",
        8: "bad time",
        9: "bad time",
    }


def test_fragment_payloads(spark):
    values = [
        f"{HEAD} ---> POST http://points:8080/v2/x HTTP/1.1",
        f"{HEAD} x-event-id: a:b",
        f"{HEAD} <--- HTTP/1.1 200 OK (47ms)",
        f"{HEAD}",
        f"{HEAD} ---> GET",
    ]
    rows = {r.offset: r for r in fragments(parse_lines(records(spark, values))).collect()}
    assert (rows[0].method, rows[0].url) == ("POST", "http://points:8080/v2/x")
    assert (rows[0].client, rows[0].client_profile) == ("svc3", "dev8081")
    assert (rows[1].header_value, rows[1].client) == ("a", None)
    assert (rows[2].duration_ms, rows[2].http_status) == (47, "200")
    assert (rows[3].kind, rows[3].other_log, rows[3].client) == ("other", "", "svc3")
    assert (rows[4].method, rows[4].url) == ("GET", None)


def test_day_border(spark):
    df = spark.createDataFrame([(1514822399999,), (1514822400000,)], "ms long")
    days = df.select(log_day(F.timestamp_millis("ms"))).collect()
    assert [str(d[0]) for d in days] == ["2018-01-01", "2018-01-02"]
