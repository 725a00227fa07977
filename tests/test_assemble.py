"""Assembly against goldens and against a plain fold over single lines."""

import random

import pytest
from pyspark.sql import functions as F

from wireloom.operators import assemble as assembling
from wireloom.operators.assemble import (
    LOG_SEPARATOR,
    assemble,
    join_exchanges,
    joined_logs,
    summarise,
    summarise_views,
    to_events,
)
from wireloom.operators.lines import classify, parse_lines
from wireloom.schema import EVENTS, LOG_RECORD

BASE = "2018-01-02 10:00:00"
THREAD = "hystrix-grp-svc3:dev:8081-0"
EXCHANGE = [
    (0, "---> POST http://points:8080/v2/x HTTP/1.1"),
    (1, "x-event-id: a:b"),
    (1, "X-Event-Type: pay"),
    (1, "Accept: application/json"),
    (2, '{"q":1}'),
    (3, "---> END HTTP (7-byte body)"),
    (50, "<--- HTTP/1.1 200 OK (47ms)"),
    (50, "X-Application-Context: points:dev:8080"),
    (51, "Connection: close"),
    (52, '{"s":2}'),
    (53, "<--- END HTTP (7-byte body)"),
]


def line(key, ms, content, thread=THREAD):
    return f"{BASE},{ms:03d} {thread} {key} DEBUG c.f.Client {content}"


def lines_of(spark, rows):
    """Rows are (partition, offset, value)."""
    records = [("t", partition, offset, value) for partition, offset, value in rows]
    return classify(parse_lines(spark.createDataFrame(records, LOG_RECORD)))


def as_dicts(events):
    times = [f.name for f in EVENTS.fields if f.dataType.typeName() == "timestamp"]
    for name in times:
        events = events.withColumn(name, F.unix_millis(name) - 1514858400000)
    return {row.request_key: row.asDict() for row in events.collect()}


def test_golden_exchange(spark):
    rows = [(0, i, line("r1", ms, text)) for i, (ms, text) in enumerate(EXCHANGE)]
    (event,) = as_dicts(assemble(lines_of(spark, rows))).values()
    assert event == {
        "request_key": "r1",
        "start_time": 0,
        "event_time": 0,
        "method": "POST",
        "url": "http://points:8080/v2/x",
        "server": "points:8080",
        "server_profile": " pointsdev8080",
        "event_id": "a",
        "event_type": "pay",
        "event_code": None,
        "event_platform": None,
        "event_sequence": None,
        "request_body": '{"q":1}',
        "request_end_time": 3,
        "response_body": '{"s":2}',
        "http_status": "200",
        "duration_ms": 47,
        "end_time": 53,
        "other_log": "Accept: application/json ; Connection: close",
        "client": "svc3",
        "client_profile": "dev8081",
        "response_start_time": 50,
    }


BODY_CASES = {
    "B10 E20 B30": (10, 30),
    "E20 B30": (None, 30),
    "E20 B20": (20, None),
    "B30 B10 E20": (10, 30),
    "B10": (None, 10),
    "B30 E20": (None, 30),
    "B10 B20 B30": (20, 30),
    "E20 B10 B30": (10, 30),
}


def test_body_slots(spark):
    rows, offset = [], 0
    for key, case in enumerate(BODY_CASES):
        for step in case.split():
            ms = int(step[1:])
            text = f"{{{ms}}}" if step[0] == "B" else "---> END"
            rows.append((0, offset, line(f"k{key}", ms, text)))
            offset += 1
    got = as_dicts(assemble(lines_of(spark, rows)))
    as_text = lambda ms: None if ms is None else f"{{{ms}}}"
    for key, expected in enumerate(BODY_CASES.values()):
        event = got[f"k{key}"]
        assert (event["request_body"], event["response_body"]) == tuple(map(as_text, expected))


def slots_by_rule(steps):
    """The slot rule step by step, as a table of effects on (time, end, request, response)."""
    seen = end = request = response = None
    for kind, ms, text in steps:
        if kind == "E":
            end = ms
            alone = seen is not None and None in (request, response)
            if alone and (request is None) == (seen <= end):
                request, response = response, request
        elif seen is None:
            early = end is not None and ms <= end
            request, response, seen = (text, None, ms) if early else (None, text, ms)
        else:
            if ms < seen:
                request, response = text, response if request is None else request
            else:
                request, response = request if response is None else response, text
            seen = ms
    return request, response


def random_rows(seed, keys, n, partitions=3):
    """Random lines of few keys, with few distinct times so that ties are common."""
    rng = random.Random(seed)
    texts = [
        lambda i: f"---> POST http://h{i}/x HTTP/1.1",
        lambda i: f"x-event-id: {i}",
        lambda i: f"{{{i}}}",
        lambda i: f"{{{i}}}",
        lambda i: "---> END",
        lambda i: f"<--- HTTP/1.1 {i} OK ({i}ms)",
        lambda i: "<--- END",
        lambda i: f"note {i}",
    ]
    rows = []
    for i in range(n):
        rows.append(
            (
                rng.randrange(partitions),
                i,
                rng.choice(keys),
                rng.randrange(12),
                rng.choice(texts)(i),
            )
        )
    return rows


def expected_events(rows):
    """Plain fold over the sorted lines of each key."""
    out = {}
    for partition, offset, key, ms, text in sorted(rows):
        event = out.setdefault(
            key, dict(steps=[], notes=[], first=ms, start=None, url=None, id=None,
                      status=None, end=None)
        )
        if text.startswith("---> POST"):
            event.update(start=ms, url=text.split(" ")[2])
        elif text.startswith("x-event-id"):
            event["id"] = text.split(" ")[1]
        elif text.startswith("{"):
            event["steps"].append(("B", ms, text))
        elif text == "---> END":
            event["steps"].append(("E", ms, None))
        elif text == "<--- END":
            event["end"] = ms
        elif text.startswith("<---"):
            event["status"] = text.split(" ")[2]
        else:
            event["notes"].append(text)
    return {
        key: (
            e["start"],
            e["first"] if e["start"] is None else e["start"],
            e["url"],
            e["id"],
            e["status"],
            e["end"],
            *slots_by_rule(e["steps"]),
            LOG_SEPARATOR.join(e["notes"]) if e["notes"] else None,
        )
        for key, e in out.items()
    }


def observed(events):
    names = ["start_time", "event_time", "url", "event_id", "http_status", "end_time",
             "request_body", "response_body", "other_log"]
    return {key: tuple(e[n] for n in names) for key, e in as_dicts(events).items()}


def to_lines(spark, rows):
    return lines_of(spark, [(p, o, line(key, ms, text)) for p, o, key, ms, text in rows])


@pytest.mark.parametrize("bits", [10, 3, 1])
def test_random_lines_against_fold(spark, bits, monkeypatch):
    monkeypatch.setattr(assembling, "PIECE_BITS", bits)
    rows = random_rows(1, ["hot"] * 40 + [f"k{i}" for i in range(80)], 900)
    assert observed(assemble(to_lines(spark, rows))) == expected_events(rows)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan()


def test_one_scan_and_no_sum_before_the_shuffle(spark, tmp_path):
    rows = random_rows(2, [f"k{i}" for i in range(300)], 3000)
    records = [("t", p, o, line(key, ms, text)) for p, o, key, ms, text in rows]
    spark.createDataFrame(records, LOG_RECORD).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    text = plan_of(assemble(classify(parse_lines(log)))).toString().split("== Initial Plan ==")[0]
    scans = [part for part in text.splitlines() if "FileScan" in part]
    assert len(scans) == 1
    # Nothing but a projection lies between the scan and the first exchange, so map tasks
    # neither sum up nor sort.
    below = text[: text.index("FileScan")]
    first = below[below.rindex("Exchange hashpartitioning(request_key") :]
    assert "Aggregate" not in first and "Sort" not in first


@pytest.mark.parametrize("topic", ["as a column", "as a constant"])
def test_lines_are_shuffled_once_and_exchanges_once(spark, tmp_path, topic):
    rows = random_rows(2, [f"k{i}" for i in range(300)], 3000)
    records = [("t", p, o, line(key, ms, text)) for p, o, key, ms, text in rows]
    spark.createDataFrame(records, LOG_RECORD).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    if topic == "as a constant":
        log = log.withColumn("topic", F.lit("t"))
    known = summarise(classify(parse_lines(log)))
    for events in (assemble(classify(parse_lines(log))), to_events(known.exchanges, known.texts)):
        text = plan_of(events).toString().split("== Initial Plan ==")[0]
        assert text.count("Exchange hashpartitioning") == 2 and text.count("FileScan") == 1
        assert observed(events) == expected_events(rows)


def test_log_too_long_for_a_row_fails_with_its_key(spark, monkeypatch):
    monkeypatch.setattr(assembling, "MOST_LOG_BYTES", 30)
    rows = [(0, i, line("short", 0, "note")) for i in range(2)]
    rows += [(0, 10 + i, line("long", 0, f"note {i}")) for i in range(5)]
    known = summarise(lines_of(spark, rows))
    logs = joined_logs(known.texts)
    assert logs.filter("request_key = 'short'").first().other_log == "note ; note"
    with pytest.raises(Exception, match="request key long"):
        logs.collect()


@pytest.mark.parametrize("seed", [4, 5])
def test_joined_batches_equal_one_batch(spark, seed):
    rows = random_rows(seed, [f"k{i}" for i in range(40)], 500, partitions=1)
    early = summarise(to_lines(spark, rows[:200]), 0)
    late = summarise(to_lines(spark, rows[200:]), 1)
    joined = join_exchanges(early.exchanges, late.exchanges)
    events = to_events(joined, early.texts.unionByName(late.texts))
    assert observed(events) == expected_events(rows)


def test_views_are_what_is_known_of_their_lines(spark):
    """Views that overlap, that no line is in, and whose condition is null: each as if summed up alone."""
    random_lines = random.Random(5)
    texts = [text for _, text in EXCHANGE]
    rows = [
        (random_lines.randrange(2), 700 * i, line(f"r{random_lines.randrange(9)}", random_lines.randrange(999), random_lines.choice(texts)))
        for i in range(400)
    ]
    lines = lines_of(spark, rows)
    offset = F.col("offset")
    views = [offset % 2000 < 900, F.lit(True), offset < 0, F.when(offset > 100_000, offset % 3 == 0)]
    together = summarise_views(lines, *views)
    for number, view in enumerate(views):
        alone = summarise(lines.filter(view))
        found = as_dicts(to_events(together.filter(F.col("view") == number), None))
        assert found == as_dicts(to_events(alone.exchanges, alone.texts))
        assert bool(found) == (number != 2)


@pytest.mark.parametrize("bits, long, company", [(10, 1, 2), (3, 200, 1), (3, 60, 100), (1, 1 << 16, 100)])
def test_long_logs_apart_equal_a_fold(spark, tmp_path, monkeypatch, bits, long, company):
    monkeypatch.setattr(assembling, "PIECE_BITS", bits)
    monkeypatch.setattr(assembling, "LONG_TEXT_BYTES", long)
    monkeypatch.setattr(assembling, "COMPANY", company)
    monkeypatch.setattr(assembling, "TIDY_BYTES", 500)
    rows = random_rows(1, ["hot"] * 40 + [f"k{i}" for i in range(80)], 900)
    assert observed(assemble(to_lines(spark, rows), str(tmp_path / "apart"))) == expected_events(rows)


def test_no_row_holds_a_long_log_before_it_is_put_together(spark, tmp_path, monkeypatch):
    """The table has the log of a key in rows of bounded size, and its event is dealt once more as a whole row."""
    monkeypatch.setattr(assembling, "PIECE_BITS", 2)
    monkeypatch.setattr(assembling, "LONG_TEXT_BYTES", 100)
    rows = [(0, i, line("long", 0, f"note {i:05d}")) for i in range(640)]
    rows += [(1, 10 * i, line(f"k{i}", 0, "---> END")) for i in range(9)] + [(2, 5, line("k1", 0, "note"))]
    events = assemble(lines_of(spark, rows), str(tmp_path / "apart"))
    table = spark.read.parquet(str(tmp_path / "apart"))
    sizes = table.select(F.coalesce(F.octet_length("other_log"), F.lit(0)), F.aggregate("texts", F.lit(0), lambda n, t: n + F.octet_length(t["text"])))
    assert 0 < max(max(row[0], row[1] or 0) for row in sizes.collect()) < 200
    assert "Repartition" in events._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[0]
    logs = {row.request_key: row.other_log for row in events.select("request_key", "other_log").collect()}
    assert logs.pop("long") == LOG_SEPARATOR.join(f"note {i:05d}" for i in range(640))
    assert logs == {f"k{i}": "note" if i == 1 else None for i in range(9)}


def test_long_log_apart_fails_with_its_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(assembling, "LONG_TEXT_BYTES", 20)
    monkeypatch.setattr(assembling, "MOST_LOG_BYTES", 50)
    rows = [(0, (i << 20), line("long", 0, f"note {i} and more of it")) for i in range(4)]
    with pytest.raises(Exception, match="request key long"):
        assemble(lines_of(spark, rows), str(tmp_path / "apart")).collect()
