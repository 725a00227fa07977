"""A backlog in batches of equal bytes, and streams that stop between batches."""

import json
import time
import threading

import pytest

from test_assemble import observed
from test_batches import records
from test_streaming import END, START, Stream, at
from wireloom.operators.assemble import assemble
from wireloom.operators.lines import classify, parse_lines
from wireloom.operators.upsert import read_events, read_writes
from wireloom.plans.log_batch import LogTables, run_backlog
from wireloom.sources.admission import batch_ranges, kafka_offsets, of_batch
from wireloom.streaming.log_job import await_log_job, request_stop, start_log_job


def backlog(n=900):
    """Nine tenths of the log in one partition, long and short lines, gaps between offsets."""
    rows = []
    for i in range(n):
        place = (0, 7 * i) if i % 10 else (1 + i // 10 % 3, 1_000_000 + i)
        key, note = f"k{i // 3}-{place[0]}", "x" * (400 if i < n // 3 else 20)
        rows.append((*place, at(0, i, key, (START, note, END)[i % 3])))
    return rows


def test_batches_are_alike_and_lose_nothing(spark):
    rows = backlog()
    log = records(spark, rows)
    total = sum(len(value) + 1 for *_, value in rows)
    ranges = batch_ranges(log, target_bytes=total // 5 + 1).collect()
    held = {}
    for row in ranges:
        held[row.batch] = held.get(row.batch, 0) + row.bytes
    assert sorted(held) == list(range(5)) and sum(held.values()) == total
    assert max(held.values()) <= 1.2 * min(held.values())
    assert sum(row.n_records for row in ranges) == len(rows)
    seen = []
    for batch in range(5):
        own = [row for row in ranges if row.batch == batch]
        got = [(r.partition, r.offset) for r in of_batch(log, own, batch).collect()]
        assert len(got) == sum(row.n_records for row in own)
        seen += got
        low, high = (json.loads(text)["t"] for text in kafka_offsets(own))
        assert all(low[str(row.partition)] == row.from_offset < row.until_offset == high[str(row.partition)] for row in own)
    assert sorted(seen) == sorted((p, o) for p, o, _ in rows)
    # Ranges of a partition follow one another.
    for partition in range(4):
        own = sorted((r for r in ranges if r.partition == partition), key=lambda r: r.batch)
        assert all(a.until_offset <= b.from_offset for a, b in zip(own, own[1:]))


def test_records_without_a_place_or_a_value(spark):
    log = records(spark, [(0, 0, "a"), (0, 1, None), (None, 5, "b"), (0, None, "c"), (None, None, None)])
    ranges = batch_ranges(log, target_bytes=4).collect()
    numbers = sorted({row.batch for row in ranges})
    found = [r.value for b in numbers for r in of_batch(log, [r for r in ranges if r.batch == b], b).collect()]
    assert sorted(found, key=str) == [None, None, "a", "b", "c"]
    assert batch_ranges(records(spark, []), 10).collect() == []
    with pytest.raises(ValueError):
        batch_ranges(log, 0)


def test_a_backlog_gives_the_result_of_one_batch(spark, tmp_path):
    rows = [(0, 7 * i, at(0, i, f"k{i // 3}", (START, f"note {i}", END)[i % 3])) for i in range(90)]
    rows += [(1, i, at(0, 40 + i, f"other{i // 3}", (START, "note", END)[i % 3])) for i in range(9)]
    log, tables = records(spark, rows), LogTables.under(str(tmp_path))
    counts = run_backlog(log, tables, target_bytes=sum(len(r[2]) + 1 for r in rows) // 3 + 1)
    assert len(counts) == 3 and sum(c.malformed + c.dropped for c in counts) == 0
    events = read_events(spark, tables.events)
    assert observed(events) == observed(assemble(classify(parse_lines(log))))
    assert {r.status for r in events.collect()} == {"complete"}


def test_a_stream_stops_between_batches(spark, tmp_path):
    """The stop comes while a batch is at work: that one ends, the next does not begin, nothing is lost or written twice."""
    stream, marker = Stream(spark, tmp_path), str(tmp_path / "control" / "stop")
    for n in range(3):
        stream.feed([(0, 2 * n, at(n, 0, f"k{n}", START)), (0, 2 * n + 1, at(n, 1, f"k{n}", END))])
    stop_at = {1: lambda: request_stop(spark, marker)}

    def report(number, counts):
        stream.counts[number] = counts
        stop_at.get(number, lambda: None)()

    stream.rules = {"stop_marker": marker}

    def start(trigger):
        from wireloom.sources.logs import record_files

        source = record_files(spark, stream.source)
        return start_log_job(source, stream.tables, str(tmp_path / "checkpoint"), trigger, report, **stream.rules)

    assert await_log_job(start({"availableNow": True}), spark, marker)
    assert sorted(stream.counts) == [0, 1] and not (tmp_path / "control" / "stop").exists()
    assert stream.outcome() == [("k0", "complete"), ("k1", "complete")]
    # The next start goes on with what the other did not begin; then a stop that finds the stream idle.
    query = start({"processingTime": "1 second"})
    waiter = threading.Thread(target=lambda: await_log_job(query, spark, marker))
    waiter.start()
    until = time.monotonic() + 90
    while 2 not in stream.counts and time.monotonic() < until:
        time.sleep(0.2)
    request_stop(spark, marker)
    waiter.join(60)
    assert not waiter.is_alive() and not query.isActive
    assert stream.outcome() == [("k0", "complete"), ("k1", "complete"), ("k2", "complete")]
    assert sorted(r.request_key for r in read_writes(spark, stream.tables.events).collect()) == ["k0", "k1", "k2"]
