"""The log job in batches: replay, restart, hot keys, and equality with one batch."""

import datetime

import pytest

from test_assemble import line, lines_of, observed, random_rows, to_lines
from test_streaming import END, START, at
from wireloom.operators.assemble import Summed, assemble, summarise
from wireloom.operators.route import reconcile
from wireloom.operators import assemble as assembling
from wireloom.operators.upsert import (
    append_batch,
    compact_days,
    read_events,
    read_writes,
    standing_days,
    upsert_days,
)
from wireloom.plans.log_batch import LogTables, run_log_batch
from wireloom.plans.versions import read_rows
from wireloom.schema import LOG_RECORD


def records(spark, rows):
    return spark.createDataFrame([("t", p, o, value) for p, o, value in rows], LOG_RECORD)


def test_batches_with_a_hot_key_and_replays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(assembling, "PIECE_BITS", 3)
    keys = ["hot"] * 20 + [f"k{i}" for i in range(30)]
    rows = [r for r in random_rows(21, keys, 400, partitions=1) if r[4] != END]
    opening = [(0, -40 + i, k, 0, START) for i, k in enumerate(sorted(set(keys)))]
    closing = [(0, 1000 + i, k, 11, END) for i, k in enumerate(sorted(set(keys)))]
    rows = opening + rows + closing
    tables = LogTables.under(str(tmp_path))
    cuts = [0, 90, 250, len(rows)]
    batches = [
        records(spark, [(p, o, line(k, ms, text)) for p, o, k, ms, text in rows[a:b]])
        for a, b in zip(cuts, cuts[1:])
    ]
    for number in (0, 1, 1, 2):
        run_log_batch(batches[number], number, tables)
    events = read_events(spark, tables.events)
    assert observed(events) == observed(assemble(to_lines(spark, rows)))
    assert not (tmp_path / "open" / "batch_id=0").exists()
    for part in ("exchanges", "texts"):
        assert spark.read.parquet(f"{tables.open}/batch_id=2/{part}").count() == 0


def staging_left(spark):
    """Folders of runs in the shared folder."""
    shared = spark._jvm.org.apache.hadoop.fs.Path(spark.conf.get("spark.checkpoint.dir"))
    files = shared.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(shared)
    return [f.getPath().getName() for f in files if f.getPath().getName().startswith("run-")]


def test_batches_keep_malformed_dropped_and_long_logs(spark, tmp_path):
    tables = LogTables.under(str(tmp_path))
    before = staging_left(spark)
    notes = lambda a, b: [(0, 2 + i, at(0, 1, "k", f"note {i}")) for i in range(a, b)]
    batches = [
        [(0, 0, "junk"), (0, 1, at(0, 0, "k", START)), *notes(0, 8)],
        [*notes(8, 58), (0, 70, at(0, 1, "stray", "note")), (0, 71, "2018-13-02 x y z t4 t5 c")],
        [*notes(58, 66), (0, 90, at(0, 9, "k", END))],
    ]
    counts = [run_log_batch(records(spark, rows), n, tables) for n, rows in enumerate(batches)]
    assert [(c.malformed, c.dropped) for c in counts] == [(1, 0), (1, 1), (0, 0)]
    (event,) = read_events(spark, tables.events).collect()
    assert event.other_log == " ; ".join(f"note {i}" for i in range(66))
    reasons = [(r.offset, r.reason) for r in read_rows(spark, tables.malformed).collect()]
    assert sorted(reasons) == [(0, "too few words"), (71, "bad time")]
    (stray,) = read_rows(spark, tables.dropped).collect()
    assert (stray.request_key, stray.status, stray.other_log) == ("stray", "dropped", "note")
    assert staging_left(spark) == before
    kept = {f.name for f in tmp_path.iterdir()}
    assert kept == {"events", "open", "malformed", "dropped", "runs"}


def test_a_new_run_keeps_the_writes_of_the_old_one(spark, tmp_path):
    tables = LogTables.under(str(tmp_path))
    batch = lambda key: records(spark, [(0, 0, at(0, 0, key, START)), (0, 1, at(1, 0, key, END))])
    run_log_batch(batch("a"), 0, tables, run="one")
    run_log_batch(batch("b"), 1, tables, run="one")
    for _ in range(2):  # delivered twice
        run_log_batch(batch("c"), 0, tables, run="two")
    found = {r.request_key for r in read_events(spark, tables.events).collect()}
    assert found == {"a", "b", "c"}
    numbers = [r.batch_id for r in read_writes(spark, tables.events).collect()]
    assert sorted(numbers) == [0, 1, 2]


@pytest.mark.parametrize("minutes, ms, status", [(15, 59_999, None), (16, 0, "timeout")])
def test_expiry_border(spark, minutes, ms, status):
    old = summarise(lines_of(spark, [(0, 0, at(0, 0, "k", START))]))
    new = summarise(
        lines_of(
            spark,
            [(0, 1, at(minutes, ms, "x", START)), (0, 2, at(minutes, ms, "x", END))],
        )
    )
    outcome = reconcile(new, old)
    fates = {r.request_key: r.status for r in outcome.emitted.collect()}
    assert fates.pop("x") == "complete"
    assert fates == ({"k": status} if status else {})
    assert outcome.still_open.exchanges.count() == (0 if status else 1)


def test_clock_of_a_batch_without_complete_events(spark):
    old = summarise(
        lines_of(spark, [(0, 0, at(0, 0, "a", START)), (0, 1, at(0, 0, "b", START))])
    )
    new = summarise(
        lines_of(spark, [(0, 2, at(20, 0, "a", "note")), (0, 3, at(40, 0, "stray", END))])
    )
    outcome = reconcile(new, old)
    assert {r.request_key for r in outcome.emitted.collect()} == {"a", "b"}
    assert [r.request_key for r in outcome.dropped.collect()] == ["stray"]
    nothing = reconcile(Summed.nothing(spark), old)
    assert nothing.emitted.count() == 0 and nothing.still_open.exchanges.count() == 2


def emitted(spark, rows):
    return reconcile(summarise(lines_of(spark, rows)), Summed.nothing(spark)).emitted


def test_upserts(spark, tmp_path):
    path, days = str(tmp_path / "log"), str(tmp_path / "days")
    assert read_events(spark, path).count() == 0
    first = emitted(
        spark,
        [
            (0, i, at(m, 0, key, text).replace("01-02", "01-03" if key == "c" else "01-02"))
            for i, (m, key, text) in enumerate(
                [(0, "a", START), (1, "a", END), (0, "b", START), (1, "b", END),
                 (0, "c", START), (0, "c", END)]
            )
        ],
    )
    second = emitted(
        spark, [(0, 10, at(0, 0, "a", START)), (0, 11, at(2, 0, "a", END))]
    )
    for number, batch in ((0, first), (1, second), (0, first)):
        append_batch(batch, number, path)
    for number, batch in ((0, first), (1, second), (1, second)):
        upsert_days(batch, number, days)
    for rows in (read_events(spark, path), spark.read.parquet(days)):
        got = {
            (str(r.event_day), r.request_key): (r.end_time - r.start_time).seconds
            for r in rows.collect()
        }
        assert got == {
            ("2018-01-02", "a"): 120, ("2018-01-02", "b"): 60, ("2018-01-03", "c"): 0,
        }
    pruned = read_events(spark, path).filter("event_day = date'2018-01-03'")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_day" in plan
    assert pruned.count() == 1
    day = datetime.date(2018, 1, 3)
    plan = standing_days(spark, days, [day])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_day" in plan and "2018-01-03" in plan or "17534" in plan
    # Folding days changes nothing, whether all are folded, or some, or written again.
    whole = lambda: sorted(map(str, read_events(spark, path).collect()))
    expected = whole()
    assert compact_days(spark, path, before=day) == 1
    assert whole() == expected
    append_batch(first, 0, path)
    assert whole() == expected
    assert compact_days(spark, path) == 2 and compact_days(spark, path) == 0
    assert whole() == expected
    plan = read_events(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
