"""Open exchanges as a log of changes: what is written, folded and removed, and runs that take over."""

import pytest
from pyspark.sql import Row
from test_batches import records
from test_streaming import END, START, Stream, at
from wireloom.operators.upsert import read_events, read_writes
from wireloom.plans import open_store
from wireloom.plans.log_batch import LogTables, run_log_batch
from wireloom.plans.open_store import OpenStore
from wireloom.plans.staging import at_once
from wireloom.plans.versions import read_rows
from wireloom.streaming.log_job import starting_offsets


def written_by(folder, write):
    files = [f for f in (folder / "open" / f"batch_id={write}").rglob("*.parquet")]
    return sum(f.stat().st_size for f in files)


def test_a_batch_writes_what_it_touches(spark, tmp_path, monkeypatch):
    """As much whether few or many exchanges stay open; a fold comes after as many changes as were open."""
    monkeypatch.setattr(open_store, "BUCKET_ROWS", 100)
    sizes = {}
    for many in (100, 600):
        folder = tmp_path / str(many)
        tables, store = LogTables.under(str(folder)), OpenStore(spark, str(folder / "open"))
        opening = [(0, i, at(0, 0, f"key-{i:05}", START)) for i in range(many)]
        run_log_batch(records(spark, opening), 0, tables)
        assert store.commits()[-1].snapshot == 0 and store.commits()[-1].held == many
        assert store.commits()[-1].buckets == 1 + many // 100
        lines = [at(1, 0, "key-00001", "a note"), at(1, 1, "key-00002", END), at(1, 2, "key-new", START)]
        run_log_batch(records(spark, [(0, 10_000 + i, text) for i, text in enumerate(lines)]), 1, tables)
        sizes[many] = written_by(folder, 1)
        commit = store.commits()[-1]
        assert (commit.snapshot, commit.changes, commit.changed) == (0, (1,), 3)
        heads = {r["request_key"] for r in store.heads(commit).collect()}
        assert len(heads) == many and "key-new" in heads and "key-00002" not in heads
        assert commit.offsets == (("t", 0, 0, 10_003),)
    assert abs(sizes[600] - sizes[100]) < 0.05 * sizes[100]
    # All expire at once: they are read from all buckets, given out, and gone from the next snapshot.
    late = [(0, 20_000, at(30, 0, "x", START)), (0, 20_001, at(30, 0, "x", END))]
    run_log_batch(records(spark, late), 2, tables)
    outcome = [r.status for r in read_events(spark, tables.events).collect()]
    assert outcome.count("timeout") == 600 and outcome.count("complete") == 2
    commit = store.commits()[-1]
    assert commit.snapshot == 2 and commit.held == 0 and commit.changes == ()
    names = {f.name for f in (folder / "open").iterdir()}
    assert names == {"batch_id=1", "batch_id=2", "snapshot=0", "snapshot=2", "commits"}


def test_a_key_that_opens_again_starts_anew(spark, tmp_path):
    tables = LogTables.under(str(tmp_path))
    others = [(0, 100 + i, at(0, 0, f"o{i}", START)) for i in range(9)]
    batches = [
        [(0, 0, at(0, 0, "k", START)), (0, 1, at(0, 0, "k", "first")), *others],
        [(0, 200, at(0, 1, "k", END))],
        [(0, 201, at(0, 2, "k", START)), (0, 202, at(0, 2, "k", "second"))],
        [(0, 203, at(0, 3, "k", END))],
    ]
    for number, rows in enumerate(batches):
        run_log_batch(records(spark, rows), number, tables)
    writes = read_writes(spark, tables.events).orderBy("batch_id").collect()
    assert [(w.request_key, w.other_log) for w in writes] == [("k", "first"), ("k", "second")]
    assert OpenStore(spark, tables.open).commits()[-1].snapshot == 0


def test_a_run_takes_over(spark, tmp_path):
    """A new checkpoint reads all records again; with resume it goes on where the old one ended."""
    stream = Stream(spark, tmp_path)
    assert starting_offsets(spark, stream.tables) == "earliest"
    stream.feed([(0, 0, at(0, 0, "a", START)), (0, 1, at(0, 1, "a", END)), (0, 2, at(0, 2, "b", START)), (1, 5, "junk")])
    stream.run()
    assert starting_offsets(spark, stream.tables) == '{"t": {"0": 3, "1": 6}}'
    stream.feed([(0, 3, at(0, 3, "b", END)), (1, 6, at(0, 3, "c", START)), (2, 0, at(0, 4, "d", START))])
    stream.rules = {"resume": True}
    stream.run("another")
    assert stream.outcome() == [("a", "complete"), ("b", "complete")]
    appended = read_writes(spark, stream.tables.events).collect()
    assert sorted((r.request_key, r.batch_id) for r in appended) == [("a", 0), ("b", 2)]
    assert read_rows(spark, stream.tables.malformed).count() == 1
    # Later batches of that run skip no more than its first one.
    stream.feed([(1, 7, at(0, 5, "c", END)), (2, 1, at(0, 5, "d", END))])
    stream.run("another")
    assert stream.outcome() == [(key, "complete") for key in "abcd"]


def jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def test_commits_are_files_read_without_a_job(spark, tmp_path):
    store, before = OpenStore(spark, str(tmp_path / "open")), jobs(spark)
    assert store.commits() == [] and store.before(9) is None
    offsets = [Row(topic="t", partition=0, first=5, last=7), Row(topic=None, partition=None, first=0, last=1)]
    done = store.commit(None, 3, "run", 0, offsets, (("t", 1, 0, 4),))
    # A batch that runs again replaces its commit.
    again = store.commit(None, 3, "run", 0, offsets[:1], ())
    assert done.offsets == ((None, None, 0, 2), ("t", 0, 5, 8)) and done.taken_over == (("t", 1, 0, 4),)
    assert store.commits() == [again] and store.before(3) is None and store.before(4) == again
    assert jobs(spark) == before


def test_jobs_of_a_batch_are_bounded(spark, tmp_path):
    """Neither open exchanges nor lines nor earlier batches make a batch run more jobs."""
    tables, counts = LogTables.under(str(tmp_path)), []
    for number in range(4):
        first, many = 1000 * number, 5 if number < 2 else 300
        rows = [(0, first + i, at(0, number, f"n{number}-{i}", START)) for i in range(many)]
        rows += [(0, first + 900, at(0, number, f"n{number - 1}-0", END)), (0, first + 901, "junk")]
        before = jobs(spark)
        run_log_batch(records(spark, rows), number, tables, base=0)
        counts.append(jobs(spark) - before)
    assert max(counts) <= 50 and counts[3] <= counts[1] + 8, counts


def test_work_side_by_side(spark):
    """All of it ends before an error is raised, so a batch that runs again meets no writer of the first."""
    ended = []

    def fails():
        raise ValueError("no")

    def works():
        ended.append(spark.range(10).count())

    with pytest.raises(ValueError):
        at_once(spark, fails, works)
    assert ended == [10]
    assert at_once(spark, lambda: 1, lambda: spark.range(3).count()) == [1, 3]
