"""The stream against the batch operators, whatever the cut into micro-batches."""

import random

import pytest

from test_assemble import line, observed, random_rows, to_lines
from wireloom.operators.assemble import assemble
from wireloom.operators.upsert import read_events, read_writes
from wireloom.plans.versions import read_rows
from wireloom.schema import LOG_RECORD
from wireloom.sources.logs import record_files
from wireloom.plans.log_batch import LogTables
from wireloom.streaming.log_job import start_log_job


class Stream:
    """Feeds micro-batches one by one through a log job over files."""

    def __init__(self, spark, folder, **rules):
        self.spark, self.folder, self.rules, self.n = spark, folder, rules, 0
        self.source, self.tables = str(folder / "in"), LogTables.under(str(folder / "tables"))
        self.counts = {}
        (folder / "in").mkdir()

    def feed(self, rows):
        """Rows are (partition, offset, value)."""
        data = [("t", p, o, value) for p, o, value in rows]
        part = f"{self.folder}/part{self.n}"
        self.spark.createDataFrame(data, LOG_RECORD).coalesce(1).write.parquet(part)
        (file,) = [f for f in (self.folder / f"part{self.n}").iterdir() if f.suffix == ".parquet"]
        (self.folder / "in" / f"{self.n:03d}.parquet").write_bytes(file.read_bytes())
        self.n += 1
        return self

    def run(self, checkpoint="checkpoint"):
        query = start_log_job(
            record_files(self.spark, self.source),
            self.tables,
            str(self.folder / checkpoint),
            trigger={"availableNow": True},
            report=self.counts.__setitem__,
            **self.rules,
        )
        assert query.awaitTermination(120)
        return query

    def rows(self):
        return read_events(self.spark, self.tables.events)

    def outcome(self):
        return sorted((r.request_key, r.status) for r in self.rows().collect())


def at(minutes, ms, key, text):
    """A line ``minutes`` and ``ms`` after the base time."""
    total = minutes * 60000 + ms
    h, rest = divmod(total, 3600000)
    m, rest = divmod(rest, 60000)
    s, f = divmod(rest, 1000)
    return (
        f"2018-01-02 {10 + h:02d}:{m:02d}:{s:02d},{f:03d} a-b-c:d-1 {key} DEBUG c.f.Client {text}"
    )


START = "---> GET http://h/x HTTP/1.1"
END = "<--- END"


@pytest.mark.parametrize("seed", [11, 12])
def test_any_cut_gives_the_batch_result(spark, tmp_path, seed):
    """Keys start first and end last, so every cut must lead to the same events."""
    rng = random.Random(seed)
    rows = random_rows(seed, [f"k{i}" for i in range(30)], 300, partitions=1)
    rows = [r for r in rows if r[4] != END]
    keys = sorted({r[2] for r in rows})
    opening = [(0, -len(keys) + i, k, 0, START) for i, k in enumerate(keys)]
    closing = [(0, 1000 + i, k, 11, END) for i, k in enumerate(keys)]
    rows = opening + rows + closing
    stream = Stream(spark, tmp_path)
    cuts = [0, *sorted(rng.sample(range(1, len(rows)), 3)), len(rows)]
    for a, b in zip(cuts, cuts[1:]):
        stream.feed([(p, o, line(k, ms, text)) for p, o, k, ms, text in rows[a:b]])
    stream.run()
    expected = observed(assemble(to_lines(spark, rows)))
    assert observed(stream.rows()) == expected
    assert {r.status for r in stream.rows().collect()} == {"complete"}


def test_fate_of_keys(spark, tmp_path):
    """Expiry by the clock of the batch, lines without an open exchange, and a start after its
    fragments."""
    stream = Stream(spark, tmp_path)
    stream.feed(
        [
            (0, 0, at(0, 0, "early", START)),
            (0, 1, at(0, 1, "late", START)),
            (0, 2, at(0, 5, "orphan", END)),
            (0, 3, at(0, 6, "same", "note")),
            (0, 4, at(0, 7, "same", START)),
            (0, 5, at(0, 8, "same", END)),
            (0, 6, at(0, 9, "before", "note")),
        ]
    )
    stream.feed([(0, 7, at(1, 0, "before", START)), (0, 8, at(1, 1, "before", END))])
    stream.feed([(0, 9, at(16, 0, "other", START)), (0, 10, at(16, 0, "other", END))])
    stream.run()
    assert stream.outcome() == [
        ("before", "complete"), ("early", "timeout"), ("other", "complete"), ("same", "complete"),
    ]
    before = stream.rows().filter("request_key = 'before'").first()
    assert before.other_log is None
    assert {n: c.dropped for n, c in stream.counts.items()} == {0: 2, 1: 0, 2: 0}

    stream.feed([(0, 11, at(16, 2, "late", END))])
    stream.run()
    assert ("late", "complete") in stream.outcome()


def test_lagging_partition_is_not_lost(spark, tmp_path):
    """An hour behind, and its exchange spans two micro-batches."""
    stream = Stream(spark, tmp_path)
    stream.feed([(0, 0, at(300, 0, "new", START)), (0, 1, at(300, 1, "new", END))])
    stream.feed([(0, 2, at(301, 0, "new2", START)), (1, 0, at(0, 0, "old", START))])
    stream.feed([(0, 3, at(301, 1, "new3", "note")), (1, 1, at(0, 1, "old", END))])
    stream.run()
    assert ("old", "complete") in stream.outcome()
    assert not [r for r in stream.outcome() if r[1] == "timeout"]


def test_one_line_from_the_future(spark, tmp_path):
    """Exchanges that span two batches are not given up because of it."""
    stream = Stream(spark, tmp_path)
    future = at(0, 0, "future", START).replace("2018-01-02", "2099-01-02")
    stream.feed([(0, 0, future), (0, 1, at(0, 0, "a", START)), (0, 2, at(0, 0, "b", START))])
    stream.feed([(0, 3, at(0, 9, "a", END)), (0, 4, at(1, 0, "c", START))])
    stream.feed([(0, 5, at(1, 9, "b", END)), (0, 6, at(1, 9, "c", END))])
    stream.run()
    assert stream.outcome() == [("a", "complete"), ("b", "complete"), ("c", "complete")]


def test_fragments_on_request(spark, tmp_path):
    stream = Stream(spark, tmp_path, emit_fragments=True)
    stream.feed([(0, 0, at(0, 0, "k", START))])
    stream.feed([(0, 1, at(0, 1, "k", "note"))])
    stream.feed([(0, 2, at(0, 2, "k", END))])
    stream.run()
    appended = read_writes(spark, stream.tables.events)
    writes = appended.orderBy("batch_id", "status").collect()
    assert [(w.status, w.other_log) for w in writes] == [
        ("fragment", "note"), ("complete", "note"), ("fragment", None),
    ]
    assert stream.outcome() == [("k", "complete")]


def test_second_start_moves_the_expiry(spark, tmp_path):
    done = lambda minutes, key: [at(minutes, 0, key, START), at(minutes, 1, key, END)]
    stream = Stream(spark, tmp_path)
    stream.feed([(0, 0, at(0, 0, "k", START))])
    stream.feed([(0, 1, at(10, 0, "k", START + " again"))])
    stream.feed([(0, 2 + i, text) for i, text in enumerate(done(20, "x"))])
    stream.run()
    assert stream.outcome() == [("x", "complete")]
    stream.feed([(0, 6 + i, text) for i, text in enumerate(done(26, "y"))])
    stream.run()
    assert ("k", "timeout") in stream.outcome()


def test_malformed_records_are_kept(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.feed([(0, 0, "no line"), (0, 1, at(0, 0, "k", START))])
    stream.run()
    rows = read_rows(spark, stream.tables.malformed).select("offset", "reason")
    assert [tuple(r) for r in rows.collect()] == [(0, "too few words")]
    assert stream.counts[0].malformed == 1


def test_a_new_checkpoint_does_not_overwrite(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.feed([(0, 0, at(0, 0, "a", START)), (0, 1, at(0, 1, "a", END))])
    stream.run()
    before = read_writes(spark, stream.tables.events).count()
    stream.feed([(0, 2, at(1, 0, "b", START)), (0, 3, at(1, 1, "b", END))])
    stream.run("another")
    assert stream.outcome() == [("a", "complete"), ("b", "complete")]
    assert read_writes(spark, stream.tables.events).count() == before + 2
