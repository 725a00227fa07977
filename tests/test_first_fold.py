"""The first fold of the open store."""

from test_batches import records
from test_streaming import END, START, at
from wireloom.operators.upsert import read_events
from wireloom.plans.log_batch import LogTables, run_log_batch
from wireloom.plans.open_store import OpenStore


def test_a_first_write_is_folded_as_it_is(spark, tmp_path, monkeypatch):
    """No key can have a second row or be gone, so nothing is looked up; later folds do look."""
    looked, heads = [], OpenStore.heads
    monkeypatch.setattr(OpenStore, "heads", lambda self, commit: looked.append(commit.write) or heads(self, commit))
    tables, store = LogTables.under(str(tmp_path)), OpenStore(spark, str(tmp_path / "open"))
    first = [(0, i, at(0, i, f"k{i}", START)) for i in range(9)] + [(0, 20 + i, at(0, 20, f"k{i}", "note")) for i in range(9)]
    run_log_batch(records(spark, [*first, (0, 40, at(0, 40, "done", START)), (0, 41, at(0, 41, "done", END)), (0, 42, at(0, 42, "x", END))]), 0, tables)
    commit = store.commits()[-1]
    assert not looked and (commit.snapshot, commit.held, commit.changes) == (0, 9, ())
    found = store.lookup(commit, heads(store, commit), few=False)
    assert sorted(r[0] for r in found.exchanges.select("request_key").collect()) == [f"k{i}" for i in range(9)]
    assert sorted((r.request_key, r.other_log) for r in found.texts.collect()) == [(f"k{i}", "note") for i in range(9)]
    run_log_batch(records(spark, [(0, 50 + i, at(1, i, f"k{i}", END)) for i in range(9)]), 1, tables)
    assert 1 in looked and store.commits()[-1].held == 0
    assert {(r.request_key, r.status, r.other_log) for r in read_events(spark, tables.events).collect()} == {
        *((f"k{i}", "complete", "note") for i in range(9)), ("done", "complete", None),
    }
