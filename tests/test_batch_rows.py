"""What a batch sums up in one pass: exchanges with their texts, malformed records, places."""

import pytest
from pyspark.sql import functions as F
from test_batches import records
from test_scale import FOLDER, optimized
from test_streaming import END, START, at
from wireloom.operators import assemble as assembling
from wireloom.operators.assemble import Summed, exchanges_of, malformed_of, places_of, sum_batch
from wireloom.operators.lines import classified_records, parse_records
from wireloom.operators.route import reconcile
from wireloom.operators.upsert import read_events
from wireloom.plans import queries
from wireloom.plans.log_batch import LogTables, _constant, run_log_batch
from wireloom.plans.staging import SORTED_GROUPS, Staging, sorted_groups
from wireloom.schema import LOG_RECORD


def rows_of(log, batch=0):
    return sum_batch(classified_records(parse_records(log)), batch)


def test_lines_are_shuffled_and_sorted_once_and_exchanges_once(spark):
    with sorted_groups(spark):
        plan = rows_of(queries.records(spark, FOLDER))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("+- Sort [") == 2
    assert plan.count("SortAggregate(") == 3 and "ObjectHashAggregate" not in plan


def test_sorted_groups_are_a_setting_of_what_runs_inside(spark):
    before = spark.conf.get(SORTED_GROUPS)
    with pytest.raises(ValueError), sorted_groups(spark):
        assert spark.conf.get(SORTED_GROUPS) == "true"
        raise ValueError
    assert spark.conf.get(SORTED_GROUPS) == before


def test_a_first_batch_gives_out_what_it_has_row_by_row(spark):
    """Texts come with the exchanges: nothing is joined or gathered for events, dropped fragments and new texts."""
    with Staging(spark) as stage:
        batch = exchanges_of(stage(rows_of(queries.records(spark, FOLDER)), "batch"))
        outcome = reconcile(batch, Summed.nothing(spark), _constant(spark, None))
        for part in (outcome.emitted, outcome.dropped, outcome.still_open.exchanges, outcome.still_open.texts):
            assert "Join" not in optimized(part) and "Aggregate" not in optimized(part)
            assert part.count() > 0


def test_tables_that_a_batch_stages(spark, tmp_path, monkeypatch):
    """Pieces are in no table, and the fate of exchanges is only where some were open before."""
    staged, call = [], Staging.__call__
    monkeypatch.setattr(Staging, "__call__", lambda self, df, name: staged.append(name) or call(self, df, name))
    tables = LogTables.under(str(tmp_path))
    run_log_batch(records(spark, [(0, 0, at(0, 0, "a", START)), (0, 1, at(0, 1, "a", "note"))]), 0, tables)
    assert staged == ["batch"]
    run_log_batch(records(spark, [(0, 2, at(0, 2, "a", "more")), (0, 3, at(0, 3, "a", END))]), 1, tables)
    assert sorted(staged[1:]) == ["batch", "before", "decided", "touched"]
    (event,) = read_events(spark, tables.events).collect()
    assert (event.status, event.other_log) == ("complete", "note ; more")


def test_places_and_malformed_records(spark, monkeypatch):
    """By topic and partition, none of them or of the offset given too; records without a key stay apart by piece."""
    monkeypatch.setattr(assembling, "PIECE_BITS", 2)
    log, places, bad = [], {}, []
    for n in range(200):
        place = (None if n % 7 == 0 else f"t{n % 2}", None if n % 11 == 0 else n % 3)
        offset, value = None if n % 13 == 0 else 5 * n, "junk" if n % 5 == 0 else at(0, n, f"k{n % 4}", "note")
        log.append((*place, offset, value))
        first, last, malformed = places.get(place, (None, None, 0))
        known = [o for o in (first, last, offset) if o is not None]
        places[place] = (min(known, default=None), max(known, default=None), malformed + (value == "junk"))
        bad += [(*place, offset, value, "too few words")] if value == "junk" else []
    with Staging(spark) as stage, sorted_groups(spark):
        rows = stage(rows_of(spark.createDataFrame(log, LOG_RECORD), 3), "batch")
        assert {(r.topic, r.partition): (r["first"], r["last"], r.malformed) for r in places_of(rows).collect()} == places
        assert sorted(map(str, malformed_of(rows).collect())) == sorted(str(r) for r in spark.createDataFrame(bad, malformed_of(rows).schema).collect())
        assert malformed_of(rows).columns == ["topic", "partition", "offset", "value", "reason"]
        without = rows.filter("request_key IS NULL")
        assert without.count() > len(places) and without.filter(F.size("malformed") > 4).filter("unkeyed.alone IS NOT NULL").count() == 0
        batch = exchanges_of(rows)
        assert sorted(r[0] for r in batch.exchanges.select("request_key").collect()) == ["k0", "k1", "k2", "k3"]
        assert {r[0] for r in batch.texts.select("batch").collect()} == {3}
        assert batch.texts.select(F.sum(F.size(F.split("other_log", " ; ")))).first()[0] == 200 - len(bad)
