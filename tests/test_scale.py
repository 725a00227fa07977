"""What queries on the whole log must not do twice."""

import datetime

import pytest
from pyspark.sql import functions as F

from wireloom.functions.clock import parse_log_time
from wireloom.operators import assemble, upsert
from wireloom.operators.assemble import Summed, join_exchanges, sum_pieces, summarise
from wireloom.plans import queries
from wireloom.plans.staging import Staging

FOLDER = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_slice_makes_each_text_once(spark):
    for part in queries._slices(spark, FOLDER):
        assert optimized(part).count("date_format(") == 1


def test_two_periods_make_each_text_once(spark, monkeypatch):
    monkeypatch.setattr(queries, "_in_batches", lambda spark, batches: batches)
    for part in queries._two_periods(spark, FOLDER):
        assert optimized(part).count("date_format(") == 1 and part.columns == ["topic", "partition", "offset", "value"]


def test_clock_and_order_read_exchanges_that_are_summed_up_once(spark):
    """Neither the places nor the clock go back to the log."""
    assert "user_id" not in optimized(queries.events_by_start(spark, FOLDER))


def test_a_key_of_a_third_of_the_log_is_put_together_apart(spark, monkeypatch):
    """The end of the query reads the table of events and texts, not the log; results are those of the plain plan."""
    monkeypatch.setattr(assemble, "LONG_TEXT_BYTES", 500)
    apart = queries.assembled_shared_keys(spark, FOLDER)
    assert "user_id" not in optimized(apart)
    key = F.when(F.col("event_id") % 3 == 0, "shared").otherwise(F.concat(F.lit("req-"), F.col("event_id").cast("string")))
    plain = queries._plain(assemble.assemble(queries._classified(spark, FOLDER, key)))
    assert apart.columns == plain.columns
    assert apart.exceptAll(plain).count() == plain.exceptAll(apart).count() == 0 < apart.count()


def test_both_writes_are_made_in_one_pass_of_the_log(spark):
    """What is read of either write is a table; the log is not parsed again for it."""
    for write in queries._two_writes(spark, FOLDER):
        assert "user_id" not in optimized(write)


def test_a_first_upsert_stages_nothing(spark, tmp_path, monkeypatch):
    """Where there is no table there is nothing to read, so rows go to their days at once; a later one reads them."""
    early, final = queries._two_writes(spark, FOLDER)
    path, staged = str(tmp_path / "days"), []
    monkeypatch.setattr(upsert, "Staging", lambda spark: staged.append(1) or Staging(spark))
    upsert.upsert_days(early, 0, path)
    assert not staged and spark.read.parquet(path).count() == early.count() > 0
    upsert.upsert_days(final, 1, path)
    assert staged and {row[0] for row in spark.read.parquet(path).select("batch_id").distinct().collect()} == {1}


def test_a_first_batch_is_joined_with_nothing(spark):
    """With no open exchanges every exchange is as the batch has it, and no rows are shuffled to find that."""
    batch = summarise(queries._classified(spark, FOLDER)).exchanges.drop("texts")
    joined = join_exchanges(Summed.nothing(spark).exchanges, batch)
    assert "Join" not in optimized(joined)
    assert joined.filter("known OR NOT seen").count() == 0
    assert joined.count() == batch.count() > 0


def test_lines_are_gathered_by_a_number_that_tells_groups_apart(spark):
    """The first column by which lines are sorted differs from group to group."""
    pieces = sum_pieces(queries._classified(spark, FOLDER))
    assert "Aggregate [sorted_by" in optimized(pieces)


@pytest.mark.parametrize("day, time, instant", [
    ("2024-02-29", "23:59:59,999", datetime.datetime(2024, 2, 29, 15, 59, 59, 999000)),
    ("2024-03-10", "18:30:00,001", datetime.datetime(2024, 3, 10, 10, 30, 0, 1000)),
    ("2024-02-30", "00:00:00,000", None), ("2024-01-01", "24:00:00,000", None), ("2024-01-01", "00:60:00,000", None),
    ("2024-01-01", "00:00:60,000", None), ("2024-01-01", "00:00:00.000", None), (None, "00:00:00,000", None),
])
def test_log_times(spark, day, time, instant):
    found = spark.createDataFrame([(day, time)], "day string, time string")
    micros = found.select(F.unix_micros(parse_log_time(F.col("day"), F.col("time")))).first()[0]
    at = None if instant is None else instant.replace(tzinfo=datetime.timezone.utc).timestamp()
    assert micros == (None if at is None else round(at * 1_000_000))
