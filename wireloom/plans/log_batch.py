"""The log job over a bounded set of records, with open exchanges kept in a table.

For a backlog, for a scheduler that runs batches, and as the body of the stream
(``streaming.log_job``). No line passes through Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from wireloom.operators.assemble import Summed, exchanges_of, malformed_of, places_of, sum_batch, text_rows
from wireloom.operators.lines import classified_records, parse_records
from wireloom.operators.route import DROPPED, EXPIRE_MINUTES, OPEN, batch_clock, is_expired, reconcile
from wireloom.operators.upsert import append_batch, next_write
from wireloom.plans.open_store import Commit, OpenStore, unread
from wireloom.plans.staging import Staging, at_once, sorted_groups
from wireloom.plans.versions import VersionedTable, add_rows
from wireloom.sources.admission import batch_ranges, of_batch

RUNS = "run string, base bigint"


@dataclass(frozen=True)
class LogTables:
    """Folders of the job: events by day, what is open between batches (``plans.open_store``), records
    that are no lines, what came without an open event, and the first write number of each run."""

    events: str
    open: str
    malformed: str
    dropped: str
    runs: str

    @classmethod
    def under(cls, folder: str) -> LogTables:
        names = ("events", "open", "malformed", "dropped", "runs")
        return cls(*[f"{folder}/{name}" for name in names])


@dataclass(frozen=True)
class BatchCounts:
    """What a batch kept apart: records that are no lines, and fragments without an event."""

    malformed: int
    dropped: int


def first_write(spark: SparkSession, tables: LogTables, run: str) -> int:
    """The write number of a run's batch 0.

    Batches of a run are numbered from 0, so a run that starts over, such as a stream with a
    new checkpoint, would overwrite the writes of the one before. Each run gets numbers above
    all that the tables hold when it first writes.
    """
    try:
        known = spark.read.schema(RUNS).parquet(tables.runs)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], RUNS)
    found = known.filter(F.col("run") == run).agg(F.max("base")).first()[0]
    if found is not None:
        return found
    written = [next_write(spark, tables.events), 1 + (known.agg(F.max("base")).first()[0] or -1)]
    base = max(written + [commit.write + 1 for commit in OpenStore(spark, tables.open).commits()])
    spark.createDataFrame([(run, base)], RUNS).coalesce(1).write.mode("append").parquet(tables.runs)
    return base


def run_log_batch(
    records: DataFrame,
    batch_id: int,
    tables: LogTables,
    expire_minutes: int = EXPIRE_MINUTES,
    emit_fragments: bool = False,
    run: str = "",
    base: int | None = None,
    resume: bool = False,
) -> BatchCounts:
    """One batch: continues what batch ``batch_id - 1`` of the run left open, and writes the
    events. The records are read once.

    Batches of a run are numbered from 0. A batch that runs again replaces what it wrote, as
    long as the next one has not run. Of the open exchanges a batch reads those that its records
    or the clock touch, and writes no others. Malformed records and dropped fragments are kept in tables of their
    own (``plans.versions.read_rows``), and counted; small folders of these are folded together. ``base`` is the run's ``first_write``, for callers that know it.

    With ``resume`` batch 0 goes on from the last batch of the run before: its open exchanges are
    taken over, and this run skips the records below the offsets that were read then. That is for
    sources that deliver the records of a partition in the order of their offsets.
    """
    spark = records.sparkSession
    base = first_write(spark, tables, run) if base is None else base
    store, write = OpenStore(spark, tables.open), base + batch_id
    last = store.before(write) if batch_id or resume else None
    taken_over = () if last is None else last.taken_over if batch_id else last.offsets
    records = unread(records, taken_over)

    with Staging(spark) as stage:
        with sorted_groups(spark):
            rows = stage(sum_batch(classified_records(parse_records(records)), write), "batch")
        batch = exchanges_of(rows)

        def keep_malformed() -> tuple[list[Row], int]:
            places = places_of(rows).collect()
            malformed = sum(row["malformed"] for row in places)
            add_rows(VersionedTable(spark, tables.malformed), malformed_of(rows), write, malformed)
            return places, malformed

        touched = lambda: _touched(store, last, batch, expire_minutes, stage)
        (places, malformed), (before, clock) = at_once(spark, keep_malformed, touched)
        outcome = reconcile(
            batch,
            before,
            clock=clock,
            expire_minutes=expire_minutes,
            emit_fragments=emit_fragments,
            # With nothing open before the fate of an exchange is told by its own row.
            keep=lambda decided: stage(decided, "decided") if _any_open(last) else decided,
        )
        left = outcome.still_open.exchanges
        new_texts = text_rows(outcome.decided.filter(F.col("status") == OPEN))
        gone = outcome.decided.filter(F.col("known") & (F.col("status") != OPEN))

        def keep_dropped() -> tuple[list[Row], int]:
            fates = outcome.decided.groupBy("status", "known").count().collect()
            dropped = sum(row["count"] for row in fates if row["status"] == DROPPED)
            add_rows(VersionedTable(spark, tables.dropped), outcome.dropped, write, dropped)
            return fates, dropped

        (fates, dropped), *_ = at_once(
            spark,
            keep_dropped,
            lambda: append_batch(outcome.emitted, write, tables.events),
            lambda: store.write(write, left, new_texts, gone),
        )
        changed = sum(row["count"] for row in fates if row["status"] == OPEN or row["known"])
        offsets = [row for row in places if row["last"] is not None]
        store.commit(last, write, run, changed, offsets, taken_over)
    return BatchCounts(malformed, dropped)


def run_backlog(records: DataFrame, tables: LogTables, target_bytes: int, **rules) -> list[BatchCounts]:
    """The log job over a backlog, in batches of about ``target_bytes`` (``sources.admission``), one after the other.

    ``rules`` go to ``run_log_batch``. The ranges are planned once and kept in a table; of these a batch reads its own,
    a row for each topic partition.
    """
    with Staging(records.sparkSession) as stage:
        ranges = stage(batch_ranges(records, target_bytes), "ranges")
        numbers = [row[0] for row in ranges.select("batch").distinct().orderBy("batch").collect()]
        done = []
        for batch_id, number in enumerate(numbers):
            own = ranges.filter(F.col("batch") == number).collect()
            done.append(run_log_batch(of_batch(records, own, batch_id), batch_id, tables, **rules))
    return done


def _touched(
    store: OpenStore, last: Commit | None, batch: Summed, expire_minutes: int, stage: Staging
) -> tuple[Summed, DataFrame]:
    """The open exchanges that have lines in the batch or that expire, and the clock."""
    if not _any_open(last):
        # Nothing can expire, so no clock is looked for.
        return Summed.nothing(store.spark), _constant(store.spark, None)
    heads = store.heads(last)
    clock = _told(batch_clock(batch.exchanges, heads))
    seen = batch.exchanges.select("request_key", F.lit(True).alias("seen"))
    old = is_expired(clock.scalar(), F.col("start_ts"), expire_minutes)
    keys = heads.join(seen, "request_key", "left").filter(F.coalesce("seen", F.lit(False)) | old)
    keys = stage(keys.select("request_key", "born"), "touched")
    found = store.lookup(last, keys)
    return Summed(stage(found.exchanges, "before"), found.texts), clock


def _any_open(last: Commit | None) -> bool:
    return last is not None and bool(last.held or last.changed)


def _told(clock: DataFrame) -> DataFrame:
    """The clock, looked up once: a row of a constant, which enters later plans as such."""
    return _constant(clock.sparkSession, clock.select(F.unix_micros("clock")).first()[0])


def _constant(spark: SparkSession, micros: int | None) -> DataFrame:
    return spark.sql(f"SELECT timestamp_micros({'NULL' if micros is None else micros}) AS clock")
