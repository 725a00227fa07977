"""The log job as a stream: records in, events by day out, open exchanges in a table."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from wireloom.plans.log_batch import BatchCounts, LogTables, first_write, run_log_batch
from wireloom.plans.open_store import OpenStore
from wireloom.plans.staging import file_exists, remove_folder, touch


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of this checkpoint; a new checkpoint is a new run."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def starting_offsets(spark: SparkSession, tables: LogTables) -> str:
    """Where the last batch ended, as Kafka's option ``startingOffsets``; ``earliest`` if there was none."""
    commits = OpenStore(spark, tables.open).commits()
    places: dict[str, dict[str, int]] = {}
    for topic, partition, _, until in commits[-1].offsets if commits else ():
        places.setdefault(topic, {})[str(partition)] = until
    return json.dumps(places) if places else "earliest"


class StopRequested(Exception):
    """Ends a stream before a batch that has not begun."""


def request_stop(spark: SparkSession, marker: str) -> None:
    """Asks the stream that was started with this ``stop_marker`` to end; any process that sees the folder may."""
    touch(spark, marker)


def await_log_job(query: StreamingQuery, spark: SparkSession, marker: str, poll: float = 0.5) -> bool:
    """Waits until the stream ends, and ends it between two batches once ``marker`` is there; whether it was asked to.

    The batch at work is not interrupted: it ends, with its progress. One that comes after the
    marker gives up before it has read anything, and is the first of the next start. The marker is removed.
    """
    asked = False
    while query.isActive:
        asked = asked or file_exists(spark, marker)
        if asked and not query.status["isTriggerActive"]:
            query.stop()
            break
        time.sleep(poll)
    try:
        query.awaitTermination()
    except StreamingQueryException as error:
        if StopRequested.__name__ not in str(error):
            raise
        asked = True
    if asked:
        remove_folder(spark, marker)
    return asked


def start_log_job(
    records: DataFrame,
    tables: LogTables,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    report: Callable[[int, BatchCounts], None] | None = None,
    stop_marker: str | None = None,
    **rules,
) -> StreamingQuery:
    """Starts the job; ``rules`` go to ``run_log_batch``. Stop it with ``query.stop()``,
    or between two batches with ``stop_marker``, ``request_stop`` and ``await_log_job``.

    Progress is in ``checkpoint``. A batch that is delivered again after a failure replaces its
    own rows. Exchanges expire by the clock of the batch, the time of the first event that it
    gives out; so neither a source partition that runs ahead nor a line with a time in the
    future expires what others still wait for. ``report`` gets the counts of each batch.

    A new checkpoint starts a new run, which knows nothing of the old one unless the rule
    ``resume=True`` is given: then it takes over what is open and skips what was read. A Kafka source can start there
    at once, with ``starting_offsets`` as its option.

    A micro-batch takes a few Spark jobs; one that takes longer than the trigger is followed at
    once by the next, which then has more to do.
    """

    base: list[int] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        if stop_marker and file_exists(batch.sparkSession, stop_marker):
            raise StopRequested(stop_marker)
        if not base:
            spark = batch.sparkSession
            base.append(first_write(spark, tables, run_of(spark, checkpoint)))
        counts = run_log_batch(batch, batch_id, tables, base=base[0], **rules)
        if report:
            report(batch_id, counts)

    return (
        records.writeStream.queryName("log-events")
        .foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )
