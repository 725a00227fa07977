"""Tables of one row per request key and day: the last write of a key replaces the others.

A stream appends: every write is a folder of its own in a table of versions (``plans.versions``), a replay takes the
place of the folder it repeats, so the cost of a write does not depend on the size of the day. A version names the days of each
folder, so no job is needed to find them. Every so many writes are folded into one, which keeps a version short. Readers take the last write of each key. ``compact_days`` folds
closed days, one row per key in few files, where readers need no window. What was read before a fold or a replay stays readable.
``upsert_days`` folds rows into a plain table at once, rewriting the days touched and no others.
"""

from __future__ import annotations

import datetime
from collections import Counter
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from wireloom.plans.staging import Staging, file_exists
from wireloom.plans.versions import Part, Superseded, VersionedTable
from wireloom.schema import EMITTED

KEY = ["event_day", "request_key"]
WRITES = T.StructType([*EMITTED.fields, T.StructField("batch_id", T.LongType())])

# Days that a condition lists one by one; more are given as first and last.
LISTED_DAYS = 366


def last_writes(writes: DataFrame) -> DataFrame:
    """The last row of each key and day, by ``batch_id``.

    Within a batch a merged event replaces its fragments. Spark limits the rows of a key to
    one before the shuffle too, so a key that is written in every batch does no harm.
    """
    merged_last = F.when(F.col("status") == "fragment", 0).otherwise(1)
    newest_first = Window.partitionBy(*KEY).orderBy(
        F.desc("batch_id"),
        F.desc(merged_last),
        F.desc("event_time"),
        F.desc_nulls_last("end_time"),
    )
    return (
        writes.withColumn("place", F.row_number().over(newest_first))
        .filter(F.col("place") == 1)
        .drop("place")
    )


def _rebalanced(rows: DataFrame) -> DataFrame:
    """Under adaptive execution the rows of a day are brought together for few, evenly sized
    files, and a day that holds most rows is split again."""
    adaptive = rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    return rows.hint("rebalance", "event_day") if adaptive else rows


def _write(rows: DataFrame, path: str, *partitions: str) -> None:
    (
        _rebalanced(rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def _table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, "event_day")


def _folded(writes: DataFrame) -> DataFrame:
    return _rebalanced(last_writes(writes))


def append_batch(events: DataFrame, batch_id: int, path: str) -> None:
    """Writes the rows of one batch; a second call for the batch replaces the first.

    ``batch_id`` numbers the writes of the table, whoever makes them; ``plans.log_batch`` keeps
    the numbers of several runs apart.
    """
    numbered = events.withColumn("batch_id", F.lit(batch_id).cast("long")).select(*WRITES.fieldNames())
    table = _table(events.sparkSession, path)
    table.add(table.write(_rebalanced(numbered)), batch_id, WRITES)
    try:
        table.fold_due(_folded, WRITES)
    except Superseded:
        pass  # somebody else folded these writes; the next batch looks again


def _read(spark: SparkSession, path: str) -> DataFrame:
    """The rows at a path with their ``batch_id``; none if it does not exist yet."""
    try:
        return spark.read.schema(WRITES).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], WRITES)


def _days(rows: DataFrame) -> list[datetime.date]:
    return sorted(r[0] for r in rows.select("event_day").distinct().collect())


def _of_days(days: list[datetime.date]) -> Column:
    """A condition that prunes the scan to these days, or at least to the span of them."""
    if not days:
        return F.lit(False)
    if len(days) > LISTED_DAYS:
        return F.col("event_day").between(days[0], days[-1])
    return F.col("event_day").isin(days)


def next_write(spark: SparkSession, path: str) -> int:
    """A number above those of all writes in the table."""
    return _table(spark, path).last().last_number + 1


def _unsettled(parts: tuple[Part, ...]) -> set[str]:
    """Days in which a key may have several rows: those of more than one folder, or of one that is not folded."""
    held = Counter(day for part in parts for day in part.days)
    raw = {day for part in parts if part.level == 0 for day in part.days}
    return raw | {day for day, n in held.items() if n > 1}


def _only(parts: tuple[Part, ...], days: set[str]) -> list[Part]:
    return [replace(part, days=tuple(day for day in part.days if day in days)) for part in parts]


def read_writes(spark: SparkSession, path: str) -> DataFrame:
    """All rows that the table holds, several of a key too, with the number of their write."""
    table = _table(spark, path)
    return table.read(table.last().parts, WRITES)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """One row per key and day, as of now; a filter on ``event_day`` prunes the scan.

    Only days with writes that are not folded yet go through a window. Which these are is told by
    the version read, without a job. Folds and replays that come later do not touch what is read.
    """
    table = _table(spark, path)
    parts = table.last().parts
    unsettled = _unsettled(parts)
    settled = {day for part in parts for day in part.days} - unsettled
    rows = table.read(_only(parts, settled), WRITES)
    if unsettled:
        rows = rows.unionByName(last_writes(table.read(_only(parts, unsettled), WRITES)))
    return rows.drop("batch_id")


def compact_days(spark: SparkSession, path: str, before: datetime.date | None = None) -> int:
    """Folds the writes of all days, or those before a day, to one row per key; how many days.

    Safe to repeat, and beside readers and writers: the version that names the folded rows
    names the folders they come from no longer. Writes that come meanwhile or later are folded in by the next call.
    """
    table = _table(spark, path)
    while True:
        parts = table.last().parts
        days = {day for day in _unsettled(parts) if before is None or day < before.isoformat()}
        if not days:
            return 0
        try:
            touched = [part for part in parts if days & set(part.days)]
            table.fold_days(touched, days, _folded, WRITES)
            return len(days)
        except Superseded:
            continue


def upsert_days(events: DataFrame, batch_id: int, path: str) -> None:
    """Folds one row per key and day into the table at ``path``; safe to repeat.

    The new days are staged before they replace the old ones, because they are read from the
    table that they go to. If replacing them fails, the staged days are kept. Where there is no table yet, nothing is staged.
    """
    numbered = events.withColumn("batch_id", F.lit(batch_id).cast("long"))
    if not file_exists(events.sparkSession, path):
        return _write(last_writes(numbered), path, "event_day")
    with Staging(events.sparkSession) as stage:
        incoming = stage(numbered, "incoming")
        standing = standing_days(stage.spark, path, _days(incoming))
        folded = stage(last_writes(standing.unionByName(incoming)), "days")
        _write(folded, path, "event_day")


def standing_days(spark: SparkSession, path: str, days: list[datetime.date]) -> DataFrame:
    """The rows of these days in a table of ``upsert_days``; other days are not read."""
    rows = _read(spark, path)
    wanted = rows.filter(_of_days(days))
    if len(days) > LISTED_DAYS:
        found = spark.createDataFrame([(day,) for day in days], "event_day date")
        wanted = wanted.join(found, "event_day", "left_semi")
    return wanted
