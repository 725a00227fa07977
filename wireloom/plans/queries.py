"""The registered queries: every operator over the whole tables of a folder.

Times come out as epoch milliseconds and days as text, so no time zone setting can change them.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wireloom.functions.clock import whole_minutes
from wireloom.functions.text import client_of, client_profile_of, server_of
from wireloom.operators import lines as L
from wireloom.operators.assemble import assemble, summarise, summarise_views, to_events
from wireloom.operators.lines import classify, computed_once, fragments, malformed_lines, parse_lines
from wireloom.operators.members import (
    first_per_member,
    loyalty_points,
    merge_members,
    normalised_old_rows,
    rejected_rows,
    to_member_rows,
)
from wireloom.operators.order import numbered
from wireloom.operators.route import (
    START_ORDER,
    TIMEOUT,
    batch_clock,
    by_start,
    to_emitted,
    with_completeness,
    with_event_day,
)
from wireloom.operators.upsert import (
    append_batch,
    compact_days,
    last_writes,
    read_events,
    read_writes,
    upsert_days,
)
from wireloom.plans.log_batch import LogTables, run_log_batch
from wireloom.plans.member_import import import_versioned, run_import
from wireloom.plans.staging import Staging, new_folder
from wireloom.plans.versions import VersionedTable, add_rows, read_rows, replace_rows
from wireloom.schema import EMITTED, EXCHANGE, LOG_RECORD, MEMBER_CSV, MEMBER_TABLE
from wireloom.sources.admission import batch_ranges
from wireloom.sources.derived import log_records, new_members, old_members, table
from wireloom.sources.logs import record_files
from wireloom.sources.members import read_member_csv
from wireloom.streaming.log_job import start_log_job

Query = Callable[[SparkSession, str], DataFrame]

PARTNER = "P1"
IMPORT_MS = 1_700_000_000_000
# A day in the middle of the period of the events table, on the log clock.
MIDDLE_DAY = "2024-01-16"


def records(
    spark: SparkSession, folder: str, key: Column | None = None, first: str | None = None, end: str | None = None
) -> DataFrame:
    return log_records(table(spark, folder, "events"), key, first, end)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return parse_lines(records(spark, folder))


def _classified(spark: SparkSession, folder: str, key: Column | None = None) -> DataFrame:
    return classify(parse_lines(records(spark, folder, key)))


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps as epoch millis under ``_ms`` names, dates as text."""
    columns = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "timestamp":
            stem = field.name.removesuffix("_time").removesuffix("_ts")
            columns.append(F.unix_millis(field.name).alias(f"{stem}_ms"))
        elif kind == "date":
            columns.append(F.col(field.name).cast("string").alias(field.name))
        else:
            columns.append(F.col(field.name))
    return df.select(*columns)


def _no_open(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], EXCHANGE)


# Log lines


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(_lines(spark, folder))


def _with_bad_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every 11th record is cut short and every 13th has a broken time."""
    value = (
        F.when(F.col("offset") % 11 == 0, F.left("value", F.lit(23)))
        .when(F.col("offset") % 13 == 0, F.replace("value", F.lit(","), F.lit(";")))
        .otherwise(F.col("value"))
    )
    return records(spark, folder).withColumn("value", value)


def bad_lines(spark: SparkSession, folder: str) -> DataFrame:
    return malformed_lines(_with_bad_lines(spark, folder))


# Contents that the derived log lacks, by the place of a line in its exchange; null ends the
# line at its key.
ODD_CONTENTS = (
    "---> RETRYING", "X-EVENT-ID: E1", "<xml>1</xml>", None, " ---> GET http://h/x HTTP/1.1",
    "x-event-id::b", "<--- HTTP/1.1 200 OK {x} (5ms)", "x-event-code:", "x-Event-Type: a",
    "X-Application-Context: a:b:c", "X-Event-Platform:  P 1  ", "<--- END {", "---> END <xml>",
)


def odd_fragments(spark: SparkSession, folder: str) -> DataFrame:
    """Fragments of the log with other contents: odd spellings, blanks, braces, none at all."""
    words = F.split("value", " ", 7)
    head = F.array_join(F.slice(words, 1, 6), " ")
    value = F.array_join(F.slice(words, 1, 4), " ")
    place = F.col("offset") % 16
    for number, content in enumerate(ODD_CONTENTS):
        if content is not None:
            odd = F.concat(head, F.lit(f" {content}"))
            value = F.when(place == number, odd).otherwise(value)
    odd = records(spark, folder).withColumn("value", value)
    return _plain(fragments(parse_lines(odd)))


def thread_client(spark: SparkSession, folder: str) -> DataFrame:
    """Client and profile of every thread name, and of names with other numbers of pieces."""
    names = _lines(spark, folder).select("thread_name", "partition").distinct()
    cut = F.when(F.col("partition") == 0, F.col("thread_name"))
    cut = cut.when(F.col("partition") == 1, F.replace("thread_name", F.lit(":"), F.lit("-")))
    cut = cut.otherwise(F.replace("thread_name", F.lit("-svc"), F.lit("-x-svc")))
    thread = F.col("thread_name")
    return (
        names.select(cut.alias("thread_name"))
        .distinct()
        .select(
            "thread_name",
            client_of(thread).alias("client"),
            client_profile_of(thread).alias("client_profile"),
        )
    )


def all_fragments(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(fragments(_lines(spark, folder)))


def fragment_counts(spark: SparkSession, folder: str) -> DataFrame:
    lines = classify(_lines(spark, folder))
    return lines.groupBy("kind").agg(F.count("*").alias("n"))


def request_start_server(spark: SparkSession, folder: str) -> DataFrame:
    starts = fragments(_lines(spark, folder)).filter(F.col("kind") == L.REQUEST_START)
    return starts.select("request_key", "method", "url", server_of(F.col("url")).alias("server"))


# Events


def assembled_events(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(assemble(_classified(spark, folder)))


def assembled_shared_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A third of all lines carries one request key."""
    own = F.concat(F.lit("req-"), F.col("event_id").cast("string"))
    key = F.when(F.col("event_id") % 3 == 0, F.lit("shared")).otherwise(own)
    return assemble(_classified(spark, folder, key), new_folder(spark, "shared-keys"), _plain)


def event_bodies(spark: SparkSession, folder: str) -> DataFrame:
    events = assemble(_classified(spark, folder))
    return events.select("request_key", "request_body", "response_body")


def completeness(spark: SparkSession, folder: str) -> DataFrame:
    events = with_completeness(assemble(_classified(spark, folder)))
    return events.select("request_key", "completeness")


def events_by_start(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a start and their places in its order, and the minutes since the clock of the batch."""
    known = summarise(_classified(spark, folder))
    # The clock and the order both read the exchanges: they are summed up once, and the clock reads two columns.
    path = new_folder(spark, "started-exchanges")
    known.exchanges.write.parquet(path)
    exchanges = spark.read.schema(known.exchanges.schema).parquet(path)
    clock = batch_clock(exchanges, _no_open(spark))
    ordered = numbered(by_start(to_events(exchanges, known.texts)), *START_ORDER)
    return ordered.select(
        "request_key",
        "place",
        F.unix_millis("start_time").alias("start_ms"),
        whole_minutes(F.col("start_time"), clock.scalar()).alias("minutes"),
    )


def daily_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events per day, written to a day table and read back from it."""
    events = with_completeness(assemble(_classified(spark, folder)))
    emitted = with_event_day(events.withColumnRenamed("completeness", "status"))
    path = new_folder(spark, "daily-events")
    append_batch(emitted, 0, path)
    return (
        read_events(spark, path)
        .groupBy(F.col("event_day").cast("string").alias("event_day"))
        .agg(
            F.count("*").alias("n_events"),
            F.count_if(F.col("status") == "complete").alias("n_complete"),
            F.min(F.unix_millis("event_time")).alias("first_ms"),
            F.max(F.unix_millis("event_time")).alias("last_ms"),
        )
    )


def _in_batches(spark: SparkSession, batches: list[DataFrame], **rules) -> LogTables:
    """Tables of the log job after these batches of records."""
    tables = LogTables.under(new_folder(spark, "log-tables"))
    for number, batch in enumerate(batches):
        run_log_batch(batch, number, tables, **rules)
    return tables


def _written(spark: SparkSession, tables: LogTables, batch: int) -> DataFrame:
    """The rows that one batch wrote."""
    rows = read_writes(spark, tables.events)
    return rows.filter(F.col("batch_id") == batch).drop("batch_id")


def attached_fragments(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches: what comes before the response in the first one, the rest in the second."""
    log, requests = records(spark, folder), F.col("offset") % 16 < 8
    batches = [log.filter(requests), log.filter(~requests)]
    return _plain(_written(spark, _in_batches(spark, batches, emit_fragments=True), 1))


def _two_periods(spark: SparkSession, folder: str) -> LogTables:
    log, early = _with_day(records(spark, folder)), F.col("day") < MIDDLE_DAY
    return _in_batches(spark, [log.filter(early).drop("day"), log.filter(~early).drop("day")])


def expired_events(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches cut by time: open events of the first one that the second one gives up."""
    written = _written(spark, _two_periods(spark, folder), 1)
    return _plain(written.filter(F.col("status") == TIMEOUT))


def dropped_fragments(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches cut by time: what came without an open event, as kept by the job."""
    return _plain(read_rows(spark, _two_periods(spark, folder).dropped))


def batch_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches with broken records among them: what the job kept of these."""
    log, early = _with_bad_lines(spark, folder), F.col("offset") % 32 < 16
    tables = _in_batches(spark, [log.filter(early), log.filter(~early)])
    return read_rows(spark, tables.malformed)


# Writes in which ``folded_malformed`` delivers its rows.
DELIVERIES = 20


def folded_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """The malformed records of the log in many small writes, the last of them twice; folded on the way, all are there."""
    with Staging(spark) as stage:
        rows = stage(malformed_lines(_with_bad_lines(spark, folder)), "malformed")
        table = VersionedTable(spark, new_folder(spark, "folded-malformed"))
        for number in (*range(DELIVERIES), DELIVERIES - 1):
            part = rows.filter(F.pmod("offset", F.lit(DELIVERIES)) == number)
            add_rows(table, part, number, part.count())
    return read_rows(spark, table.path)


# Bytes of a batch of the backlog.
BACKLOG_BYTES = 1 << 18


def backlog_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The whole log as a backlog in which one partition holds most records: ranges of batches of equal bytes."""
    log = records(spark, folder).withColumn("partition", (F.col("partition") == 0).cast("int"))
    return batch_ranges(log, BACKLOG_BYTES)


# Keys among which the notes of ``long_logs`` are dealt.
NOTE_KEYS = 20


def long_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches of nothing but other log for a few open exchanges; their whole text."""
    events = table(spark, folder, "events")
    prefix = F.lit("2024-01-10 10:00:00,000 a-b-c:d-1 user-")

    def lines(rows: DataFrame, user: Column, offset: Column, content: Column) -> DataFrame:
        value = F.concat(prefix, user.cast("string"), F.lit(" DEBUG c.f.Client "), content)
        columns = (F.lit("applog"), F.lit(0), offset, value)
        return rows.select(
            *[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, LOG_RECORD)]
        )

    user, number = F.col("user_id") % NOTE_KEYS, F.col("event_id")
    notes = [
        lines(
            events.filter(number % 3 == batch),
            user,
            number,
            F.concat(F.lit("note "), number.cast("string")),
        )
        for batch in range(3)
    ]
    users = events.select(user.alias("user")).distinct()
    one = F.col("user")
    starts = lines(users, one, one - NOTE_KEYS, F.lit("---> GET http://h/x HTTP/1.1"))
    ends = lines(users, one, one + (1 << 40), F.lit("<--- END HTTP"))
    batches = [notes[0].unionByName(starts), notes[1], notes[2].unionByName(ends)]
    events_path = _in_batches(spark, batches).events
    return read_events(spark, events_path).select("request_key", "status", "other_log")


def _two_writes(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All events, first as known before the response, then as known in the end: two tables, made in one pass of the log."""
    known = summarise_views(_classified(spark, folder), F.col("offset") % 16 < 8, F.lit(True))
    status = F.when(F.col("view") == 0, "fragment").otherwise("complete")
    path = new_folder(spark, "two-writes")
    emitted = to_emitted(known.withColumn("status", status), None, "view")
    emitted.write.partitionBy("view").parquet(path)
    early, final = (spark.read.schema(EMITTED).parquet(f"{path}/view={view}") for view in range(2))
    return early, final


def upserted_events(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of the same keys in one table, both delivered twice."""
    early, final = _two_writes(spark, folder)
    path = new_folder(spark, "upserted-events")
    for batch_id, batch in ((0, early), (1, final), (1, final), (0, early)):
        append_batch(batch, batch_id, path)
    return _plain(read_events(spark, path))


def compacted_events(spark: SparkSession, folder: str) -> DataFrame:
    """The same two batches, with the days folded after each; the later half of the days is
    read from writes that are not folded."""
    early, final = _two_writes(spark, folder)
    path = new_folder(spark, "compacted-events")
    append_batch(early, 0, path)
    compact_days(spark, path)
    append_batch(final, 1, path)
    compact_days(spark, path, before=datetime.date.fromisoformat(MIDDLE_DAY))
    return _plain(read_events(spark, path))


def upserted_days(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of the same keys folded into one table of the days they touch."""
    early, final = _two_writes(spark, folder)
    path = new_folder(spark, "upserted-days")
    upsert_days(early, 0, path)
    upsert_days(final, 1, path)
    return _plain(spark.read.parquet(path).drop("batch_id"))


def last_written_events(spark: SparkSession, folder: str) -> DataFrame:
    early, final = _two_writes(spark, folder)
    writes = early.withColumn("batch_id", F.lit(0).cast("long")).unionByName(
        final.withColumn("batch_id", F.lit(1).cast("long"))
    )
    return _plain(last_writes(writes)).select("request_key", "event_day", "status", "batch_id")


# Days at which the stream source is cut into three slices.
SLICE_DAYS = ("2024-01-11", "2024-01-21")
# Fewest and most files of a slice; between them there is one for each core.
SLICE_FILES, MOST_SLICE_FILES = 4, 16


def _with_day(log: DataFrame) -> DataFrame:
    """Records with the day of their text, so that a filter on it does not make the text again."""
    return computed_once(log, "day", F.substring("value", 1, 10))


def _slices(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The log in three slices of time; the files of a slice split it by exchange.

    Exchanges that cross a border between slices stay open from one to the next.
    """
    spans, day = zip((None, *SLICE_DAYS), (*SLICE_DAYS, None)), F.col("day")
    files, exchange = _slice_files(spark), F.shiftright("offset", 4)
    slices = []
    for first, end in spans:
        part = _with_day(records(spark, folder, first=first, end=end))
        part = part if first is None else part.filter(day >= first)
        part = part.filter(day.isNotNull() if end is None else day < end)
        slices.append(part.drop("day").repartition(files, exchange))
    return slices


def _slice_files(spark: SparkSession) -> int:
    return max(SLICE_FILES, min(MOST_SLICE_FILES, spark.sparkContext.defaultParallelism))


def _stream(spark: SparkSession, tables: LogTables, source: str, checkpoint: str, files: int, **rules) -> None:
    query = start_log_job(
        record_files(spark, source, files_per_trigger=files),
        tables,
        checkpoint,
        trigger={"availableNow": True},
        **rules,
    )
    query.awaitTermination()


def streamed_events(spark: SparkSession, folder: str) -> DataFrame:
    """The whole log through the stream, a micro-batch for each slice."""
    source = new_folder(spark, "stream-source")
    for part in _slices(spark, folder):
        part.write.mode("append").parquet(source)
    tables = LogTables.under(new_folder(spark, "stream-tables"))
    _stream(spark, tables, source, new_folder(spark, "stream-checkpoint"), _slice_files(spark))
    return _plain(read_events(spark, tables.events))


def streamed_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The whole log through the stream, restarted after each slice."""
    source, checkpoint = new_folder(spark, "batch-source"), new_folder(spark, "batch-checkpoint")
    tables = LogTables.under(new_folder(spark, "batch-tables"))
    for part in _slices(spark, folder):
        part.write.mode("append").parquet(source)
        _stream(spark, tables, source, checkpoint, 1000)
    return _plain(read_events(spark, tables.events))


# Offset at which a log of all requests, and then all responses, is cut.
RESPONSES = 1 << 40


def resumed_events(spark: SparkSession, folder: str) -> DataFrame:
    """All requests through one stream; then a new checkpoint over the whole log, which takes over what is open and
    skips what was read. Events, and how often each was written."""
    source, tables = new_folder(spark, "resumed-source"), LogTables.under(new_folder(spark, "resumed-tables"))
    response = F.col("offset") % 16 >= 8
    log = records(spark, folder).withColumn("offset", F.col("offset") + F.when(response, RESPONSES).otherwise(0))
    for part, resume in ((F.col("offset") < RESPONSES, False), (F.col("offset") >= RESPONSES, True)):
        log.filter(part).write.mode("append").parquet(source)
        _stream(spark, tables, source, new_folder(spark, "resumed-checkpoint"), 1000, resume=resume)
    writes = read_writes(spark, tables.events).groupBy("request_key").agg(F.count("*").alias("n_writes"))
    return _plain(read_events(spark, tables.events)).join(writes, "request_key")


# Members


def _import_time() -> Column:
    return F.timestamp_millis(F.lit(IMPORT_MS))


def _new(spark: SparkSession, folder: str) -> DataFrame:
    return new_members(table(spark, folder, "customer"))


def _old(spark: SparkSession, folder: str) -> DataFrame:
    return normalised_old_rows(old_members(table(spark, folder, "customer")), "seq")


def member_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _plain(to_member_rows(_new(spark, folder), PARTNER, _import_time()))


def member_points(spark: SparkSession, folder: str) -> DataFrame:
    points = loyalty_points(F.col("partner_point")).alias("point")
    return _new(spark, folder).select("partner_member_card", "seq", "partner_point", points)


def member_merge(spark: SparkSession, folder: str) -> DataFrame:
    new = to_member_rows(_new(spark, folder), PARTNER, _import_time())
    return _plain(merge_members(new, _old(spark, folder), _import_time()))


def member_merge_first_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Only the first partner row of a member counts, so old values are kept for doubles too."""
    new = first_per_member(to_member_rows(_new(spark, folder), PARTNER, _import_time()))
    return _plain(merge_members(new, _old(spark, folder), _import_time()))


def member_merge_shared_id(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the new and of the old rows carries one member id."""
    number = F.regexp_replace("partner_member_card", "[^0-9]", "").cast("long")
    shared = F.when(number % 3 == 1, F.lit("shared")).otherwise(F.col("partner_member_id"))
    new = _new(spark, folder).withColumn("partner_member_id", shared)
    old = _old(spark, folder).withColumn("partner_member_id", shared)
    rows = to_member_rows(new, PARTNER, _import_time())
    return _plain(merge_members(rows, old, _import_time()))


def _partner_files(spark: SparkSession, folder: str) -> str:
    """Partner rows as CSV files; every 29th card lacks its id, every 31st has odd points."""
    number = F.regexp_replace("partner_member_card", "[^0-9]", "").cast("long")
    rows = _new(spark, folder).withColumns(
        {
            "partner_member_id": F.when(number % 29 != 0, F.col("partner_member_id")),
            "partner_point": F.when(number % 31 == 0, F.lit("many")).otherwise(
                F.col("partner_point").cast("string")
            ),
        }
    )
    path = new_folder(spark, "partner-files")
    rows.select(*MEMBER_CSV.fieldNames()).write.csv(path)
    return path


def member_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_member_csv(spark, _partner_files(spark, folder))
    return rejected_rows(rows).select("partner_member_card", "partner_change", "reason")


def member_import(spark: SparkSession, folder: str) -> DataFrame:
    """The whole import from partner files into a table that it also reads."""
    target = new_folder(spark, "member-table")
    _old(spark, folder).drop("seq").write.parquet(target)
    old = spark.read.schema(MEMBER_TABLE).parquet(target)
    run_import(
        read_member_csv(spark, _partner_files(spark, folder)),
        old.withColumn("seq", F.col("id")),
        PARTNER,
        lambda rows: rows.repartition(20).write.mode("overwrite").parquet(target),
        _import_time(),
    )
    return _plain(spark.read.schema(MEMBER_TABLE).parquet(target))


def _versioned_import(spark: SparkSession, folder: str, imports: int = 1) -> tuple[str, str]:
    """Member table of versions, and history, after importing the same files some times."""
    target, history = new_folder(spark, "member-versions"), new_folder(spark, "import-history")
    with Staging(spark) as stage:
        replace_rows(stage(_old(spark, folder).drop("seq"), "old"), target)
    files = _partner_files(spark, folder)
    for _ in range(imports):
        import_versioned(read_member_csv(spark, files), target, PARTNER, _import_time(), history=history)
    return target, history


def member_import_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The whole import into a table that turns to the new rows at once, when they are checked."""
    return _plain(read_rows(spark, _versioned_import(spark, folder)[0]))


def import_history(spark: SparkSession, folder: str) -> DataFrame:
    """What the history says of two imports of the same files, the second over the result of the first."""
    history = read_rows(spark, _versioned_import(spark, folder, imports=2)[1])
    return history.drop("finished_at", "seconds", "staging", "rejects")


QUERIES: dict[str, Query] = {
    "log_lines": log_lines,
    "malformed_lines": bad_lines,
    "thread_client": thread_client,
    "fragments": all_fragments,
    "odd_fragments": odd_fragments,
    "fragment_counts": fragment_counts,
    "request_start_server": request_start_server,
    "assembled_events": assembled_events,
    "assembled_shared_keys": assembled_shared_keys,
    "event_bodies": event_bodies,
    "completeness": completeness,
    "events_by_start": events_by_start,
    "daily_events": daily_events,
    "attached_fragments": attached_fragments,
    "expired_events": expired_events,
    "dropped_fragments": dropped_fragments,
    "batch_malformed": batch_malformed,
    "folded_malformed": folded_malformed,
    "backlog_ranges": backlog_ranges,
    "long_logs": long_logs,
    "upserted_events": upserted_events,
    "compacted_events": compacted_events,
    "upserted_days": upserted_days,
    "last_written_events": last_written_events,
    "streamed_events": streamed_events,
    "streamed_batches": streamed_batches,
    "resumed_events": resumed_events,
    "member_rows": member_rows,
    "member_points": member_points,
    "member_merge": member_merge,
    "member_merge_first_rows": member_merge_first_rows,
    "member_merge_shared_id": member_merge_shared_id,
    "member_rejects": member_rejects,
    "member_import": member_import,
    "member_import_versions": member_import_versions,
    "import_history": import_history,
}
