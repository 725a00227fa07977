"""What becomes of an assembled event: complete, open, attached, expired or dropped."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wireloom.functions.clock import log_day, whole_minutes
from wireloom.operators.assemble import Summed, carrying, join_exchanges, text_rows, to_events
from wireloom.schema import EMITTED, EXCHANGE

# Fixed value: an open event older than this many whole minutes is given up.
EXPIRE_MINUTES = 15

# Completeness of an event within one batch.
COMPLETE = "complete"
OPEN = "open"
END_ONLY = "end_only"
NEITHER = "neither"

# The order of events.
START_ORDER = ("start_time", "request_key")

# Status of an emitted row.
TIMEOUT = "timeout"
FRAGMENT = "fragment"

# Status of what belongs to no open event.
DROPPED = "dropped"


def completeness(start: Column, end: Column) -> Column:
    return (
        F.when(start.isNotNull() & end.isNotNull(), COMPLETE)
        .when(start.isNotNull(), OPEN)
        .when(end.isNotNull(), END_ONLY)
        .otherwise(NEITHER)
    )


def with_completeness(events: DataFrame) -> DataFrame:
    return events.withColumn(
        "completeness", completeness(F.col("start_time"), F.col("end_time"))
    )


def by_start(events: DataFrame) -> DataFrame:
    """Events that have a start, earliest first; a range-partitioned sort. ``order.numbered`` gives their places."""
    return events.filter(F.col("start_time").isNotNull()).orderBy(*START_ORDER)


def with_event_day(events: DataFrame) -> DataFrame:
    return events.withColumn("event_day", log_day(F.col("event_time")))


def is_expired(
    clock: Column, start: Column, expire_minutes: int = EXPIRE_MINUTES
) -> Column:
    """More than ``expire_minutes`` whole minutes have passed since ``start``."""
    return F.coalesce(whole_minutes(clock, start) > expire_minutes, F.lit(False))


def batch_clock(batch: DataFrame, open_exchanges: DataFrame) -> DataFrame:
    """One row, one column: the time of the first event that this batch gives out.

    That is the earliest start among its complete events, or else the earliest time of a
    fragment that belongs to an open exchange. Null if the batch gives out nothing.
    """
    complete = F.col("start").isNotNull() & F.col("end_ts").isNotNull()
    first_complete = batch.agg(F.min(F.when(complete, F.col("start.ts"))).alias("ts"))
    attached = batch.filter(F.col("start").isNull()).join(
        open_exchanges.select("request_key"), "request_key", "left_semi"
    )
    first_attached = attached.agg(F.min("first_ts").alias("ts"))
    ranked = first_complete.withColumn("rank", F.lit(0)).unionByName(
        first_attached.withColumn("rank", F.lit(1))
    )
    known = F.when(F.col("ts").isNotNull(), F.col("rank"))
    return ranked.agg(F.min_by("ts", known).alias("clock"))


@dataclass(frozen=True)
class Reconciled:
    """Outcome of one batch; each part is lazy."""

    emitted: DataFrame  # rows of schema EMITTED
    still_open: Summed  # for the next batch
    dropped: DataFrame  # rows of schema EMITTED: what came without an open event
    decided: DataFrame  # exchange rows with the batch's ``texts``, ``status``, ``known`` (open before), ``seen`` (in the batch)


def reconcile(
    batch: Summed,
    before: Summed,
    clock: DataFrame | None = None,
    expire_minutes: int = EXPIRE_MINUTES,
    emit_fragments: bool = False,
    keep: Callable[[DataFrame], DataFrame] = lambda decided: decided,
) -> Reconciled:
    """Continues the open exchanges with those of a batch.

    Exchange rows are one per key on both sides, so their join cannot be skewed. They are read
    several times, so they should be tables; so is the fate of every exchange, which ``keep``
    may put into a table. The rows of a batch carry their texts (``summarise``, ``sum_batch``); only events that were open
    before are joined with text rows, those of the open exchanges. ``clock`` is a one-row frame as ``batch_clock``
    makes it; it enters the plan as a scalar subquery.
    """
    clock = batch_clock(batch.exchanges, before.exchanges) if clock is None else clock
    later = batch.exchanges if "texts" in batch.exchanges.columns else carrying(batch.exchanges, batch.texts)
    joined = join_exchanges(before.exchanges, later, "texts")
    ended = F.col("start").isNotNull() & F.col("end_ts").isNotNull()
    expired = F.col("known") & is_expired(clock.scalar(), F.col("start.ts"), expire_minutes)
    fate = (
        F.when(F.col("start").isNull(), DROPPED)
        .when(ended, COMPLETE)
        .when(expired, TIMEOUT)
        .otherwise(OPEN)
    )
    decided = keep(joined.withColumn("status", fate))
    given_out = decided.filter(F.col("status").isin(COMPLETE, TIMEOUT))
    continued = carrying(given_out.filter("known"), before.texts)
    emitted = to_emitted(given_out.filter("NOT known"), None).unionByName(to_emitted(continued, None))
    if emit_fragments:
        emitted = to_emitted(attached_fragments(later, before.exchanges), None).unionByName(emitted)
    still_open = decided.filter(F.col("status") == OPEN)
    kept = still_open.select(*EXCHANGE.fieldNames())
    old_texts = before.texts.join(kept.select("request_key"), "request_key", "left_semi")
    return Reconciled(
        emitted=emitted,
        still_open=Summed(kept, old_texts.unionByName(text_rows(still_open))),
        # What was open before has a start, so nothing of it is dropped.
        dropped=to_emitted(decided.filter(F.col("status") == DROPPED), None),
        decided=decided,
    )


def attached_fragments(batch: DataFrame, open_exchanges: DataFrame) -> DataFrame:
    """Exchange rows without a start that belong to an open exchange."""
    return (
        batch.filter(F.col("start").isNull())
        .join(open_exchanges.select("request_key"), "request_key", "left_semi")
        .withColumn("status", F.lit(FRAGMENT))
    )


def to_emitted(exchanges: DataFrame, texts: DataFrame | None, *keep: str) -> DataFrame:
    """Rows of schema ``EMITTED`` from exchange rows that have a ``status``; ``keep`` names further columns."""
    return with_event_day(to_events(exchanges, texts, "status", *keep)).select(*EMITTED.fieldNames(), *keep)
