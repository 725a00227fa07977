"""A backlog in batches of equal bytes, planned from offsets and sizes; no record is left out.

Each topic partition gives every batch the same share of its bytes, in the order of its offsets. So batches
are alike even if one partition holds nearly all of the log, and all partitions move through time together.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

#: Stretches of offsets for each batch of a partition: a batch misses its share by about one stretch at most.
FINENESS = 64

#: Bytes that a record takes beside its value.
OVERHEAD = 1

PLACE = ["topic", "partition"]


def batch_ranges(records: DataFrame, target_bytes: int) -> DataFrame:
    """topic, partition, batch (from 0), from_offset, until_offset (exclusive), bytes, n_records.

    As many batches as the target asks for. A partition is summed over at most FINENESS stretches a
    batch before anything is ordered, whatever its length. The ranges of a partition follow one another; a partition that
    has less than a stretch for some batch has no row there. Records without an offset
    count for their partition's lowest stretch; ``of_batch`` gives them to batch 0. An empty table has no ranges.
    """
    if target_bytes < 1:
        raise ValueError("target_bytes must be positive")
    size = F.coalesce(F.octet_length("value"), F.lit(0)) + OVERHEAD
    sized = records.select(*PLACE, "offset", size.cast("long").alias("bytes"))
    spans = sized.groupBy(*PLACE).agg(F.min("offset").alias("first"), F.max("offset").alias("last"), F.sum("bytes").alias("held"))
    rows = spans.collect()  # one for each topic partition
    n = max(1, -(-sum(row["held"] for row in rows) // target_bytes))
    width = F.expr(f"(last - first + {FINENESS * n}) div {FINENESS * n}").alias("width")
    spots = records.sparkSession.createDataFrame(rows, spans.schema).select("*", width)
    t, p = F.col("t"), F.col("p")
    spots = spots.withColumnsRenamed({"topic": "t", "partition": "p"})
    known = sized.join(F.broadcast(spots), F.col("topic").eqNullSafe(t) & F.col("partition").eqNullSafe(p))
    at = F.coalesce(F.expr("(offset - first) div width"), F.lit(0).cast("long"))
    stretches = known.groupBy(*PLACE, at.alias("stretch")).agg(
        F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n_records"), F.first("held").alias("held"),
        F.first("first").alias("first"), F.first("last").alias("last"), F.first("width").alias("width"),
    )
    before = Window.partitionBy(*PLACE).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("bytes").over(before), F.lit(0)) * 2 + F.col("bytes")
    batch = F.expr(f"(cast(middle AS decimal(24,0)) * {n}) div (2 * held)")
    cut = stretches.withColumn("middle", middle).withColumn("batch", batch)
    until = F.least(F.max(F.col("first") + (F.col("stretch") + 1) * F.col("width")), F.max("last") + 1)
    return cut.groupBy(*PLACE, "batch").agg(
        F.min(F.col("first") + F.col("stretch") * F.col("width")).alias("from_offset"), until.alias("until_offset"),
        F.sum("bytes").alias("bytes"), F.sum("n_records").alias("n_records"),
    )


def of_batch(records: DataFrame, ranges: Iterable[Row], batch: int) -> DataFrame:
    """The records of one batch; ``ranges`` has a row for each topic partition of it.

    Records without an offset belong to batch 0.
    """
    rows = [(r["topic"], r["partition"], r["from_offset"], r["until_offset"]) for r in ranges]
    wanted = records.sparkSession.createDataFrame(rows, "t string, p int, low bigint, high bigint")
    place = F.col("topic").eqNullSafe(F.col("t")) & F.col("partition").eqNullSafe(F.col("p"))
    inside = (F.col("offset") >= F.col("low")) & (F.col("offset") < F.col("high"))
    found = records.filter(F.col("offset").isNotNull()).join(F.broadcast(wanted), place & inside).select(*records.columns)
    return found if batch else found.unionByName(records.filter(F.col("offset").isNull()))


def kafka_offsets(ranges: Iterable[Row]) -> tuple[str, str]:
    """The ranges of one batch as Kafka's options ``startingOffsets`` and ``endingOffsets``.

    Partitions without a range in the batch must be left out of the subscription (``assign``).
    """
    low: dict[str, dict[str, int]] = {}
    high: dict[str, dict[str, int]] = {}
    for row in ranges:
        low.setdefault(row["topic"], {})[str(row["partition"])] = row["from_offset"]
        high.setdefault(row["topic"], {})[str(row["partition"])] = row["until_offset"]
    return json.dumps(low), json.dumps(high)
