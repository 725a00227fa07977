"""The order of rows as a column: places in a total order without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wireloom.plans.staging import new_folder

#: Fixed value: monotonically_increasing_id() numbers the rows of a partition in its low bits.
ROW_BITS = 33


def numbered(rows: DataFrame, *order: Column | str, name: str = "place") -> DataFrame:
    """Rows with ``name``, a bigint: 1, 2, 3 ... in the given order.

    Rows are dealt by ranges of the order and sorted in each range; counts of the ranges, one row
    each, tell where each begins. The sorted rows are written as a table under
    ``spark.checkpoint.dir``, so places stay the same when executors are lost. Rows that are equal in
    ``order`` are placed one after the other as they come; a range cannot split them, so make the order total
    where many may be equal. No rows give none. A column called ``name`` is replaced.
    """
    spark, inner = rows.sparkSession, "_row_of_range"
    path = new_folder(spark, "ordered")
    # The order is taken before a column of that name is replaced.
    at = F.monotonically_increasing_id()
    ordered = rows.orderBy(*order).drop(name).withColumn(inner, at)
    ordered.write.parquet(path)
    ordered = spark.read.schema(ordered.schema).parquet(path)
    part = F.shiftright(inner, ROW_BITS)
    counts = ordered.groupBy(part.alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.col(inner).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    placed = ordered.withColumn("_range", part).join(F.broadcast(starts), "_range")
    return placed.withColumn(name, F.col("_before") + within + 1).drop("_range", "_before", inner)


def first_of_groups(rows: DataFrame, n: int, groups: list[str], *order: Column, parts: int = 64) -> DataFrame:
    """The first ``n`` rows of each group in a total order.

    Each group is dealt over ``parts`` tasks first, so that none of them sees a whole group, even one that
    holds most rows; Spark keeps no more than ``n`` rows of a group in the map tasks too.
    """
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.lit(parts)))
    for keys in ([*groups, "_part"], groups):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        dealt = dealt.withColumn("_place", place).filter(F.col("_place") <= n)
    return dealt.drop("_part", "_place")
