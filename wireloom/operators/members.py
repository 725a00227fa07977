"""Merging partner rows into the member table.

All rows of one ``partner_member_id`` count in the order new before old, then ``seq``. The
first row wins; if there is a second one, three columns are kept from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wireloom.schema import MEMBER_TABLE
from wireloom.sources.members import CORRUPT, as_member_rows

# Points from this number on are worth ten each, others five.
POINT_TIER = 10_000
HIGH_RATE = 10
LOW_RATE = 5

KEPT_FROM_SECOND = ["idcard_no", "unionId", "convert_status"]


def loyalty_points(partner_point: Column) -> Column:
    known = F.coalesce(partner_point, F.lit(0).cast("long"))
    return F.when(known >= POINT_TIER, known * HIGH_RATE).otherwise(known * LOW_RATE)


def reject_reason(rows: DataFrame) -> Column:
    """Why a partner row cannot be imported, or null."""
    corrupt = F.col(CORRUPT).isNotNull() if CORRUPT in rows.columns else F.lit(False)
    return F.when(corrupt, "does not fit the schema").when(
        F.col("partner_member_id").isNull(), "no member id"
    )


def rejected_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reason", reject_reason(rows)).filter(
        F.col("reason").isNotNull()
    )


def to_member_rows(
    rows: DataFrame, partner_code: str, import_time: Column | None = None
) -> DataFrame:
    """Rows of the member table, with ``seq``, from the valid partner rows."""
    known_points = F.coalesce("partner_point", F.lit(0).cast("long"))
    valid = rows.filter(reject_reason(rows).isNull())
    return valid.select(
        F.col("partner_member_id").alias("id"),
        F.lit(partner_code).alias("partner_code"),
        (F.current_timestamp() if import_time is None else import_time).alias(
            "generation_time"
        ),
        "partner_member_card",
        "user_name",
        "partner_member_id",
        "mobile_phone",
        known_points.alias("partner_point"),
        loyalty_points(F.col("partner_point")).alias("point"),
        F.coalesce("partner_change", F.lit("")).alias("partner_change"),
        F.lit("").alias("idcard_no"),
        F.lit("").alias("unionId"),
        F.lit(0).cast("long").alias("convert_status"),
        "seq",
    )


def normalised_old_rows(rows: DataFrame, *keep: str) -> DataFrame:
    """Existing rows with the types and defaults of the member table.

    Defaults stand for null only. What could not be read is named in ``unreadable``; such rows
    must not be written back.
    """
    typed = as_member_rows(rows, *keep)
    zero, empty = F.lit(0).cast("long"), F.lit("")
    return typed.withColumns(
        {
            "partner_point": F.coalesce("partner_point", zero),
            "point": F.coalesce("point", zero),
            "partner_change": F.coalesce("partner_change", empty),
        }
    )


def first_per_member(rows: DataFrame) -> DataFrame:
    """The first row of each member; for files whose later rows of a member do not count."""
    in_order = Window.partitionBy("partner_member_id").orderBy("seq")
    return (
        rows.withColumn("place", F.row_number().over(in_order))
        .filter(F.col("place") == 1)
        .drop("place")
    )


def merge_members(
    new: DataFrame, old: DataFrame, import_time: Column | None = None
) -> DataFrame:
    """The member table after the import, one row per member id.

    ``merged`` tells whether a row comes from more than one. Old rows without a member id
    belong to no member and pass unchanged.

    One shuffle, and one scan of either side. Only the first two rows of a member matter, and Spark keeps no more of them
    per map task (the filter on ``row_number`` limits groups before the shuffle), so a member
    id that fills a third of the rows is as cheap as any other.
    """
    now = F.current_timestamp() if import_time is None else import_time
    columns = MEMBER_TABLE.fieldNames()
    order = ["src", "new_seq", "old_seq"]
    nothing = F.lit(None)
    new_side = new.select(
        *columns,
        F.lit(0).alias("src"),
        F.col("seq").alias("new_seq"),
        nothing.cast(old.schema["seq"].dataType).alias("old_seq"),
    )
    old_side = old.select(
        *columns,
        F.lit(1).alias("src"),
        nothing.cast(new.schema["seq"].dataType).alias("new_seq"),
        F.col("seq").alias("old_seq"),
    )
    # A row without a member id is a group of its own.
    own = F.when(F.col("partner_member_id").isNull(), F.monotonically_increasing_id())
    rows = new_side.unionByName(old_side).withColumn("own", own)

    member = ["partner_member_id", "own"]
    in_order = Window.partitionBy(*member).orderBy(*order)
    pairs = rows.withColumn("place", F.row_number().over(in_order)).filter(
        F.col("place") <= 2
    )
    by_place = Window.partitionBy(*member).orderBy(*order)
    followed = pairs.withColumn(
        "second",
        F.lead(F.struct(*KEPT_FROM_SECOND)).over(by_place),
    ).filter(F.col("place") == 1)

    merged = F.col("second").isNotNull()
    result = {name: F.col(name) for name in columns}
    result["id"] = F.when(merged, F.col("partner_member_id")).otherwise(F.col("id"))
    result["generation_time"] = F.when(merged, now).otherwise(F.col("generation_time"))
    result["point"] = F.when(merged, loyalty_points(F.col("partner_point"))).otherwise(
        F.col("point")
    )
    for name in KEPT_FROM_SECOND:
        result[name] = F.when(merged, F.col("second")[name]).otherwise(F.col(name))
    return followed.select(
        *[value.alias(name) for name, value in result.items()], merged.alias("merged")
    )


def lacks_required() -> Column:
    """True for a member row with null in a column that must not be null."""
    missing = F.lit(False)
    for field in MEMBER_TABLE.fields:
        if not field.nullable:
            missing = missing | F.col(field.name).isNull()
    return missing
