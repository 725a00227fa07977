"""Reading partner files and the existing member table; writing the table back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireloom.schema import MEMBER_CSV, MEMBER_TABLE

CORRUPT = "corrupt_record"
UNREADABLE = "unreadable"


def read_member_csv(
    spark: SparkSession, path: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows of headerless partner files, with ``seq``, their place in the files.

    Files come in the order of their names. ``corrupt_record`` holds what does not fit the
    schema, the row or its points, and is null for all other rows. Points are read as text and
    cast here: the reader would check them only in plans that use them.
    """
    settings = {
        "header": "false",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "columnPruning": "false",
        **(options or {}),
    }
    columns = [f"{name} string" for name in MEMBER_CSV.fieldNames()]
    rows = spark.read.schema(", ".join([*columns, f"{CORRUPT} string"])).options(**settings)
    points = F.col("partner_point").try_cast("long")
    bad_points = F.when(points.isNull(), F.col("partner_point"))
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.csv(path).select(
        *[c for c in MEMBER_CSV.fieldNames() if c != "partner_point"],
        points.alias("partner_point"),
        F.coalesce(CORRUPT, bad_points).alias(CORRUPT),
        place.alias("seq"),
    )


def as_member_rows(df: DataFrame, *keep: str) -> DataFrame:
    """The thirteen columns of the member table, by name and with their types.

    Text that is no number or time becomes null; ``unreadable`` lists the columns where that
    happened, and is empty for all other rows.
    """
    columns = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in MEMBER_TABLE.fields]
    lost = [
        F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), f.name)
        for f in MEMBER_TABLE.fields
    ]
    before = F.col(UNREADABLE) if UNREADABLE in df.columns else F.lit(None)
    listed = F.coalesce(F.nullif(before, F.lit("")), F.concat_ws(", ", *lost))
    return df.select(*columns, listed.alias(UNREADABLE), *keep)


def read_member_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    predicates: Sequence[str] | None = None,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 20,
    fetch_size: int = 10_000,
) -> DataFrame:
    """The existing member table over JDBC, in several connections.

    ``predicates`` (one per partition) or a numeric ``column`` with ``bounds`` split the scan;
    one of them is required, as the whole table through one connection is one task.
    ``fetch_size`` is the number of rows of a round trip.
    """
    properties = {"fetchsize": str(fetch_size), **(properties or {})}
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=properties)
    if not column or not bounds:
        raise ValueError("give predicates, or a column and its bounds, to split the scan by")
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
        properties=properties,
    )


def replace_member_table(
    staged_rows: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partitions: int = 20,
    batch_size: int = 5000,
) -> None:
    """Overwrites the table with rows that are already staged.

    The rows must not depend on the table any more, because it is emptied first. It keeps its
    definition (``truncate``).
    """
    (
        staged_rows.repartition(partitions)
        .write.mode("overwrite")
        .option("truncate", "true")
        .option("batchsize", batch_size)
        .jdbc(url, table, properties=dict(properties or {}))
    )
