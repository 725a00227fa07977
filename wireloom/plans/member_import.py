"""The member import: partner files into the JDBC member table."""

from __future__ import annotations

import datetime
import time
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wireloom.operators.members import (
    first_per_member,
    lacks_required,
    merge_members,
    normalised_old_rows,
    reject_reason,
    to_member_rows,
)
from wireloom.plans.staging import Staging, new_folder
from wireloom.plans.versions import Version, VersionedTable, add_rows, replace_rows
from wireloom.schema import MEMBER_TABLE
from wireloom.sources.members import (
    UNREADABLE,
    as_member_rows,
    read_member_csv,
    read_member_table,
    replace_member_table,
)


@dataclass(frozen=True)
class ImportSummary:
    rows_read: int
    rows_rejected: int
    old_rows: int
    rows_written: int
    rows_merged: int
    seconds: float
    staging: str
    rejects: str
    #: The version of a versioned member table that the import made.
    table_version: int | None = None


#: A row of the history of imports.
HISTORY = T.StructType(
    [
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("partner_code", T.StringType()),
        *[
            T.StructField(name, T.LongType())
            for name in ("table_version", "rows_read", "rows_rejected", "old_rows", "rows_written", "rows_merged")
        ],
        T.StructField("seconds", T.DoubleType()),
        T.StructField("staging", T.StringType()),
        T.StructField("rejects", T.StringType()),
    ]
)


def record_import(spark: SparkSession, summary: ImportSummary, partner_code: str, path: str) -> None:
    """Adds an import to the history at ``path`` (``plans.versions.read_rows`` reads it); rows are never changed."""
    known = {**asdict(summary), "partner_code": partner_code, "finished_at": datetime.datetime.now(datetime.timezone.utc)}
    row = spark.createDataFrame([[known[name] for name in HISTORY.fieldNames()]], HISTORY).coalesce(1)
    add_rows(VersionedTable(spark, path), row, None, 1)


def import_members(
    spark: SparkSession,
    csv: str,
    table: str,
    partner_code: str,
    url: str,
    properties: Mapping[str, str] | None = None,
    parallelism: int = 20,
    import_time: Column | None = None,
    dedupe_new: bool = False,
    read_options: Mapping[str, object] | None = None,
    history: str | None = None,
) -> ImportSummary:
    """Imports partner files over JDBC; every error is raised.

    ``read_options`` say how the scan of the table is split (see ``read_member_table``). The
    order of old rows of one member is the order of their ids.
    """
    for name, value in (("csv", csv), ("table", table), ("partner_code", partner_code)):
        if not value or not value.strip():
            raise ValueError(f"{name} is required")
    old = read_member_table(spark, url, table, properties, **(read_options or {}))
    return run_import(
        read_member_csv(spark, csv),
        as_member_rows(old).withColumn("seq", F.struct("id", *OLD_ORDER)),
        partner_code,
        lambda rows: replace_member_table(rows, url, table, properties, parallelism),
        import_time,
        dedupe_new,
        history,
    )


def import_versioned(
    partner_rows: DataFrame,
    path: str,
    partner_code: str,
    import_time: Column | None = None,
    dedupe_new: bool = False,
    history: str | None = None,
) -> ImportSummary:
    """Imports partner rows into a member table of versions (``plans.versions``).

    Readers see the old rows until the new ones are written and checked, then all of the new ones; a failure
    anywhere before leaves the old version. An import that another one overtook raises Superseded.
    """
    spark = partner_rows.sparkSession
    table = VersionedTable(spark, path)
    version = table.last()
    old = table.read(version.parts, MEMBER_TABLE)
    return run_import(
        partner_rows,
        old.withColumn("seq", F.struct("id", *OLD_ORDER)),
        partner_code,
        lambda rows: replace_rows(rows, path, made_from=version.version),
        import_time,
        dedupe_new,
        history,
    )


# Old rows of one member come in the order of these columns behind the id.
OLD_ORDER = ["generation_time", "partner_member_card", "point", "idcard_no", "unionId"]


def run_import(
    partner_rows: DataFrame,
    old_rows: DataFrame,
    partner_code: str,
    replace: Callable[[DataFrame], Version | None],
    import_time: Column | None = None,
    dedupe_new: bool = False,
    history: str | None = None,
) -> ImportSummary:
    """Merges, stages the result, and hands the staged rows to ``replace``.

    ``old_rows`` must carry ``seq``. Either input is read once, into a table of the run, so what
    is counted, checked and merged is the same even if the member table changes meanwhile. The
    merged rows stay where ``ImportSummary.staging`` says, so the table can be restored if
    replacing it fails half-way.

    Old rows with text that is no number or time stop the import: they would come back as
    zeros. The rows are listed in a table that the error names; the member table is unchanged.

    An import that succeeds adds a row to the table ``history``, if there is one.
    """
    spark = partner_rows.sparkSession
    started = time.monotonic()
    rejects = new_folder(spark, "member-rejects")
    staging = new_folder(spark, "member-staging")

    with Staging(spark) as stage:
        partner = stage(
            partner_rows.withColumn("reason", reject_reason(partner_rows)), "partner-rows"
        )
        bad = partner.filter(F.col("reason").isNotNull())
        bad.drop("seq").write.parquet(rejects)
        old = stage(normalised_old_rows(old_rows, "seq"), "old-rows")
        unreadable = old.filter(F.col(UNREADABLE) != "")
        seen = old.agg(F.count("*").alias("n"), F.count_if(F.col(UNREADABLE) != "").alias("lost"))
        seen = seen.first()
        if seen["lost"]:
            listed = new_folder(spark, "member-unreadable")
            unreadable.drop("seq").write.parquet(listed)
            raise ValueError(
                f"{seen['lost']} old rows have values that cannot be read; the table is"
                f" unchanged, the rows are in {listed}"
            )
        new = to_member_rows(partner, partner_code, import_time)
        if dedupe_new:
            new = first_per_member(new)
        written = Observation()
        merged = merge_members(new, old, import_time).observe(
            written,
            F.count("*").alias("n"),
            F.count_if("merged").alias("merged"),
            F.count_if(lacks_required()).alias("incomplete"),
        )
        merged.drop("merged").write.parquet(staging)
        rows_read, rejected = partner.count(), bad.count()
    if written.get["incomplete"]:
        raise ValueError(
            f"{written.get['incomplete']} old rows lack a required column; the table is"
            f" unchanged, the merged rows are in {staging}"
        )
    made = replace(spark.read.schema(MEMBER_TABLE).parquet(staging))
    summary = ImportSummary(
        rows_read=rows_read,
        rows_rejected=rejected,
        old_rows=seen["n"],
        rows_written=written.get["n"],
        rows_merged=written.get["merged"],
        seconds=time.monotonic() - started,
        staging=staging,
        rejects=rejects,
        table_version=made.version if isinstance(made, Version) else None,
    )
    if history:
        record_import(spark, summary, partner_code, history)
    return summary
