"""Log records and member tables derived from the tables of a star schema.

The test tables hold no trace log and no members. Both are derived from ``events`` and
``customer`` by plain projections, so they grow with those tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINES_PER_EVENT = 13


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the tables, spread over all cores if its files make fewer splits than that."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# No text begins with a day as such behind this one.
LAST_DAY = "9999-12-30"


def log_records(
    events: DataFrame, key: Column | None = None, first: str | None = None, end: str | None = None
) -> DataFrame:
    """Up to thirteen log records for every event, as one exchange of key ``req-<event_id>``.

    Every tenth event lacks its start, its end, or both, and every fourth its request body.
    ``key`` sets another request key. With ``first`` and ``end`` records that cannot be of a day from ``first``, or of one
    before ``end``, may be left out before their text is made.
    """
    e, j = F.col("event_id"), F.col("j")
    text = lambda *parts: F.concat(
        *[p if isinstance(p, Column) else F.lit(p) for p in parts]
    )
    s = lambda c: F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    waited = F.floor("value").cast("long")
    delay = F.when(j < 8, j.cast("long")).otherwise(j + waited)
    at = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + delay * 1000)
    content = (
        F.when(
            j == 0,
            text(
                "---> ",
                F.when(e % 4 == 0, "GET").otherwise("POST"),
                " http://host-",
                F.col("event_type"),
                "/v2/",
                s("user_id"),
                " HTTP/1.1",
            ),
        )
        .when(j == 1, text("x-event-id: E", s(e)))
        .when(j == 2, text("X-Event-Type: ", F.col("event_type")))
        .when(j == 3, text("x-event-code: C", s(e % 5)))
        .when(j == 4, text("x-event-platform: P", s(F.col("user_id") % 3)))
        .when(j == 5, text("X-Event-Sequence: ", s(e)))
        .when(j == 6, F.col("props"))
        .when(j == 7, "---> END HTTP (10-byte body)")
        .when(
            j == 8,
            text(
                "<--- HTTP/1.1 ",
                F.when(F.col("event_type") == "error", "500").otherwise("200"),
                " OK (",
                s(waited),
                "ms)",
            ),
        )
        .when(j == 9, "x-application-context: svc:dev:8080")
        .when(j == 10, "Accept: application/json")
        .when(j == 11, text('{"ok": ', s(e), "}"))
        .otherwise("<--- END HTTP (12-byte body)")
    )
    value = text(
        F.date_format(at, "yyyy-MM-dd HH:mm:ss,SSS"),
        " hystrix-grp-svc",
        s(F.col("user_id") % 5),
        ":dev:808",
        s(F.col("user_id") % 3),
        "-",
        s(e % 7),
        " ",
        F.concat(F.lit("req-"), s(e)) if key is None else key,
        " DEBUG c.f.Client ",
        content,
    )
    there = ~(
        ((j == 12) & (e % 10).isin(3, 7))
        | ((j == 0) & (e % 10).isin(5, 7))
        | ((j == 6) & (e % 4 == 0))
    )
    # The text shows the day on the clock of the session, as this does.
    day, within = at.cast("date"), F.lit(True)
    if first is not None:
        within = within & (day >= F.lit(first).cast("date"))
    if end is not None:
        within = within & ((day < F.lit(end).cast("date")) | (day > F.lit(LAST_DAY).cast("date")))
    return (
        events.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(LINES_PER_EVENT - 1))))
        .filter(there & within)
        .select(
            F.lit("applog").alias("topic"),
            (e % 3).cast("int").alias("partition"),
            (e * 16 + j).alias("offset"),
            value.alias("value"),
        )
    )


def _points() -> Column:
    return F.floor(F.greatest("c_acctbal", F.lit(0.0)) * 2).cast("long")


def new_members(customer: DataFrame) -> DataFrame:
    """Rows of a partner file with their row number ``seq``; every 25th member comes twice."""
    k, d = F.col("c_custkey"), F.col("d")
    return (
        customer.withColumn("d", F.explode(F.array(F.lit(0), F.lit(1))))
        .filter((k % 3 != 0) & ((d == 0) | (k % 25 == 1)))
        .select(
            F.concat(F.lit("card"), k.cast("string")).alias("partner_member_card"),
            F.col("c_name").alias("user_name"),
            F.concat(F.lit("m"), k.cast("string")).alias("partner_member_id"),
            F.concat(F.lit("138"), k.cast("string")).alias("mobile_phone"),
            F.when(k % 17 != 0, _points() + d).alias("partner_point"),
            F.concat(F.lit("chg"), d.cast("string")).alias("partner_change"),
            (k * 2 + d).alias("seq"),
        )
    )


def old_members(customer: DataFrame) -> DataFrame:
    """Rows of an existing member table with their row number ``seq``."""
    k = F.col("c_custkey")
    tagged = lambda tag: F.concat(F.lit(tag), k.cast("string"))
    return customer.filter(k % 2 == 0).select(
        tagged("m").alias("id"),
        F.lit("old").alias("partner_code"),
        F.timestamp_millis(F.lit(1577836800000)).alias("generation_time"),
        tagged("ocard").alias("partner_member_card"),
        F.col("c_name").alias("user_name"),
        tagged("m").alias("partner_member_id"),
        tagged("139").alias("mobile_phone"),
        _points().alias("partner_point"),
        (_points() * 3).alias("point"),
        F.lit("old").alias("partner_change"),
        tagged("ID").alias("idcard_no"),
        tagged("U").alias("unionId"),
        (k % 4).cast("long").alias("convert_status"),
        k.alias("seq"),
    )
