"""Log records from Kafka, or from any table with the same four columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wireloom.schema import LOG_RECORD


def as_records(df: DataFrame) -> DataFrame:
    """The four record columns of a Kafka source or of a table that has them."""
    return df.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in LOG_RECORD]
    )


def _options(servers: str, topics: str, options: Mapping[str, str] | None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": "earliest",
        **(options or {}),
    }


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topics: str,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Stream of log records, from the earliest offset unless a checkpoint knows better.

    Consumer settings go into ``options`` with the prefix ``kafka.``. A micro-batch takes all
    that has come; ``maxOffsetsPerTrigger`` bounds it where a backlog should be worked off in
    parts.
    """
    settings = _options(servers, topics, options)
    return as_records(spark.readStream.format("kafka").options(**settings).load())


def kafka_batch(
    spark: SparkSession,
    servers: str,
    topics: str,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """All log records between the starting and the ending offsets."""
    return as_records(
        spark.read.format("kafka").options(**_options(servers, topics, options)).load()
    )


def record_files(
    spark: SparkSession, path: str, files_per_trigger: int = 1
) -> DataFrame:
    """Stream of log records from parquet files that appear in a folder."""
    return (
        spark.readStream.schema(LOG_RECORD)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )
