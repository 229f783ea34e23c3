"""Event, page and bar sources. The log connector is only named here; a deployment brings its package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.schemas import BAR_CSV, PAGE

LOG_COLUMNS = ["value", "topic", "partition", "offset", "timestamp"]


def log_options(servers: str, topic: str, starting_offsets: str = "latest") -> dict[str, str]:
    if starting_offsets not in ("latest", "earliest"):
        raise ValueError("starting offsets are latest or earliest")
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets, "failOnDataLoss": "true"}


def log_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest") -> DataFrame:
    """A keyed log as a stream of value and metadata."""
    return spark.readStream.format("kafka").options(**log_options(servers, topic, starting_offsets)).load().select(LOG_COLUMNS)


def log_batch(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """All that the log holds now."""
    return spark.read.format("kafka").options(**log_options(servers, topic, "earliest")).load().select(LOG_COLUMNS)


def text_records(spark: SparkSession, path: str) -> DataFrame:
    """One event a line, bounded."""
    return spark.read.text(path)


def replay_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Landed text files as a stream, in the order of their times; some files a trigger for ordered replays."""
    reader = spark.readStream.schema("value string")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of historical trades as they were landed. A page whose trades or token has another type fails the job."""
    return spark.read.schema(PAGE).option("mode", "FAILFAST").json(path)


def bar_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def bar_csv(spark: SparkSession, path: str) -> DataFrame:
    """Bars as exported: a header and 13 fields."""
    return spark.read.schema(BAR_CSV).option("header", True).option("enforceSchema", False).csv(path)


def page_bounds(limit: int, max_pages: int, start: str, end: str, spark: SparkSession) -> None:
    """Check what a historical request may ask for: 1 to 10,000 trades a page, a page at least, a span with zones."""
    if not 1 <= limit <= 10_000:
        raise ValueError("limit is 1 to 10000")
    if max_pages < 1:
        raise ValueError("at least one page")
    row = spark.range(1).select(
        *[F.lit(x).rlike(r"(Z|[+-]\d{2}:\d{2})$").alias(n) for n, x in (("start_zoned", start), ("end_zoned", end))], (F.try_to_timestamp(F.lit(start)) < F.try_to_timestamp(F.lit(end))).alias("ordered")
    ).first()
    if not (row["start_zoned"] and row["end_zoned"]):
        raise ValueError("bounds need a zone")
    if not row["ordered"]:
        raise ValueError("start must be before end")
