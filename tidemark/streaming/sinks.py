"""Sinks: a keyed bar log with replay-safe batches, record publishing, CSV export, a database by way of staging."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.schemas import BAR_COLUMNS, BAR_CSV, BAR_KEY
from tidemark.operators.envelope import latest_by
from tidemark.operators.quality import constraint_violations, digest_matches, duplicate_keys, export_manifest


def guard(bars: DataFrame) -> None:
    """Raise unless all bars are final, have a start, meet the row constraints and have keys of their own.

    One aggregate decides about the rows; no row comes to the driver.
    """
    state = bars.agg(F.sum((~F.coalesce("is_final", F.lit(False))).cast("long")).alias("open"), F.sum(F.col("bar_start").isNull().cast("long")).alias("nowhere")).first()
    if state["open"]:
        raise ValueError("only final bars can be written")
    if state["nowhere"]:
        raise ValueError("bars need a bar_start")
    if constraint_violations(bars).limit(1).count():
        raise ValueError("bars break a constraint of the table")
    if duplicate_keys(bars).limit(1).count():
        raise ValueError("a batch has two bars with one key")


def with_epoch_micros(bars: DataFrame) -> DataFrame:
    """bar_start as microseconds since 1970, which no session's time zone shifts."""
    return bars.withColumn("bar_start_micros", F.unix_micros("bar_start"))


class BarLog:
    """A bar table as a log of batches. Every batch overwrites only its own folder, so a retry leaves one copy; the
    current bars are, for each key, those of the latest commit. A batch that breaks a rule writes nothing."""

    def __init__(self, spark: SparkSession, path: str, run_id: str | None = None) -> None:
        self.spark, self.path, self.run_id = spark, path.rstrip("/"), run_id or uuid.uuid4().hex

    def write_batch(self, bars: DataFrame, batch_id: int) -> int:
        """Write a batch of final bars; how many. An empty one writes nothing."""
        kept = bars.select(BAR_COLUMNS).persist()
        try:
            n = kept.count()
            if n:
                guard(kept)
                stamp = F.current_timestamp()
                out = kept.withColumn("spark_batch_id", F.lit(batch_id).cast("long")).withColumn("updated_at", stamp).withColumn("commit_seq", F.unix_micros(stamp))
                out.write.mode("overwrite").parquet(f"{self.path}/run_id={self.run_id}/batch={batch_id}")
            return n
        finally:
            kept.unpersist()

    def log(self) -> DataFrame:
        return self.spark.read.option("basePath", self.path).parquet(f"{self.path}/run_id=*/batch=*")

    def current(self) -> DataFrame:
        return current_bars(self.log()).select(*BAR_COLUMNS, "spark_batch_id", "updated_at")

    def compact(self, path: str) -> None:
        """The current bars as a table with a folder a day."""
        self.current().withColumn("bar_date", F.to_date("bar_start")).repartition("bar_date").write.mode("overwrite").partitionBy("bar_date").parquet(path)


def current_bars(log: DataFrame) -> DataFrame:
    """For each key the bar of the latest commit: the last writer wins, whatever its batch number."""
    return latest_by(log, BAR_KEY, ["commit_seq", "spark_batch_id"])


def publish_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.enable.idempotence": "true", "kafka.compression.type": "none", "kafka.linger.ms": "0"}


def publish(records: DataFrame, servers: str, topic: str) -> None:
    """key and value to a keyed log."""
    records.select("key", "value").write.format("kafka").options(**publish_options(servers, topic)).save()


UPSERT = (
    "INSERT INTO market_bars ({columns}) SELECT {columns} FROM {staging} ON CONFLICT (" + ", ".join(BAR_KEY) + ") DO UPDATE SET {assignments}, updated_at = now()"
)


def upsert_statement(staging: str) -> str:
    """The one statement by which a database takes a staged batch: new keys in, other columns of known keys replaced."""
    columns = [*BAR_COLUMNS, "spark_batch_id"]
    return UPSERT.format(columns=", ".join(columns), staging=staging, assignments=", ".join(f"{c} = EXCLUDED.{c}" for c in columns if c not in BAR_KEY))


def stage_batch(bars: DataFrame, batch_id: int, url: str, staging: str, properties: dict[str, str]) -> None:
    """Executors write a guarded batch to a staging table; the database then runs `upsert_statement`."""
    guard(bars)
    bars.select(BAR_COLUMNS).withColumn("spark_batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").jdbc(url, staging, properties=properties)


def sink_of(url: str, properties: dict[str, str], run: Callable[[str], None], staging: str = "market_bars_staging") -> Callable[[DataFrame, int], None]:
    """A foreachBatch function bound to a database: stages a batch and has `run` (the driver's connection) take it over.

    The address and its secrets stay inside; neither is part of the plan or logged.
    """

    def write(batch: DataFrame, number: int) -> None:
        if batch.limit(1).count():
            stage_batch(batch, number, url, staging, properties)
            run(upsert_statement(staging))

    return write


def export_csv(bars: DataFrame, path: str, root: str | None = None, expected_sha256: str | None = None) -> DataFrame:
    """Bars in order as one CSV with a header, and a manifest row: rows, first and last bar, fields, sha256, matches.

    An export of nothing is an error, and so is a path outside `root`. The digest is over the ordered canonical lines;
    `matches` tells whether it is `expected_sha256` (null without one). For exports that fit in memory.
    """
    if root is not None and os.path.commonpath([os.path.realpath(path), os.path.realpath(root)]) != os.path.realpath(root):
        raise ValueError("an export must stay inside its folder")
    if not bars.limit(1).count():
        raise ValueError("nothing to export")
    bars.select(BAR_CSV.fieldNames()).orderBy("bar_start", "symbol", "source", "feed").coalesce(1).write.mode("overwrite").option("header", True).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ssXXX").csv(path)
    digest = digest_matches(bars.withColumn("__all", F.lit(True)), expected_sha256, "__all").select("sha256", "matches")
    return export_manifest(bars).crossJoin(digest)  # one row each
