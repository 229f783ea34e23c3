"""The bar log with a dated base under it: batches are merged in, whole days dropped, and readers see one version.

A version is one small file that names the folder of each day and the batches that are in them. Everything it names is
written before it, and nothing that it names is deleted while it counts, so a crash between two steps leaves the version
before. One writer at a time.
"""

from __future__ import annotations

import json
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.schemas import BAR, BAR_COLUMNS
from tidemark.operators.features import by_windows

from .sinks import BarLog, current_bars

STORED = T.StructType([*BAR.fields, T.StructField("spark_batch_id", T.LongType()), T.StructField("updated_at", T.TimestampType()), T.StructField("commit_seq", T.LongType())])
NOTHING = {"version": 0, "days": {}, "merged": []}


class BarStore:
    def __init__(self, spark: SparkSession, path: str, run_id: str | None = None) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.log = BarLog(spark, f"{self.path}/log", run_id)
        self.write_batch = self.log.write_batch

    # files, by way of Hadoop's file systems, so that any shared store will do

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{path}")
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        where, files = self._at(path)
        return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []

    def _delete(self, path: str) -> None:
        where, files = self._at(path)
        files.delete(where, True)

    def manifest(self) -> dict:
        """The version that counts: the latest."""
        names = [n for n in self._names("versions") if n.endswith(".json")]
        if not names:
            return NOTHING
        where, files = self._at(f"versions/{max(names)}")
        with_ = files.open(where)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(with_, "UTF-8"))
        finally:
            with_.close()

    def _commit(self, version: int, days: dict[str, str], merged: list[str]) -> None:
        """The version appears as a whole, by a rename, or not at all."""
        name = f"versions/{version:012d}"
        draft, files = self._at(f"{name}.draft")
        final, _ = self._at(f"{name}.json")
        if files.exists(final):
            raise ValueError(f"version {version} is there: another writer came first")
        out = files.create(draft, True)
        out.write(bytearray(json.dumps({"version": version, "days": days, "merged": merged}).encode()))
        out.close()
        if not files.rename(draft, final):
            raise ValueError(f"version {version} couldn't be written")

    # bars

    def _logged(self) -> list[str]:
        return [f"{run}/{b}" for run in self._names("log") if run.startswith("run_id=") for b in self._names(f"log/{run}") if b.startswith("batch=")]

    def _batches(self, manifest: dict) -> list[str]:
        """Batches that the version's days don't hold."""
        return [b for b in self._logged() if b not in manifest["merged"]]

    def _read(self, folders: list[str]) -> DataFrame:
        read = self.spark.read.schema(STORED)
        found = read.parquet(*[f"{self.path}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], STORED)
        return found.select(STORED.fieldNames())

    def _merged(self, manifest: dict, batches: list[str]) -> tuple[DataFrame, list[str]]:
        """The latest bar of each key on the days that the batches touch, and these days."""
        newer = self._read([f"log/{b}" for b in batches])
        days = sorted(str(r[0]) for r in newer.select(F.to_date("bar_start")).distinct().collect())  # days, not rows
        return current_bars(self._read([manifest["days"][d] for d in days if d in manifest["days"]]).unionByName(newer)), days

    def current(self) -> DataFrame:
        """For each key the bar of the latest commit. Days that no newer batch touches are read as they are."""
        m = self.manifest()
        fresh, days = self._merged(m, self._batches(m))
        still = self._read([folder for d, folder in sorted(m["days"].items()) if d not in days])
        return still.unionByName(fresh).select(*BAR_COLUMNS, "spark_batch_id", "updated_at")

    def _write_days(self, bars: DataFrame, version: int) -> dict[str, str]:
        """Folders by day. A day is dealt out over tasks by symbol."""
        base = f"base/version={version:012d}"
        self._delete(base)  # what a crash may have left
        bars.withColumn("bar_date", F.to_date("bar_start")).repartition("bar_date", "symbol").write.partitionBy("bar_date").parquet(f"{self.path}/{base}")
        return {n.removeprefix("bar_date="): f"{base}/{n}" for n in self._names(base) if n.startswith("bar_date=")}

    def merge(self) -> int:
        """Take all new batches into the days that they touch; the version's number."""
        m = self.manifest()
        batches = self._batches(m)
        if not batches:
            return m["version"]
        fresh, _ = self._merged(m, batches)
        self._commit(m["version"] + 1, m["days"] | self._write_days(fresh, m["version"] + 1), [b for b in m["merged"] if b in self._logged()] + batches)
        return m["version"] + 1

    def expire(self, now: date, days: int, kept: DataFrame | None = None) -> dict[str, int]:
        """Drop days that end `days` or more before `now`, but for bars inside the windows `kept` (symbol, start, end);
        how many bars each of these days had before. New batches are merged first."""
        self.merge()
        m = self.manifest()
        limit = str(now - timedelta(days=days))
        old = sorted(d for d in m["days"] if d < limit)
        if not old:
            return {}
        bars = self._read([m["days"][d] for d in old])
        before = {str(r["day"]): r["count"] for r in bars.groupBy(F.to_date("bar_start").alias("day")).count().collect()}
        staying = self._write_days(by_windows(bars, kept, "left_semi"), m["version"] + 1) if kept is not None else {}
        self._commit(m["version"] + 1, {d: f for d, f in m["days"].items() if d >= limit} | staying, m["merged"])
        return before

    def vacuum(self) -> None:
        """Delete what the latest version doesn't name. Readers of earlier versions must be done."""
        m = self.manifest()
        for version in self._names("base"):
            named = {f.split("/")[2] for f in m["days"].values() if f.startswith(f"base/{version}/")}
            for day in self._names(f"base/{version}"):
                if day not in named:
                    self._delete(f"base/{version}/{day}")
            if not named:
                self._delete(f"base/{version}")
        for batch in m["merged"]:
            self._delete(f"log/{batch}")
        for name in self._names("versions"):
            if name != f"{m['version']:012d}.json":
                self._delete(f"versions/{name}")
