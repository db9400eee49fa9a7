"""Stored tables as Parquet.

Monthly tables are partitioned by ``month_start`` and rewritten one month at a time (dynamic partition
overwrite).  Small state tables are written as numbered snapshots; readers take the newest committed one,
so a job never overwrites what it is reading, and a write that dies midway leaves the old snapshot current.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import MONTHLY_TABLES, TABLES

KEPT_SNAPSHOTS = 3


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- paths (through Hadoop, so that any file system works) --

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        location = jvm.org.apache.hadoop.fs.Path(path)
        return location.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), location

    def _exists(self, path: str) -> bool:
        fs, location = self._fs(path)
        return fs.exists(location)

    def _children(self, path: str) -> list[str]:
        fs, location = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(location)] if fs.exists(location) else []

    def _delete(self, path: str) -> None:
        fs, location = self._fs(path)
        fs.delete(location, True)

    def _snapshots(self, name: str) -> list[int]:
        base = f"{self.root}/{name}"
        numbers = sorted(int(c.split("=")[1]) for c in self._children(base) if c.startswith("snapshot="))
        return [n for n in numbers if self._exists(f"{base}/snapshot={n}/_SUCCESS")]

    def exists(self) -> bool:
        return self._exists(self.root)

    # -- reading --

    def _empty(self, name: str) -> DataFrame:
        """No rows, and known to have none: what is joined to them is dropped from a plan or left where it is."""
        columns = self.spark.createDataFrame([], TABLES[name]).schema
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in columns]).filter(F.lit(False))

    def read(self, name: str) -> DataFrame:
        empty = self._empty(name)
        if name in MONTHLY_TABLES:
            path = f"{self.root}/{name}"
            if not any(c.startswith("month_start=") for c in self._children(path)):
                return empty
            return self.spark.read.schema(TABLES[name]).parquet(path).select(*empty.columns)
        snapshots = self._snapshots(name)
        if not snapshots:
            return empty
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.root}/{name}/snapshot={snapshots[-1]}")

    def all(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in TABLES}

    # -- writing --

    def replace(self, name: str, rows: DataFrame) -> None:
        """New snapshot of a state table."""
        shaped = self._shape(name, rows)
        done = self._snapshots(name)
        number = (done[-1] if done else 0) + 1
        shaped.hint("rebalance").write.mode("overwrite").parquet(f"{self.root}/{name}/snapshot={number}")
        for old in done[: -(KEPT_SNAPSHOTS - 1)]:
            self._delete(f"{self.root}/{name}/snapshot={old}")

    def replace_months(self, name: str, rows: DataFrame, months: list[dt.date | None]) -> None:
        """Rewrite exactly the given months of a monthly table; a month without rows ends up empty.

        ``rows`` may read the table itself: new files are staged and moved in place when the job commits.
        """
        path = f"{self.root}/{name}"
        before = {month: self._children(self._month_path(path, month)) for month in months}
        # rebalance: months too large for one task are split, small ones are written by one task each
        spread = self._shape(name, rows).hint("rebalance", "month_start")
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "month_start"
        ).parquet(path)
        for month, files in before.items():
            # no new files: nothing was written for this month, so what is there is out of date
            if files and self._children(self._month_path(path, month)) == files:
                self._delete(self._month_path(path, month))

    @staticmethod
    def _month_path(path: str, month: dt.date | None) -> str:
        return f"{path}/month_start={month.isoformat() if month else '__HIVE_DEFAULT_PARTITION__'}"

    def stage(self, run_id: str, name: str, rows: DataFrame) -> DataFrame:
        """Write an intermediate result next to the tables and read it back: it is computed once, and lost
        executors do not take it with them."""
        path = f"{self.root}/_staging/{run_id}/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def stage_measured(self, run_id: str, name: str, rows: DataFrame, **metrics: Column) -> tuple[DataFrame, dict[str, int]]:
        """The same, with figures taken by the write itself: no further job counts the rows."""
        observation = Observation()
        staged = self.stage(run_id, name, rows.observe(observation, *[m.alias(n) for n, m in metrics.items()]))
        seen = observation.get
        return staged, {n: int(seen.get(n) or 0) for n in metrics}

    def drop_stage(self, run_id: str, name: str | None = None) -> None:
        """Delete one staged result of a run that is no longer read, or all of them."""
        self._delete(f"{self.root}/_staging/{run_id}" + (f"/{name}" if name else ""))

    def _shape(self, name: str, rows: DataFrame) -> DataFrame:
        target = self.spark.createDataFrame([], TABLES[name]).schema
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])
