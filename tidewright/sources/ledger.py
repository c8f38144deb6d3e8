"""Backfills that commit period by period, so that one stopped anywhere goes on where it was."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.dates import dateadd, datediff
from tidewright.session import hadoop_path
from tidewright.sources.load import ConcurrentLoad, _add_entry, _last_entry, by_period

_ENTRY = "version bigint, period bigint, path string, rows bigint"


class PeriodLedger:
    """A table filled by period: the ledger has one entry per finished period with its folder and number of rows.

    A period is finished when its entry is there; entries are never written twice, so of two backfills over the same
    periods each period is taken from one. Periods without rows have entries as well, so a gap is not loaded again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def entries(self) -> DataFrame:
        """``period, path, rows`` of the finished periods."""
        if _last_entry(self.spark, self.root, _ENTRY) is None:
            return self.spark.createDataFrame([], "period bigint, path string, rows bigint")
        return self.spark.read.schema(_ENTRY).json(f"{self.root}/log").where("version is not null").select("period", "path", "rows")

    def finished(self) -> set[int]:
        return {r["period"] for r in self.entries().select("period").toLocalIterator()}

    def read(self, schema: T.StructType | str) -> DataFrame:
        """Rows of all finished periods."""
        paths = [r["path"] for r in self.entries().where("path is not null").select("path").collect()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def backfill(
        self, rows: DataFrame, ts: str, period: str, start: Column, stop: Column, together: int = 1, most: int | None = None
    ) -> list[int]:
        """Load the periods between two moments that are not there yet, and return their numbers.

        Period ``i`` holds ``start + i periods < ts <= start + i + 1 periods``, and ``start`` and ``stop`` themselves stay
        outside, as in ``by_period``. ``together`` periods are written by one job and then committed one by one; the
        filter on their bounds reaches the scan. ``most`` ends the run after so many periods, to go on later. Periods
        count from ``start``, so that must stay the same; the last one is committed as far as ``stop`` lets it go.
        """
        bounds = self.spark.range(1).select(datediff(start, stop, period).alias("n"), dateadd(period, datediff(start, stop, period).cast("int"), start).alias("at"), stop.alias("stop")).first()
        count = bounds["n"] + (1 if bounds["at"] < bounds["stop"] else 0)
        done = self.finished()
        todo = [i for i in range(count) if i not in done][:most]
        for at in range(0, len(todo), together):
            self._load(rows, ts, period, start, stop, todo[at : at + together])
        return todo

    def _load(self, rows: DataFrame, ts: str, period: str, start: Column, stop: Column, periods: Sequence[int]) -> None:
        lower, upper = (dateadd(period, F.lit(i), start) for i in (periods[0], periods[-1] + 1))
        inside = rows.where((F.col(ts) > lower) & (F.col(ts) <= upper))
        numbered = by_period(inside, ts, period, start, stop).where(F.col("period_number").isin(*periods))
        root = f"{self.root}/data/{uuid.uuid4().hex}"
        numbered.hint("rebalance", "period_number").write.partitionBy("period_number").parquet(root)
        folder, files = hadoop_path(self.spark, root)
        made = {s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()}
        counts = {}
        if made:
            # From the footers of what was written, so that an unsteady source cannot give another number.
            written = self.spark.read.schema(T.StructType([T.StructField("period_number", T.LongType())])).parquet(root)
            counts = {r["period_number"]: r["count"] for r in written.groupBy("period_number").count().collect()}
        for i in periods:
            path = f"{root}/period_number={i}" if f"period_number={i}" in made else None
            try:
                _add_entry(self.spark, self.root, i + 1, {"period": i, "path": path, "rows": counts.get(i, 0)})
            except ConcurrentLoad:
                continue  # another backfill finished it first; its folder stands

