"""Streaming jobs over files: alerts from log lines, deduplicated event logs, daily counts and change data.

Each transformation takes and gives frames, so it runs on a stream and on a batch alike. The checkpoint is the
cursor: a run with ``available_now`` takes what has landed since the last one and stops. How rows are dealt to
micro-batches, and how late they come, does not touch what is read in the end.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.text import check_column, check_kind, check_target
from tidewright.operators.anomaly import SLOW_FACTOR
from tidewright.operators.reshape import newest
from tidewright.session import hadoop_path
from tidewright.sources.load import apply_changes

c = F.col

# Keeps state on disk, so that it may outgrow the executors' memory.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

LOG_LINE = (
    "info struct<name:string>, data struct<status:string, name:string, attached_node:string, num_failures:bigint, "
    "node_info:struct<node_finished_at:string, meta:struct<channel:string, owner:string, subscribers:array<string>, "
    "tags:array<string>>>>"
)


def prepare_streams(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


# Most bytes of files that one micro-batch takes.
BATCH_BYTES = 64 << 30


def read_files(spark: SparkSession, path: str, schema: str, fmt: str = "parquet", batch_bytes: int = BATCH_BYTES, **options) -> DataFrame:
    if "maxFilesPerTrigger" not in options:
        options["maxBytesPerTrigger"] = str(batch_bytes)
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


class BatchTable:
    """A folder with one subfolder for each micro-batch; a batch that is written again replaces its own.

    Batches can be folded into a generation, which stands for all batches up to its number. The batches it replaces, and
    the generation before, are removed by the fold after it, so that whoever reads meanwhile finds them.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.root}/batch_id={batch_id}")

    def _numbered(self, place: str, name: str) -> dict[int, str]:
        """Finished folders ``name=<number>``, by number."""
        folder, files = hadoop_path(self.spark, place)
        found = {}
        for status in files.listStatus(folder) if files.exists(folder) else ():
            match = re.fullmatch(rf"{name}=(\d+)", status.getPath().getName())
            if match and files.exists(hadoop_path(self.spark, f"{place}/{match[0]}/_SUCCESS")[0]):
                found[int(match[1])] = f"{place}/{match[0]}"
        return found

    def _live(self) -> tuple[int, list[str]]:
        """The newest generation's number (-1 without one), and the folders that make up the table."""
        folded = self._numbered(f"{self.root}/_folded", "upto")
        upto = max(folded, default=-1)
        later = {i: p for i, p in self._numbered(self.root, "batch_id").items() if i > upto}
        return upto, [*([folded[upto]] if folded else []), *[later[i] for i in sorted(later)]]

    def read(self) -> DataFrame:
        """Rows of the newest generation and the batches after it."""
        return self.spark.read.parquet(*self._live()[1])

    def fold(self, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Make ``change(rows)`` the generation that stands for all batches so far, and return the table.

        Not while a batch is written that is older than another one already there.
        """
        before, _ = self._live()
        batches = self._numbered(self.root, "batch_id")
        upto = max(batches, default=before)
        if upto > before:
            change(self.read()).write.mode("overwrite").parquet(f"{self.root}/_folded/upto={upto}")
            old = [p for i, p in batches.items() if i <= before]
            old += [p for i, p in self._numbered(f"{self.root}/_folded", "upto").items() if i < before]
            for path in old:
                folder, files = hadoop_path(self.spark, path)
                files.delete(folder, True)
        return self.read()


def to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what is new to parquet files, exactly once."""
    run = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
    run.outputMode("append").trigger(availableNow=True).start().awaitTermination()


def to_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Hand each micro-batch to a function that may be called again with the same batch."""
    run = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    run.outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def overdue_runs(log: DataFrame, means: DataFrame, lateness: str, threshold: float = SLOW_FACTOR) -> DataFrame:
    """Runs that were still open when they had taken ``threshold`` times their job's mean, each as that moment passes.

    ``log`` is a stream of job, run_id, record (``started`` or ``completed``; others only tell that time passes) and at, a
    timestamp. Records come less than ``lateness`` out of order; later ones are dropped. ``means`` has job and
    average_duration in seconds; runs of other jobs are never overdue. A run completes after it starts, and a start that
    is delivered twice is reported twice.

    Starts wait as state until they are due, completions as long as a start before them may come. So state is bounded by
    the records of the longest time allowed and the lateness.
    """
    allowed = F.floor(c("average_duration") * threshold * 1_000_000)
    top = means.agg(F.max(allowed)).first()[0] or 0
    longest = F.expr(f"interval {int(top) + 1} microseconds")
    # Spark drops state by the column that carries the watermark, so that must be the moment a run is due. All records
    # reach both watermarks, or else a side without records would hold time still; the filters behind them name the
    # column of the watermark and so stay behind them.
    due = F.timestamp_micros(F.unix_micros("at") + allowed + 1)  # the first microsecond at which the run is overdue
    started = log.join(means, "job", "left").withColumn("due_at", F.when(c("record") == "started", due))
    started = started.withColumn("due_at", F.coalesce("due_at", "at")).withWatermark("due_at", lateness)
    opened = started.where(F.when(c("due_at") > c("at"), c("record")) == "started")
    opened = opened.select("job", "run_id", c("at").alias("created_at"), "average_duration", "due_at").alias("s")
    closed = log.withWatermark("at", lateness).where(F.when(c("at").isNotNull(), c("record")) == "completed")
    closed = closed.select("run_id", "at").alias("e")
    in_time = (c("e.at") < c("s.due_at")) & (c("e.at") >= c("s.due_at") - longest) & (c("e.at") >= c("s.created_at"))
    both = opened.join(closed, (c("s.run_id") == c("e.run_id")) & in_time, "left_outer")
    return both.where(c("e.run_id").isNull()).select("s.job", "s.run_id", "s.created_at", "s.due_at", "s.average_duration")


def still_open(alerts: DataFrame, ends: DataFrame, at: Column) -> DataFrame:
    """Overdue runs without a completion up to a moment: what ``long_running`` finds then."""
    return alerts.where(c("due_at") <= at).join(ends.where(c("completed_at") <= at), "run_id", "left_anti")


def check_alerts(lines: DataFrame, value: str = "value") -> DataFrame:
    """Alert rows for failed or warned checks that name a channel; lines that do not parse are skipped."""
    parsed = lines.select(F.from_json(value, LOG_LINE).alias("log")).select("log.info", "log.data")
    d, meta = c("data"), c("data.node_info.meta")
    wanted = parsed.where(
        (c("info.name") == "LogTestResult")
        & F.lower(d["status"]).isin("fail", "warn")
        & (F.coalesce(meta["channel"], F.lit("")) != "")
    )

    def listed(items):
        return F.when(F.size(items) > 0, F.array_join(items, ", ")).otherwise("None")

    named = wanted.select(
        check_target(F.coalesce(d["attached_node"], F.lit(""))).alias("model"),
        F.coalesce(d["name"], F.lit("")).alias("__name"),
        F.coalesce(meta["owner"], F.lit("Unknown")).alias("owner"),
        meta["channel"].alias("channel"),
        listed(meta["subscribers"]).alias("subscribers"),
        listed(meta["tags"]).alias("tags"),
        F.upper(d["status"]).alias("status"),
        F.coalesce(d["num_failures"].cast("string"), F.lit("unknown")).alias("failures"),
        F.coalesce(c("data.node_info.node_finished_at"), F.lit("")).alias("failed_at"),
    )
    rows = named.withColumns(
        {"test_name": check_kind(c("__name"), c("model")), "column_name": check_column(c("__name"), c("model"))}
    ).drop("__name")
    text = F.concat(
        F.lit("test failure: "), "test_name", F.lit(" on "), "model", F.lit("."), "column_name",
        F.lit(" ("), "failures", F.lit(" failures)"),
    )
    return rows.withColumn("alert_text", text)


def keep_latest(table: BatchTable, keys: Sequence[str], order_by: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Batch writer for a latest-state table: each batch adds only its own newest row per key.

    Reading with ``latest`` picks the newest of all batches, so a batch costs its own size, may come late, and may
    come twice. ``compact`` folds the batches together now and then. With a log record's topic, partition and offset
    as keys this keeps each record once, however often and however late it is delivered.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table.write(newest(batch, keys, order_by), batch_id)

    return write


def latest(table: BatchTable, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    return newest(table.read(), keys, order_by)


def compact(table: BatchTable, keys: Sequence[str], order_by: Sequence[str], path: str | None = None) -> DataFrame:
    """Fold the batches into their newest rows, so that reading costs the live rows and later batches only.

    With ``path`` the rows are also written to a folder of their own.
    """
    rows = table.fold(lambda df: newest(df, keys, order_by))
    if path is None:
        return rows
    rows.write.mode("overwrite").parquet(path)
    return table.spark.read.parquet(path)


def keep_daily_parts(table: BatchTable, ts: str) -> Callable[[DataFrame, int], None]:
    """Batch writer for daily figures: counts, sums and a sketch of the users of each day that the batch touches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        days = batch.groupBy(F.to_date(ts).alias("event_date"))
        parts = days.agg(
            F.count(F.lit(1)).alias("events"), F.sum("event_value").alias("value"), F.hll_sketch_agg("user_name", USER_SKETCH).alias("users")
        )
        table.write(parts, batch_id)

    return write


# Size of the user sketches as a power of two; their standard error is about 1.04 / sqrt(2**14), under 1 %.
USER_SKETCH = 14


def daily_counts(table: BatchTable) -> DataFrame:
    """Events, summed values and roughly counted users per day, over all batches so far."""
    days = table.read().groupBy("event_date").agg(
        F.sum("events").alias("total_events"), F.sum("value").alias("total_value"), F.hll_union_agg("users").alias("users")
    )
    return days.withColumn("unique_users_approx", F.hll_sketch_estimate("users")).drop("users")


def keep_distinct(table: BatchTable, columns: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Batch writer for distinct rows; a row that several batches have is still to be counted once on reading."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.write(batch.select(*columns).distinct(), batch_id)

    return write


def changed_state(base: DataFrame, changes: BatchTable, keys: Sequence[str], sequence: str, op: str) -> DataFrame:
    """Base table with all change batches applied."""
    return apply_changes(base, changes.read(), keys, sequence, op)
