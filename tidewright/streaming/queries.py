"""Streaming queries: files derived from the given tables are streamed, and the result is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.anomaly import mean_durations
from tidewright.plans.loads import _CDC, changes
from tidewright.plans.registry import query
from tidewright.session import scratch_path
from tidewright.streaming import jobs

c = F.col
# Options of every file stream below, and how many files land; tests set others.
STREAM: dict[str, str] = {}
FILES: int | None = None


class Landing:
    """A folder where files land, with the places a stream over it needs."""

    def __init__(self, t, name: str):
        self.spark = jobs.prepare_streams(t.spark)
        self.root = scratch_path(t.spark, f"stream-{name}")
        self.files, self.out, self.checkpoint = (f"{self.root}/{x}" for x in ("in", "out", "checkpoint"))

    def land(self, df: DataFrame, fmt: str = "parquet") -> None:
        rows = df if FILES is None else df.repartition(FILES)
        rows.write.mode("append").format(fmt).save(self.files)

    def stream(self, schema: str, fmt: str = "parquet") -> DataFrame:
        return jobs.read_files(self.spark, self.files, schema, fmt, **STREAM)

    def table(self) -> jobs.BatchTable:
        return jobs.BatchTable(self.spark, self.out)


def log_lines(t) -> DataFrame:
    """An event as a log line: errors are failed checks, clicks warnings; some lines are broken or other records."""
    meta = F.struct(
        F.when(c("user_id") > 5, "data-alerts").otherwise("").alias("channel"),
        F.when(c("value") > 20, F.concat(F.lit("user-"), c("user_id").cast("string"))).alias("owner"),
        F.array(F.lit("a"), F.lit("b")).alias("subscribers"),
        F.array().cast("array<string>").alias("tags"),
    )
    status = F.when(c("event_type") == "error", "fail").when(c("event_type") == "click", "Warn").otherwise("pass")
    data = F.struct(
        status.alias("status"),
        F.concat(F.lit("not_null_"), "event_type", F.lit("_user_id__"), F.substring(F.md5("props"), 1, 6)).alias("name"),
        F.concat(F.lit("model.shop."), "event_type").alias("attached_node"),
        F.when(c("value") > 10, c("event_id")).alias("num_failures"),
        F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("node_finished_at"), meta.alias("meta")).alias("node_info"),
    )
    name = F.when(c("event_type") == "view", "Stats").otherwise("LogTestResult")
    whole = F.to_json(F.struct(F.struct(name.alias("name")).alias("info"), data.alias("data")))
    return t.events.select(F.when(c("value") > 95, F.left(whole, F.lit(40))).otherwise(whole).alias("value"))


@query(
    "t1_log_alerts",
    """with a as (select event_type as model, case when value > 20 then 'user-' || user_id else 'Unknown' end as owner, 'data-alerts' as channel, 'a, b' as subscribers,
      'None' as tags, case event_type when 'error' then 'FAIL' else 'WARN' end as status, case when value > 10 then cast(event_id as varchar) else 'unknown' end as failures,
      strftime(ts, '%Y-%m-%d %H:%M:%S') as failed_at, 'not_null' as test_name, 'user_id' as column_name from events
      where event_type in ('error', 'click') and user_id > 5 and value <= 95)
    select *, 'test failure: ' || test_name || ' on ' || model || '.' || column_name || ' (' || failures || ' failures)' as alert_text from a""",
)
def _(t):
    files = Landing(t, "log")
    files.land(log_lines(t), "text")
    lines = files.stream("value string", "text")
    jobs.to_files(jobs.check_alerts(lines), files.out, files.checkpoint)
    return t.spark.read.parquet(files.out)


_LOG = "topic string, partition int, offset bigint, message_key bigint, event_time timestamp, event_type string"


def event_log(t) -> DataFrame:
    return t.events.select(
        F.concat(F.lit("orders."), F.left("event_type", F.lit(1))).alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        c("event_id").alias("offset"),
        c("user_id").alias("message_key"),
        c("ts").cast("timestamp").alias("event_time"),
        "event_type",
    )


def land_twice(t, files: Landing) -> None:
    """The log, with purchases and errors delivered a second time in files of their own."""
    rows = event_log(t)
    files.land(rows.unionAll(rows.where("event_type in ('purchase', 'error')")))


@query(
    "t2_deduplicated_log",
    """select 'orders.' || left(event_type, 1) as topic, cast(user_id % 4 as integer) as partition, event_id as "offset", user_id as message_key, event_type from events""",
)
def _(t):
    files, keys = Landing(t, "offsets"), ["topic", "partition", "offset"]
    land_twice(t, files)
    table = files.table()
    jobs.to_batches(files.stream(_LOG), jobs.keep_latest(table, keys, ["event_time"]), files.checkpoint)
    return jobs.latest(table, keys, ["event_time"]).drop("event_time")


@query("t2_latest_state", "select user_id as message_key, arg_max(event_type, event_id) as state, max(event_id) as \"offset\" from events group by 1")
def _(t):
    files, keys, order = Landing(t, "state"), ["message_key"], ["offset"]
    land_twice(t, files)
    log = files.stream(_LOG)
    table = files.table()
    jobs.to_batches(log.select("message_key", c("event_type").alias("state"), "offset"), jobs.keep_latest(table, keys, order), files.checkpoint)
    return jobs.compact(table, keys, order, f"{files.root}/compact")


_EVENT = "event_ts timestamp, user_name string, event_value bigint"


def day_events(t) -> DataFrame:
    return t.events.select(
        c("ts").cast("timestamp").alias("event_ts"), c("user_id").cast("string").alias("user_name"), c("event_id").alias("event_value")
    )


@query("t3_daily_counts", "select cast(ts as date) as event_date, count(*) as total_events, cast(sum(event_id) as bigint) as total_value, true as users_near from events group by 1")
def _(t):
    files = Landing(t, "daily")
    files.land(day_events(t))
    table = files.table()
    jobs.to_batches(files.stream(_EVENT), jobs.keep_daily_parts(table, "event_ts"), files.checkpoint)
    exact = t.events.groupBy(F.to_date("ts").alias("event_date")).agg(F.count_distinct("user_id").alias("users"))
    days = jobs.daily_counts(table).join(exact, "event_date")
    near = F.abs(c("unique_users_approx") - c("users")) <= F.greatest(F.lit(1.0), c("users") * 0.03)
    return days.select("event_date", "total_events", "total_value", near.alias("users_near"))


@query("t3_daily_users", "select cast(ts as date) as event_date, count(distinct user_id) as unique_users from events group by 1")
def _(t):
    files = Landing(t, "users")
    files.land(day_events(t))
    table, columns = files.table(), ["event_date", "user_name"]
    events = files.stream(_EVENT).select("user_name", F.to_date("event_ts").alias("event_date"))
    jobs.to_batches(events, jobs.keep_distinct(table, columns), files.checkpoint)
    return table.read().groupBy("event_date").agg(F.count_distinct("user_name").alias("unique_users"))


@query("t4_incremental_append", "select event_id, user_id, event_type from events")
def _(t):
    files = Landing(t, "cursor")
    rows = t.events.select("event_id", "user_id", "event_type")
    for part in (c("event_type") != "view", c("event_type") == "view"):
        files.land(rows.where(part))
        stream = files.stream("event_id bigint, user_id bigint, event_type string")
        jobs.to_files(stream, files.out, files.checkpoint)
    return t.spark.read.parquet(files.out)


@query("t4_change_merge", _CDC)
def _(t):
    files = Landing(t, "cdc")
    files.land(changes(t))
    stream = files.stream("id bigint, segment string, op string, seq bigint")
    table = files.table()
    jobs.to_batches(stream, jobs.keep_latest(table, ["id"], ["seq"]), files.checkpoint)
    base = t.customer.select(c("c_custkey").alias("id"), c("c_mktsegment").alias("segment"))
    return jobs.changed_state(base, table, ["id"], "seq", "op")


_RUN_RECORD = "job string, run_id bigint, record string, at timestamp"
LATENESS = "7 days"


def run_log(t) -> DataFrame:
    """Start and completion records of a run per event; some views are lost and never complete."""
    took = F.round(c("value") * 60).cast("int")
    started = F.date_trunc("second", c("ts").cast("timestamp"))
    lost = (c("event_type") == "view") & (c("value") > 90)
    ended = F.when(~lost, F.timestamp_add("SECOND", took, started))
    records = F.array(F.struct(F.lit("started").alias("record"), started.alias("at")), F.struct(F.lit("completed").alias("record"), ended.alias("at")))
    rows = t.events.select(F.concat(F.lit("job-"), c("user_id").cast("string")).alias("job"), c("event_id").alias("run_id"), F.inline(records))
    return rows.where("at is not null")


def run_means(log: DataFrame) -> DataFrame:
    """Mean seconds of the completed runs of each job."""
    runs = log.groupBy("job", "run_id").agg(
        F.max(F.when(c("record") == "started", c("at"))).alias("created_at"), F.max(F.when(c("record") == "completed", c("at"))).alias("completed_at")
    )
    return mean_durations(runs.withColumns({x: c(x).cast("timestamp_ntz") for x in ("created_at", "completed_at")}))


def overdue(t, files: Landing, weeks: int = 5) -> DataFrame:
    """Alerts of a stream over the log, which lands week by week and in any order within a week."""
    log = run_log(t)
    first = t.events.agg(F.min("ts").cast("timestamp")).first()[0]
    means = run_means(log)
    # Weeks by number, the first and the last one open to their side.
    week = F.floor((F.unix_micros("at") - F.unix_micros(F.lit(first).cast("timestamp"))) / (7 * 86_400_000_000))
    for i in range(weeks):
        files.land(log.where(F.least(F.greatest(week, F.lit(0)), F.lit(weeks - 1)) == i))
    jobs.to_files(jobs.overdue_runs(files.stream(_RUN_RECORD), means, LATENESS), files.out, files.checkpoint)
    return t.spark.read.parquet(files.out)


@query(
    "n1_overdue_stream",
    """with log as (select 'job-' || user_id as job, event_id as run_id, date_trunc('second', ts) as created_at,
      case when not (event_type = 'view' and value > 90) then date_trunc('second', ts) + to_seconds(cast(round(value * 60) as bigint)) end as completed_at from events),
    means as (select job, cast(sum(epoch_us(completed_at) - epoch_us(created_at)) as double) / count(*) / 1000000 as average_duration
      from log where completed_at is not null group by 1),
    t as (select greatest(max(created_at), max(completed_at)) - interval 7 day as passed from log),
    due as (select *, epoch_us(created_at) + cast(floor(average_duration * 2 * 1000000) as bigint) + 1 as due_us from log join means using (job))
    select job, run_id, created_at, round(average_duration, 6) as average_duration, completed_at is null or completed_at > passed as still_open
    from due, t where due_us <= epoch_us(passed) and (completed_at is null or epoch_us(completed_at) >= due_us)""",
)
def _(t):
    files = Landing(t, "overdue")
    alerts = overdue(t, files)
    ends = run_log(t).where("record = 'completed'").select("run_id", c("at").alias("completed_at"))
    passed = run_log(t).agg((F.max("at") - F.expr("interval 7 days")).alias("at")).first()["at"]
    still = jobs.still_open(alerts, ends, F.lit(passed)).select("run_id", F.lit(True).alias("still_open"))
    both = alerts.join(still, "run_id", "left")
    return both.select(
        "job",
        "run_id",
        c("created_at").cast("timestamp_ntz").alias("created_at"),
        F.round("average_duration", 6).alias("average_duration"),
        F.coalesce("still_open", F.lit(False)).alias("still_open"),
    )
