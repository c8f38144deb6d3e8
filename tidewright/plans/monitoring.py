"""Run-duration, volume and impact queries; events stand for runs, orders and lines for tasks and operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions import dates, numbers
from tidewright.operators import anomaly
from tidewright.plans.registry import query

c = F.col
NOW = "2024-01-31 00:10:00"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def runs(t) -> DataFrame:
    """A run per event; views of the last days are still open."""
    took = F.round(c("value") * 60).cast("int")
    open_run = (c("event_type") == "view") & (c("ts") >= F.lit("2024-01-29").cast("timestamp_ntz"))
    started = F.date_trunc("second", "ts").cast("timestamp_ntz")
    return t.events.select(
        F.concat(F.lit("job-"), c("user_id").cast("string")).alias("job"),
        c("event_id").alias("run_id"),
        F.when(open_run, "RUNNING").when(c("event_type") == "error", "FAILED").otherwise("SUCCEEDED").alias("status"),
        started.alias("created_at"),
        F.when(~open_run, dates.dateadd("second", took, started)).alias("completed_at"),
    )


_RUNS = f"""runs as (select 'job-' || user_id as job, event_id as run_id,
    case when event_type = 'view' and ts >= timestamp '2024-01-29' then 'RUNNING' when event_type = 'error' then 'FAILED' else 'SUCCEEDED' end as status,
    date_trunc('second', ts) as created_at, case when not (event_type = 'view' and ts >= timestamp '2024-01-29')
    then date_trunc('second', ts) + to_seconds(cast(round(value * 60) as bigint)) end as completed_at from events),
  means as (select job, cast(sum(epoch_us(completed_at) - epoch_us(created_at)) as double) / count(*) / 1000000 as average_duration
    from runs where completed_at is not null group by 1),
  slow as (select job as job_name, run_id, status, round(cast(epoch_us(timestamp '{NOW}') - epoch_us(created_at) as double) / 1000000, 2) as duration,
    round(average_duration, 2) as average_duration, '{anomaly.SLOW_REASON}' as reason from runs join means using (job)
    where completed_at is null and cast(epoch_us(timestamp '{NOW}') - epoch_us(created_at) as double) / 1000000 > average_duration * 2),
  fast as (select job as job_name, run_id, status, round(cast(epoch_us(completed_at) - epoch_us(created_at) as double) / 1000000, 2) as duration,
    round(average_duration, 2) as average_duration, '{anomaly.FAST_REASON}' as reason from runs join means using (job)
    where completed_at is not null and epoch_us(timestamp '{NOW}') - epoch_us(completed_at) <= 21600000000
      and cast(epoch_us(completed_at) - epoch_us(created_at) as double) / 1000000 < average_duration * 0.5)"""


@query("n1_long_running", f"with {_RUNS} select * from slow")
def _(t):
    return anomaly.long_running(runs(t), now())


@query("n2_suspiciously_short", f"with {_RUNS} select * from fast")
def _(t):
    return anomaly.suspiciously_short(runs(t), now(), cadence_minutes=360)


@query("n6_run_anomalies", f"with {_RUNS} select * from slow union all select * from fast")
def _(t):
    return anomaly.run_anomalies(runs(t), now(), cadence_minutes=360)


@query(
    "n3_impact",
    """with totals as (select l_orderkey, cast(sum(cast(l_quantity as bigint)) as bigint) as total from lineitem where l_quantity > 0 group by 1),
    tasks as (select o_orderkey, o_custkey, o_orderdate, o_orderpriority = '1-URGENT' and o_orderstatus = 'F' as flag from orders),
    merged as (select tasks.*, total from tasks join totals on l_orderkey = o_orderkey),
    firsts as (select o_custkey, min(o_orderdate) as first_use from merged where flag group by 1),
    s as (select o_custkey, cast(sum(case when o_orderdate < first_use then total end) as double)
        / nullif(count(case when o_orderdate < first_use then 1 end), 0) as avg_before,
      cast(sum(case when o_orderdate >= first_use then total end) as double) / nullif(count(case when o_orderdate >= first_use then 1 end), 0)
        as avg_after from merged join firsts using (o_custkey) group by 1)
    select cast(o_custkey as varchar) as task_name, avg_before, avg_after, case when avg_before > 0 then (avg_after - avg_before) / avg_before * 100 end
      as pct_change from s""",
)
def _(t):
    operations = t.lineitem.select(c("l_orderkey").alias("task_run_id"), c("l_quantity").cast("bigint").alias("seconds"))
    flag = (c("o_orderpriority") == "1-URGENT") & (c("o_orderstatus") == "F")
    tasks = t.orders.select(
        c("o_orderkey").alias("task_run_id"),
        c("o_custkey").cast("string").alias("task_name"),
        c("o_orderdate").alias("created_at"),
        flag.alias("flag"),
    )
    return anomaly.impact(operations, tasks)


@query(
    "n4_duration_above_baseline",
    """with r as (select o_custkey as job, o_orderkey as run_id, o_orderdate as done_at, cast(round(o_totalprice * 100) as bigint) as duration from orders),
    w as (select *, cast(sum(duration) over s as double) / count(duration) over s as baseline from r
      window s as (partition by job order by done_at, run_id rows between 10 preceding and 1 preceding))
    select * from w where duration > baseline * (1 + 30.0::double / 100)""",
)
def _(t):
    rows = t.orders.select(
        c("o_custkey").alias("job"),
        c("o_orderkey").alias("run_id"),
        c("o_orderdate").alias("done_at"),
        numbers.to_cents(c("o_totalprice")).alias("duration"),
    )
    return anomaly.duration_above_baseline(rows, "job", "done_at", "run_id", "duration")


@query(
    "n5_volume_anomalies",
    """with v as (select cast(date_trunc('hour', ts) as timestamp) as ts, event_type as series, count(*) as target from events group by 1, 2),
    band as (select series, avg(target) as forecast, stddev_samp(target) as sd from v where ts < timestamp '2024-01-16' group by 1)
    select series, ts, target, round(forecast, 6) as forecast, round(forecast - 2 * sd, 6) as lower_bound, round(forecast + 2 * sd, 6) as upper_bound,
      target < forecast - 2 * sd or target > forecast + 2 * sd as is_anomaly from v join band using (series) where ts >= timestamp '2024-01-16'""",
)
def _(t):
    volume = t.events.groupBy(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), c("event_type").alias("series")
    ).agg(F.count(F.lit(1)).alias("target"))
    split = F.lit("2024-01-16").cast("timestamp_ntz")
    scored = anomaly.volume_anomalies(volume.where(c("ts") < split), volume.where(c("ts") >= split), width=2.0)
    return scored.withColumns({x: F.round(x, 6) for x in ("forecast", "lower_bound", "upper_bound")})


# Daily volumes per line: a weekly wave on a slope, with a spike on a few days of the last half year.
_VOLUMES = """c as (select l_linenumber as series, cast(l_shipdate as date) as day, count(*) as n from lineitem group by all),
    v as (select series, day, n + cast(dayofweek(day) * 1000 as bigint) + date_diff('day', date '1992-01-01', day)
      + case when day >= date '1998-03-01' and day(day) = 13 then 500 else 0 end as target from c)"""


@query(
    "n5_seasonal_forecast",
    f"""with {_VOLUMES}, h as (select * from v where day < date '1998-01-01'), o as (select series, min(day) as origin from h group by 1),
    x as (select h.series, origin, isodow(day) as w, date_diff('day', origin, day)::hugeint as t, target::hugeint as y from h join o using (series)),
    d as (select series, origin, w, count(*) as n, sum(t)::double / count(*) as mt, sum(y)::double / count(*) as my,
        (count(*) * sum(t * t) - sum(t) * sum(t))::double / count(*) as ctt, (count(*) * sum(t * y) - sum(t) * sum(y))::double / count(*) as cty,
        (count(*) * sum(y * y) - sum(y) * sum(y))::double / count(*) as cyy from x group by all),
    s as (select series, origin, sum(cty) / sum(ctt) as slope, sqrt((sum(cyy) - sum(cty) / sum(ctt) * sum(cty)) / (sum(n) - count(*) - 1)) as sd from d group by all),
    f as (select v.series, v.day, v.target, my - slope * mt + slope * date_diff('day', s.origin, v.day) as forecast, sd
      from v join s using (series) join d on d.series = v.series and d.w = isodow(v.day) where v.day >= date '1998-01-01')
    select series, day, target, round(forecast, 4) as forecast, round(forecast - 4 * sd, 4) as lower_bound, round(forecast + 4 * sd, 4) as upper_bound,
      target < forecast - 4 * sd or target > forecast + 4 * sd as is_anomaly from f""",
)
def _(t):
    day = F.to_date("l_shipdate")
    wave = (F.dayofweek("day") - 1) * 1000 + F.datediff("day", F.lit("1992-01-01").cast("date"))
    spike = F.when((c("day") >= F.lit("1998-03-01").cast("date")) & (F.dayofmonth("day") == 13), 500).otherwise(0)
    counts = t.lineitem.groupBy(c("l_linenumber").alias("series"), day.alias("day")).agg(F.count("*").alias("n"))
    volume = counts.select("series", "day", (c("n") + wave + spike).cast("bigint").alias("target"))
    split = F.lit("1998-01-01").cast("date")
    scored = anomaly.seasonal_forecast(volume.where(c("day") < split), volume.where(c("day") >= split), width=4.0)
    return scored.withColumns({x: F.round(x, 4) for x in ("forecast", "lower_bound", "upper_bound")})
