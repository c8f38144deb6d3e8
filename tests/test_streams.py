"""Streams give what a batch over the same rows gives, across restarts and repeated deliveries."""

from __future__ import annotations

import json
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.operators import anomaly
from tidewright.streaming import jobs

c = F.col


@pytest.fixture
def place(spark, tmp_path):
    jobs.prepare_streams(spark)
    return lambda name: str(tmp_path / name)


def line(kind="LogTestResult", status="fail", channel="ops", **data):
    node = {"node_finished_at": "now", "meta": {"channel": channel, "owner": "me", "subscribers": ["a", "b"], "tags": []}}
    return json.dumps({"info": {"name": kind}, "data": {"status": status, "node_info": node, **data}})


def test_alerts_skip_broken_and_other_lines(spark, place):
    named = {"name": "unique_orders_id__ab", "attached_node": "model.shop.orders", "num_failures": 3}
    lines = [line(**named), line(status="PASS", **named), line(channel="", **named), line(kind="Other", **named), "{broken", line(status="Warn")]
    landed = spark.createDataFrame([(x,) for x in lines], "value string")
    landed.write.text(place("in"))
    stream = jobs.read_files(spark, place("in"), "value string", "text")
    jobs.to_files(jobs.check_alerts(stream), place("out"), place("cp"))
    found = spark.read.parquet(place("out"))
    assert rows(found) == rows(jobs.check_alerts(landed))
    first = found.where("status = 'FAIL'").first()
    assert (first.model, first.test_name, first.column_name, first.subscribers, first.tags) == ("orders", "unique", "id", "a, b", "None")
    assert first.alert_text == "test failure: unique on orders.id (3 failures)"
    assert found.where("status = 'WARN'").first().failures == "unknown"


def test_offsets_once_across_restarts(spark, place):
    ddl = "topic string, partition int, offset bigint, event_time timestamp"
    data = spark.range(50).select(
        F.lit("t").alias("topic"), (c("id") % 3).cast("int").alias("partition"), c("id").alias("offset"),
        F.timestamp_seconds(c("id") * 60 + 1_700_000_000).alias("event_time"),
    )
    keys, table = ["topic", "partition", "offset"], jobs.BatchTable(spark, place("out"))
    for part in (data.where("offset >= 20"), data.where("offset < 30")):  # the older half comes last
        part.write.mode("append").parquet(place("in"))
        stream = jobs.read_files(spark, place("in"), ddl, maxFilesPerTrigger=1)
        jobs.to_batches(stream, jobs.keep_latest(table, keys, ["event_time"]), place("cp"))
    assert rows(jobs.latest(table, keys, ["event_time"])) == rows(data)


def test_latest_state_takes_late_and_repeated_batches(spark, place):
    table = jobs.BatchTable(spark, place("state"))
    write = jobs.keep_latest(table, ["k"], ["seq"])
    frames = [spark.createDataFrame(x, "k int, v string, seq int") for x in ([(1, "b", 2), (2, "x", 1)], [(1, "a", 1)], [(2, "y", 3)])]
    for i, df in enumerate(frames):
        write(df, i)
        write(df, i)
    assert rows(jobs.latest(table, ["k"], ["seq"])) == [(1, "b", 2), (2, "y", 3)]
    assert rows(jobs.compact(table, ["k"], ["seq"], place("compact"))) == [(1, "b", 2), (2, "y", 3)]


def test_daily_counts_over_two_runs(spark, place):
    ddl = "event_ts timestamp, user_name string, event_value bigint"
    data = spark.range(100).select(
        F.timestamp_seconds(c("id") * 3600 + 1_700_000_000).alias("event_ts"), (c("id") % 5).cast("string").alias("user_name"), c("id").alias("event_value")
    )
    table = jobs.BatchTable(spark, place("days"))
    for part in (data.where("event_value >= 40"), data.where("event_value < 40")):
        part.write.mode("append").parquet(place("in"))
        stream = jobs.read_files(spark, place("in"), ddl, maxFilesPerTrigger=2)
        jobs.to_batches(stream, jobs.keep_daily_parts(table, "event_ts"), place("cp"))
    got = jobs.daily_counts(table).select("event_date", "total_events", "total_value", "unique_users_approx")
    batch = data.groupBy(F.to_date("event_ts").alias("event_date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_value").alias("s"), F.count_distinct("user_name").alias("u")
    )
    assert rows(got) == rows(batch)


@pytest.mark.parametrize("name", ["t2_deduplicated_log", "t2_latest_state", "t3_daily_counts", "t3_daily_users"])
def test_one_file_per_batch_gives_the_same(spark, folder, monkeypatch, name):
    from tests.oracle import connect, differences
    from tidewright.plans.registry import load_all, runner
    from tidewright.streaming import queries

    monkeypatch.setattr(queries, "STREAM", {"maxFilesPerTrigger": "1"})
    monkeypatch.setattr(queries, "FILES", 4)
    q = load_all()[name]
    assert differences(runner(q)(spark, folder), q.sql, connect(folder)) == []


@pytest.mark.parametrize("seed, cuts", [(1, 1), (2, 3), (3, 6)])
def test_overdue_runs_are_those_of_the_batch_for_any_cut(spark, place, seed, cuts):
    """Whatever the cuts, and in any order within the lateness; runs that end late are reported, too."""
    rng = random.Random(seed)
    start = 1_700_000_000
    means = spark.createDataFrame([("a", 60.0), ("b", 600.0)], "job string, average_duration double")
    allowed = {"a": 120, "b": 1200}
    runs = []
    for i in range(120):
        begin = start + rng.randrange(20_000)
        job = rng.choice(["a", "b", "unknown"])
        limit = allowed.get(job, 60)
        runs.append((job, i, begin, rng.choice([None, begin, begin + limit, begin + limit + 1, begin + rng.randrange(3 * limit)])))
    records = [(j, i, "started", a) for j, i, a, _ in runs] + [(j, i, "completed", b) for j, i, _, b in runs if b is not None]
    records += [("none", 999, "heartbeat", start + 23_000)]
    records.sort(key=lambda r: r[3] + rng.randrange(60))  # out of order by less than a minute
    ddl = "job string, run_id long, record string, at timestamp"
    log = spark.createDataFrame([(j, i, r, datetime.fromtimestamp(t, timezone.utc)) for j, i, r, t in records], ddl)
    data = log.collect()
    size = -(-len(data) // cuts)
    for k in range(0, len(data), size):
        spark.createDataFrame(data[k : k + size], ddl).coalesce(1).write.mode("append").parquet(place("log"))
        stream = jobs.read_files(spark, place("log"), ddl)
        jobs.to_files(jobs.overdue_runs(stream, means, "1 minute"), place("alerts"), place("cp"))
    alerts = spark.read.parquet(place("alerts"))
    now = start + 23_000 - 60
    want = {i for j, i, a, b in runs if j in allowed and a + allowed[j] < now and (b is None or b > a + allowed[j])}
    assert sorted(r.run_id for r in alerts.collect()) == sorted(want)
    # What is still open is what the batch check finds at that moment.
    at = F.timestamp_seconds(F.lit(now))
    ends = log.where("record = 'completed'").select("run_id", c("at").alias("completed_at"))
    table = log.where("record = 'started'").select("job", "run_id", c("at").alias("created_at")).join(ends.where(c("completed_at") <= at), "run_id", "left")
    table = table.select("job", "run_id", F.lit("x").alias("status"), *[c(x).cast("timestamp_ntz").alias(x) for x in ("created_at", "completed_at")])
    batch = anomaly.long_running(table, at.cast("timestamp_ntz"), means=means)
    assert sorted(r.run_id for r in jobs.still_open(alerts, ends, at).collect()) == sorted(r.run_id for r in batch.collect())


def test_overdue_state_is_bounded(spark, place):
    """Completed and overdue runs leave the state as time passes."""
    means = spark.createDataFrame([("a", 60.0)], "job string, average_duration double")
    ddl, start = "job string, run_id long, record string, at timestamp", 1_700_000_000
    kept = []
    for k in range(4):
        rows_ = spark.range(200).select(
            F.lit("a").alias("job"), (c("id") + 200 * k).alias("run_id"), F.explode(F.array(F.lit("started"), F.lit("completed"))).alias("record"),
            F.timestamp_seconds(c("id") * 20 + 4000 * k + start).alias("at"),
        )
        rows_.where("record = 'started' or run_id % 3 > 0").coalesce(1).write.mode("append").parquet(place("log"))
        alerts = jobs.overdue_runs(jobs.read_files(spark, place("log"), ddl), means, "1 second")
        run = alerts.writeStream.format("parquet").option("checkpointLocation", place("cp")).option("path", place("out")).trigger(availableNow=True).start()
        run.awaitTermination()
        kept.append(run.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(kept) < 60  # of 200 runs a batch
