from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.operators import anomaly

c = F.col
T0 = datetime(2024, 1, 1)
RUNS = "job string, run_id int, status string, created_at timestamp_ntz, completed_at timestamp_ntz"


def now(minutes):
    return F.lit((T0 + timedelta(minutes=minutes)).isoformat(sep=" ")).cast("timestamp_ntz")


def run(job, i, start, took=None):
    begin = T0 + timedelta(minutes=start)
    return (job, i, "RUNNING" if took is None else "SUCCEEDED", begin, None if took is None else begin + timedelta(minutes=took))


def test_run_anomalies(spark):
    data = [run("a", 1, 0, 10), run("a", 2, 20, 10), run("a", 3, 90, 1), run("a", 4, 60), run("a", 5, 95), run("new", 6, 0)]
    found = anomaly.run_anomalies(spark.createDataFrame(data, RUNS), now(100))
    assert rows(found) == [
        ("a", 3, "SUCCEEDED", 60.0, 420.0, anomaly.FAST_REASON),
        ("a", 4, "RUNNING", 2400.0, 420.0, anomaly.SLOW_REASON),
    ]
    # Out of the window of the last 15 minutes the short run is no longer looked at.
    assert anomaly.suspiciously_short(spark.createDataFrame(data, RUNS), now(200)).isEmpty()


def test_impact(spark):
    operations = spark.createDataFrame([(1, 10), (1, 20), (2, 40), (3, 15), (4, 5), (5, 0), (6, 7)], "task_run_id int, seconds int")
    tasks = spark.createDataFrame(
        [
            (1, "t", datetime(2024, 1, 1), False), (2, "t", datetime(2024, 1, 2), False), (3, "t", datetime(2024, 1, 3), True),
            (4, "t", datetime(2024, 1, 4), False), (5, "t", datetime(2024, 1, 5), True), (6, "never", datetime(2024, 1, 1), False),
        ],
        "task_run_id int, task_name string, created_at timestamp_ntz, flag boolean",
    )
    only = anomaly.impact(operations, tasks).first()
    assert (only.task_name, only.avg_before, only.avg_after) == ("t", 35.0, 10.0)
    assert abs(only.pct_change + 71.42857) < 1e-4
    flagged_first = anomaly.impact(operations, tasks.where("task_run_id >= 3")).first()
    assert (flagged_first.avg_before, flagged_first.pct_change) == (None, None)


def test_duration_above_baseline_over_slices(spark, monkeypatch):
    """Overlapping slices give what one window per job gives."""
    n = c("id")
    runs = spark.range(400).select(
        F.when(n % 3 == 0, "hot").otherwise((n % 4).cast("string")).alias("job"), n.alias("run_id"),
        (n * 37 % 101).alias("at"), (n * 7919 % 53 + 1).alias("d"),
    )
    import inspect

    source = inspect.getsource(anomaly.duration_above_baseline)
    scope = dict(vars(anomaly))
    exec(source.replace("width = 100_000", "width = 25"), scope)  # noqa: S102
    got = scope["duration_above_baseline"](runs, "job", "at", "run_id", "d", 30, 10)
    w = Window.partitionBy("job").orderBy("at", "run_id").rowsBetween(-10, -1)
    plain = runs.withColumn("baseline", F.sum("d").over(w) / F.count("d").over(w)).where("d > baseline * 1.3")
    assert rows(got.select("run_id", "baseline")) == rows(plain.select("run_id", "baseline"))


def test_volume_anomalies(spark):
    train = spark.createDataFrame([("s", i, 10 + i % 2) for i in range(10)] + [("t", 0, 5)], "series string, ts int, target int")
    fresh = spark.createDataFrame([("s", 11, 11), ("s", 12, 30), ("s", 13, 0), ("t", 1, 6), ("unknown", 1, 1)], "series string, ts int, target int")
    scored = anomaly.volume_anomalies(train, fresh)
    assert {(r.series, r.ts): r.is_anomaly for r in scored.collect()} == {
        ("s", 11): False, ("s", 12): True, ("s", 13): True, ("t", 1): True,
    }
