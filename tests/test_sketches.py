"""Quantiles from stored parts, heavy values with a guarantee, and seasonal forecasts."""

from __future__ import annotations

import math
import random
from collections import Counter
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.operators import anomaly, sketches


def test_quantiles_of_merged_parts(spark):
    rng = random.Random(1)
    data = [(d, rng.choice(["a", "b"]), rng.expovariate(1 / 50)) for d in range(30) for _ in range(300)] + [(1, "a", None)]
    df = spark.createDataFrame(data, "day int, kind string, v double").repartition(7)
    stored = sketches.quantile_parts(df, ["day", "kind"], "v")
    assert stored.count() == 60
    by_kind = sketches.merge_quantile_parts(sketches.merge_quantile_parts(stored.withColumn("week", F.col("day") % 5), ["week", "kind"]), ["kind"])
    for r in sketches.quantiles(by_kind, p50=0.5, p90=0.9).collect():
        values = sorted(v for _, k, v in data if k == r.kind and v is not None)
        assert r.n_values == len(values)
        for got, share in ((r.p50, 0.5), (r.p90, 0.9)):
            assert abs(np.searchsorted(values, got) / len(values) - share) <= sketches.rank_error() + 1 / len(values)
    assert sketches.rank_error(200) > sketches.rank_error(800) > 0.005


def test_heavy_values_are_exact(spark):
    rng = random.Random(2)
    data = [int(rng.paretovariate(0.7)) for _ in range(20_000)] + [None] * 500
    df = spark.createDataFrame([(v,) for v in data], "v long").repartition(6)
    for skip, n in ((True, 20), (False, 10)):
        count = Counter(v for v in data if not (skip and v is None))
        want = sorted(count.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or 0))[:n]
        got = sketches.heavy_values(df, "v", n, tracked=2000, skip_null=skip)
        assert [(r.value, r["count"]) for r in got.orderBy("rank").collect()] == want


def test_heavy_values_that_cannot_be_told(spark):
    df = spark.range(50_000).select((F.col("id") % 25_000).alias("v"))
    with pytest.raises(sketches.NotGuaranteed):
        sketches.heavy_values(df, "v", 5, tracked=100)
    # All values fit the sketch, so even ties are exact.
    small = spark.range(300).select((F.col("id") % 30).cast("string").alias("v"))
    assert [r.value for r in sketches.heavy_values(small, "v", 3, tracked=100).orderBy("rank").collect()] == ["0", "1", "10"]
    assert sketches.heavy_values(small.where("false"), "v", 3).isEmpty()
    with pytest.raises(ValueError):
        sketches.heavy_values(spark.sql("select array(1) as v"), "v", 3)


def series(weeks, wave, slope, noise=0, start=date(2024, 1, 1)):
    rng = random.Random(weeks)
    return [(start + timedelta(i), wave[i % 7] + slope * i + rng.randint(-noise, noise)) for i in range(7 * weeks)]


def test_waves_are_no_alarms_and_spikes_are(spark):
    waves = {"a": [100, 120, 90, 80, 300, 20, 10], "b": [5] * 7, "c": [0, 0, 0, 0, 0, 900, 900]}
    train = [(s, d, y) for s, w in waves.items() for d, y in series(10, w, 3, 4)]
    later = [(s, d, y) for s, w in waves.items() for d, y in series(14, w, 3)[70:]]
    spikes = {("a", later[3][1]), ("c", later[60][1]), ("b", later[40][1])}
    later = [(s, d, y + (60 if (s, d) in spikes else 0)) for s, d, y in later]
    schema = "series string, day date, target long"
    made = anomaly.seasonal_forecast(spark.createDataFrame(train, schema), spark.createDataFrame(later, schema), width=4.0)
    assert {(r.series, r.day) for r in made.collect() if r.is_anomaly} == spikes
    # One band around the mean takes the weekends of "c" for normal and finds nothing.
    flat = anomaly.volume_anomalies(
        *[spark.createDataFrame(x, schema).withColumnRenamed("day", "ts") for x in (train, later)], width=4.0
    )
    assert {(r.series, r.ts) for r in flat.collect() if r.is_anomaly} != spikes


def test_fit_is_that_of_least_squares(spark):
    data = series(9, [10, 4, 7, 30, 2, 60, 1], 0.7, 5)[:60]
    a = np.array([[*(float(d.weekday() == w) for w in range(7)), (d - data[0][0]).days] for d, _ in data])
    y = np.array([v for _, v in data])
    fit, left, *_ = np.linalg.lstsq(a, y, rcond=None)
    schema = "series int, day date, target double"
    new = [(1, date(2024, 4, 1) + timedelta(i), float(i)) for i in range(9)]
    made = anomaly.seasonal_forecast(spark.createDataFrame([(1, *x) for x in data], schema), spark.createDataFrame(new, schema), 2.0)
    for r in made.collect():
        want = fit[r.day.weekday()] + fit[7] * (r.day - data[0][0]).days
        assert math.isclose(r.forecast, want, rel_tol=1e-9) and math.isclose(r.upper_bound - want, 2 * math.sqrt(left[0] / (60 - 8)), rel_tol=1e-6)


def test_short_histories(spark):
    schema = "series string, day date, target long"
    train = spark.createDataFrame([("one", date(2024, 1, 1), 5), ("two", date(2024, 1, 1), 4), ("two", date(2024, 1, 2), None), (None, None, 1)], schema)
    new = spark.createDataFrame([("one", date(2024, 1, 9), 5), ("one", date(2024, 1, 8), None), ("two", date(2024, 1, 8), 9), ("new", date(2024, 1, 8), 1)], schema)
    got = {(r.series, r.day.day): (r.forecast, r.is_anomaly) for r in anomaly.seasonal_forecast(train, new).collect()}
    assert got == {("one", 9): (5.0, False), ("one", 8): (5.0, False), ("two", 8): (4.0, True)}
    assert rows(anomaly.seasonal_forecast(train.where("false"), new)) == []
