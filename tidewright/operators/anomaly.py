"""Run-duration and volume anomalies, and before/after impact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.dates import micros
from tidewright.operators.windows import row_number, running_sum, with_window

# Fixed values of the run checks.
SLOW_FACTOR = 2.0
FAST_FACTOR = 0.5
CADENCE_MINUTES = 15
SLOW_REASON = "Run is taking too long"
FAST_REASON = "Run completed significantly faster than average"


def seconds_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / 1_000_000


def mean_durations(runs: DataFrame) -> DataFrame:
    """Mean seconds of the completed runs of each job, from exact integer sums."""
    done = runs.where(F.col("completed_at").isNotNull())
    took = micros(F.col("completed_at")) - micros(F.col("created_at"))
    return done.groupBy("job").agg((F.sum(took) / F.count(F.lit(1)) / 1_000_000).alias("average_duration"))


def long_running(
    runs: DataFrame, now: Column, threshold: float = SLOW_FACTOR, means: DataFrame | None = None
) -> DataFrame:
    """Open runs older than ``threshold`` times the mean; jobs without completed runs give nothing.

    ``runs`` has job, run_id, status, created_at, completed_at.
    """
    open_runs = runs.where(F.col("completed_at").isNull())
    age = seconds_between(F.col("created_at"), now)
    return _judged(open_runs, runs, means, age, lambda d, m: d > m * threshold, SLOW_REASON)


def suspiciously_short(
    runs: DataFrame,
    now: Column,
    cadence_minutes: int = CADENCE_MINUTES,
    factor: float = FAST_FACTOR,
    means: DataFrame | None = None,
) -> DataFrame:
    """Runs completed within the last minutes that took less than ``factor`` times the mean."""
    since = seconds_between(F.col("completed_at"), now)
    recent = runs.where(F.col("completed_at").isNotNull() & (since <= cadence_minutes * 60))
    took = seconds_between(F.col("created_at"), F.col("completed_at"))
    return _judged(recent, runs, means, took, lambda d, m: d < m * factor, FAST_REASON)


def _judged(rows: DataFrame, runs: DataFrame, means: DataFrame | None, duration: Column, test, reason: str) -> DataFrame:
    means = means if means is not None else mean_durations(runs)
    timed = rows.withColumn("duration", duration).join(means, "job", "inner")
    bad = timed.where(test(F.col("duration"), F.col("average_duration")))
    return bad.select(
        F.col("job").alias("job_name"),
        "run_id",
        "status",
        F.round("duration", 2).alias("duration"),
        F.round("average_duration", 2).alias("average_duration"),
        F.lit(reason).alias("reason"),
    )


def run_anomalies(runs: DataFrame, now: Column, threshold: float = SLOW_FACTOR, cadence_minutes: int = CADENCE_MINUTES) -> DataFrame:
    """Long-running and suspiciously short runs together."""
    slow = long_running(runs, now, threshold)
    return slow.unionByName(suspiciously_short(runs, now, cadence_minutes))


def impact(operations: DataFrame, task_runs: DataFrame) -> DataFrame:
    """Mean operation time per run before and after a task's first use of a flag, with the change in percent.

    ``operations`` has task_run_id and seconds; ``task_runs`` has task_run_id, task_name, created_at, flag. Tasks
    that never used the flag are left out. A run lies before the first use when no flagged run is at or before it,
    which a running count tells in one pass.
    """
    totals = (
        operations.where(F.col("task_run_id").isNotNull() & (F.col("seconds") > 0))
        .groupBy(F.col("task_run_id").cast("string").alias("task_run_id"))
        .agg(F.sum("seconds").alias("total_seconds"))
    )
    runs = task_runs.withColumn("task_run_id", F.col("task_run_id").cast("string"))
    merged = runs.join(totals, "task_run_id", "inner").withColumn("__flag", F.col("flag").cast("int"))
    timed = with_window(merged, ["created_at"], ["task_name"], key_source=task_runs, __uses=running_sum("__flag"))
    early, total = F.coalesce("__uses", F.lit(0)) == 0, F.col("total_seconds")

    def mean(test: Column) -> Column:
        kept = F.when(test, total)
        return F.sum(kept).cast("double") / F.nullif(F.count(kept), F.lit(0))

    stats = timed.groupBy("task_name").agg(
        mean(early).alias("avg_before"), mean(~early).alias("avg_after"), F.max("__flag").alias("__used")
    )
    before, after = F.col("avg_before"), F.col("avg_after")
    change = F.when(before > 0, (after - before) / before * 100).alias("pct_change")
    return stats.where(F.col("__used") == 1).select("task_name", "avg_before", "avg_after", change)


def duration_above_baseline(
    runs: DataFrame,
    job: str,
    at: str,
    run_id: str,
    duration: str,
    percent: float = 30.0,
    history: int = 10,
    width: int = 100_000,
) -> DataFrame:
    """Runs longer than the mean of the job's earlier ``history`` runs by more than ``percent``.

    A bounded frame needs only the rows just before; jobs with very many runs are cut into time slices that
    overlap by ``history`` runs. A slice holds ``width`` runs; its size does not touch the result.
    """
    numbered = with_window(runs, [at, run_id], [job], __n=row_number())
    # Slices of a job: each run also goes to the next slice when that one needs it as history.
    slot = F.floor((F.col("__n") - 1) / width)
    ahead = F.floor((F.col("__n") - 1 + history) / width)
    copies = numbered.withColumn("__slot", F.explode(F.sequence(slot, ahead)))
    w = Window.partitionBy(job, "__slot").orderBy("__n").rowsBetween(-history, -1)
    timed = copies.select(
        "*", F.sum(duration).over(w).alias("__sum"), F.count(duration).over(w).alias("__cnt")
    ).where(F.col("__slot") == slot)
    baseline = F.col("__sum") / F.nullif(F.col("__cnt"), F.lit(0))
    out = timed.withColumn("baseline", baseline).where(F.col(duration) > F.col("baseline") * (1 + percent / 100))
    return out.drop("__n", "__slot", "__sum", "__cnt")


def volume_anomalies(train: DataFrame, predict: DataFrame, width: float = 3.0) -> DataFrame:
    """New points outside the mean plus or minus ``width`` standard deviations of their series' history.

    Both frames have ts, target and series.
    """
    band = train.groupBy("series").agg(
        F.avg("target").alias("forecast"), F.coalesce(F.stddev_samp("target"), F.lit(0.0)).alias("__sd")
    )
    scored = predict.join(band, "series", "inner").select(
        "series",
        "ts",
        "target",
        "forecast",
        (F.col("forecast") - width * F.col("__sd")).alias("lower_bound"),
        (F.col("forecast") + width * F.col("__sd")).alias("upper_bound"),
    )
    outside = (F.col("target") < F.col("lower_bound")) | (F.col("target") > F.col("upper_bound"))
    return scored.withColumn("is_anomaly", outside)


def seasonal_forecast(train: DataFrame, predict: DataFrame, width: float = 3.0) -> DataFrame:
    """New points outside the band around a trend with weekday effects, fitted per series by least squares.

    Both frames have series, day (date) and target (a number); a series has at most one row per day, or all rows of a day
    count. The model is ``level of the weekday + slope * day``; the slope comes from each weekday's own sums, so the fit
    takes two groupings of sums and no series is collected. The band is ``width`` residual standard deviations wide on
    either side. Days are counted from the series' first one, sums of whole numbers are exact.

    A weekday without history takes the mean level of the others, a series whose weekdays all lie on one day has slope 0,
    one with no more rows than fitted numbers a band of width 0, and rows of series without history are left out. Null days
    and targets are left out of the history; a null target is no anomaly.
    """
    zero = F.lit(0.0)
    known = train.where(F.col("day").isNotNull() & F.col("target").isNotNull())
    origin = known.groupBy("series").agg(F.min("day").alias("__origin"))
    y = _summable(train, "target")
    timed = known.join(origin, "series").select(
        "series", "__origin", F.weekday("day").alias("__w"), F.datediff("day", "__origin").cast("decimal(9,0)").alias("t"), y.alias("y")
    )
    t, y, n = F.col("t"), F.col("y"), F.col("n")
    sums = {"st": t, "sy": y, "stt": t * t, "sty": t * y, "syy": y * y}
    day = timed.groupBy("series", "__w", "__origin").agg(
        F.count(F.lit(1)).cast("decimal(18,0)").alias("n"), *[F.sum(e).alias(name) for name, e in sums.items()]
    )

    def spread_of(product: str, one: str, other: str) -> Column:
        return (n * F.col(product) - F.col(one) * F.col(other)).cast("double") / n.cast("double")

    part = day.select(
        "series",
        "__w",
        "__origin",
        "n",
        (F.col("st").cast("double") / n.cast("double")).alias("mt"),
        (F.col("sy").cast("double") / n.cast("double")).alias("my"),
        spread_of("stt", "st", "st").alias("ctt"),
        spread_of("sty", "st", "sy").alias("cty"),
        spread_of("syy", "sy", "sy").alias("cyy"),
    )
    # At most seven rows per series from here on; they are taken in order, so that sums do not depend on the plan.
    items = F.array_sort(F.collect_list(F.struct("__w", "n", "mt", "my", "ctt", "cty", "cyy")))
    whole = part.groupBy("series", "__origin").agg(items.alias("d"))

    def over(value) -> Column:
        return F.aggregate("d", zero, lambda a, x: a + value(x))

    ctt, cty, cyy = (over(lambda x, k=k: x[k]) for k in ("ctt", "cty", "cyy"))
    whole = whole.select("*", F.when(ctt > 0, cty / ctt).otherwise(zero).alias("slope"), ctt.alias("ctt"), cty.alias("cty"), cyy.alias("cyy"))
    rows, fitted = over(lambda x: x["n"].cast("double")), F.size("d") + F.when(F.col("ctt") > 0, 1).otherwise(0)
    left = F.greatest(F.col("cyy") - F.col("slope") * F.col("cty"), zero)
    spread = F.when(rows > fitted, F.sqrt(left / (rows - fitted))).otherwise(zero)
    levels = F.map_from_entries(F.transform("d", lambda x: F.struct(x["__w"], x["my"] - F.col("slope") * x["mt"])))
    fit = whole.select("series", "__origin", "slope", spread.alias("__sd"), levels.alias("__levels"))
    shared = F.aggregate(F.map_values("__levels"), zero, lambda a, x: a + x) / F.size("__levels")
    level = F.coalesce(F.try_element_at("__levels", F.weekday("day")), shared)
    made = predict.join(fit, "series").withColumn("forecast", level + F.col("slope") * F.datediff("day", "__origin"))
    banded = made.select(
        "series",
        "day",
        "target",
        "forecast",
        (F.col("forecast") - width * F.col("__sd")).alias("lower_bound"),
        (F.col("forecast") + width * F.col("__sd")).alias("upper_bound"),
    )
    outside = (F.col("target") < F.col("lower_bound")) | (F.col("target") > F.col("upper_bound"))
    return banded.withColumn("is_anomaly", F.coalesce(outside, F.lit(False)))


def _summable(df: DataFrame, column: str) -> Column:
    """Whole numbers as decimals, whose sums of products are exact; others as doubles."""
    whole = isinstance(df.schema[column].dataType, T.IntegralType)
    return F.col(column).cast("decimal(18,0)" if whole else "double")
