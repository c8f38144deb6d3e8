"""Files of bounded size, rows along a curve, and backfills that go on where they stopped."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.operators import audit, reshape
from tidewright.sources import layout, load
from tidewright.sources.ledger import PeriodLedger
from tidewright.sources.tables import export_csv, export_per_value, push_sheet, read_csv, unload
from tidewright.streaming import jobs

c = F.col


def test_no_file_is_above_the_limit(spark, tmp_path):
    path = str(tmp_path / "out")
    # The second half does not compress at all, so the planned rows per file are too many there.
    noise = F.concat(*[F.sha2(F.concat_ws("-", "id", F.lit(i)), 512) for i in range(6)])
    df = spark.range(6000).select("id", F.when(c("id") > 3000, noise).otherwise("x").alias("v")).coalesce(1)
    unload(df, path, max_bytes=100_000)
    sizes = layout.file_sizes(spark, path)
    assert max(sizes.values()) <= 100_000 and len(sizes) > 10
    assert rows(spark.read.parquet(path).agg(F.count("*"), F.count_distinct("id"), F.sum(F.length("v")))) == rows(
        df.agg(F.count("*"), F.count_distinct("id"), F.sum(F.length("v")))
    )
    unload(df.limit(5), path, max_bytes=100_000)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError):
        unload(df.where("id > 5980"), path, max_bytes=300)
    assert spark.read.parquet(path).count() == 5


def test_both_columns_prune(spark, tmp_path):
    df = spark.range(40_000).select(
        F.pmod(F.xxhash64("id"), F.lit(5000)).alias("a"), F.exp(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) / 10).alias("b"), "id"
    )
    path = str(tmp_path / "curve")
    layout.write_clustered(df, path, ["a", "b"], 24_000)
    laid = spark.read.parquet(path)
    files = len(layout.file_sizes(spark, path))
    assert files >= 16 and max(layout.file_sizes(spark, path).values()) <= 24_000
    assert layout.files_to_read(laid, "a", 0, 200) <= files / 2 and layout.files_to_read(laid, "b", 0, 2) <= files / 2
    assert laid.count() == 40_000 and laid.agg(F.sum("id")).first()[0] == 40_000 * 39_999 // 2


def test_hot_values_and_nulls_spread(spark, tmp_path):
    df = spark.range(20_000).select(F.when(c("id") % 3 > 0, 7).alias("a"), F.lit("same").alias("b"), "id")
    path = str(tmp_path / "hot")
    layout.write_clustered(df, path, ["a", "b"], 20_000)
    assert len(layout.file_sizes(spark, path)) >= 4 and spark.read.parquet(path).where("a is null").count() == 6667
    layout.write_clustered(df.where("false"), path, ["a", "b"], 20_000)
    assert spark.read.schema(df.schema).parquet(path).isEmpty()


def test_row_size_is_sampled_where_rows_lie(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "sample")
    monkeypatch.setattr(layout, "scratch_path", lambda *_: path)

    def with_task(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "task": [TaskContext.get().taskAttemptId()] * batch.num_rows})

    df = spark.range(0, 120_000, 1, 6).mapInArrow(with_task, "id long, task long")
    assert 2 < layout.row_bytes(df, 120_000) < 16
    written = spark.read.parquet(path)
    assert written.select("task").distinct().count() == 6  # no task read it all
    assert len(layout.file_sizes(spark, path)) == 1 and 40_000 < written.count() < 60_000


def test_curve_interleaves_ranks(spark):
    df = spark.range(16).select((c("id") % 4).alias("x"), F.floor(c("id") / 4).alias("y"))
    key = layout.curve_key(df, ["x", "y"], bits=2)
    got = {(r.x, r.y): r.k for r in df.withColumn("k", key).collect()}
    assert got == {(x, y): sum(((x >> b & 1) << (2 * b + 1)) | ((y >> b & 1) << (2 * b)) for b in range(2)) for x in range(4) for y in range(4)}


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def bounds():
    return at("2024-01-01"), at("2024-06-20")


def readings(spark):
    first = datetime(2024, 1, 1)
    # Nothing in March; edges of months belong to the month before.
    times = [first + timedelta(days=d) for d in range(0, 175, 2)] + [datetime(2024, 2, 1), datetime(2024, 5, 1)]
    return spark.createDataFrame([(i, t) for i, t in enumerate(times) if t.month != 3], "id int, ts timestamp_ntz")


@pytest.mark.parametrize("stop_after", range(1, 6))
def test_a_backfill_stopped_anywhere_goes_on(spark, tmp_path, monkeypatch, stop_after):
    rows_ = readings(spark)
    whole = load.by_period(rows_, "ts", "month", *bounds())
    ledger = PeriodLedger(spark, str(tmp_path / "ledger"))
    write, written = PeriodLedger._load, []

    def breaks(self, *args):
        if len(written) == stop_after:
            raise RuntimeError("lost")
        written.append(args[-1])
        write(self, *args)

    monkeypatch.setattr(PeriodLedger, "_load", breaks)
    with pytest.raises(RuntimeError):
        ledger.backfill(rows_, "ts", "month", *bounds())
    before = {r.period: r.path for r in ledger.entries().collect()}
    assert sorted(before) == list(range(stop_after))
    monkeypatch.setattr(PeriodLedger, "_load", write)
    assert ledger.backfill(rows_, "ts", "month", *bounds(), together=2) == list(range(stop_after, 6))
    entries = {r.period: (r.path, r.rows) for r in ledger.entries().collect()}
    assert all(entries[p][0] == path for p, path in before.items())  # not written again
    counts = {r.period_number: r["count"] for r in whole.groupBy("period_number").count().collect()}
    assert {p: n for p, (_, n) in entries.items()} == {p: counts.get(p, 0) for p in range(6)}
    assert entries[2] == (None, 0) or counts.get(2)  # a gap has an entry, too
    assert rows(ledger.read(rows_.schema)) == rows(whole.drop("period_number"))
    assert ledger.backfill(rows_, "ts", "month", *bounds()) == []


def test_two_backfills_take_each_period_once(spark, tmp_path):
    rows_ = readings(spark)
    a, b = (PeriodLedger(spark, str(tmp_path / "ledger")) for _ in range(2))
    a.backfill(rows_, "ts", "month", *bounds(), most=3)
    b._load(rows_, "ts", "month", *bounds(), [1, 2, 3])  # as if it had looked before the first one finished
    assert rows(a.read(rows_.schema)) == rows(load.by_period(rows_, "ts", "month", *bounds()).where("period_number < 4").drop("period_number"))
    empty = PeriodLedger(spark, str(tmp_path / "none"))
    assert empty.read("id int").isEmpty() and empty.finished() == set()


def test_exports_keep_quotes_headers_and_the_value(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", you', "F"), (2, "plain", "O"), (3, None, "F")], "id int, v string, kind string").repartition(3)
    path = str(tmp_path / "values")
    export_per_value(df, path, "kind", single=True)
    names = layout.file_sizes(spark, path)
    assert len(names) == 2
    assert rows(read_csv(spark, f"{path}/kind=F", "id int, v string, kind string")) == [(1, 'say "hi", you', "F"), (3, None, "F")]
    sheet = str(tmp_path / "sheet")
    push_sheet(df, sheet)
    (file,) = (tmp_path / "sheet").glob("part-*.csv")
    lines = file.read_text().splitlines()
    assert lines[0] == "id,v,kind" and '1,"say ""hi"", you",F' in lines and len(lines) == 4
    export_csv(df, path, single=True)
    assert rows(read_csv(spark, path, "id int, v string, kind string")) == rows(df)


def test_route_keeps_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "007"), (2, "7"), (3, None)], "id int, code string")
    assert rows(load.route(df, str(tmp_path / "routed"), "code")) == rows(df)


def test_union_of_names_that_differ_in_case(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], "v int, w string"), spark.createDataFrame([(2.5, "y")], "V double, W string")
    made = reshape.union_relations({"a": a, "b": b}, column_override={"V": "double"}, exclude=["w"])
    made.write.parquet(str(tmp_path / "union"))
    assert made.columns == ["_source_relation", "v"] and rows(made) == [("a", 1.0), ("b", 2.5)]


def test_cursors_of_every_type(spark):
    big = spark.createDataFrame([(2**60 + 1,)], "k long"), spark.createDataFrame([(2**60,)], "k long")
    assert int(audit.cursor_reconciliation(*big, "k").first().max_drift) == 1
    times = spark.sql("select timestamp_ntz'2024-01-02 00:00:00.000005' as k"), spark.sql("select timestamp_ntz'2024-01-01' as k")
    r = audit.cursor_reconciliation(*times, "k").first()
    assert (r.max_drift, r.next_cursor) == (86_400_000_005, datetime(2024, 1, 2, 0, 0, 0, 5))
    days = spark.sql("select date'2024-01-02' as k"), spark.sql("select date'2024-02-01' as k")
    assert audit.cursor_reconciliation(*days, "k").first().max_drift == -30
    words = spark.sql("select 'b' as k"), spark.sql("select 'a' as k where false")
    r = audit.cursor_reconciliation(*words, "k").first()
    assert (r.source_max, r.target_max, r.max_drift, r.next_cursor, r.count_drift) == ("b", None, None, "b", 1)


@pytest.mark.parametrize(
    "a, b, same",
    [("1", "cast(1.00 as decimal(5,2))", True), ("'1.00'", "1", True), ("'x'", "1", False), ("1", "1.5", False), ("null", "null", True),
     ("date'2024-01-01'", "timestamp_ntz'2024-01-01 00:00:00'", True), ("'1.50'", "1.5D", True), ("null", "0", False), ("'a'", "'a'", True)],
)
def test_scalars_by_value(spark, a, b, same):
    assert audit.scalar_reconciliation(spark.sql(f"select {a} as x"), spark.sql(f"select {b} as y")).first().is_match is same


def test_large_metrics_are_exact(spark):
    a, b = spark.sql(f"select {2**60 + 1} as n"), spark.sql(f"select {2**60} as N")
    assert not audit.reconcile_metrics(a, b).first().is_match and audit.reconcile_metrics(a, a).first().is_match


def test_folded_batches_are_retired(spark, tmp_path):
    table = jobs.BatchTable(spark, str(tmp_path / "batches"))
    write = jobs.keep_latest(table, ["k"], ["seq"])
    batch = lambda *data: spark.createDataFrame(list(data), "k int, v string, seq int")
    write(batch((1, "a", 1), (2, "x", 1)), 0)
    write(batch((1, "b", 2)), 1)
    assert rows(jobs.compact(table, ["k"], ["seq"])) == [(1, "b", 2), (2, "x", 1)]
    assert table._live()[1] == [f"{table.root}/_folded/upto=1"]
    write(batch((1, "late", 0), (3, "c", 1)), 2)
    assert rows(jobs.latest(table, ["k"], ["seq"])) == [(1, "b", 2), (2, "x", 1), (3, "c", 1)]
    jobs.compact(table, ["k"], ["seq"])
    # The second fold removed the batches that the first one replaced.
    assert not (tmp_path / "batches" / "batch_id=0").exists() and (tmp_path / "batches" / "batch_id=2").exists()
    assert table.read().count() == 3 and rows(jobs.compact(table, ["k"], ["seq"])) == rows(table.read())
