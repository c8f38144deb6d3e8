"""Load modes: first run, second run, late rows and repeats."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.operators import checks as ck
from tidewright.sources import load
from tidewright.sources.load import AuditFailed, VersionedTable

c = F.col


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "table"))


def kv(spark, *data):
    return spark.createDataFrame(list(data), "k int, v string, seq int")


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def test_replace_append_read(spark, table):
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()
    table.append(kv(spark, (1, "a", 1)))
    table.append(kv(spark, (2, "b", 1)))
    assert rows(table.read()) == [(1, "a", 1), (2, "b", 1)]
    # A table may be rewritten from itself.
    table.replace(table.read().where("k = 2"))
    assert rows(table.read()) == [(2, "b", 1)]


def test_a_reader_keeps_its_version(spark, table):
    table.replace(kv(spark, (1, "a", 1)))
    old = table.read()
    table.replace(kv(spark, (9, "z", 9)))
    assert rows(old) == [(1, "a", 1)] and rows(table.read()) == [(9, "z", 9)]


def test_merge_last_version_wins_and_repeats(spark, table):
    table.merge(kv(spark, (1, "a", 1), (2, "b", 1)), ["k"], ["seq"])
    batch = kv(spark, (2, "old", 2), (2, "new", 3), (3, "c", 1))
    for _ in range(2):
        table.merge(batch, ["k"], ["seq"])
        assert rows(table.read()) == [(1, "a", 1), (2, "new", 3), (3, "c", 1)]


def test_upsert_latest_ignores_late_rows(spark, table):
    table.upsert_latest(kv(spark, (1, "new", 5)), ["k"], ["seq"])
    table.upsert_latest(kv(spark, (1, "late", 4), (2, "b", 1)), ["k"], ["seq"])
    assert rows(table.read()) == [(1, "new", 5), (2, "b", 1)]


def test_delete_insert(spark, table):
    table.replace(kv(spark, (1, "a", 1), (1, "b", 2), (2, "c", 1)))
    assert rows(table.delete_insert(kv(spark, (1, "x", 9)), ["k"])) == [(1, "x", 9), (2, "c", 1)]


def test_merge_partitions(spark, tmp_path):
    path = str(tmp_path / "parts")
    kv(spark, (1, "a", 1), (2, "b", 1), (11, "c", 1)).withColumn("p", F.floor(c("k") / 10)).write.partitionBy("p").parquet(path)
    batch = kv(spark, (11, "C", 2), (12, "d", 1)).withColumn("p", F.floor(c("k") / 10))
    load.merge_partitions(spark, path, batch, ["k"], ["seq"], "p")
    assert rows(spark.read.parquet(path).drop("p")) == [(1, "a", 1), (11, "C", 2), (12, "d", 1), (2, "b", 1)]


def test_incremental_append(spark, table):
    source = kv(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3))
    load.incremental_append(table, source, "seq", upto=F.lit(2))
    load.incremental_append(table, source, "seq", upto=F.lit(2))
    assert table.read().count() == 2
    assert load.incremental_append(table, source, "seq").count() == 3


def test_incremental_by_key(spark, table):
    first = kv(spark, (1, "a", 1), (2, "b", 9))
    load.incremental_by_key(table, first, ["k"], c("seq") > 5)
    again = kv(spark, (1, "changed", 1), (2, "changed", 9))
    load.incremental_by_key(table, again, ["k"], c("seq") > 5)
    assert rows(table.read()) == [(1, "a", 1), (2, "changed", 9)]
    load.incremental_by_key(table, again, ["k"], c("seq") > 5, full_refresh=True)
    assert rows(table.read()) == [(1, "changed", 1), (2, "changed", 9)]


def test_scd2_check(spark):
    base = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, loc string")
    then = spark.createDataFrame([(1, "x"), (2, "z"), (3, "w"), (4, "n")], "id int, loc string")
    day1, day2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    history = load.first_snapshot(base, at("2024-01-01"))
    second = load.scd2(history, then, "id", at("2024-01-02"), check_cols=["loc"])
    expected = [
        (1, "x", day1, None), (2, "y", day1, day2), (2, "z", day2, None),
        (3, None, day1, day2), (3, "w", day2, None), (4, "n", day2, None),
    ]
    assert sorted(rows(second), key=str) == sorted(expected, key=str)
    # The same input again changes nothing; a key that is gone stays open.
    third = load.scd2(second, then.where("id <> 1"), "id", at("2024-01-03"), check_cols=["loc"])
    assert sorted(rows(third), key=str) == sorted(expected, key=str)


def test_scd2_timestamp(spark):
    ddl = "id int, v string, updated_at timestamp_ntz"
    base = spark.createDataFrame([(1, "a", datetime(2024, 1, 1)), (2, "b", datetime(2024, 1, 1))], ddl)
    then = spark.createDataFrame([(1, "ignored", datetime(2024, 1, 1)), (2, "B", datetime(2024, 1, 5))], ddl)
    made = load.scd2(load.first_snapshot(base, at("2024-01-01")), then, "id", at("2024-02-01"), updated_at="updated_at")
    opened = {(r.id, r.v): (r.valid_from.day, r.valid_to and r.valid_to.day) for r in made.collect()}
    assert opened == {(1, "a"): (1, None), (2, "b"): (1, 5), (2, "B"): (5, None)}
    with pytest.raises(ValueError):
        load.scd2(base, then, "id", at("2024-02-01"))


def test_insert_by_period(spark, tmp_path):
    created = ["2017-12-02", "2018-01-02", "2018-02-02", "2018-03-02", "2018-04-02", "2018-05-02", "2018-06-02", "2018-07-02", "2018-08-02"]
    data = [(i + 1, datetime.fromisoformat(x)) for i, x in enumerate(created)]
    df = spark.createDataFrame(data, "id int, created_at timestamp_ntz")
    for _ in range(2):
        made = load.insert_by_period(spark, str(tmp_path / "p"), df, "created_at", "month", at("2018-01-01"), at("2018-06-01"))
        assert rows(made.select("id", "period_number")) == [(2, 0), (3, 1), (4, 2), (5, 3), (6, 4)]


def test_insert_by_period_resumes(spark, tmp_path):
    path, bounds = str(tmp_path / "p"), (at("2018-01-01"), at("2019-01-01"))
    ddl = "id int, t timestamp_ntz"
    first = [(1, datetime(2018, 1, 10)), (2, datetime(2018, 2, 10))]
    load.insert_by_period(spark, path, spark.createDataFrame(first, ddl), "t", "month", *bounds, resume=True)
    # Rows of the last period that came late are taken in; earlier periods are left alone.
    more = [(9, datetime(2018, 1, 11)), *first[1:], (3, datetime(2018, 2, 20)), (4, datetime(2018, 3, 1, 12))]
    made = load.insert_by_period(spark, path, spark.createDataFrame(more, ddl), "t", "month", *bounds, resume=True)
    assert rows(made.select("id", "period_number")) == [(1, 0), (2, 1), (3, 1), (4, 2)]


def test_period_edges(spark):
    times = ["2018-01-15 00:00:00", "2018-01-15 00:00:01", "2018-02-15 00:00:00", "2018-02-15 00:00:01", "2018-03-01 00:00:00"]
    df = spark.createDataFrame([(datetime.fromisoformat(x),) for x in times], "t timestamp_ntz")
    made = load.by_period(df, "t", "month", at("2018-01-15"), at("2019-01-01"))
    assert [r.period_number for r in made.orderBy("t").collect()] == [0, 0, 1, 1]


def test_backfill_windows(spark):
    bounds = spark.createDataFrame([(datetime(2024, 1, 1), datetime(2024, 1, 20))], "a timestamp_ntz, b timestamp_ntz")
    got = [(r.window_from, r.window_to) for r in load.backfill_windows(bounds, "a", "b").orderBy("chunk_number").collect()]
    assert got == [
        (datetime(2024, 1, 13), datetime(2024, 1, 20)),
        (datetime(2024, 1, 5, 23, 59, 59), datetime(2024, 1, 12, 23, 59, 59)),
        (datetime(2024, 1, 1), datetime(2024, 1, 5, 23, 59, 58)),
    ]


def test_write_audit_publish(spark, table):
    checks = {"k is filled": lambda df: ck.not_null(df, "k")}
    table.audited(kv(spark, (1, "a", 1)), checks)
    with pytest.raises(AuditFailed, match="k is filled"):
        table.audited(kv(spark, (None, "a", 1)), checks)
    assert rows(table.read()) == [(1, "a", 1)]


def test_clone_is_independent(spark, table, tmp_path):
    table.replace(kv(spark, (1, "a", 1)))
    copy = table.clone_to(str(tmp_path / "copy"))
    table.append(kv(spark, (2, "b", 1)))
    copy.append(kv(spark, (3, "c", 1)))
    assert rows(copy.read()) == [(1, "a", 1), (3, "c", 1)]


def test_change_data(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    changes = spark.createDataFrame(
        [(1, "x", "U", 1), (1, "y", "U", 2), (2, None, "D", 3), (4, "n", "I", 4), (5, "m", "I", 5), (5, None, "D", 6)],
        "k int, v string, op string, seq int",
    )
    assert rows(load.apply_changes(target, changes, ["k"], "seq", "op")) == [(1, "y"), (3, "c"), (4, "n")]


def test_lookback(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 9),)], "t timestamp_ntz")
    assert load.lookback(df, "t", at("2024-01-10"), 3).count() == 1
    assert load.lookback(df, "t", at("2024-01-10"), None).count() == 2


def files_of(path):
    from pathlib import Path

    return {str(p) for p in Path(path).rglob("*.parquet")}


def test_merge_partitions_loses_nothing(spark, tmp_path):
    ddl, path = "k int, v string, seq int, p string", str(tmp_path / "parts")
    first = [(1, "a", 1, None), (2, "b", 1, None), (3, "c", 1, "007"), (4, "d", 1, "7"), (5, "e", 1, "x")]
    spark.createDataFrame(first, ddl).write.partitionBy("p").parquet(path)
    untouched = {f for f in files_of(path) if "p=7/" in f or "p=x" in f}
    batch = spark.createDataFrame([(9, "n", 1, None), (2, "B", 2, None), (3, "C", 2, "007")], ddl)
    for _ in range(2):
        load.merge_partitions(spark, path, batch, ["k"], ["seq"], "p")
        got = rows(spark.read.schema(ddl).parquet(path))
        assert got == rows(spark.createDataFrame([(1, "a", 1, None), (2, "B", 2, None), (9, "n", 1, None), (3, "C", 2, "007"), (4, "d", 1, "7"), (5, "e", 1, "x")], ddl))
        assert untouched and untouched <= files_of(path)


def test_incremental_append_takes_late_rows_at_the_edge(spark, table):
    source = kv(spark, (1, "a", 1), (2, "b", 2), (4, "null", None))
    load.incremental_append(table, source, "seq", keys=["k"])
    more = source.unionAll(kv(spark, (3, "late", 2), (5, "new", 3), (6, "null too", None)))
    for _ in range(2):
        got = load.incremental_append(table, more, "seq", keys=["k"])
        assert sorted(r.k for r in got.collect()) == [1, 2, 3, 4, 5, 6]


def test_history_with_null_keys_and_repeats(spark, table, tmp_path):
    base = spark.createDataFrame([(None, "x"), (2, "y")], "id int, loc string")
    then = spark.createDataFrame([(None, "x"), (2, "z")], "id int, loc string")
    for n in range(3):
        table.track(base, "id", at(f"2024-01-0{n + 1}"), check_cols=["loc"])
    assert table.read().count() == 2
    for n in range(2):
        table.track(then, "id", at(f"2024-02-0{n + 1}"), check_cols=["loc"])
    day, later = datetime(2024, 1, 1), datetime(2024, 2, 1)
    assert sorted(rows(table.read()), key=str) == sorted([(None, "x", day, None), (2, "y", day, later), (2, "z", later, None)], key=str)
    closed = table._last()["paths"][0]
    before = files_of(closed)
    table.track(base, "id", at("2024-03-01"), check_cols=["loc"])
    assert before and files_of(closed) == before and closed in table._last()["paths"]
    with pytest.raises(ValueError, match="occurs 2 times"):
        table.track(base.unionAll(base), "id", at("2024-04-01"), check_cols=["loc"])


def test_vacuum_removes_what_no_version_names(spark, table):
    for n in range(3):
        table.replace(kv(spark, (n, "a", n)))
    assert len(table.vacuum(keep_versions=1)) == 2
    assert rows(table.read()) == [(2, "a", 2)]


def test_promoted_sets_change_together(spark, tmp_path):
    live = load.PromotedSet(spark, str(tmp_path / "set"))
    live.promote({"a": kv(spark, (1, "x", 1)), "b": kv(spark, (2, "y", 1))})
    broken = kv(spark, (3, "z", 1)).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        live.promote({"a": kv(spark, (9, "new", 1)), "b": broken})
    assert rows(live.read()["a"]) == [(1, "x", 1)] and rows(live.read()["b"]) == [(2, "y", 1)]


def test_partitioned_writes_make_few_files(spark, tmp_path):
    data = spark.range(0, 4000, 1, 16).select("id", (c("id") % 5).cast("string").alias("kind"))
    load.route(data, str(tmp_path / "routed"), "kind")
    assert len(files_of(tmp_path / "routed")) <= 10
