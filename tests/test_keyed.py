"""Keyed tables: only touched buckets are read and written, null is a key, and grouped models stay up to date."""

from __future__ import annotations

import random
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.plans import models
from tidewright.sources import load, upkeep
from tidewright.sources.load import KeyedTable, VersionedTable

DDL = "k int, v string, seq int"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "keyed"), ["k"], buckets=8)


def kv(spark, *data):
    return spark.createDataFrame(list(data), DDL)


def paths(table):
    return set(table._last()["paths"])


def test_a_batch_leaves_other_buckets_alone(spark, table):
    table.merge(kv(spark, *[(i, "a", 1) for i in range(200)]), order_by=["seq"])
    before = paths(table)
    assert len(before) == 8
    after = table.merge(kv(spark, (5, "b", 2)), order_by=["seq"])
    assert len(before & paths(table)) == 7 and len(paths(table) - before) == 1
    assert after.count() == 200 and rows(after.where("k = 5")) == [(5, "b", 2)]
    # What the batch reads are the files of its bucket.
    read = []
    frame = table._frame
    table._frame = lambda last, paths, schema=None: read.append(list(paths)) or frame(last, paths, schema)
    table.delete_insert(kv(spark, (5, "c", 3), (5, "d", 3)))
    assert len(read[0]) == 1
    assert rows(table.read().where("k = 5")) == [(5, "c", 3), (5, "d", 3)]


def test_null_is_a_key(spark, table):
    table.merge(kv(spark, (None, "a", 1), (1, "a", 1)), order_by=["seq"])
    for _ in range(2):
        table.merge(kv(spark, (None, "b", 2), (2, "b", 2)), order_by=["seq"])
        assert rows(table.read()) == [(None, "b", 2), (1, "a", 1), (2, "b", 2)]
    table.delete_insert(kv(spark, (None, "c", 3), (None, "d", 3)))
    assert rows(table.read().where("k is null")) == [(None, "c", 3), (None, "d", 3)]
    changes = spark.createDataFrame([(None, "x", 9, "D"), (1, "z", 9, "U"), (7, "n", 8, "I"), (7, "gone", 9, "D")], f"{DDL}, op string")
    table.apply_changes(changes, ["k"], "seq", "op")
    assert rows(table.read()) == [(1, "z", 9), (2, "b", 2)]


@pytest.mark.parametrize("change", ["merge", "delete_insert", "changes"])
def test_null_keys_in_plain_loads(spark, change):
    target = kv(spark, (None, "a", 1), (1, "a", 1))
    batch = kv(spark, (None, "b", 2))
    if change == "merge":
        made = load.merge_by_key(target, batch, ["k"], ["seq"])
    elif change == "delete_insert":
        made = load.delete_insert(target, batch, ["k"])
    else:
        made = load.apply_changes(target, batch.withColumn("op", F.lit("D")), ["k"], "seq", "op")
    assert rows(made) == [(1, "a", 1)] if change == "changes" else rows(made) == [(None, "b", 2), (1, "a", 1)]


def test_same_as_a_table_in_one_piece(spark, tmp_path, table):
    rng = random.Random(4)
    plain = VersionedTable(spark, str(tmp_path / "plain"))
    for n in range(4):
        batch = kv(spark, *[(rng.choice([None, *range(30)]), f"{n}{i}", rng.randrange(5) * 100 + i) for i in range(20)])
        for t in (table, plain):
            t.upsert_latest(batch, ["k"], ["seq"])
    assert rows(table.read()) == rows(plain.read())


def test_growing_columns_and_keys(spark, table):
    table.merge(kv(spark, (1, "a", 1), (2, "a", 1)), order_by=["seq"])
    table.merge(spark.createDataFrame([(1, 2.5, 2, "new")], "k bigint, v double, seq int, w string"), order_by=["seq"])
    got = table.read()
    assert got.schema.simpleString() == "struct<k:bigint,v:string,seq:int,w:string>"
    assert rows(got) == [(1, "2.5", 2, "new"), (2, "a", 1, None)]
    with pytest.raises(ValueError):
        table.merge(spark.createDataFrame([("1", 1)], "k string, seq int"), order_by=["seq"])
    with pytest.raises(ValueError):
        table.merge(kv(spark, (1, "a", 1)), ["v"], ["seq"])
    with pytest.raises(NotImplementedError):
        table.append(kv(spark, (1, "a", 1)))


def test_empty_batches_and_empty_tables(spark, table):
    assert table.merge(kv(spark), order_by=["seq"]).isEmpty()
    table.merge(kv(spark, (1, "a", 1)), order_by=["seq"])
    before = paths(table)
    table.merge(kv(spark), order_by=["seq"])
    assert paths(table) == before
    gone = spark.createDataFrame([(1, 5, "D")], "k int, seq int, op string")
    assert table.apply_changes(gone, ["k"], "seq", "op").isEmpty()
    assert rows(table.merge(kv(spark, (3, "c", 1)), order_by=["seq"])) == [(3, "c", 1)]


def test_vacuum_removes_replaced_buckets(spark, table):
    table.merge(kv(spark, *[(i, "a", 1) for i in range(50)]), order_by=["seq"])
    table.merge(kv(spark, (5, "b", 2)), order_by=["seq"])
    gone = table.vacuum()
    assert len(gone) == 1 and KeyedTable.BUCKET in gone[0]
    assert table.read().count() == 50


def test_models_stay_up_to_date(spark, tmp_path):
    """Late rows, corrections and groups that vanish: as the full model after every batch."""
    rng = random.Random(2)
    facts = KeyedTable(spark, str(tmp_path / "facts"), ["id"], 4)
    model = KeyedTable(spark, str(tmp_path / "model"), ["day"], 4)

    def full(df):
        return df.groupBy("day").agg(F.count("*").alias("n"), F.count_distinct("user").alias("users"), F.median("v").alias("mid"))

    for n in range(4):
        data = [(rng.randrange(40), rng.choice([None, 1, 2, 3, 10 + n]), rng.randrange(4), float(rng.randrange(9))) for _ in range(15)]
        batch = spark.createDataFrame(data, "id int, day int, user int, v double").dropDuplicates(["id"])
        # A corrected row may leave its old day, so that is touched as well.
        old = facts.read().join(batch.select("id"), "id", "left_semi").select("day") if facts.exists() else batch.select("day")
        old = spark.createDataFrame(old.collect(), old.schema)
        now = facts.merge(batch, order_by=["v"])
        upkeep.recompute(model, batch.select("day").unionAll(old), now, ["day"], full)
        assert rows(model.read().select("day", "n", "users", "mid")) == rows(full(facts.read()))


def test_folded_parts_add_up(spark, tmp_path):
    model = KeyedTable(spark, str(tmp_path / "folded"), ["day"], 4)
    total = {}
    for n in range(3):
        data = [(d, (n + 1) * (d or 7), d) for d in (None, 1, 2, n)]
        for d, v, low in data:
            a, b = total.get(d, (0, None))
            total[d] = (a + v, low if b is None else min(b, low))
        parts = spark.createDataFrame(data, "day int, total int, low int").groupBy("day").agg(
            F.sum("total").alias("total"), F.min("low").alias("low")
        )
        upkeep.fold(model, parts, {"total": F.sum, "low": F.min})
    assert {r.day: (r.total, r.low) for r in model.read().collect()} == total


def test_scd2_with_columns_of_one_side(spark):
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    history = load.first_snapshot(spark.createDataFrame([(1, "x", "only"), (2, "y", "old")], "id int, v string, gone string"), at("2024-01-01"))
    new = spark.createDataFrame([(1, "x", None), (2, "y", 5)], "id int, v string, more int")
    made = load.scd2(history, new, "id", at("2024-02-01"), check_cols=["v", "more"])
    got = {(r.id, r.v, r.gone, r.more, r.valid_from.month, r.valid_to and r.valid_to.month) for r in made.collect()}
    assert got == {(1, "x", "only", None, 1, None), (2, "y", "old", None, 1, 2), (2, "y", None, 5, 2, None)}


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_load_goes_through_the_buckets_in_waves(spark, table, monkeypatch):
    """One bucket at a time where a bucket fills a wave; before, all buckets were shuffled together."""
    monkeypatch.setattr(KeyedTable, "WAVE", 1, raising=False)
    staged, stage = [], KeyedTable._stage_buckets
    monkeypatch.setattr(KeyedTable, "_stage_buckets", lambda self, df, schema: staged.append(stage(self, df, schema)) or staged[-1])
    table.replace(kv(spark, *[(i, "a", 1) for i in range(200)], (None, "a", 1), (7, "twice", 1)))
    assert [len(x) for x in staged] == [1] * 8
    got = table.merge(kv(spark, *[(i, "b", 2) for i in range(0, 300, 2)], (None, "b", 2), (0, "old", 1)), order_by=["seq"])
    assert [len(x) for x in staged[8:]] == [1] * 8 and len(paths(table)) == 8
    kept = [(7, "twice", 1), *[(i, "a", 1) for i in range(1, 200, 2)]]
    assert sorted(map(str, rows(got))) == sorted(map(str, [*kept, *[(i, "b", 2) for i in range(0, 300, 2)], (None, "b", 2)]))
    monkeypatch.setattr(KeyedTable, "WAVE", 1 << 30)
    assert rows(table.delete_insert(got)) == rows(got) and len(staged) == 17


def test_a_load_leaves_no_shuffle_files(spark, table):
    before = shuffle_files(spark)
    table.replace(kv(spark, *[(i, "a", 1) for i in range(200)]).repartition(3, "v"))
    table.merge(kv(spark, *[(i, "b", 2) for i in range(0, 200, 2)]).repartition(3, "v"), order_by=["seq"])
    # What is left are a few bytes of counts per bucket. Blocks are removed beside the driver's work.
    end = time.monotonic() + 3
    while len(left := {f.split("_")[1] for f in shuffle_files(spark) - before}) > 2 and time.monotonic() < end:
        time.sleep(0.2)
    assert len(left) <= 2
    assert table.read().count() == 200


def test_catalog_summary_is_grouped_where_the_customers_are_joined(spark):
    ddl = "bill_customer_sk_id {0}, ship_customer_sk_id {0}, ship_date date, order_number int, quantity bigint, cost bigint"
    data = [(1, 2, date(2024, 1, 1), 7, 1, 10), (1, 2, date(2024, 1, 1), 7, 1, 10), (None, 2, date(2024, 1, 1), 8, 2, 20)]
    customers = spark.createDataFrame([(1, "A", "B")], "customer_sk_id bigint, first_name string, last_name string")
    orders = spark.createDataFrame(data, ddl.format("bigint"))
    key, limit = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        made = models.catalog_orders_summary(models.catalog_orders_staging(orders, customers))
        assert "hashpartitioning(first_name" not in made._jdf.queryExecution().executedPlan().toString()
        assert rows(made.drop("_pk", "ship_date")) == [(None, None, "None", "2", 1, 2, 20), ("A", "B", "1", "2", 1, 2, 20)]
    finally:
        spark.conf.set(key, limit)
    # Texts still make the groups where null and its word are one.
    texts = spark.createDataFrame([("None", "2", *data[0][2:]), (None, "2", *data[0][2:])], ddl.format("string"))
    staged = texts.select("*", F.lit("A").alias("first_name"), F.lit("B").alias("last_name"))
    assert rows(models.catalog_orders_summary(staged).select("bill_customer_sk_id", "orders", "cost")) == [("None", 1, 20)]
