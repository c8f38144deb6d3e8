"""Load-mode queries: tables are written to the shared scratch folder, loaded again, and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators import checks as ck
from tidewright.plans.models import CATALOG_SQL, catalog_summary
from tidewright.plans.registry import query
from tidewright.session import scratch_path
from tidewright.sources import layout, load, upkeep
from tidewright.sources.ledger import PeriodLedger
from tidewright.sources.load import KeyedTable, VersionedTable

c = F.col
CUT = "1999-06-01"


def at(text: str):
    return F.lit(text).cast("timestamp_ntz")


def table(t, name: str) -> VersionedTable:
    return VersionedTable(t.spark, scratch_path(t.spark, name))


def keyed(t, name: str, *keys: str, buckets: int = 16) -> KeyedTable:
    return KeyedTable(t.spark, scratch_path(t.spark, name), keys, buckets)


def early(t) -> DataFrame:
    """First load: orders up to the cut, all still open."""
    return t.orders.where(c("o_orderdate") <= at(CUT)).select(
        "o_orderkey", "o_custkey", F.lit("new").alias("status"), "o_orderdate"
    )


def late(t) -> DataFrame:
    """Second load: orders from a year before the cut on, some twice with an older status."""
    rows = t.orders.where(c("o_orderdate") > at("1998-06-01"))
    final = rows.select("o_orderkey", "o_custkey", c("o_orderstatus").alias("status"), "o_orderdate", F.lit(2).alias("seq"))
    older = rows.where("o_orderstatus = 'F'").select(
        "o_orderkey", "o_custkey", F.lit("P").alias("status"), "o_orderdate", F.lit(1).alias("seq")
    )
    return final.unionByName(older)


_EARLY = f"early as (select o_orderkey, o_custkey, 'new' as status, o_orderdate from orders where o_orderdate <= timestamp '{CUT}')"
_MERGED = f"""select o_orderkey, o_custkey, case when o_orderdate > timestamp '1998-06-01' then o_orderstatus else 'new' end as status, o_orderdate from orders"""


@query("l1_replace", "select o_orderkey, o_custkey, o_orderstatus as status, o_orderdate from orders where o_orderdate > timestamp '1998-06-01'")
def _(t):
    orders = table(t, "replace")
    orders.replace(early(t))
    return orders.replace(late(t).where("seq = 2").drop("seq"))


@query("l2_incremental_append", "select o_orderkey, o_orderdate from orders")
def _(t):
    orders, source = table(t, "append"), t.orders.select("o_orderkey", "o_orderdate")
    # Some rows of the first run's last day come late.
    punctual = source.where((c("o_orderdate") < at(CUT)) | (c("o_orderkey") % 2 == 0))
    load.incremental_append(orders, punctual, "o_orderdate", upto=at(CUT), keys=["o_orderkey"])
    return load.incremental_append(orders, source, "o_orderdate", keys=["o_orderkey"])


@query("l3_merge_by_key", _MERGED)
def _(t):
    orders = keyed(t, "merge", "o_orderkey")
    orders.merge(early(t).withColumn("seq", F.lit(0)), ["o_orderkey"], ["seq"])
    return orders.merge(late(t), ["o_orderkey"], ["seq"]).drop("seq")


@query(
    "l3_merge_touched_partitions",
    f"select o_orderkey, o_custkey, status, cast(year(o_orderdate) as integer) as year from ({_MERGED})",
)
def _(t):
    path = scratch_path(t.spark, "merge-parts")
    year = F.year("o_orderdate").alias("year")
    cols = ["o_orderkey", "o_custkey", "status"]
    early(t).select(*cols, F.lit(0).alias("seq"), year).write.partitionBy("year").parquet(path)
    batch = late(t).select(*cols, "seq", year)
    load.merge_partitions(t.spark, path, batch, ["o_orderkey"], ["seq"], "year")
    return t.spark.read.parquet(path).drop("seq")


@query(
    "l4_delete_insert",
    f"""with {_EARLY}, batch as (select o_orderkey, o_custkey, o_orderstatus as status, o_orderdate from orders where o_totalprice > 480000)
    select * from early where o_custkey not in (select o_custkey from batch) union all select * from batch""",
)
def _(t):
    orders = keyed(t, "delete-insert", "o_custkey")
    orders.replace(early(t))
    batch = t.orders.where("o_totalprice > 480000").select("o_orderkey", "o_custkey", c("o_orderstatus").alias("status"), "o_orderdate")
    return orders.delete_insert(batch, ["o_custkey"])


@query(
    "l5_incremental_model",
    f"""with {CATALOG_SQL} select first_name, last_name, bill_customer_sk_id, ship_customer_sk_id, ship_date,
        case when ship_date >= date '2000-01-01' then orders * 10 else orders end as orders, quantity, cost, _pk from summary""",
)
def _(t):
    prod, rows = keyed(t, "incremental", "_pk"), catalog_summary(t)
    recent = c("ship_date") >= F.lit("2000-01-01").cast("date")
    load.incremental_by_key(prod, rows, ["_pk"], recent)
    return load.incremental_by_key(prod, rows.withColumn("orders", c("orders") * 10), ["_pk"], recent)


def _places(t) -> tuple[DataFrame, DataFrame]:
    """Customers' segments before and after: some move, some become unknown, some are new, some are gone."""
    first = t.customer.where("c_acctbal < 9000").select(c("c_custkey").alias("id"), c("c_mktsegment").alias("location"))
    moved = F.when(c("c_nationkey") < 5, "MOVED").when(c("c_nationkey") >= 8, c("c_mktsegment"))
    then = t.customer.where("c_acctbal >= 1000").select(c("c_custkey").alias("id"), moved.alias("location"))
    return first, then


_PLACES = """a as (select c_custkey as id, c_mktsegment as location from customer where c_acctbal < 9000),
  b as (select c_custkey as id, case when c_nationkey < 5 then 'MOVED' when c_nationkey >= 8 then c_mktsegment end as location from customer where c_acctbal >= 1000)"""
_SCD = """select a.id, a.location, timestamp '2024-01-01' as valid_from, case when b.id is not null and a.location is distinct from b.location
    then timestamp '2024-02-01' end as valid_to from a left join b on a.id = b.id
  union all select b.id, b.location, timestamp '2024-02-01', null from b left join a on a.id = b.id
    where a.id is null or a.location is distinct from b.location"""


def snapshot(t) -> DataFrame:
    """Two snapshots, the second one taken twice: the repeat changes nothing."""
    history, (first, then) = table(t, "snapshot"), _places(t)
    history.track(first, "id", at("2024-01-01"), check_cols=["location"])
    history.track(then, "id", at("2024-02-01"), check_cols=["location"])
    return history.track(then, "id", at("2024-03-01"), check_cols=["location"])


@query("l6_scd2_check", f"with {_PLACES} {_SCD}")
def _(t):
    return snapshot(t)


@query(
    "l7_scd2_timestamp",
    """with a as (select o_orderkey as id, 'new' as status, o_orderdate as updated_at from orders),
    b as (select o_orderkey as id, o_orderstatus as status, case when o_orderstatus = 'F' then o_orderdate + interval 2 day else o_orderdate end as updated_at from orders)
    select a.*, timestamp '1994-01-01' as valid_from, case when b.updated_at > a.updated_at then b.updated_at end as valid_to from a join b on a.id = b.id
    union all select b.*, b.updated_at, null from a join b on a.id = b.id where b.updated_at > a.updated_at""",
)
def _(t):
    first = t.orders.select(c("o_orderkey").alias("id"), F.lit("new").alias("status"), c("o_orderdate").alias("updated_at"))
    later = F.when(c("o_orderstatus") == "F", F.timestamp_add("DAY", F.lit(2), c("o_orderdate"))).otherwise(c("o_orderdate"))
    then = t.orders.select(c("o_orderkey").alias("id"), c("o_orderstatus").alias("status"), later.alias("updated_at"))
    history = table(t, "snapshot-ts")
    history.track(first, "id", at("1994-01-01"), updated_at="updated_at")
    return history.track(then, "id", at("2024-02-01"), updated_at="updated_at")


@query(
    "l8_insert_by_period",
    """select o_orderkey, o_orderdate, cast(date_sub('month', timestamp '1994-12-15', o_orderdate - interval 1 microsecond) as integer)
       as period_number from orders where o_orderdate > timestamp '1994-12-15' and o_orderdate < timestamp '2003-01-01'""",
)
def _(t):
    path = scratch_path(t.spark, "by-period")
    rows = t.orders.select("o_orderkey", "o_orderdate")
    bounds = at("1994-12-15"), at("2003-01-01")
    return load.insert_by_period(t.spark, path, rows, "o_orderdate", "month", *bounds)


@query(
    "l9_backfill_windows",
    """with b as (select min(ts) as lo, max(ts) as hi from events),
    w as (select i as chunk_number, greatest(lo, hi - to_seconds(i * 604801) - interval 7 day) as window_from, hi - to_seconds(i * 604801) as window_to
      from b, (select unnest(generate_series(0, 20)) as i) where hi - to_seconds(i * 604801) > lo)
    select w.*, count(event_id) as events from w left join events on ts between window_from and window_to group by all""",
)
def _(t):
    lo, hi = t.events.agg(F.min("ts"), F.max("ts")).first()
    bounds = t.spark.range(1).select(F.lit(lo).cast("timestamp_ntz").alias("lo"), F.lit(hi).cast("timestamp_ntz").alias("hi"))
    windows = load.backfill_windows(bounds, "lo", "hi")
    end, first = F.lit(hi).cast("timestamp_ntz"), F.lit(lo).cast("timestamp_ntz")
    numbered = t.events.select("ts", load.chunk_of(c("ts"), end).alias("chunk_number"))
    inside = c("ts") >= load.chunk_start(c("chunk_number"), first, end)
    counts = numbered.where(inside).groupBy("chunk_number").agg(F.count("ts").alias("events"))
    return windows.join(counts, "chunk_number", "left").withColumn("events", F.coalesce("events", F.lit(0)))


@query(
    "l10_write_audit_publish",
    """select o_orderkey, o_custkey, o_orderstatus, 'rejected' as second_load from orders""",
)
def _(t):
    orders = table(t, "audited")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    checks = {
        "o_custkey is filled": lambda df: ck.not_null(df, "o_custkey"),
        "o_orderkey is unique": lambda df: ck.unique(df, "o_orderkey"),
    }
    orders.audited(rows, checks)
    try:
        orders.audited(rows.withColumn("o_custkey", F.nullif("o_custkey", F.lit(7))), checks)
        second = "published"
    except load.AuditFailed:
        second = "rejected"
    return orders.read().withColumn("second_load", F.lit(second))


@query(
    "l11_promote_set",
    """select 'customer' as table_name, count(*) as n from customer union all select 'supplier', count(*) from supplier""",
)
def _(t):
    prod = load.PromotedSet(t.spark, scratch_path(t.spark, "prod"))
    prod.promote({"customer": t.customer.limit(0), "supplier": t.supplier.limit(0)})
    live = prod.promote({"customer": t.customer, "supplier": t.supplier})
    parts = [live[n].agg(F.count("*").alias("n")).select(F.lit(n).alias("table_name"), "n") for n in live]
    return parts[0].unionByName(parts[1])


@query("l12_clone", "select c_custkey, c_name from customer")
def _(t):
    first = table(t, "clone-source")
    first.replace(t.customer.select("c_custkey", "c_name"))
    copy = first.clone_to(scratch_path(t.spark, "clone-copy"))
    first.replace(t.customer.limit(0).select("c_custkey", "c_name"))
    return copy.read()


_CHANGES = """ch as (select o_custkey as id, o_orderpriority as segment, case o_orderstatus when 'F' then 'D' when 'P' then 'U' else 'I' end as op,
    o_orderkey as seq from orders), last as (select * from (select *, row_number() over (partition by id order by seq desc) as n from ch) where n = 1)"""
_CDC = f"""with {_CHANGES} select c_custkey as id, c_mktsegment as segment from customer where c_custkey not in (select id from last)
    union all select id, segment from last where op <> 'D'"""


def changes(t) -> DataFrame:
    op = F.when(c("o_orderstatus") == "F", "D").when(c("o_orderstatus") == "P", "U").otherwise("I")
    return t.orders.select(c("o_custkey").alias("id"), c("o_orderpriority").alias("segment"), op.alias("op"), c("o_orderkey").alias("seq"))


@query("l13_change_data", _CDC)
def _(t):
    target = t.customer.select(c("c_custkey").alias("id"), c("c_mktsegment").alias("segment"))
    customers = keyed(t, "cdc", "id")
    customers.replace(target)
    return customers.apply_changes(changes(t), ["id"], "seq", "op")


@query("l14_lookback", "select event_id, ts from events where ts >= timestamp '2024-01-31' - interval 7 day")
def _(t):
    return load.lookback(t.events.select("event_id", "ts"), "ts", at("2024-01-31"), 7)


@query("l15_route_by_type", "select event_id, user_id, event_type from events")
def _(t):
    return load.route(t.events.select("event_id", "user_id", "event_type"), scratch_path(t.spark, "routed"), "event_type")


@query("l15_route_keeps_text", "select event_id, '00' || user_id as code from events")
def _(t):
    rows = t.events.select("event_id", F.concat(F.lit("00"), c("user_id").cast("string")).alias("code"))
    return load.route(rows, scratch_path(t.spark, "routed-text"), "code")


@query(
    "l16_materializations",
    """select 'table' as kind, count(*) as n from orders union all select 'view', count(*) from orders union all select 'ephemeral', count(*) from orders""",
)
def _(t):
    root = scratch_path(t.spark, "materialized")
    parts = [
        load.materialize(t.orders.select("o_orderkey"), kind, f"orders_as_{kind}", root)
        .agg(F.count("*").alias("n"))
        .select(F.lit(kind).alias("kind"), "n")
        for kind in ("table", "view", "ephemeral")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("j15_upsert_join", _MERGED)
def _(t):
    return load.merge_by_key(early(t), late(t).where("seq = 2").drop("seq"), ["o_orderkey"], ["o_orderdate"])


@query(
    "m13_orders_with_snapshot",
    f"""with {_PLACES}, s as ({_SCD}) select o_orderkey as order_id, c_custkey as customer_id, c_name as customer_name, o_orderdate as order_date, location, valid_from, valid_to
    from orders join customer on c_custkey = o_custkey join s on s.id = c_custkey""",
)
def _(t):
    customers = t.customer.select(c("c_custkey").alias("customer_id"), c("c_name").alias("customer_name"))
    orders = t.orders.select(c("o_orderkey").alias("order_id"), c("o_custkey").alias("customer_id"), c("o_orderdate").alias("order_date"))
    dim_orders = customers.join(orders, "customer_id")
    return dim_orders.join(snapshot(t).withColumnRenamed("id", "customer_id"), "customer_id")


@query(
    "m8_catalog_incremental_clone",
    f"with {CATALOG_SQL} select ship_date, count(*) as rows, cast(sum(cost) as bigint) as cost from summary group by 1",
)
def _(t):
    prod = table(t, "catalog-prod")
    load.incremental_by_key(prod, catalog_summary(t), ["_pk"], F.lit(True))
    copy = prod.clone_to(scratch_path(t.spark, "catalog-clone")).read()
    return copy.groupBy("ship_date").agg(F.count("*").alias("rows"), F.sum("cost").alias("cost"))


# --- keys that are null, columns that come and go ----------------------------------------------------------


def last_orders(t, where: str = "true") -> DataFrame:
    """Newest order per customer; orders of low priority have no customer."""
    key = F.when(c("o_orderpriority") != "5-LOW", c("o_custkey")).alias("customer")
    return t.orders.where(where).groupBy(key).agg(F.max("o_orderkey").alias("last_order"), F.count("*").alias("orders"))


_LAST = "select case when o_orderpriority <> '5-LOW' then o_custkey end as customer, max(o_orderkey) as last_order, count(*) as orders from orders"


@query(
    "l3_merge_null_keys",
    f"""with a as ({_LAST} group by 1), b as ({_LAST} where o_totalprice > 400000 group by 1)
    select case when b.orders is not null then b.customer else a.customer end as customer, coalesce(b.last_order, a.last_order) as last_order,
      coalesce(b.orders, a.orders) as orders from a full join b on a.customer is not distinct from b.customer""",
)
def _(t):
    table = keyed(t, "null-keys", "customer")
    table.merge(last_orders(t), order_by=["last_order"])
    batch = last_orders(t, "o_totalprice > 400000")
    table.merge(batch, order_by=["last_order"])
    return table.merge(batch, order_by=["last_order"])  # a repeat changes nothing


@query(
    "l13_change_data_null_keys",
    f"""with a as ({_LAST} group by 1), ch as (select case when o_orderpriority <> '5-LOW' then o_custkey end as customer, o_orderkey as seq,
        case o_orderstatus when 'F' then 'D' else 'U' end as op, 0 as orders from orders where o_totalprice > 300000),
      l as (select * from (select *, row_number() over (partition by customer order by seq desc) as n from ch) where n = 1)
    select a.* from a where not exists (select 1 from l where l.customer is not distinct from a.customer)
    union all select customer, seq, orders from l where op <> 'D'""",
)
def _(t):
    table = keyed(t, "null-changes", "customer")
    table.replace(last_orders(t))
    op = F.when(c("o_orderstatus") == "F", "D").otherwise("U")
    key = F.when(c("o_orderpriority") != "5-LOW", c("o_custkey"))
    rows = t.orders.where("o_totalprice > 300000").select(
        key.alias("customer"), c("o_orderkey").alias("seq"), op.alias("op"), c("o_orderkey").alias("last_order"), F.lit(0).cast("bigint").alias("orders")
    )
    return table.apply_changes(rows, ["customer"], "seq", "op")


@query(
    "l2_evolving_append",
    """select o_orderkey, cast(o_custkey as double) as customer, o_orderstatus as status, cast(null as bigint) as ship_year from orders where o_orderstatus <> 'P'
       union all select o_orderkey, o_totalprice, null, cast(year(o_orderdate) as bigint) from orders where o_orderstatus = 'P'""",
)
def _(t):
    """The second batch lacks a column, brings one, and has a wider type."""
    orders = table(t, "evolving")
    orders.append(t.orders.where("o_orderstatus <> 'P'").select("o_orderkey", c("o_custkey").cast("int").alias("customer"), c("o_orderstatus").alias("status")))
    late_rows = t.orders.where("o_orderstatus = 'P'")
    return orders.append(late_rows.select("o_orderkey", c("o_totalprice").alias("CUSTOMER"), F.year("o_orderdate").cast("long").alias("ship_year")))


@query(
    "l6_scd2_new_column",
    """with a as (select c_custkey as id, c_mktsegment as segment from customer), b as (select c_custkey as id, c_mktsegment as segment,
         case when c_acctbal > 5000 then cast(c_nationkey as bigint) end as nation from customer)
    select a.id, a.segment, cast(null as bigint) as nation, timestamp '2024-01-01' as valid_from, case when nation is not null then timestamp '2024-02-01' end as valid_to
      from a join b using (id)
    union all select id, segment, nation, timestamp '2024-02-01', null from b where nation is not null""",
)
def _(t):
    """A checked column that the history does not have yet."""
    history = table(t, "snapshot-grown")
    first = t.customer.select(c("c_custkey").alias("id"), c("c_mktsegment").alias("segment"))
    history.track(first, "id", at("2024-01-01"), check_cols=["segment"])
    nation = F.when(c("c_acctbal") > 5000, c("c_nationkey").cast("bigint")).alias("nation")
    then = t.customer.select(c("c_custkey").alias("id"), c("c_mktsegment").alias("segment"), nation)
    return history.track(then, "id", at("2024-02-01"), check_cols=["segment", "nation"])


# --- periods one by one ------------------------------------------------------------------------------------

_PERIODS = """select o_orderkey, o_orderdate, cast(date_sub('quarter', timestamp '1994-12-15', o_orderdate - interval 1 microsecond) as bigint) as period_number
    from orders where o_orderdate > timestamp '1994-12-15' and o_orderdate < timestamp '1997-01-01'"""


def _ledger(t) -> PeriodLedger:
    """A backfill by quarter that stops after three periods and then goes on."""
    ledger = PeriodLedger(t.spark, scratch_path(t.spark, "ledger"))
    rows, bounds = t.orders.select("o_orderkey", "o_orderdate"), (at("1994-12-15"), at("1997-01-01"))
    ledger.backfill(rows, "o_orderdate", "quarter", *bounds, most=3)
    ledger.backfill(rows, "o_orderdate", "quarter", *bounds, together=4)
    return ledger


@query("l8_period_ledger", f"select o_orderkey, o_orderdate from ({_PERIODS})")
def _(t):
    return _ledger(t).read(t.orders.select("o_orderkey", "o_orderdate").schema)


@query(
    "l8_period_counts",
    f"select i as period, count(period_number) as \"rows\" from range(9) r(i) left join ({_PERIODS}) p on p.period_number = i group by 1",
)
def _(t):
    return _ledger(t).entries().select("period", "rows")


# --- aggregates kept up to date ----------------------------------------------------------------------------


def _event_batches(t) -> list[DataFrame]:
    """Three batches of events; the later ones also bring late rows of the first days."""
    slot = F.when(c("event_type") == "error", 2).when(c("ts") < at("2024-01-16"), 0).when(c("event_type") == "purchase", 2).otherwise(1)
    return [t.events.where(slot == i) for i in range(3)]


_DAILY = "select cast(ts as date) as event_date, count(*) as events, count(distinct user_id) as users, max(event_id) as last_event from events group by 1"


@query("m7_daily_recomputed", _DAILY)
def _(t):
    """Events per day with distinct users, brought up to date after each batch from the touched days alone."""
    day = F.to_date("ts").alias("event_date")
    facts = keyed(t, "facts", "event_date")
    model = keyed(t, "daily", "event_date")
    for batch in _event_batches(t):
        rows = batch.select("event_id", "user_id", day)
        facts.folded(rows, lambda now, new: now.unionByName(new))
        figures = [F.count("*").alias("events"), F.count_distinct("user_id").alias("users"), F.max("event_id").alias("last_event")]
        upkeep.recompute(model, rows, facts.read(), ["event_date"], lambda df, f=figures: df.groupBy("event_date").agg(*f))
    return model.read()


@query(
    "m7_daily_folded",
    "select cast(ts as date) as event_date, event_type, count(*) as events, cast(sum(event_id) as bigint) as total, min(user_id) as first_user from events group by 1, 2",
)
def _(t):
    """Partial figures of each batch added to those of the table; no event is read twice."""
    model = keyed(t, "folded", "event_date", "event_type")
    for batch in _event_batches(t):
        parts = batch.groupBy(F.to_date("ts").alias("event_date"), "event_type").agg(
            F.count("*").alias("events"), F.sum("event_id").alias("total"), F.min("user_id").alias("first_user")
        )
        upkeep.fold(model, parts, {"events": F.sum, "total": F.sum, "first_user": F.min})
    return model.read()


# --- files ------------------------------------------------------------------------------------------------


@query("s5_unload_by_bytes", "select l_orderkey, l_linenumber, l_comment_like, true as within_limit from (select l_orderkey, l_linenumber, l_returnflag || l_linestatus as l_comment_like from lineitem)")
def _(t):
    path, limit = scratch_path(t.spark, "unload-bytes"), 64 << 10
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.concat("l_returnflag", "l_linestatus").alias("l_comment_like"))
    layout.unload_by_bytes(rows, path, limit)
    largest = max(layout.file_sizes(t.spark, path).values())
    return t.spark.read.parquet(path).withColumn("within_limit", F.lit(largest <= limit))


@query(
    "s4_clustered_layout",
    """select l_orderkey, l_linenumber, l_partkey, l_shipdate, true as prunes_part, true as prunes_date from lineitem
       where l_partkey <= (select max(l_partkey) // 16 from lineitem) or l_shipdate < timestamp '1993-01-01'""",
)
def _(t):
    """Lines along a curve through part and ship date: a filter on either one needs less than half of the files."""
    path = scratch_path(t.spark, "clustered")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    whole = t.lineitem.agg(F.max("l_partkey").alias("p"), F.min("l_shipdate").alias("d"), F.count("*").alias("n")).first()
    layout.write_clustered(rows, path, ["l_partkey", "l_shipdate"], max(4096, whole["n"]))
    laid = t.spark.read.parquet(path)
    files = laid.select(F.input_file_name().alias("f")).distinct().count()
    part = layout.files_to_read(laid, "l_partkey", 0, whole["p"] // 16)
    date = layout.files_to_read(laid, "l_shipdate", whole["d"], at("1992-12-31 23:59:59"))
    wanted = (c("l_partkey") <= whole["p"] // 16) | (c("l_shipdate") < at("1993-01-01"))
    return laid.where(wanted).withColumns({"prunes_part": F.lit(part * 2 < files), "prunes_date": F.lit(date * 2 < files)})
