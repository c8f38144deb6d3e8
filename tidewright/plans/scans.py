"""Queries over sources and sinks. Written tables lie in the shared scratch folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.reshape import column_values, union_relations
from tidewright.plans.registry import query
from tidewright.session import scratch_path
from tidewright.sources import tables as src

c = F.col


@query("s1_source_scan", "select o_orderkey as id, o_orderstatus as status from orders")
def _(t):
    return t("orders").select(c("o_orderkey").alias("id"), c("o_orderstatus").alias("status"))


_EVENT_CSV = "event_name string, time string, name string, number bigint"


@query(
    "s2_csv_scan",
    """select event_type as event_name, date_trunc('second', ts) as event_ts, cast(user_id as varchar) as user_name,
       event_id as event_value from events""",
)
def _(t):
    path = scratch_path(t.spark, "csv")
    t.events.select(
        c("event_type").alias("event_name"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"),
        c("user_id").alias("name"),
        c("event_id").alias("number"),
    ).write.option("header", True).csv(path)
    landed = src.read_csv(t.spark, f"{path}/*.csv", _EVENT_CSV)
    return landed.select(
        "event_name",
        c("time").cast("timestamp_ntz").alias("event_ts"),
        c("name").alias("user_name"),
        c("number").alias("event_value"),
    )


@query("s3_seed_load", "select n_nationkey, n_name, n_regionkey, count(c_custkey) as customers from nation left join customer on c_nationkey = n_nationkey group by all")
def _(t):
    path = scratch_path(t.spark, "seed")
    src.export_csv(t.nation, path, single=True)
    seed = src.read_seed(t.spark, path, "n_nationkey int, n_name string, n_regionkey int")
    per_nation = t.customer.groupBy(c("c_nationkey").alias("n_nationkey")).agg(F.count("c_custkey").alias("customers"))
    return seed.join(per_nation, "n_nationkey", "left").select(
        "n_nationkey", "n_name", "n_regionkey", F.coalesce("customers", F.lit(0)).alias("customers")
    )


@query(
    "s4_filtered_scan",
    """select event_id, ts, user_id from events
       where ts >= timestamp '2024-01-05 05:00:00' and ts < timestamp '2024-01-22 05:00:00'""",
)
def _(t):
    window = src.half_open("ts", "2024-01-05T00:00:00-05:00", "2024-01-22T00:00:00-05:00")
    return src.scan(t.spark, t.path("events"), ["event_id", "ts", "user_id"], window)


@query("s5_parquet_unload", "select l_returnflag, count(*) as n, cast(sum(l_linenumber) as bigint) as lines from lineitem group by all")
def _(t):
    path = scratch_path(t.spark, "unload")
    src.unload(t.lineitem.select("l_returnflag", "l_linenumber"), path, rows_per_file=5_000_000)
    back = t.spark.read.parquet(path)
    return back.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"))


@query(
    "s6_load_by_name",
    """select c_custkey as custkey, cast(c_nationkey as bigint) as nationkey, c_mktsegment as mktsegment,
       cast(null as varchar) as phone from customer""",
)
def _(t):
    landed = t.customer.select(
        c("c_mktsegment").alias("MKTSEGMENT"), c("c_custkey").alias("CustKey"), c("c_nationkey").alias("NATIONKEY")
    )
    target = t.spark.createDataFrame([], "custkey bigint, nationkey bigint, mktsegment string, phone string").schema
    path = scratch_path(t.spark, "by-name")
    src.match_by_name(landed, target).write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


@query("s7_filtered_csv_export", "select o_orderkey, o_custkey, o_orderpriority from orders where o_orderstatus in ('F', 'O')")
def _(t):
    path = scratch_path(t.spark, "export")
    rows = t.orders.where(c("o_orderstatus").isin("F", "O"))
    src.export_per_value(rows.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"), path, "o_orderstatus")
    columns = "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_orderstatus string"
    one = src.read_csv(t.spark, f"{path}/o_orderstatus=F", columns).where("o_orderstatus = 'F'")
    other = src.read_csv(t.spark, f"{path}/o_orderstatus=O", columns).where("o_orderstatus = 'O'")
    return one.unionAll(other).drop("o_orderstatus")


@query(
    "s8_mirror_tables",
    """select 'customer' as table_name, count(*) as n, cast(sum(c_custkey) as bigint) as key_sum from customer
       union all select 'supplier', count(*), cast(sum(s_suppkey) as bigint) from supplier""",
)
def _(t):
    root = scratch_path(t.spark, "mirror")
    paths = src.mirror({"customer": t.customer, "supplier": t.supplier}, root)
    keys = {"customer": "c_custkey", "supplier": "s_suppkey"}
    parts = [
        t.spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n"), F.sum(keys[name]).alias("key_sum")).select(
            F.lit(name).alias("table_name"), "n", "key_sum"
        )
        for name, p in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts)


_ALL = (
    "benchmark conversations customer documents embeddings events labels lineitem nation orders pages part region supplier"
).split()


@query("s9_row_counts", " union all ".join(f"select '{n}' as table_name, count(*) as row_count, true as timed from {n}" for n in _ALL))
def _(t):
    counts = src.row_counts({n: t(n) for n in _ALL})
    return counts.select("table_name", "row_count", c("extracted_at").isNotNull().alias("timed"))


@query(
    "s10_column_metadata",
    """with typed as (
      select table_name, column_name, ordinal_position, is_nullable, case data_type when 'BIGINT' then 'bigint'
        when 'INTEGER' then 'int' when 'VARCHAR' then 'string' when 'DOUBLE' then 'double'
        when 'TIMESTAMP' then 'timestamp_ntz' end as data_type
      from information_schema.columns where table_name in ('orders', 'events')),
    filled as (
      select 'orders' as table_name, unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate',
        'o_orderpriority']) as column_name, unnest([count(o_orderkey), count(o_custkey), count(o_orderstatus),
        count(o_totalprice), count(o_orderdate), count(o_orderpriority)]) as filled from orders
      union all
      select 'events', unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props']),
        unnest([count(event_id), count(ts), count(user_id), count(event_type), count(value), count(props)]) from events)
    select t.table_name, t.column_name, cast(ordinal_position as integer) as ordinal_position, data_type, is_nullable,
      filled from typed t join filled using (table_name, column_name)""",
)
def _(t):
    named = {"orders": t.orders, "events": t.events}
    catalog = src.column_catalog(t.spark, named)
    filled = []
    for name, df in named.items():
        one = df.agg(*[F.count(x).alias(x) for x in df.columns])
        filled.append(one.unpivot([], list(df.columns), "column_name", "filled").withColumn("table_name", F.lit(name)))
    return catalog.join(filled[0].unionByName(filled[1]), ["table_name", "column_name"])


@query(
    "s11_run_log",
    """select 'events/' || event_type as source_name, '{"action":"snapshot","rows":' || count(*) || '}' as details,
       true as has_id from events group by event_type""",
)
def _(t):
    path = scratch_path(t.spark, "run-log")
    loads = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows")).select(
        F.concat(F.lit("events/"), "event_type").alias("name"), "rows"
    )
    details = F.struct(F.lit("snapshot").alias("action"), c("rows"))
    src.run_log_rows(loads, "name", details).write.mode("append").parquet(path)
    log = t.spark.read.parquet(path)
    return log.select("source_name", "details", (F.length("run_id") == 36).alias("has_id"))


@query("s12_json_payload", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def _(t):
    parsed = src.json_payload(t.events.select("event_id", "props"), "props")
    return parsed.select("event_id", F.try_variant_get("props", "$.k", "bigint").alias("k"))


@query(
    "s13_sheet_rows",
    """select cast(c_custkey as varchar) as c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), '') as segment,
       cast(c_nationkey as varchar) as c_nationkey from customer""",
)
def _(t):
    rows = t.customer.select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_nationkey"
    )
    path = scratch_path(t.spark, "sheet")
    src.push_sheet(rows, path)
    back = src.read_csv(t.spark, path, "c_custkey string, segment string, c_nationkey string", emptyValue="")
    return back.select("c_custkey", F.coalesce("segment", F.lit("")).alias("segment"), "c_nationkey")


@query(
    "s14_inline_values",
    """select v.id, v.name, count(o_orderkey) as orders from (values (1, 'final', 'F'), (2, 'open', 'O'),
       (3, 'partial', 'P')) as v(id, name, code) join orders on o_orderstatus = v.code group by v.id, v.name""",
)
def _(t):
    names = t.spark.sql(
        "select * from values (1, 'final', 'F'), (2, 'open', 'O'), (3, 'partial', 'P') as v(id, name, code) order by id"
    )
    joined = t.orders.join(names, c("o_orderstatus") == c("code"))
    return joined.groupBy("id", "name").agg(F.count("o_orderkey").alias("orders"))


def _event_views(t) -> list[str]:
    """One view for each event type there is; few by nature, and checked to be."""
    for kind in column_values(t.events, "event_type", max_values=1000):
        t.events.where(c("event_type") == kind).select("user_id", "event_id").createOrReplaceTempView(f"data_events_{kind}")
    t.events.limit(0).createOrReplaceTempView("data_events_old")
    return src.catalog_names(t.spark)


_UNION_SQL = """select 'data_events_' || event_type as _source_relation, user_id, event_id from events"""


@query("s15_relations_by_pattern", _UNION_SQL)
def _(t):
    found = src.relations_by_pattern(_event_views(t), "DATA_events_%", exclude="%_old")
    return union_relations({n: t.spark.table(n) for n in found})


@query("s16_relations_by_prefix", _UNION_SQL)
def _(t):
    found = src.relations_by_prefix(_event_views(t), "data_events_", exclude="%old")
    return union_relations({n: t.spark.table(n) for n in found})
