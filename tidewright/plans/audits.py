"""Audit and reconciliation queries over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.functions.dates import epoch_seconds
from tidewright.functions.numbers import to_cents
from tidewright.operators import audit, difference
from tidewright.plans.registry import query
from tidewright.sources.tables import column_catalog

c = F.col
_CENTS = "cast(round({0} * 100) as bigint)"

# A second version of the orders: expensive ones have a changed status, some urgent ones are missing,
# and customers' keys are null for low priorities.
_B = """select o_orderkey, case when o_orderpriority = '5-LOW' then null else o_custkey end as o_custkey,
  case when o_totalprice > 450000 then 'X' when o_totalprice < 50000 then null else o_orderstatus end as o_orderstatus
  from orders where o_orderpriority <> '1-URGENT' or o_totalprice < 400000"""
_A = "select o_orderkey, o_custkey, o_orderstatus from orders where o_orderpriority <> '2-HIGH' or o_totalprice < 400000"


def _a(t):
    kept = (c("o_orderpriority") != "2-HIGH") | (c("o_totalprice") < 400000)
    return t.orders.where(kept).select("o_orderkey", "o_custkey", "o_orderstatus")


def _b(t):
    kept = (c("o_orderpriority") != "1-URGENT") | (c("o_totalprice") < 400000)
    status = F.when(c("o_totalprice") > 450000, "X").when(c("o_totalprice") >= 50000, c("o_orderstatus"))
    return t.orders.where(kept).select(
        "o_orderkey",
        F.when(c("o_orderpriority") != "5-LOW", c("o_custkey")).alias("o_custkey"),
        status.alias("o_orderstatus"),
    )


def _compare_sql(cols: str) -> str:
    return f"""with a as (select {cols} from ({_A})), b as (select {cols} from ({_B})),
    r as (select true as in_a, true as in_b from (select * from a intersect select * from b)
      union all select true, false from (select * from a except select * from b)
      union all select false, true from (select * from b except select * from a))
    select in_a, in_b, count(*) as "count", round(100.0::double * count(*) / sum(count(*)) over (), 2) as percent_of_total
    from r group by 1, 2"""


@query("u1_compare_queries", _compare_sql("o_orderkey, o_custkey, o_orderstatus"))
def _(t):
    return audit.compare_queries(_a(t), _b(t))


@query("u2_compare_relations", _compare_sql("o_orderkey, o_orderstatus"))
def _(t):
    return audit.compare_relations(_a(t), _b(t), exclude_columns=["O_CUSTKEY"])


def _values_sql(key: str, column: str) -> str:
    names = ", ".join(f"({i}, '{n}')" for i, n in enumerate(audit.MATCH_CLASSES))
    return f"""with a as ({_A}), b as ({_B}), j as (select case
      when a.{column} = b.{column} then 0
      when a.{column} is null and b.{column} is null then 1
      when a.{key} is null then 2
      when b.{key} is null then 3
      when a.{column} is null then 4
      when b.{column} is null then 5
      when a.{column} <> b.{column} then 6 end as match_order
      from a full outer join b on a.{key} = b.{key})
    select cast(match_order as integer) as match_order, n.name as match_status, count(*) as count_records,
      round(100.0::double * count(*) / sum(count(*)) over (), 2) as percent_of_total
    from j join (values {names}) as n(i, name) on n.i = match_order group by 1, 2"""


@query("u3_compare_column_values", _values_sql("o_orderkey", "o_orderstatus"))
def _(t):
    return audit.compare_column_values(_a(t), _b(t), "o_orderkey", "o_orderstatus")


@query("u3_compare_column_values_repeated_key", _values_sql("o_custkey", "o_orderstatus"))
def _(t):
    return audit.compare_column_values(_a(t), _b(t), "o_custkey", "o_orderstatus")


@query(
    "u4_compare_relation_columns",
    """with a(column_name, p, ty, filled) as (select unnest(['o_orderkey', 'o_custkey', 'o_orderstatus']), unnest([1, 2, 3]),
        unnest(['bigint', 'bigint', 'string']), unnest([count(o_orderkey), count(o_custkey), count(o_orderstatus)]) from orders),
      b(column_name, p, ty) as (values ('o_custkey', 1, 'string'), ('o_orderstatus', 3, 'string'), ('o_extra', 2, 'int'))
    select coalesce(a.column_name, b.column_name) as column_name, a.p as a_ordinal_position, b.p as b_ordinal_position,
      a.ty as a_data_type, b.ty as b_data_type, coalesce(a.p = b.p, false) as has_ordinal_position_match,
      coalesce(a.ty = b.ty, false) as has_data_type_match, filled
    from a full join b on a.column_name = b.column_name""",
)
def _(t):
    a = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    b = t.orders.select(c("o_custkey").cast("string"), F.lit(1).alias("o_extra"), "o_orderstatus")
    columns = audit.compare_relation_columns(
        column_catalog(t.spark, {"a": a}), column_catalog(t.spark, {"b": b})
    )
    filled = a.agg(*[F.count(x).alias(x) for x in a.columns]).unpivot([], a.columns, "column_name", "filled")
    return columns.join(filled, "column_name", "left")


@query("u5_row_count_parity", f"select * from (select (select count(*) from ({_A})) as count_a, (select count(*) from ({_B})) as count_b) where count_a <> count_b")
def _(t):
    return audit.row_count_parity(_a(t), _b(t))


@query(
    "u6_schema_parity",
    """select column_name, data_type, actual_type, (select count(*) from orders) as row_count from (values ('o_custkey', 'bigint', 'string'),
       ('o_totalprice', 'double', null)) as v(column_name, data_type, actual_type)""",
)
def _(t):
    wanted = column_catalog(t.spark, {"orders": t.orders})
    other = t.orders.select("o_orderkey", c("o_custkey").cast("string"), "o_orderstatus")
    found = audit.schema_parity(
        wanted, column_catalog(t.spark, {"other": other}), ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]
    )
    return found.withColumn("row_count", F.lit(t.orders.count()).cast("bigint"))


def _checksum_sql(rows: str) -> str:
    return f"""select bit_xor(fp) as checksum, count(*) as row_count, count(fp) as filled from (select
      ('0x' || left(md5(o_orderkey || '|' || o_custkey || '|' || o_orderstatus), 15))::bigint as fp from ({rows}))"""


@query(
    "u7_content_parity",
    f"""select a.checksum as checksum_a, b.checksum as checksum_b, a.row_count as rows_a, b.row_count as rows_b
        from ({_checksum_sql(_A)}) a, ({_checksum_sql(_B)}) b where a.checksum <> b.checksum""",
)
def _(t):
    found = audit.content_parity(_a(t), _b(t), ["o_orderkey", "o_custkey", "o_orderstatus"])
    return found.select(
        c("a.checksum").alias("checksum_a"),
        c("b.checksum").alias("checksum_b"),
        c("a.row_count").alias("rows_a"),
        c("b.row_count").alias("rows_b"),
    )


def _six(rows: str) -> str:
    return f"""select count(*) as row_count, count(distinct event_type) as kinds, count(distinct user_id) as users,
      sum({_CENTS.format('value')}) / 100.0::double as total, floor(epoch(min(ts))) as min_ts, floor(epoch(max(ts))) as max_ts from ({rows})"""


@query(
    "u8_metric_reconciliation",
    f"""with a as (unpivot (select columns(*)::double from ({_six('select * from events')})) on columns(*) into name metric value a_value),
    b as (unpivot (select columns(*)::double from ({_six("select * from events where event_type <> 'error'")})) on columns(*) into name metric value b_value)
    select metric, a_value, b_value, abs(a_value - b_value) <= 0.01 as is_match from a join b using (metric)""",
)
def _(t):
    def six(df):
        return audit.metrics(
            df,
            row_count=F.count("*"),
            kinds=F.count_distinct("event_type"),
            users=F.count_distinct("user_id"),
            total=F.sum(to_cents(c("value"))) / F.lit(100.0),
            min_ts=epoch_seconds(F.min("ts")),
            max_ts=epoch_seconds(F.max("ts")),
        )

    return audit.reconcile_metrics(six(t.events), six(t.events.where("event_type <> 'error'")))


@query(
    "u9_cursor_reconciliation",
    """with s as (select max(o_orderkey) as m, count(*) as n from orders where o_orderkey > 100),
    d as (select max(o_orderkey) as m, count(*) as n from orders where o_orderkey > 100 and o_orderstatus <> 'P' and o_totalprice < 490000)
    select s.m as source_max, d.m as target_max, s.n as source_count, d.n as target_count, cast(s.m - d.m as decimal(21,0)) as max_drift,
      s.n - d.n as count_drift, greatest(s.m, d.m) as next_cursor from s, d""",
)
def _(t):
    target = t.orders.where("o_orderstatus <> 'P' and o_totalprice < 490000")
    return audit.cursor_reconciliation(t.orders, target, "o_orderkey", F.lit(100))


@query(
    "u9_cursor_timestamp",
    """with s as (select max(ts) as m, count(*) as n from events where ts > timestamp '2024-01-10'),
    d as (select max(ts) as m, count(*) as n from events where ts > timestamp '2024-01-10' and event_type <> 'error' and value < 90)
    select s.m as source_max, d.m as target_max, s.n as source_count, d.n as target_count, epoch_us(s.m) - epoch_us(d.m) as max_drift,
      s.n - d.n as count_drift, greatest(s.m, d.m) as next_cursor from s, d""",
)
def _(t):
    """The usual cursor, a time: drift in microseconds, the next cursor a time again."""
    target = t.events.where("event_type <> 'error' and value < 90")
    return audit.cursor_reconciliation(t.events, target, "ts", F.lit("2024-01-10").cast("timestamp_ntz"))


@query(
    "u10_scalar_by_value",
    """select cast(cast(sum(l_linenumber) as decimal(20,2)) as varchar) as source_value, cast(sum(l_linenumber) as varchar) as target_value, true as is_match from lineitem""",
)
def _(t):
    """A decimal with two places against a whole number."""
    exact = t.lineitem.agg(F.sum("l_linenumber").cast("decimal(20,2)"))
    return audit.scalar_reconciliation(exact, t.lineitem.agg(F.sum("l_linenumber")))


@query(
    "u10_scalar_reconciliation",
    """select cast((select count(*) from orders) as varchar) as source_value, cast((select count(distinct o_orderkey) from orders) as varchar)
       as target_value, (select count(*) from orders) = (select count(distinct o_orderkey) from orders) as is_match""",
)
def _(t):
    return audit.scalar_reconciliation(t.orders.agg(F.count("*")), t.orders.agg(F.count_distinct("o_orderkey")))


@query(
    "j6_schema_full_join",
    """with n as (select count(c_custkey) as c, count(c_name) as nm from customer)
    select column_name, a_type, b_type, case column_name when 'c_custkey' then (select c from n) when 'c_name' then (select nm from n) end as filled
    from (values ('c_custkey', 'bigint', 'bigint'), ('c_name', 'string', null), ('c_phone', null, 'string')) as v(column_name, a_type, b_type)""",
)
def _(t):
    a = t.customer.select("c_custkey", "c_name")
    b = t.customer.select("c_custkey", F.lit("").alias("c_phone"))
    both = audit.compare_relation_columns(column_catalog(t.spark, {"a": a}), column_catalog(t.spark, {"b": b}))
    filled = a.agg(*[F.count(x).alias(x) for x in a.columns]).unpivot([], a.columns, "column_name", "filled")
    return both.select("column_name", c("a_data_type").alias("a_type"), c("b_data_type").alias("b_type")).join(
        filled, "column_name", "left"
    )


# Lines of large orders at full discount and tax: a few of them are changed, lost, doubled.
_RARE = "l_quantity > 47 and l_discount > 0.085 and l_tax > 0.065"
_CHANGED = f"""select l_orderkey, l_linenumber, l_partkey, case when {_RARE} and l_linenumber = 1 then l_quantity + 1 else l_quantity end as l_quantity,
    l_shipdate from lineitem where not ({_RARE} and l_linenumber = 2)
  union all select l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate from lineitem where {_RARE} and l_linenumber = 3"""


@query(
    "u7_differing_rows",
    f"""with a as (select l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate from lineitem), b as ({_CHANGED}),
    d as (select 'a' as only_in, x.* from (select * from a except all select * from b) x union all select 'b', x.* from (select * from b except all select * from a) x)
    select *, count(*) as copies from d group by all""",
)
def _(t):
    a = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    rare = F.expr(_RARE)
    quantity = F.when(rare & (c("l_linenumber") == 1), c("l_quantity") + 1).otherwise(c("l_quantity"))
    b = t.lineitem.where(~(rare & (c("l_linenumber") == 2))).withColumn("l_quantity", quantity).select(*a.columns)
    b = b.unionAll(t.lineitem.where(rare & (c("l_linenumber") == 3)).select(*a.columns))
    return difference.differing_rows(a, b, ["l_orderkey"])
