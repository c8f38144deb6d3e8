"""One query per data-quality check, each on a whole table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions import dates, numbers, text
from tidewright.operators import checks as ck
from tidewright.plans.registry import query

c = F.col
_CENTS = "cast(round({0} * 100) as bigint)"
NOW = "2024-02-01 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


@query("c1_accepted_range", "select l_orderkey, l_linenumber, l_quantity from lineitem where not (l_quantity >= 3) or not (l_quantity <= 48)")
def _(t):
    return ck.accepted_range(t.lineitem, "l_quantity", 3, 48).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "c2_at_least_one",
    """select 'signup' as part, count(case when event_type = 'signup' then nullif(event_type, 'signup') end) as filled from events
       having count(case when event_type = 'signup' then nullif(event_type, 'signup') end) = 0
       union all select 'all', count(event_type) from events having count(event_type) = 0""",
)
def _(t):
    never = t.events.select(F.when(c("event_type") == "signup", F.nullif("event_type", F.lit("signup"))).alias("v"))
    a = ck.at_least_one(never, "v").select(F.lit("signup").alias("part"), "filled")
    return a.unionByName(ck.at_least_one(t.events, "event_type").select(F.lit("all").alias("part"), "filled"))


@query(
    "c3_cardinality_equality",
    """with a as (select c_nationkey as value, count(*) as num_rows from customer group by 1),
    b as (select s_nationkey as value, count(*) as num_rows from supplier group by 1)
    select *, 'a' as found_in from (select * from a except select * from b)
    union all select *, 'b' from (select * from b except select * from a)""",
)
def _(t):
    return ck.cardinality_equality(t.customer, "c_nationkey", t.supplier, "s_nationkey")


@query(
    "c4_equal_rowcount",
    """select count_a, count_b, abs(count_a - count_b) as diff_count from
       (select (select count(*) from orders) as count_a, (select count(*) from customer) as count_b)""",
)
def _(t):
    return ck.equal_rowcount(t.orders, t.customer)


_ORDERS_B = "select o_orderkey, o_custkey, case when o_totalprice > 495000 then 'X' else o_orderstatus end as o_orderstatus from orders where o_orderpriority <> '1-URGENT' or o_totalprice < 400000"


def _altered(t) -> DataFrame:
    status = F.when(c("o_totalprice") > 495000, "X").otherwise(c("o_orderstatus"))
    kept = t.orders.where((c("o_orderpriority") != "1-URGENT") | (c("o_totalprice") < 400000))
    return kept.select("o_orderkey", "o_custkey", status.alias("o_orderstatus"))


@query(
    "c5_equality",
    f"""with a as (select o_orderkey, o_custkey, o_orderstatus from orders), b as ({_ORDERS_B})
    select 'a_minus_b' as which_diff, * from (select * from a except select * from b)
    union all select 'b_minus_a', * from (select * from b except select * from a)""",
)
def _(t):
    return ck.equality(t.orders, _altered(t), ["o_orderkey", "o_custkey", "o_orderstatus"])


@query(
    "c5_equality_score",
    f"""with a as (select o_orderkey, o_custkey, o_orderstatus from orders), b as ({_ORDERS_B}),
    x as (select count(*) as n from (select * from a except select * from b)),
    y as (select count(*) as n from (select * from b except select * from a))
    select x.n + y.n + abs(x.n - y.n) as failures from x, y""",
)
def _(t):
    return ck.equality_score(ck.equality(t.orders, _altered(t), ["o_orderkey", "o_custkey", "o_orderstatus"]))


@query("c6_expression_is_true", "select l_orderkey, l_linenumber, l_discount, l_tax from lineitem where l_returnflag = 'R' and not (l_discount + l_tax < 0.17)")
def _(t):
    rows = ck.expression_is_true(t.lineitem, "+ l_tax < 0.17", column="l_discount", condition="l_returnflag = 'R'")
    return rows.select("l_orderkey", "l_linenumber", "l_discount", "l_tax")


@query(
    "c7_fewer_rows_than",
    """select a.n as count_a, b.n as count_b, case when a.n > b.n then a.n - b.n when a.n = b.n then 1 else 0 end as row_count_delta
       from (select count(*) as n from lineitem) a, (select count(*) as n from orders) b""",
)
def _(t):
    made = ck.fewer_rows_than(t.lineitem, t.orders)
    return made.withColumn("row_count_delta", c("row_count_delta").cast("bigint"))


@query(
    "c8_mutually_exclusive_ranges",
    """with w as (select l_suppkey, l_orderkey, l_linenumber, l_partkey, l_shipdate, l_shipdate + to_days(l_linenumber - 1) as upto,
       lead(l_shipdate) over (partition by l_suppkey order by l_shipdate, l_orderkey, l_linenumber, l_partkey) as next_lower_bound,
       row_number() over (partition by l_suppkey order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_partkey desc) = 1
       as is_last from lineitem)
    select l_orderkey, l_linenumber, l_partkey, l_shipdate, upto, next_lower_bound from w
    where not (coalesce(l_shipdate < upto, false) and coalesce(upto <= next_lower_bound, is_last, false))""",
)
def _(t):
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate").withColumn(
        "upto", dates.dateadd("day", c("l_linenumber") - 1, c("l_shipdate"))
    )
    bad = ck.mutually_exclusive_ranges(
        rows, "l_shipdate", "upto", "l_suppkey", tie_break=["l_orderkey", "l_linenumber", "l_partkey"]
    )
    return bad.drop("l_suppkey")


@query("c9_not_accepted_values", "select distinct o_orderstatus as value_field from orders where o_orderstatus in ('P', 'X')")
def _(t):
    return ck.not_accepted_values(t.orders, "o_orderstatus", ["P", "X"])


@query(
    "c10_not_constant",
    """select 'flag' as part, count(distinct case when l_returnflag <> 'R' then 1 end) as distinct_values from lineitem
       having count(distinct case when l_returnflag <> 'R' then 1 end) = 1
       union all select 'status', count(distinct l_linestatus) from lineitem having count(distinct l_linestatus) = 1""",
)
def _(t):
    rows = t.lineitem.select("l_linestatus", F.when(c("l_returnflag") != "R", 1).alias("flag"))
    a = ck.not_constant(rows, "flag").select(F.lit("flag").alias("part"), "distinct_values")
    b = ck.not_constant(rows, "l_linestatus").select(F.lit("status").alias("part"), "distinct_values")
    return a.unionByName(b)


@query(
    "c11_not_null_proportion",
    """select cast(count(quality) as double) / count(*) as not_null_proportion from documents d left join labels l
       on d.doc_id = l.doc_id having cast(count(quality) as double) / count(*) < 0.9""",
)
def _(t):
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return ck.not_null_proportion(rows, "quality", 0.9)


@query(
    "c12_recency",
    f"""select max(ts) as most_recent, timestamp '{NOW}' - interval 1 day as threshold from events
        having max(ts) < timestamp '{NOW}' - interval 1 day""",
)
def _(t):
    return ck.recency(t.events, "ts", "day", 1, now())


@query(
    "c13_relationships_where",
    """select o_custkey as id from orders where o_orderstatus = 'F' and o_custkey is not null and o_custkey not in
       (select c_custkey from customer where c_mktsegment <> 'BUILDING')""",
)
def _(t):
    return ck.relationships_where(
        t.orders, "o_custkey", t.customer, "c_custkey", "o_orderstatus = 'F'", "c_mktsegment <> 'BUILDING'"
    )


@query(
    "c14_sequential_values",
    """with w as (select doc_id, lag(doc_id) over (order by doc_id) as previous_doc_id from labels)
    select * from w where not (doc_id = previous_doc_id + 1)""",
)
def _(t):
    return ck.sequential_values(t.labels, "doc_id")


@query(
    "c14_sequential_days",
    """with d as (select distinct o_orderdate from orders), w as (select o_orderdate, lag(o_orderdate) over (order by o_orderdate)
       as previous_o_orderdate from d)
    select * from w where not (o_orderdate = previous_o_orderdate + interval 1 day)""",
)
def _(t):
    return ck.sequential_values(t.orders.select("o_orderdate").distinct(), "o_orderdate", 1, "day")


@query("c15_unique_combination", "select l_orderkey, l_linenumber, count(*) as n_records from lineitem group by 1, 2 having count(*) > 1")
def _(t):
    return ck.unique_combination_of_columns(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "c16_where_wrappers",
    """select 'unique_where' as check_name, cast(l_orderkey as varchar) as v from lineitem where l_linenumber = 1
       group by l_orderkey having count(*) > 1
       union all select 'not_null_where', cast(d.doc_id as varchar) from documents d left join labels l on d.doc_id = l.doc_id
       where lang = 'en' and quality is null""",
)
def _(t):
    doubled = ck.unique(t.lineitem, "l_orderkey", where="l_linenumber = 1")
    labelled = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    blank = ck.not_null(labelled, "quality", where="lang = 'en'")
    return doubled.select(F.lit("unique_where").alias("check_name"), c("l_orderkey").cast("string").alias("v")).unionByName(
        blank.select(F.lit("not_null_where").alias("check_name"), c("doc_id").cast("string").alias("v"))
    )


@query(
    "c17_builtin_checks",
    """select 'unique' as check_name, count(*) as failing_rows from (select p_name from part group by 1 having count(*) > 1)
       union all select 'not_null', count(*) from orders where o_custkey is null
       union all select 'accepted_values', count(*) from (select distinct o_orderstatus from orders where o_orderstatus not in ('F', 'O'))
       union all select 'relationships', count(*) from lineitem where l_orderkey not in (select o_orderkey from orders)""",
)
def _(t):
    found = {
        "unique": ck.unique(t.part, "p_name"),
        "not_null": ck.not_null(t.orders, "o_custkey"),
        "accepted_values": ck.accepted_values(t.orders, "o_orderstatus", ["F", "O"]),
        "relationships": ck.relationships(t.lineitem, "l_orderkey", t.orders, "o_orderkey"),
    }
    return reduce(DataFrame.unionByName, [ck.verdict(df, n).drop("status") for n, df in found.items()])


@query(
    "c18_average",
    f"""select cast(o_orderdate as date) as date_, nullif(o_orderpriority, '5-LOW') as store,
        cast(sum({_CENTS.format('o_totalprice')}) as double) / nullif(count(o_totalprice), 0) as avg_ from orders group by 1, 2
        having cast(sum({_CENTS.format('o_totalprice')}) as double) / nullif(count(o_totalprice), 0) > 40000000""",
)
def _(t):
    rows = t.orders.withColumn("day", F.to_date("o_orderdate"))
    return ck.average(rows, numbers.to_cents(c("o_totalprice")), "day", F.nullif("o_orderpriority", F.lit("5-LOW")), 40000000)


@query("c19_recent_days", "select cast(max(o_orderdate) as date) as latest_date from orders having cast(max(o_orderdate) as date) < date '2024-02-01' - 30")
def _(t):
    return ck.recent_days(t.orders, c("o_orderdate"), 30, F.to_date(now()))


@query(
    "c20_recent_julian_days",
    """select date '1920-01-01' + cast(max(day_key) - 2415020 as integer) as latest_date from
       (select date_diff('day', date '1920-01-01', cast(o_orderdate as date)) + 2415020 as day_key from orders)
       having date '1920-01-01' + cast(max(day_key) - 2415020 as integer) < date '2024-02-01' - 30""",
)
def _(t):
    rows = t.orders.select(dates.date_to_julian(F.to_date("o_orderdate")).alias("day_key"))
    return ck.recent_julian_days(rows, "day_key", 30, F.to_date(now()))


@query(
    "c21_hourly_completeness",
    """with h as (select date_trunc('hour', o_orderdate) as hour_, count(*) as rows_ from orders
       where o_orderdate >= timestamp '2002-01-01' - interval 1000 day group by 1),
    w as (select *, lead(hour_) over (order by hour_) as next_hour from h)
    select *, date_diff('hour', hour_, next_hour) as hourly_diff from w where date_diff('hour', hour_, next_hour) <> 1""",
)
def _(t):
    return ck.completeness_hourly(t.orders, "o_orderdate", 1000, F.lit("2002-01-01").cast("timestamp_ntz"))


@query(
    "c22_source_freshness",
    f"""select event_type, max(ts) as max_loaded_at, case when max(ts) < timestamp '{NOW}' - interval 47 hour then 'error'
        when max(ts) < timestamp '{NOW}' - interval 26 hour then 'warn' else 'pass' end as status from events
        group by 1""",
)
def _(t):
    return ck.freshness(t.events, "ts", now(), (26, "hour"), (47, "hour"), by=["event_type"])


@query(
    "c23_conditional_not_null",
    "select d.doc_id, lang from documents d left join labels l on d.doc_id = l.doc_id where lang = 'fr' and quality is null",
)
def _(t):
    rows = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return ck.missing_when(rows, "lang", "fr", "quality").select("doc_id", "lang")


_NET = "case when l_returnflag = 'R' then -{0} else {0} end".format(_CENTS.format("l_extendedprice"))


@query("c24_negative_totals", f"select l_orderkey, cast(sum({_NET}) as bigint) as total_amount from lineitem group by 1 having sum({_NET}) < 0")
def _(t):
    v = numbers.to_cents(c("l_extendedprice"))
    return ck.negative_totals(t.lineitem, "l_orderkey", F.when(c("l_returnflag") == "R", -v).otherwise(v))


@query(
    "c24_negative_totals_daily",
    f"select l_orderkey, cast(sum({_NET}) as bigint) as total_amount from lineitem where l_shipdate = timestamp '1998-06-01' group by 1 having sum({_NET}) < 0",
)
def _(t):
    v = numbers.to_cents(c("l_extendedprice"))
    on = F.lit("1998-06-01").cast("timestamp_ntz")
    return ck.negative_totals(t.lineitem, "l_orderkey", F.when(c("l_returnflag") == "R", -v).otherwise(v), "l_shipdate", on)


@query(
    "c25_assert_equal",
    """select l.doc_id, quality, toxic, false as blank from labels l where quality <> toxic
       union all select doc_id, null, null, true from documents where replace(lang, 'en', '') = ''""",
)
def _(t):
    unequal = ck.assert_equal(t.labels, "quality", "toxic").select("doc_id", "quality", "toxic", F.lit(False).alias("blank"))
    rows = t.documents.select("doc_id", text.replace(c("lang"), "en", "").alias("lang"))
    blank = ck.not_empty_string(rows, "lang").select("doc_id", F.lit(True).alias("blank"))
    return unequal.unionByName(blank, allowMissingColumns=True)


@query(
    "c26_threshold_verdict",
    """select 'high_quantity' as check_name, count(*) as failing_rows, case when count(*) > 1000000 then 'FAILED'
       when count(*) > 0 then 'WARNING' else 'SUCCEEDED' end as status from lineitem where l_quantity > 49
       union all select 'row_total', count(*), case when count(*) = 0 then 'FAILED' else 'SUCCEEDED' end from lineitem""",
)
def _(t):
    high = ck.verdict(ck.accepted_range(t.lineitem, "l_quantity", max_value=49), "high_quantity", "> 1000000", "> 0")
    total = t.lineitem.agg(F.count("*").alias("n"))
    return high.unionByName(ck.verdict(total, "row_total", "= 0", None, scalar="n"))


@query(
    "c27_check_matrix",
    """with v as (
      select 'lineitem' as table_name, 'not_null:l_shipdate' as check_name, count(*) filter (where l_shipdate is null) as failing_rows from lineitem
      union all select 'lineitem', 'not_null:l_quantity', count(*) filter (where l_quantity is null) from lineitem
      union all select 'lineitem', 'invalid:l_discount', count(*) filter (where l_discount > 0.09) from lineitem
      union all select 'events', 'invalid:event_type', count(*) filter (where upper(event_type) = 'ERROR') from events
      union all select 'lineitem', 'duplicates:l_orderkey,l_linenumber', count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
      union all select 'orders', 'duplicates:o_orderkey', count(*) from (select 1 from orders group by o_orderkey having count(*) > 1))
    select *, case when failing_rows > 0 then 'FAILED' else 'SUCCEEDED' end as status from v""",
)
def _(t):
    tables = {"lineitem": t.lineitem, "events": t.events, "orders": t.orders}
    plan = ck.CheckPlan(
        rows=[
            ck.RowCheck("lineitem", "not_null:l_shipdate", c("l_shipdate").isNull()),
            ck.RowCheck("lineitem", "not_null:l_quantity", c("l_quantity").isNull()),
            ck.RowCheck("lineitem", "invalid:l_discount", c("l_discount") > 0.09),
            ck.RowCheck("events", "invalid:event_type", text.is_placeholder(c("event_type"), "ERROR")),
        ],
        duplicates=[("lineitem", ["l_orderkey", "l_linenumber"]), ("orders", ["o_orderkey"])],
    )
    return ck.run_checks(tables, plan)


@query("c28_timestamp_sanity", "select l_orderkey, l_linenumber, l_partkey, l_shipdate from lineitem where l_shipdate is null or year(l_shipdate) < 1996 or year(l_shipdate) > 2000")
def _(t):
    return ck.timestamp_sanity(t.lineitem, "l_shipdate", 1996, 2000).select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")


@query(
    "c29_severity",
    """select 'as_warning' as check_name, count(*) as failing_rows, 'WARNING' as status from orders where o_orderstatus = 'P'
       union all select 'warn_if_one', count(*), case when count(*) >= 1 then 'WARNING' else 'SUCCEEDED' end from orders where o_orderstatus = 'F'""",
)
def _(t):
    a = ck.verdict(ck.not_accepted_values(t.orders, "o_orderstatus", ["X"]).unionAll(
        t.orders.where("o_orderstatus = 'P'").select("o_orderstatus")), "as_warning", severity="warn")
    b = ck.verdict(t.orders.where("o_orderstatus = 'F'"), "warn_if_one", error_if=None, warn_if=">= 1")
    return a.unionByName(b)


@query("c30_loaded_vs_expected", "select count(*) as loaded_rows, (select count(*) from orders) as expected_rows from lineitem having count(*) <> (select count(*) from orders)")
def _(t):
    return ck.loaded_vs_expected(t.lineitem, t.orders.count())
