"""Projections, reshaping, joins, aggregates, windows and sorts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewright.functions import dates, keys, numbers, text
from tidewright.operators import joins, reshape, sketches, windows
from tidewright.plans.registry import query
from tidewright.session import scratch_path

c = F.col
cents = numbers.to_cents

_CENTS = "cast(round({0} * 100) as bigint)"
OT = _CENTS.format("o_totalprice")
LX = _CENTS.format("l_extendedprice")
EV = _CENTS.format("value")

# --- projections and filters -----------------------------------------------------------------------------


@query("r1_rename_projection", "select c_custkey as customer_id, c_name as customer_name, c_name || '/' || c_mktsegment as label from customer")
def _(t):
    return t.customer.selectExpr(
        "c_custkey as customer_id", "c_name as customer_name", "c_name || '/' || c_mktsegment as label"
    )


@query(
    "r2_star",
    """select o_orderkey as src_o_orderkey_v1, o_custkey as src_o_custkey_v1, o_orderstatus as src_o_orderstatus_v1,
       o_orderpriority as src_o_orderpriority_v1 from orders""",
)
def _(t):
    return t.orders.select(*reshape.star(t.orders, ["O_TOTALPRICE", "o_orderdate"], prefix="src_", suffix="_v1"))


@query("r3_filtered_columns", "select max(o_custkey) as o_custkey, max(o_orderstatus) as o_orderstatus, max(o_orderpriority) as o_orderpriority from orders")
def _(t):
    kept = reshape.filtered_columns(t.orders, ["O_ORDERKEY", "o_totalprice", "o_orderdate"])
    return t.orders.agg(*[F.max(x).alias(x) for x in kept])


@query(
    "r4_conditional_column",
    """select o_orderkey, case when o_orderstatus not in ('F', 'P') then o_orderdate end as valid_order_date,
       case when o_orderpriority = '4-NOT SPECIFIED' then null else o_orderpriority end as priority from orders""",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        F.when(~c("o_orderstatus").isin("F", "P"), c("o_orderdate")).alias("valid_order_date"),
        F.when(c("o_orderpriority") != "4-NOT SPECIFIED", c("o_orderpriority")).alias("priority"),
    )


@query(
    "r5_null_filter",
    """select d.doc_id, quality, n_chars from documents d left join labels l on d.doc_id = l.doc_id
       where quality is not null and n_chars is not null""",
)
def _(t):
    joined = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")
    return joined.where(c("quality").isNotNull() & c("n_chars").isNotNull()).select("doc_id", "quality", "n_chars")


@query(
    "r6_range_filter_log10",
    """select l_orderkey, l_linenumber, l_partkey, l_quantity, round(log10(l_quantity), 9) as log_quantity from lineitem
       where l_quantity > 5 and l_quantity < 40 and l_shipdate >= timestamp '1998-01-01'""",
)
def _(t):
    rows = t.lineitem.where(
        (c("l_quantity") > 5) & (c("l_quantity") < 40) & (c("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    )
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.round(F.log10("l_quantity"), 9).alias("log_quantity")
    )


@query("r7_constant_columns", "select *, 'test_column' as _test_column, 4 as _fourth_column from supplier")
def _(t):
    return reshape.add_constants(t.supplier, _test_column="test_column", _fourth_column=4)


@query(
    "r8_blank_to_null",
    """select c_custkey, nullif(case when c_nationkey < 5 then '' else c_name end, '') as c_name,
       nullif(c_mktsegment, '') as c_mktsegment, c_acctbal from customer""",
)
def _(t):
    rows = t.customer.select(
        "c_custkey", F.when(c("c_nationkey") < 5, "").otherwise(c("c_name")).alias("c_name"), "c_mktsegment", "c_acctbal"
    )
    return reshape.blanks_to_null(rows)


@query(
    "r9_try_cast_staging",
    """select cast(event_id as varchar) as run_id, case when event_type <> 'error' then date_trunc('second', ts) end as started_at
       from events""",
)
def _(t):
    raw = F.when(c("event_type") == "error", "n/a").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.events.select(
        c("event_id").cast("string").alias("run_id"), text.safe_cast(raw, "timestamp_ntz").alias("started_at")
    )


@query("r10_row_sum", "select l_orderkey, l_linenumber, l_partkey + l_suppkey + nullif(l_linenumber, 3) as row_sum from lineitem")
def _(t):
    made = numbers.row_sum(c("l_partkey"), c("l_suppkey"), F.nullif("l_linenumber", F.lit(3)))
    return t.lineitem.select("l_orderkey", "l_linenumber", made.alias("row_sum"))


@query("r11_membership_filter", f"select o_orderkey, o_custkey from orders where o_custkey in (select o_custkey from orders where {OT} > 49000000)")
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey")
    members = t.orders.where(cents(c("o_totalprice")) > 49000000)
    return joins.semi_by_set(rows, members, "o_custkey")


@query("r12_drop_columns", "select o_orderkey, o_custkey, o_totalprice from orders")
def _(t):
    return reshape.drop_columns(t.orders, ["O_ORDERSTATUS", "o_orderdate", "o_orderpriority"])


@query(
    "r13_value_predicates",
    """select count(*) filter (where upper(event_type) = 'ERROR') as placeholders,
       count(*) filter (where event_type <> upper(event_type[1]) || lower(event_type[2:])) as not_title_case,
       count(*) filter (where year(ts) < 2024 or year(ts) > 2030) as bad_years,
       (select count(*) from documents where ascii(left(text, 1)) > 127) as non_ascii from events""",
)
def _(t):
    kind = c("event_type")
    counts = t.events.agg(
        F.count_if(text.is_placeholder(kind, "ERROR")).alias("placeholders"),
        F.count_if(text.is_not_title_case(kind)).alias("not_title_case"),
        F.count_if(dates.year_out_of(c("ts"), 2024, 2030)).alias("bad_years"),
    )
    other = t.documents.agg(F.count_if(text.starts_non_ascii(c("text"))).alias("non_ascii"))
    both = counts.withColumn("non_ascii", F.lit(None).cast("bigint")).unionByName(other, allowMissingColumns=True)
    return both.agg(*[F.max(x).alias(x) for x in both.columns])


# --- reshaping and set operations ------------------------------------------------------------------------


@query(
    "r14_union_relations",
    """select 'customers' as _source_relation, c_custkey as id, cast(c_nationkey as varchar) as nation,
       c_mktsegment as segment, cast(null as varchar) as label from customer
       union all select 'suppliers', s_suppkey, cast(s_nationkey as varchar), null, s_name from supplier""",
)
def _(t):
    a = t.customer.select(
        c("c_custkey").alias("id"), c("c_nationkey").alias("nation"), c("c_mktsegment").alias("segment"), "c_acctbal"
    )
    b = t.supplier.select(c("s_suppkey").alias("id"), c("s_name").alias("label"), c("s_nationkey").alias("nation"))
    return reshape.union_relations(
        {"customers": a, "suppliers": b}, column_override={"nation": "string"}, exclude=["c_acctbal"]
    )


_FLAGS = "cast(sum(case when l_returnflag = '{0}' then 1 else 0 end) as bigint) as {1}"


@query(
    "r15_pivot",
    "select l_orderkey, "
    + ", ".join(_FLAGS.format(f, f"n_{f}_lines") for f in "ANR")
    + ", "
    + ", ".join(f"cast(sum(case when l_returnflag = '{f}' then {LX} else 0 end) as bigint) as amount_{f}" for f in "ANR")
    + " from lineitem group by l_orderkey",
)
def _(t):
    flags = reshape.column_values(t.lineitem, "l_returnflag")
    lines = t.lineitem.withColumn("amount", cents(c("l_extendedprice")))
    return reshape.group_by(lines.select("l_orderkey", "l_returnflag", "amount"), 1).agg(
        *reshape.pivot_columns("l_returnflag", flags, prefix="n_", suffix="_lines"),
        *reshape.pivot_columns("l_returnflag", flags, prefix="amount_", then_value="amount"),
    )


@query(
    "r16_unpivot",
    """select o_orderkey, 'o_custkey' as prop, cast(o_custkey as varchar) as val from orders
       union all select o_orderkey, 'status', nullif(o_orderstatus, 'P') from orders
       union all select o_orderkey, 'is_big', case when o_totalprice > 250000 then 'true' else 'false' end from orders""",
)
def _(t):
    rows = t.orders.select(
        "o_orderkey",
        "o_custkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        (c("o_totalprice") > 250000).alias("is_big"),
        "o_orderdate",
    )
    return reshape.unpivot(rows, exclude=["O_ORDERKEY"], remove=["o_orderdate"], field_name="prop", value_name="val")


@query(
    "r17_deduplicate",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate from (
       select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc, l_partkey desc,
       l_suppkey desc) as n from lineitem) where n = 1""",
)
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return reshape.newest(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


@query("r18_except", "select l_partkey as k, l_suppkey as s from lineitem except select l_suppkey, l_partkey from lineitem")
def _(t):
    """Pairs of part and supplier that never occur the other way round."""
    pairs = t.lineitem.select(c("l_partkey").alias("k"), c("l_suppkey").alias("s"))
    return pairs.subtract(t.lineitem.select("l_suppkey", "l_partkey"))


@query("r19_intersect", "select l_partkey as k, l_suppkey as s from lineitem intersect select l_suppkey, l_partkey from lineitem")
def _(t):
    """Pairs of part and supplier that occur the other way round as well."""
    pairs = t.lineitem.select(c("l_partkey").alias("k"), c("l_suppkey").alias("s"))
    return pairs.intersect(t.lineitem.select("l_suppkey", "l_partkey"))


@query("r20_tagged_union", "select 'c' as kind, c_nationkey as nation from customer union all select 's', s_nationkey from supplier")
def _(t):
    a = t.customer.select(F.lit("c").alias("kind"), c("c_nationkey").alias("nation"))
    return a.unionAll(t.supplier.select(F.lit("s").alias("kind"), c("s_nationkey").alias("nation")))


@query("r21_generate_series", "select cast(g as bigint) as generated_number, o_orderkey is not null as is_order from generate_series(1, (select count(*) from orders)) s(g) left join orders on o_orderkey = g")
def _(t):
    series = reshape.generate_series(t.spark, t.orders.count())
    keys_ = t.orders.select("o_orderkey")
    return series.join(keys_, c("generated_number") == c("o_orderkey"), "left").select(
        "generated_number", c("o_orderkey").isNotNull().alias("is_order")
    )


@query(
    "r22_date_spine",
    """select cast(d as date) as date_day from (select unnest(generate_series(cast(min(o_orderdate) as date),
       cast(max(o_orderdate) as date) - 1, interval 1 day)) as d from orders)""",
)
def _(t):
    bounds = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    return reshape.date_spine(bounds, "day", "a", "b")


@query(
    "r22_month_spine",
    """select cast(date_trunc('month', lo) + to_months(cast(i as integer)) + to_days(cast(day(lo) - 1 as integer)) as date) as date_month
       from (select min(o_orderdate) as lo, max(o_orderdate) as hi from orders), unnest(range(0, 200)) r(i)
       where i < date_diff('month', lo, hi)""",
)
def _(t):
    bounds = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    return reshape.date_spine(bounds, "month", "a", "b")


@query("r23_group_by_first_columns", f"select o_orderstatus, o_orderpriority, cast(sum({OT}) as bigint) as cents from orders group by 1, 2")
def _(t):
    rows = t.orders.select("o_orderstatus", "o_orderpriority", cents(c("o_totalprice")).alias("cents"))
    return reshape.group_by(rows, 2).agg(F.sum("cents").alias("cents"))


@query("r24_column_values", "select p_name as value, count(*) as row_count from part group by 1 order by 2 desc, 1 limit 15")
def _(t):
    return reshape.value_counts(t.part, "p_name", 15)


@query(
    "r24_column_values_custom_order",
    """select event_type as value, row_number() over (order by max(event_id), event_type) as place from events group by 1""",
)
def _(t):
    found = reshape.column_values(t.events, "event_type", order_by=F.max("event_id"))
    listed = t.spark.range(1).select(F.posexplode(F.array(*[F.lit(x) for x in found])).alias("n", "value"))
    return listed.select("value", (c("n") + 1).cast("bigint").alias("place"))


# --- joins -----------------------------------------------------------------------------------------------

_LINES = f"select l_orderkey, cast(sum({LX}) as bigint) as cents, max(l_shipdate) as last_ship from lineitem group by 1"


def _lines(t):
    return t.lineitem.groupBy("l_orderkey").agg(
        F.sum(cents(c("l_extendedprice"))).alias("cents"), F.max("l_shipdate").alias("last_ship")
    )


@query("j1_left_join_aggregated", f"select o_orderkey, o_custkey, cents, last_ship from orders left join ({_LINES}) on l_orderkey = o_orderkey")
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey")
    return rows.join(_lines(t), c("o_orderkey") == c("l_orderkey"), "left").drop("l_orderkey")


@query(
    "j2_left_join_dimension",
    """select o_orderkey, o_orderdate, c_name, n_name from orders left join customer on c_custkey = o_custkey
       left join nation on n_nationkey = c_nationkey where o_orderdate is not null and o_orderstatus = 'F'""",
)
def _(t):
    named = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey"), "left")
    rows = t.orders.join(named, c("o_custkey") == c("c_custkey"), "left")
    return rows.where(c("o_orderdate").isNotNull() & (c("o_orderstatus") == "F")).select(
        "o_orderkey", "o_orderdate", "c_name", "n_name"
    )


@query(
    "j3_inner_join_both_sides",
    """select c_custkey as customer_id, c_name as name, o_orderkey as id, 'order ' || o_orderkey as name_right
       from customer join orders on o_custkey = c_custkey""",
)
def _(t):
    left = t.customer.select(c("c_custkey").alias("customer_id"), c("c_name").alias("name"))
    right = t.orders.select(
        c("o_custkey").alias("customer_id"),
        c("o_orderkey").alias("id"),
        F.concat(F.lit("order "), c("o_orderkey").cast("string")).alias("name"),
    )
    return joins.inner_distinct_names(left, right, ["customer_id"])


@query(
    "j4_full_join_using",
    """with a as (select cast(o_orderdate as date) as day, count(*) as orders from orders group by 1),
    b as (select cast(l_shipdate as date) as day, count(*) as lines from lineitem group by 1)
    select coalesce(a.day, b.day) as day, orders, lines from a full outer join b on a.day = b.day""",
)
def _(t):
    a = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("orders"))
    b = t.lineitem.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count("*").alias("lines"))
    return a.join(b, "day", "full")


@query(
    "j5_full_join_on_key",
    """with a as (select c_custkey as k, c_mktsegment as v from customer),
    b as (select user_id as k, count(*) as w from events group by 1)
    select coalesce(a.k, b.k) as k, a.v, b.w, a.k is null as missing_a, b.k is null as missing_b
    from a full outer join b on a.k = b.k""",
)
def _(t):
    """Customers and users by their number; users start at 0, customers at 1, and either may end first."""
    a = t.customer.select(c("c_custkey").alias("ka"), c("c_mktsegment").alias("v"))
    b = t.events.groupBy(c("user_id").alias("kb")).agg(F.count("*").alias("w"))
    return a.join(b, c("ka") == c("kb"), "full_outer").select(
        F.coalesce("ka", "kb").alias("k"), "v", "w", c("ka").isNull().alias("missing_a"), c("kb").isNull().alias("missing_b")
    )


@query(
    "j7_anti_join",
    "select o_orderkey, o_custkey from orders left join (select * from customer where c_nationkey < 5) on c_custkey = o_custkey where c_custkey is null",
)
def _(t):
    parent = t.customer.where("c_nationkey < 5")
    return joins.missing_in(t.orders.select("o_orderkey", "o_custkey"), parent, "o_custkey", "c_custkey")


@query(
    "j8_running_self_join",
    f"""select a.o_orderkey, cast(sum({_CENTS.format('b.o_totalprice')}) as bigint) as running_cents from orders a
        join orders b on a.o_custkey = b.o_custkey and a.o_orderkey >= b.o_orderkey group by 1""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_custkey", cents(c("o_totalprice")).alias("cents"))
    made = windows.with_window(
        rows, ["o_orderkey"], ["o_custkey"], key_source=t.orders, running_cents=windows.running_sum("cents")
    )
    return made.select("o_orderkey", "running_cents")


@query("j9_two_counts", "select (select count(*) from orders) as count_a, (select count(*) from lineitem) as count_b")
def _(t):
    return joins.count_pair(t.orders, t.lineitem)


@query(
    "j10_calendar_left_join",
    """with cal as (select cast(d as date) as day from (select unnest(generate_series(cast(min(l_shipdate) as date),
       cast(max(l_shipdate) as date), interval 1 day)) as d from lineitem)),
    f as (select cast(o_orderdate as date) as order_day, count(*) as orders from orders group by 1)
    select day, order_day, orders from cal left join f on day = order_day""",
)
def _(t):
    calendar = reshape.calendar(t.lineitem, "l_shipdate")
    facts = t.orders.groupBy(F.to_date("o_orderdate").alias("order_day")).agg(
        F.count("*").alias("orders")
    )
    return joins.calendar_left(calendar, facts, "day", "order_day")


@query(
    "j11_multi_fact_join",
    f"""with a as (select cast(ts as date) as day, count(*) as events from events group by 1),
    b as (select cast(ts as date) as day, event_type, count(*) as n from events group by 1, 2)
    select a.day, events, cast(sum(n) as bigint) as by_type, max(case when event_type = 'click' then n end) as clicks
    from a left join b on a.day = b.day group by 1, 2""",
)
def _(t):
    a = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("events"))
    b = t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    per_day = b.groupBy("day").agg(
        F.sum("n").alias("by_type"), F.max(F.when(c("event_type") == "click", c("n"))).alias("clicks")
    )
    return a.join(per_day, "day", "left")


@query(
    "j12_lookup_left_join",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name from lineitem left join part on p_partkey = l_partkey + l_suppkey""",
)
def _(t):
    """A lookup in all parts by a number that not all of them have."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    parts = t.part.select("p_partkey", "p_name")
    return rows.join(parts, c("l_partkey") + c("l_suppkey") == c("p_partkey"), "left").drop("p_partkey")


@query(
    "j13_inner_merge_totals",
    f"""select cast(o_orderkey as varchar) as id, o_orderdate, cents from orders join ({_LINES}) on
        cast(l_orderkey as varchar) = cast(o_orderkey as varchar)""",
)
def _(t):
    totals = _lines(t).select(c("l_orderkey").cast("string").alias("id"), "cents")
    runs = t.orders.select(c("o_orderkey").cast("string").alias("id"), "o_orderdate")
    return runs.join(totals, "id", "inner")


@query("j14_semi_join", "select event_id, user_id from events where user_id in (select user_id from events where event_type = 'error' and value > 90)")
def _(t):
    members = t.events.where("event_type = 'error' and value > 90")
    return joins.semi_by_set(t.events.select("event_id", "user_id"), members, "user_id")


# --- aggregates ------------------------------------------------------------------------------------------


@query("a1_count_distinct_sum", f"select l_returnflag, count(*) as n, count(distinct l_orderkey) as orders, cast(sum({LX}) as bigint) as cents from lineitem group by 1")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.count_distinct("l_orderkey").alias("orders"), F.sum(cents(c("l_extendedprice"))).alias("cents")
    )


@query("a2_customer_summary", f"select o_custkey, min(o_orderdate) as first_order, max(o_orderdate) as last_order, count(o_orderkey) as orders, cast(sum({OT}) as bigint) as cents from orders group by 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.count("o_orderkey").alias("orders"),
        F.sum(cents(c("o_totalprice"))).alias("cents"),
    )


@query(
    "a3_conditional_sum",
    f"""select o_orderkey, coalesce(cents, 0) as cents, cents is null as none_final from orders left join (select l_orderkey,
        cast(sum(case when l_linestatus = 'F' then {LX} end) as bigint) as cents from lineitem group by 1) on l_orderkey = o_orderkey""",
)
def _(t):
    paid = F.sum(F.when(c("l_linestatus") == "F", cents(c("l_extendedprice"))))
    per_order = t.lineitem.groupBy(c("l_orderkey").alias("o_orderkey")).agg(paid.alias("paid"))
    return t.orders.select("o_orderkey").join(per_order, "o_orderkey", "left").select(
        "o_orderkey", F.coalesce("paid", F.lit(0)).alias("cents"), c("paid").isNull().alias("none_final")
    )


@query(
    "a4_status_counts",
    """select cast(ts as date) as day, cast(sum(case when lower(event_type) in ('purchase', 'signup') then 1 else 0 end) as bigint)
       as good, cast(sum(case when lower(event_type) in ('error') then 1 else 0 end) as bigint) as bad, count(*) as total
       from events group by 1""",
)
def _(t):
    kind = F.lower("event_type")
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(
        F.sum(F.when(kind.isin("purchase", "signup"), 1).otherwise(0)).alias("good"),
        F.sum(F.when(kind.isin("error"), 1).otherwise(0)).alias("bad"),
        F.count("*").alias("total"),
    )


@query(
    "a5_count_if_filter",
    """select cast(ts as date) as day, count(*) filter (where event_type = 'signup') as signups,
       count(*) filter (where event_type = 'signup') as signups_alt from events group by 1""",
)
def _(t):
    return t.events.groupBy(F.to_date("ts").alias("day")).agg(
        F.count_if(c("event_type") == "signup").alias("signups"),
        F.expr("count(*) filter (where event_type = 'signup')").alias("signups_alt"),
    )


@query(
    "a6_percentiles",
    f"""select cast(ts as date) as day, cast(sum({EV}) as double) / count(*) as avg_cents, min({EV}) as min_cents,
        max({EV}) as max_cents, quantile_disc({EV}, 0.5) as p50, quantile_disc({EV}, 0.9) as p90 from events group by 1""",
)
def _(t):
    v = cents(c("value"))
    made = t.events.groupBy(F.to_date("ts").alias("day")).agg(
        (F.sum(v).cast("double") / F.count("*")).alias("avg_cents"),
        F.min(v).alias("min_cents"),
        F.max(v).alias("max_cents"),
        F.percentile_approx(v, [0.5, 0.9], 10_000).alias("p"),
    )
    return made.select("day", "avg_cents", "min_cents", "max_cents", c("p")[0].alias("p50"), c("p")[1].alias("p90"))


@query(
    "a7_guarded_ratio",
    """select user_id, case when count(*) filter (where value > 90) > 0 then cast(count(*) filter (where event_type = 'error'
       and value > 90) as double) / count(*) filter (where value > 90) end as error_share from events group by 1""",
)
def _(t):
    high = c("value") > 90
    made = numbers.ratio(F.count_if(high & (c("event_type") == "error")), F.count_if(high))
    return t.events.groupBy("user_id").agg(made.alias("error_share"))


@query("a8_any_value", "select p_brand, min(p_type) as p_type, count(*) as num_rows from part group by 1")
def _(t):
    return t.part.groupBy("p_brand").agg(F.min("p_type").alias("p_type"), F.count("*").alias("num_rows"))


@query("a9_bool_or", "select user_id, bool_or(case when event_type <> 'view' then value > 99 end) as any_high from events group by 1")
def _(t):
    return t.events.groupBy("user_id").agg(F.bool_or(F.when(c("event_type") != "view", c("value") > 99)).alias("any_high"))


@query(
    "a10_listagg",
    """with d as (select distinct user_id, event_type from events), r as (select user_id, event_type, event_id,
       row_number() over (partition by user_id order by event_id) as n from events),
    a as (select user_id, string_agg(event_type, ', ' order by event_type) as kinds from d group by 1),
    b as (select user_id, string_agg(event_type, '_|_' order by event_id) as first_3 from r where n <= 3 group by 1)
    select user_id, kinds, first_3 from a join b using (user_id)""",
)
def _(t):
    kinds = reshape.listagg(t.events, ["user_id"], "event_type", ", ", distinct=True, name="kinds")
    first = reshape.listagg(t.events, ["user_id"], "event_type", "_|_", order_by="event_id", limit=3, name="first_3")
    return kinds.join(first, "user_id")


@query("a11_having_duplicates", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def _(t):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


@query(
    "a12_table_checksum",
    """with f as (select ('0x' || left(md5(o_orderkey || '|' || o_custkey || '|' || nullif(o_orderstatus, 'P')), 15))::bigint
       as fp from orders)
    select bit_xor(fp) as checksum, cast(sum(fp % 1000003) as bigint) as fingerprint_sum, count(*) as row_count,
      count(fp) as rows_without_null from f""",
)
def _(t):
    from tidewright.operators.audit import table_checksum

    return table_checksum(t.orders, [c("o_orderkey"), c("o_custkey"), F.nullif("o_orderstatus", F.lit("P"))])


@query("a13_share_of_total", "select event_type, count(*) as n, round(100.0::double * count(*) / sum(count(*)) over (), 2) as percent_of_total from events group by 1")
def _(t):
    counts = t.events.groupBy("event_type").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.select("event_type", "n", numbers.percent_of(c("n"), total).alias("percent_of_total"))


@query(
    "a14_before_after_means",
    f"""with f as (select user_id, min(ts) as first_use from events where event_type = 'purchase' group by 1)
    select user_id, cast(sum(case when ts < first_use then {EV} end) as double) / nullif(count(case when ts < first_use then 1 end), 0)
      as avg_before, cast(sum(case when ts >= first_use then {EV} end) as double) / count(case when ts >= first_use then 1 end)
      as avg_after from events join f using (user_id) group by 1""",
)
def _(t):
    first = t.events.where("event_type = 'purchase'").groupBy("user_id").agg(F.min("ts").alias("first_use"))
    early, v = c("ts") < c("first_use"), cents(c("value"))

    def mean(test):
        return F.sum(F.when(test, v)).cast("double") / F.nullif(F.count_if(test), F.lit(0))

    return t.events.join(first, "user_id").groupBy("user_id").agg(
        mean(early).alias("avg_before"), mean(~early).alias("avg_after")
    )


@query("a15_max_per_group_day", f"select cast(ts as date) as day, event_type, max({EV}) as top_cents from events group by 1, 2")
def _(t):
    return t.events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.max(cents(c("value"))).alias("top_cents"))


@query(
    "a16_reconciliation_metrics",
    f"""select count(*) as row_count, count(distinct event_type) as kinds, count(distinct user_id) as users,
        cast(sum({EV}) as bigint) as cents, cast(floor(epoch(min(ts))) as bigint) as min_ts, cast(floor(epoch(max(ts))) as bigint)
        as max_ts from events""",
)
def _(t):
    from tidewright.operators.audit import metrics

    return metrics(
        t.events,
        row_count=F.count("*"),
        kinds=F.count_distinct("event_type"),
        users=F.count_distinct("user_id"),
        cents=F.sum(cents(c("value"))),
        min_ts=dates.epoch_seconds(F.min("ts")),
        max_ts=dates.epoch_seconds(F.max("ts")),
    )


# --- windows ---------------------------------------------------------------------------------------------


def _paid(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate", cents(c("o_totalprice")).alias("cents"))


@query("w1_global_row_number", "select o_orderkey, row_number() over (order by o_orderkey) as transaction_seq from orders")
def _(t):
    return windows.with_window(t.orders.select("o_orderkey"), ["o_orderkey"], transaction_seq=windows.row_number())


@query("w1_global_row_number_text", "select c_custkey, c_name, row_number() over (order by c_name) as seq from customer")
def _(t):
    return windows.with_window(t.customer.select("c_custkey", "c_name"), ["c_name"], seq=windows.row_number())


@query(
    "w2_partitioned_text_order",
    """select c_custkey, row_number() over (partition by c_mktsegment order by c_name) as seq,
       rank() over (partition by c_mktsegment order by c_name) as place from customer""",
)
def _(t):
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_name")
    made = windows.with_window(rows, ["c_name"], ["c_mktsegment"], hot_rows=20, slices=16, seq=windows.row_number(), place=windows.rank())
    return made.select("c_custkey", "seq", "place")


@query(
    "w2_partitioned_row_number",
    """select o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) as customer_sales_seq,
       case when rank() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1 then 'new' else 'return' end as nvsr
       from orders""",
)
def _(t):
    keys_ = t.orders
    hot = windows.hot_keys(keys_.select("o_custkey"), ["o_custkey"])
    shared = {"partition_by": ["o_custkey"], "key_source": keys_, "hot": hot}
    made = windows.with_window(_paid(t), ["o_orderkey"], **shared, customer_sales_seq=windows.row_number())
    made = windows.with_window(made, ["o_orderdate", "o_orderkey"], **shared, place=windows.rank())
    return made.select("o_orderkey", "customer_sales_seq", F.when(c("place") == 1, "new").otherwise("return").alias("nvsr"))


@query("w3_running_sum", f"select o_orderkey, cast(sum({OT}) over (partition by o_custkey order by o_orderdate) as bigint) as running from orders")
def _(t):
    made = windows.with_window(
        _paid(t), ["o_orderdate"], ["o_custkey"], key_source=t.orders, running=windows.running_sum("cents")
    )
    return made.select("o_orderkey", "running")


@query("w4_first_value", "select o_orderkey, first_value(o_orderdate) over (partition by o_custkey order by o_orderdate) as first_day from orders")
def _(t):
    made = windows.with_window(
        _paid(t), ["o_orderdate"], ["o_custkey"], key_source=t.orders, first_day=windows.first_value("o_orderdate")
    )
    return made.select("o_orderkey", "first_day")


@query(
    "w5_lead_last_record",
    """select o_orderkey, lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as next_date,
       row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1 as is_last from orders""",
)
def _(t):
    made = windows.with_window(
        _paid(t).withColumn("one", F.lit(1)),
        ["o_orderdate", "o_orderkey"],
        ["o_custkey"],
        key_source=t.orders,
        next_date=windows.lead("o_orderdate"),
        next_one=windows.lead("one"),
    )
    return made.select("o_orderkey", "next_date", c("next_one").isNull().alias("is_last"))


@query("w6_global_lag", "select event_id, lag(ts) over (order by event_id) as previous_ts from events")
def _(t):
    return windows.with_window(t.events.select("event_id", "ts"), ["event_id"], previous_ts=windows.lag("ts")).select("event_id", "previous_ts")


@query(
    "w7_hour_gaps",
    """with h as (select date_trunc('hour', ts) as hour_, count(*) as n from events group by 1)
    select hour_, n, lag(hour_) over (order by hour_ desc) as prev_hour from h""",
)
def _(t):
    hours = t.events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_")).agg(F.count("*").alias("n"))
    return windows.with_window(windows.landed(hours, "hours"), ["hour_"], prev_hour=windows.lead("hour_"))


@query("w8_total_over_all", "select o_orderpriority, count(*) as n, cast(sum(count(*)) over () as bigint) as total from orders group by 1")
def _(t):
    counts = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return counts.select("*", F.sum("n").over(Window.partitionBy()).alias("total"))


@query(
    "w9_row_number_dedupe",
    """select doc_id, lang, n_chars from (select doc_id, lang, n_chars, row_number() over (partition by text order by doc_id) as n
       from documents) where n = 1""",
)
def _(t):
    rows = t.documents.select(keys.hash_text(c("text")).alias("text_hash"), "doc_id", "lang", "n_chars")
    return reshape.deduplicate(rows, ["text_hash"], [c("doc_id")]).drop("text_hash")


# --- sorts and limits ------------------------------------------------------------------------------------


@query("o1_order_by", "select cast(ts as date) as event_date, count(*) as total_events from events group by 1 order by 1")
def _(t):
    return t.events.groupBy(F.to_date("ts").alias("event_date")).agg(F.count("*").alias("total_events")).orderBy("event_date")


@query("o2_limit", "select c_custkey, c_name from customer order by c_custkey limit 10")
def _(t):
    return t.customer.select("c_custkey", "c_name").orderBy("c_custkey").limit(10)


def sampled(df, order_by: str, limit: int | None = None):
    """A preview of the first rows where a limit is set; the whole frame otherwise."""
    return df.orderBy(order_by).limit(limit) if limit is not None else df


@query("o3_preview_limit", "select o_orderkey, o_custkey from orders order by o_orderkey limit 100")
def _(t):
    return sampled(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", limit=100)


@query("o4_top_values", "select l_partkey, count(*) as n from lineitem group by 1 order by 2 desc, 1 limit 20")
def _(t):
    return t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l_partkey").limit(20)


@query(
    "a6_quantile_sketches",
    "select event_type, cast(date_trunc('month', ts) as date) as month, count(*) as n_values, true as p50_near, true as p90_near from events group by 1, 2",
)
def _(t):
    """Medians and 90 % points of a month from a stored row per day; near is within the stated error of the rank."""
    path = scratch_path(t.spark, "quantiles")
    daily = sketches.quantile_parts(t.events.withColumn("day", F.to_date("ts")), ["event_type", "day"], "value")
    daily.write.parquet(path)
    stored = t.spark.read.parquet(path).withColumn("month", F.trunc("day", "month"))
    asked = sketches.quantiles(sketches.merge_quantile_parts(stored, ["event_type", "month"]), p50=0.5, p90=0.9)
    rows = t.events.withColumn("month", F.trunc(F.to_date("ts"), "month")).join(asked, ["event_type", "month"])
    error = sketches.rank_error()

    def near(p, share):
        below, upto = F.count_if(c("value") < c(p)) / F.count("*"), F.count_if(c("value") <= c(p)) / F.count("*")
        return ((below <= share + error) & (upto >= share - error)).alias(f"{p}_near")

    return rows.groupBy("event_type", "month", "n_values").agg(near("p50", 0.5), near("p90", 0.9))


@query(
    "r24_heavy_values",
    """select *, cast(row_number() over (order by "count" desc, value) as integer) as rank from
       (select o_custkey % 50 * (o_custkey % 3) as value, count(*) as "count" from orders group by 1 order by 2 desc, 1 limit 20)""",
)
def _(t):
    spread = t.orders.select((c("o_custkey") % 50 * (c("o_custkey") % 3)).alias("code"))
    return sketches.heavy_values(spread, "code", 20, tracked=1000)
