"""Worked models: shop orders and customers, run KPIs, events, catalog orders, readings and trips.

Model functions take frames with the columns named in their text. The queries below feed them from the given tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions import dates, keys, numbers, text
from tidewright.operators import audit, joins, reshape, windows
from tidewright.plans.registry import query
from tidewright.session import landed
from tidewright.sources.tables import half_open, scan

c = F.col
_CENTS = "cast(round({0} * 100) as bigint)"

# --- shop: sources ---------------------------------------------------------------------------------------
# Orders and customers as they are; order lines stand for payments, their flag for the payment method.


def raw_orders(t) -> DataFrame:
    return t.orders.select(
        c("o_orderkey").alias("id"),
        c("o_custkey").alias("user_id"),
        c("o_orderdate").alias("order_date"),
        c("o_orderstatus").alias("status"),
    )


def raw_payments(t) -> DataFrame:
    return t.lineitem.select(
        c("l_linenumber").alias("id"),
        c("l_orderkey").alias("orderid"),
        c("l_returnflag").alias("paymentmethod"),
        F.when(c("l_linestatus") == "F", "success").otherwise("fail").alias("status"),
        numbers.to_cents(c("l_extendedprice")).alias("amount"),
        c("l_shipdate").alias("created"),
    )


def raw_customers(t) -> DataFrame:
    return t.customer.select(
        c("c_custkey").alias("id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
    )


_RAW = f"""raw_orders as (select o_orderkey as id, o_custkey as user_id, o_orderdate as order_date, o_orderstatus as status from orders),
  raw_payments as (select l_linenumber as id, l_orderkey as orderid, l_returnflag as paymentmethod,
    case when l_linestatus = 'F' then 'success' else 'fail' end as status, {_CENTS.format('l_extendedprice')} as amount,
    l_shipdate as created from lineitem),
  raw_customers as (select c_custkey as id, split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name
    from customer)"""


# --- shop: models ----------------------------------------------------------------------------------------


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        c("id").alias("order_id"),
        c("user_id").alias("customer_id"),
        "order_date",
        "status",
        F.when(~c("status").isin("P", "returned", "return_pending"), c("order_date")).alias("valid_order_date"),
    )


def stg_payments(payments: DataFrame) -> DataFrame:
    """Payments with whole cents kept next to the dollar amount, so that totals stay exact."""
    return payments.select(
        "id",
        c("orderid").alias("order_id"),
        c("paymentmethod").alias("payment_method"),
        "status",
        c("amount").alias("cents"),
        numbers.cents_to_dollars(c("amount"), 4).alias("amount"),
        "created",
    )


def stg_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        c("id").alias("customer_id"),
        "first_name",
        "last_name",
        text.full_name(c("first_name"), c("last_name")).alias("full_name"),
    )


def fct_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with the amount of their successful payments, 0 without any."""
    paid = F.sum(F.when(c("status") == "success", c("cents")))
    per_order = payments.groupBy("order_id").agg(paid.alias("cents"))
    return orders.select("order_id", "customer_id", "order_date").join(per_order, "order_id", "left").select(
        "order_id", "customer_id", "order_date", F.coalesce("cents", F.lit(0)).alias("cents")
    )


def dim_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with first and last order, order count and lifetime value."""
    per_customer = orders.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("most_recent_order_date"),
        F.count("order_id").alias("number_of_orders"),
        (F.sum("cents") / F.lit(100.0)).alias("lifetime_value"),
    )
    return customers.select("customer_id", "first_name", "last_name").join(per_customer, "customer_id", "left").select(
        "customer_id",
        "first_name",
        "last_name",
        "first_order_date",
        "most_recent_order_date",
        F.coalesce("number_of_orders", F.lit(0)).alias("number_of_orders"),
        "lifetime_value",
    )


def int_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with the total and last date of their payments that did not fail."""
    done = payments.where("status <> 'fail'").groupBy("order_id").agg(
        F.max("created").alias("payment_finalized_date"), F.sum("cents").alias("paid_cents")
    )
    return orders.select(
        "order_id", "customer_id", c("order_date").alias("order_placed_at"), c("status").alias("order_status")
    ).join(done, "order_id", "left")


def _bare(orders: DataFrame) -> DataFrame:
    """Orders as far as they tell which customers have very many of them."""
    return orders.select("customer_id", "order_id", c("order_date").alias("order_placed_at"))


def numbered_orders(paid: DataFrame, orders: DataFrame, hot, hot_rows: int = windows.HOT_ROWS) -> DataFrame:
    """Orders numbered overall and per customer. ``hot`` are the customers with very many orders, or None."""
    who = _bare(orders)
    made = windows.with_window(paid, ["order_id"], key_source=who, transaction_seq=windows.row_number())
    number = {"customer_sales_seq": windows.row_number()}
    return windows.with_window(made, ["order_id"], ["customer_id"], hot=hot, hot_rows=hot_rows, key_source=who, **number)


def _names(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", c("first_name").alias("customer_first_name"), c("last_name").alias("customer_last_name")
    )


def fct_customer_orders(
    paid: DataFrame, customers: DataFrame, orders: DataFrame, hot_rows: int = windows.HOT_ROWS, hot="find"
) -> DataFrame:
    """Orders with their sequences, new or returning buyer, running customer value and first day of sale.

    ``orders`` are the bare orders behind ``paid``, looked at to find customers with very many of them; ``hot`` takes
    these customers if they are known. ``paid`` may be numbered already.
    """
    who = _bare(orders)
    hot = windows.hot_keys(who, ["customer_id"], hot_rows) if hot == "find" else hot
    made = paid if "customer_sales_seq" in paid.columns else numbered_orders(paid, orders, hot, hot_rows)
    by_customer = {"hot": hot, "hot_rows": hot_rows, "key_source": who}
    # Sorted by day and order id here, the rows are in order for the sums by day below as well.
    made = windows.with_window(made, ["order_placed_at", "order_id"], ["customer_id"], **by_customer, place=windows.rank())
    made = windows.with_window(
        made,
        ["order_placed_at"],
        ["customer_id"],
        **by_customer,
        running_cents=windows.running_sum("paid_cents"),
        fdos=windows.first_value("order_placed_at"),
    )
    return _customer_orders(made.join(_names(customers), "customer_id", "left"), c("place") == 1)


def legacy_customer_orders(
    paid: DataFrame, customers: DataFrame, orders: DataFrame, hot_rows: int = windows.HOT_ROWS, hot="find"
) -> DataFrame:
    """The older form: every order on the first day is new, and the running value goes by order id."""
    who = _bare(orders)
    hot = windows.hot_keys(who, ["customer_id"], hot_rows) if hot == "find" else hot
    made = paid if "customer_sales_seq" in paid.columns else numbered_orders(paid, orders, hot, hot_rows)
    running = {"running_cents": windows.running_sum("paid_cents")}
    made = windows.with_window(made, ["order_id"], ["customer_id"], hot=hot, hot_rows=hot_rows, key_source=who, **running)
    first = who.groupBy("customer_id").agg(F.min("order_placed_at").alias("fdos"))
    whole = made.join(_names(customers), "customer_id", "left").join(first, "customer_id", "left")
    return _customer_orders(whole, c("fdos") == c("order_placed_at"))


def _customer_orders(made: DataFrame, is_new: Column) -> DataFrame:
    return made.select(
        "order_id",
        "customer_id",
        "order_placed_at",
        "order_status",
        (c("paid_cents") / F.lit(100.0)).alias("total_amount_paid"),
        "payment_finalized_date",
        "customer_first_name",
        "customer_last_name",
        "transaction_seq",
        "customer_sales_seq",
        F.when(is_new, "new").otherwise("return").alias("nvsr"),
        (c("running_cents") / F.lit(100.0)).alias("customer_lifetime_value"),
        "fdos",
    )


_STG_PAY = "stg_payments as (select orderid as order_id, paymentmethod as payment_method, status, amount as cents, created from raw_payments)"
_FCT = f"""{_RAW}, {_STG_PAY},
  fct as (select o.id as order_id, o.user_id as customer_id, o.order_date, coalesce(p.cents, 0) as cents from raw_orders o left join
    (select order_id, sum(case when status = 'success' then cents end) as cents from stg_payments group by 1) p on p.order_id = o.id)"""


@query("m1_stg_orders", f"with {_RAW} select id as order_id, user_id as customer_id, order_date, status, case when status <> 'P' then order_date end as valid_order_date from raw_orders")
def _(t):
    return stg_orders(raw_orders(t))


@query(
    "m1_stg_payments",
    f"""with {_RAW} select id, orderid as order_id, paymentmethod as payment_method, status, amount as cents,
        round(amount / 100.0::double, 4) as amount, created from raw_payments""",
)
def _(t):
    return stg_payments(raw_payments(t))


@query("m1_stg_customers", f"with {_RAW} select id as customer_id, first_name, last_name, first_name || ' ' || last_name as full_name from raw_customers")
def _(t):
    return stg_customers(raw_customers(t))


@query("m2_fct_orders", f"with {_FCT} select order_id, customer_id, order_date, cast(cents as bigint) as cents from fct")
def _(t):
    return fct_orders(stg_orders(raw_orders(t)), stg_payments(raw_payments(t)))


@query(
    "m2_dim_customers",
    f"""with {_FCT} select k.id as customer_id, first_name, last_name, min(order_date) as first_order_date,
        max(order_date) as most_recent_order_date, count(order_id) as number_of_orders,
        cast(sum(cents) as bigint) / 100.0::double as lifetime_value
        from raw_customers k left join fct on fct.customer_id = k.id group by 1, 2, 3""",
)
def _(t):
    orders = fct_orders(stg_orders(raw_orders(t)), stg_payments(raw_payments(t)))
    return dim_customers(stg_customers(raw_customers(t)), orders)


_PAID = f"""{_RAW}, paid as (select o.id as order_id, o.user_id as customer_id, o.order_date as order_placed_at, o.status as order_status,
    p.paid_cents, p.payment_finalized_date from raw_orders o left join (select orderid, max(created) as payment_finalized_date,
    sum(amount) as paid_cents from raw_payments where status <> 'fail' group by 1) p on p.orderid = o.id)"""
_M3 = f"""with {_PAID} select order_id, customer_id, order_placed_at, order_status, cast(paid_cents as bigint) / 100.0::double as total_amount_paid,
    payment_finalized_date, k.first_name as customer_first_name, k.last_name as customer_last_name,
    row_number() over (order by order_id) as transaction_seq,
    row_number() over (partition by customer_id order by order_id) as customer_sales_seq,
    case when rank() over (partition by customer_id order by order_placed_at, order_id) = 1 then 'new' else 'return' end as nvsr,
    cast(sum(paid_cents) over (partition by customer_id order by order_placed_at) as bigint) / 100.0::double as customer_lifetime_value,
    first_value(order_placed_at) over (partition by customer_id order by order_placed_at) as fdos
    from paid left join raw_customers k on k.id = customer_id"""
_M4 = f"""with {_PAID}, told as (select *, row_number() over (order by order_id) as nth, row_number() over mine as nth_own,
      min(order_placed_at) over (partition by customer_id) as first_day, sum(paid_cents) over (mine rows unbounded preceding) as spent
    from paid window mine as (partition by customer_id order by order_id))
    select told.* exclude (nth, nth_own, first_day, spent, paid_cents), nth as transaction_seq, nth_own as customer_sales_seq, first_day as fdos,
      first_name as customer_first_name, last_name as customer_last_name, if(order_placed_at > first_day, 'return', 'new') as nvsr,
      cast(paid_cents as bigint) / 100.0::double as total_amount_paid, cast(spent as bigint) / 100.0::double as customer_lifetime_value
    from told left join raw_customers on raw_customers.id = told.customer_id"""
#: The columns of both forms, in one order, for comparing them.
_M_COLUMNS = """order_id, customer_id, order_placed_at, order_status, total_amount_paid, payment_finalized_date, customer_first_name,
    customer_last_name, transaction_seq, customer_sales_seq, nvsr, customer_lifetime_value, fdos"""


def _paid_orders(t) -> DataFrame:
    return int_orders(stg_orders(raw_orders(t)), stg_payments(raw_payments(t)))


@query("m3_fct_customer_orders", _M3)
def _(t):
    return fct_customer_orders(_paid_orders(t), stg_customers(raw_customers(t)), stg_orders(raw_orders(t)))


@query("m4_legacy_customer_orders", _M4)
def _(t):
    return legacy_customer_orders(_paid_orders(t), stg_customers(raw_customers(t)), stg_orders(raw_orders(t)))


@query(
    "m4_old_vs_new_audit",
    f"""with a as (select {_M_COLUMNS} from ({_M4})), b as (select {_M_COLUMNS} from ({_M3})), r as (select true as in_a, true as in_b from (select * from a intersect select * from b)
      union all select true, false from (select * from a except select * from b)
      union all select false, true from (select * from b except select * from a))
    select in_a, in_b, count(*) as "count", round(100.0::double * count(*) / sum(count(*)) over (), 2) as percent_of_total from r group by 1, 2""",
)
def _(t):
    orders, customers = stg_orders(raw_orders(t)), stg_customers(raw_customers(t))
    hot = windows.hot_keys(_bare(orders), ["customer_id"])
    # Both forms start from the same numbered orders, which are worked out once.
    numbered = landed(numbered_orders(_paid_orders(t), orders, hot), "numbered")
    forms = [form(numbered, customers, orders, hot=hot) for form in (legacy_customer_orders, fct_customer_orders)]
    return audit.compare_relations(*forms)


@query(
    "m4_payments_pivoted",
    "with " + _RAW + " select orderid as order_id, " + ", ".join(
        f"cast(sum(case when paymentmethod = '{m}' then amount else 0 end) as bigint) as {m}_amount" for m in "ANR"
    ) + " from raw_payments group by 1",
)
def _(t):
    cells = reshape.pivot_columns("payment_method", ["A", "N", "R"], suffix="_amount", then_value="cents")
    return stg_payments(raw_payments(t)).groupBy("order_id").agg(*cells)


@query("m5_total_revenue", f"with {_RAW} select cast(sum(amount) as bigint) / 100.0::double as total_revenue from raw_payments where status = 'success'")
def _(t):
    paid = stg_payments(raw_payments(t)).where("status = 'success'")
    return paid.agg((F.sum("cents") / F.lit(100.0)).alias("total_revenue"))


# --- run KPIs --------------------------------------------------------------------------------------------

_STATUS = {"purchase": "success", "signup": "Completed", "click": "SUCCEEDED", "error": "failed", "view": "running"}


def raw_runs(t) -> DataFrame:
    """Events as runs with times as text: views are still running, and signups have a broken start."""
    status = F.create_map(*[F.lit(x) for pair in _STATUS.items() for x in pair])[c("event_type")]
    fmt = "yyyy-MM-dd HH:mm:ss"
    done = dates.dateadd("second", F.round(c("value") * 60).cast("int"), c("ts"))
    return t.events.select(
        c("event_id").alias("id"),
        c("user_id").alias("parent_id"),
        status.alias("status"),
        F.when(c("event_type") == "signup", "unknown").otherwise(F.date_format("ts", fmt)).alias("started_at"),
        F.when(c("event_type") != "view", F.date_format(done, fmt)).alias("completed_at"),
        F.date_format("ts", fmt).alias("updated_at"),
    )


_RUNS = """runs as (select cast(event_id as varchar) as run_id, case event_type when 'purchase' then 'success' when 'signup' then 'Completed'
    when 'click' then 'SUCCEEDED' when 'error' then 'failed' else 'running' end as status,
    case when event_type <> 'signup' then date_trunc('second', ts) end as started_at,
    case when event_type <> 'view' then date_trunc('second', ts + to_seconds(cast(round(value * 60) as bigint))) end as completed_at,
    date_trunc('second', ts) as updated_at from events),
  stg as (select *, date_diff('second', started_at, completed_at) as duration_seconds,
    cast(coalesce(started_at, completed_at, updated_at) as date) as run_date from runs)"""


def stg_runs(raw: DataFrame, key: str = "run_id") -> DataFrame:
    """Typed runs: times that do not parse are null; the run date is the first time there is."""
    times = ["started_at", "completed_at", "updated_at"]
    typed = raw.select(
        c("id").cast("string").alias(key), "status", *[dates.parse_timestamp(c(x)).alias(x) for x in times]
    )
    return typed.select(
        "*",
        dates.datediff(c("started_at"), c("completed_at"), "second").alias("duration_seconds"),
        dates.day_of(F.coalesce(*times)).alias("run_date"),
    )


def daily_statuses(runs: DataFrame) -> DataFrame:
    return runs.groupBy("run_date", "status").agg(F.count("*").alias("run_count"))


def daily_kpis(runs: DataFrame) -> DataFrame:
    """Counts by outcome, success rate and duration figures per day, in one aggregation."""
    state, d = F.lower("status"), c("duration_seconds")
    timed = F.when(d >= 0, d)
    made = runs.groupBy("run_date").agg(
        F.count("*").alias("num_total"),
        F.sum(F.when(state.isin("success", "succeeded", "completed"), 1).otherwise(0)).alias("num_success"),
        F.sum(F.when(state.isin("failed", "error"), 1).otherwise(0)).alias("num_failed"),
        F.count(timed).alias("n"),
        F.sum(timed).alias("s"),
        F.min(timed).alias("min_duration_seconds"),
        F.max(timed).alias("max_duration_seconds"),
        F.percentile_approx(timed, [0.5, 0.9], 10_000).alias("p"),
    )
    return made.select(
        "run_date",
        "num_total",
        "num_success",
        "num_failed",
        numbers.ratio(c("num_success"), c("num_total")).alias("success_rate"),
        F.nullif("n", F.lit(0)).alias("num_with_duration"),
        (c("s").cast("double") / F.nullif("n", F.lit(0))).alias("avg_duration_seconds"),
        "min_duration_seconds",
        "max_duration_seconds",
        c("p")[0].alias("p50_duration_seconds"),
        c("p")[1].alias("p90_duration_seconds"),
    )


def daily_row_counts(counts: DataFrame) -> DataFrame:
    """Largest row count per extraction day and table."""
    return counts.groupBy(dates.day_of(c("extracted_at")).alias("run_date"), "table_name").agg(
        F.max("row_count").alias("row_count")
    )


def kpi_dashboard(
    kpis: DataFrame, statuses: DataFrame, row_counts: DataFrame, repeat_tasks: bool = False
) -> DataFrame:
    """Daily KPIs with task totals and table sizes; each side is reduced to one row per day before the join.

    Joining the status rows and the size rows of a day directly counts its tasks once per size row.
    ``repeat_tasks`` gives that figure, for comparison with dashboards built so.
    """
    tasks = statuses.groupBy("run_date").agg(
        F.sum(F.when(c("status").isNotNull(), c("run_count")).otherwise(0)).alias("task_runs_total")
    )
    sizes = row_counts.groupBy("run_date").agg(
        F.max(F.when(c("table_name") == "task_runs", c("row_count"))).alias("task_runs_rows"),
        F.max(F.when(c("table_name") == "job_runs", c("row_count"))).alias("job_runs_rows"),
        F.count("*").alias("__sizes"),
    )
    head = kpis.select(
        "run_date",
        c("num_total").alias("runs_total"),
        c("num_success").alias("runs_success"),
        c("num_failed").alias("runs_failed"),
        "success_rate",
        "avg_duration_seconds",
        "p50_duration_seconds",
        "p90_duration_seconds",
    )
    joined = head.join(tasks, "run_date", "left").join(sizes, "run_date", "left")
    total = F.coalesce("task_runs_total", F.lit(0))
    if repeat_tasks:
        total = total * F.coalesce("__sizes", F.lit(1))
    return joined.withColumn("task_runs_total", total).drop("__sizes")


@query("m6_stg_runs", f"with {_RUNS} select * from stg")
def _(t):
    return stg_runs(raw_runs(t))


@query("m6_daily_statuses", f"with {_RUNS} select run_date, status, count(*) as run_count from stg group by 1, 2")
def _(t):
    return daily_statuses(stg_runs(raw_runs(t)))


_KPIS = f"""{_RUNS}, kpis as (select run_date, count(*) as num_total,
    cast(sum(case when lower(status) in ('success', 'succeeded', 'completed') then 1 else 0 end) as bigint) as num_success,
    cast(sum(case when lower(status) in ('failed', 'error') then 1 else 0 end) as bigint) as num_failed,
    cast(sum(case when lower(status) in ('success', 'succeeded', 'completed') then 1 else 0 end) as double) / count(*) as success_rate,
    nullif(count(duration_seconds), 0) as num_with_duration, cast(sum(duration_seconds) as double) / nullif(count(duration_seconds), 0)
    as avg_duration_seconds, min(duration_seconds) as min_duration_seconds, max(duration_seconds) as max_duration_seconds,
    quantile_disc(duration_seconds, 0.5) as p50_duration_seconds, quantile_disc(duration_seconds, 0.9) as p90_duration_seconds
    from stg group by 1)"""


@query("m6_daily_kpis", f"with {_KPIS} select * from kpis")
def _(t):
    return daily_kpis(stg_runs(raw_runs(t)))


_COUNTS = """counts as (select cast(ts as date) as run_date, 'task_runs' as table_name, count(*) as row_count from events group by 1
    union all select cast(ts as date), 'job_runs', count(distinct user_id) from events group by 1)"""


def _extracts(t) -> DataFrame:
    """Row counts as daily extracts would log them."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("extracted_at")
    a = t.events.groupBy(day).agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit("task_runs"))
    b = t.events.groupBy(day).agg(F.count_distinct("user_id").alias("row_count")).withColumn("table_name", F.lit("job_runs"))
    return a.unionByName(b)


@query("m6_daily_row_counts", f"with {_COUNTS} select * from counts")
def _(t):
    return daily_row_counts(_extracts(t))


@query(
    "m6_kpi_dashboard",
    f"""with {_KPIS}, {_COUNTS}, tasks as (select run_date, count(*) as task_runs_total from stg group by 1),
    sizes as (select run_date, max(case when table_name = 'task_runs' then row_count end) as task_runs_rows,
      max(case when table_name = 'job_runs' then row_count end) as job_runs_rows from counts group by 1)
    select run_date, num_total as runs_total, num_success as runs_success, num_failed as runs_failed, success_rate,
      avg_duration_seconds, p50_duration_seconds, p90_duration_seconds, coalesce(task_runs_total, 0) as task_runs_total,
      task_runs_rows, job_runs_rows from kpis left join tasks using (run_date) left join sizes using (run_date)""",
)
def _(t):
    runs = stg_runs(raw_runs(t))
    return kpi_dashboard(daily_kpis(runs), daily_statuses(stg_runs(raw_runs(t), "task_run_id")), daily_row_counts(_extracts(t)))


@query(
    "m6_kpi_dashboard_repeated_tasks",
    f"""with {_KPIS}, {_COUNTS}, per_day as (select run_date, count(*) as n from stg group by run_date),
    logged as (pivot counts on table_name in ('task_runs', 'job_runs') using max(row_count) group by run_date),
    copies as (select run_date, count(*) as times from counts group by run_date)
    select run_date, num_total as runs_total, num_success as runs_success, num_failed as runs_failed, success_rate, avg_duration_seconds,
      p50_duration_seconds, p90_duration_seconds, coalesce(n, 0) * coalesce(times, 1) as task_runs_total, task_runs as task_runs_rows,
      job_runs as job_runs_rows
    from kpis left join per_day using (run_date) left join copies using (run_date) left join logged using (run_date)""",
)
def _(t):
    runs = stg_runs(raw_runs(t))
    return kpi_dashboard(daily_kpis(runs), daily_statuses(runs), daily_row_counts(_extracts(t)), repeat_tasks=True)


# --- event analytics -------------------------------------------------------------------------------------


def raw_events(t) -> DataFrame:
    return t.events.select(
        F.when(c("value") < 99, c("event_type")).alias("event_name"),
        c("ts").alias("time"),
        c("user_id").cast("string").alias("name"),
        c("event_id").alias("number"),
    )


def events_clean(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        c("event_name").cast("string").alias("event_name"),
        c("time").cast("timestamp_ntz").alias("event_ts"),
        c("name").cast("string").alias("user_name"),
        c("number").cast("bigint").alias("event_value"),
    )
    return typed.where(c("event_name").isNotNull() & c("event_ts").isNotNull())


def events_per_day(events: DataFrame) -> DataFrame:
    return events.groupBy(dates.day_of(c("event_ts")).alias("event_date")).agg(
        F.count("*").alias("total_events"),
        F.count_distinct("user_name").alias("unique_users"),
        F.sum("event_value").alias("total_value"),
    )


def logins_per_day(events: DataFrame, login: str = "login") -> DataFrame:
    return events.groupBy(dates.day_of(c("event_ts")).alias("event_date")).agg(
        F.count_if(F.lower("event_name") == login).alias("login_events")
    )


def events_overview(per_day: DataFrame, logins: DataFrame) -> DataFrame:
    return per_day.join(logins, "event_date", "full")


_EVENTS = "clean as (select event_type as event_name, ts as event_ts, cast(user_id as varchar) as user_name, event_id as event_value from events where value < 99)"
_PER_DAY = "select cast(event_ts as date) as event_date, count(*) as total_events, count(distinct user_name) as unique_users, cast(sum(event_value) as bigint) as total_value from clean group by 1"
_LOGINS = "select cast(event_ts as date) as event_date, count(*) filter (where lower(event_name) = 'signup') as login_events from clean group by 1"


@query("m7_events_clean", f"with {_EVENTS} select * from clean")
def _(t):
    return events_clean(raw_events(t))


@query("m7_events_per_day", f"with {_EVENTS} {_PER_DAY}")
def _(t):
    return events_per_day(events_clean(raw_events(t)))


@query("m7_logins_per_day", f"with {_EVENTS} {_LOGINS}")
def _(t):
    return logins_per_day(events_clean(raw_events(t)), "signup")


@query("m7_overview", f"with {_EVENTS}, e as ({_PER_DAY}), l as ({_LOGINS}) select coalesce(e.event_date, l.event_date) as event_date, total_events, unique_users, total_value, login_events from e full join l on e.event_date = l.event_date")
def _(t):
    events = events_clean(raw_events(t))
    return events_overview(events_per_day(events), logins_per_day(events, "signup"))


# --- catalog orders --------------------------------------------------------------------------------------


def raw_catalog_sales(t) -> DataFrame:
    """Order lines with day numbers in place of dates; open lines have no ship date, one supplier is unknown."""
    bills = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    rows = t.lineitem.join(bills, c("l_orderkey") == c("o_orderkey"), "inner")
    return rows.select(
        dates.date_to_julian(dates.day_of(c("o_orderdate"))).alias("sold_date_sk"),
        F.when(c("l_linestatus") == "F", dates.date_to_julian(dates.day_of(c("l_shipdate")))).alias("ship_date_sk"),
        c("o_custkey").alias("bill_customer_sk"),
        F.nullif("l_suppkey", F.lit(3)).alias("ship_customer_sk"),
        c("l_partkey").alias("item_sk"),
        c("l_orderkey").alias("order_number"),
        c("l_quantity").cast("bigint").alias("quantity"),
        numbers.to_cents(c("l_extendedprice")).alias("cost"),
    )


def catalog_orders_clean(sales: DataFrame) -> DataFrame:
    return sales.select(
        dates.julian_to_date(c("sold_date_sk")).alias("sold_date"),
        dates.julian_to_date(c("ship_date_sk")).alias("ship_date"),
        c("bill_customer_sk").alias("bill_customer_sk_id"),
        c("ship_customer_sk").alias("ship_customer_sk_id"),
        c("item_sk").alias("item_sk_id"),
        "order_number",
        "quantity",
        "cost",
        keys.sha256_key(c("order_number")).alias("_pk"),
    )


def catalog_customers_clean(customers: DataFrame) -> DataFrame:
    return customers.select(
        c("customer_id").alias("customer_sk_id"), "first_name", "last_name", keys.sha256_key(c("customer_id")).alias("_pk")
    )


def catalog_orders_staging(orders: DataFrame, customers: DataFrame) -> DataFrame:
    who = customers.select("customer_sk_id", "first_name", "last_name")
    joined = orders.where(c("ship_date").isNotNull()).join(
        who, c("bill_customer_sk_id") == c("customer_sk_id"), "left"
    )
    return joined.drop("customer_sk_id")


def catalog_orders_summary(staged: DataFrame) -> DataFrame:
    """Orders, quantity and cost per billing customer, receiver and ship date, with a key.

    Whole numbers make the groups that their texts make, and leave the rows in the partitions of the join on them; texts
    would be shuffled twice more.
    """

    def group(name: str) -> Column:
        whole = isinstance(staged.schema[name].dataType, T.IntegralType)
        return c(name) if whole else text.text_or(c(name)).alias(name)

    ids = ["bill_customer_sk_id", "ship_customer_sk_id"]
    made = staged.groupBy("first_name", "last_name", *[group(i) for i in ids], "ship_date").agg(
        F.count_distinct("order_number").alias("orders"), F.sum("quantity").alias("quantity"), F.sum("cost").alias("cost")
    )
    return made.withColumns({i: text.text_or(c(i)) for i in ids}).withColumn(
        "_pk", keys.sha256_key(c("bill_customer_sk_id"), c("ship_customer_sk_id"), text.text_or(c("ship_date")))
    )


CATALOG_SQL = f"""clean as (select cast(o_orderdate as date) as sold_date, case when l_linestatus = 'F' then cast(l_shipdate as date) end as ship_date,
    o_custkey as bill, nullif(l_suppkey, 3) as ship, l_partkey as item, l_orderkey as order_number, cast(l_quantity as bigint) as quantity,
    {_CENTS.format('l_extendedprice')} as cost from lineitem join orders on o_orderkey = l_orderkey),
  summary as (select split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name,
    coalesce(cast(bill as varchar), 'None') as bill_customer_sk_id, coalesce(cast(ship as varchar), 'None') as ship_customer_sk_id,
    ship_date, count(distinct order_number) as orders, cast(sum(quantity) as bigint) as quantity, cast(sum(cost) as bigint) as cost,
    sha256(coalesce(cast(bill as varchar), 'None') || coalesce(cast(ship as varchar), 'None') || coalesce(cast(ship_date as varchar), 'None')) as _pk
    from clean left join customer on c_custkey = bill where ship_date is not null group by 1, 2, bill, ship, ship_date)"""


@query("m8_catalog_clean", f"with {CATALOG_SQL} select sold_date, ship_date, bill as bill_customer_sk_id, ship as ship_customer_sk_id, item as item_sk_id, order_number, quantity, cost, sha256(cast(order_number as varchar)) as _pk from clean")
def _(t):
    return catalog_orders_clean(raw_catalog_sales(t))


@query(
    "m8_catalog_staging",
    f"""with {CATALOG_SQL} select sold_date, ship_date, bill as bill_customer_sk_id, ship as ship_customer_sk_id, item as item_sk_id, order_number,
        quantity, cost, sha256(cast(order_number as varchar)) as _pk, split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name
        from clean left join customer on c_custkey = bill where ship_date is not null""",
)
def _(t):
    customers = catalog_customers_clean(stg_customers(raw_customers(t)))
    return catalog_orders_staging(catalog_orders_clean(raw_catalog_sales(t)), customers)


def catalog_summary(t) -> DataFrame:
    customers = catalog_customers_clean(stg_customers(raw_customers(t)))
    return catalog_orders_summary(catalog_orders_staging(catalog_orders_clean(raw_catalog_sales(t)), customers))


@query("m8_catalog_summary", f"with {CATALOG_SQL} select * from summary")
def _(t):
    return catalog_summary(t)


# --- daily customer orders and order products ------------------------------------------------------------


def customers_orders_daily(orders: DataFrame, customers: DataFrame, calendar: DataFrame) -> DataFrame:
    """Calendar days with the orders of each customer; days without orders keep nulls, also in the key.

    Orders are counted per customer and day first; names are looked up for the much smaller result.
    """
    per_day = orders.groupBy("customer_id", "order_date").agg(
        F.count_distinct("order_id").alias("orders"), F.sum("cents").alias("cents")
    )
    named = per_day.join(customers.select("customer_id", "first_name", "last_name"), "customer_id", "left")
    made = joins.calendar_left(calendar, named, "day", "order_date")
    return made.withColumn("_pk", keys.sha256_key(c("day"), c("customer_id")))


@query(
    "m9_customers_orders_daily",
    f"""with cal as (select cast(d as date) as day from (select unnest(generate_series(cast(min(o_orderdate) as date) - 3,
        cast(max(o_orderdate) as date) + 3, interval 1 day)) as d from orders)),
    o as (select o_custkey as customer_id, split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name,
      cast(o_orderdate as date) as order_date, count(distinct o_orderkey) as orders, cast(sum({_CENTS.format('o_totalprice')}) as bigint) as cents
      from orders left join customer on c_custkey = o_custkey group by 1, 2, 3, 4)
    select day, o.*, sha256(cast(day as varchar) || cast(customer_id as varchar)) as _pk from cal left join o on day = order_date""",
)
def _(t):
    orders = t.orders.select(
        c("o_orderkey").alias("order_id"),
        c("o_custkey").alias("customer_id"),
        dates.day_of(c("o_orderdate")).alias("order_date"),
        numbers.to_cents(c("o_totalprice")).alias("cents"),
    )
    calendar = reshape.calendar(t.orders, "o_orderdate", before=3, after=3)
    return customers_orders_daily(orders, stg_customers(raw_customers(t)), calendar)


def orders_with_products(orders: DataFrame, products: DataFrame) -> DataFrame:
    keyed = products.withColumn("_pk", keys.sha256_key(c("order_id"), c("product_id")))
    return orders.join(keyed, "order_id", "left")


@query(
    "m9_orders_with_products",
    f"""select o_orderkey as order_id, o_custkey as customer_id, o_orderstatus as order_status, l_partkey as product_id,
        l_quantity as quantity, {_CENTS.format('l_extendedprice')} as total_cents, sha256(cast(l_orderkey as varchar) || cast(l_partkey as varchar)) as _pk
        from orders left join lineitem on l_orderkey = o_orderkey""",
)
def _(t):
    orders = t.orders.select(
        c("o_orderkey").alias("order_id"), c("o_custkey").alias("customer_id"), c("o_orderstatus").alias("order_status")
    )
    products = t.lineitem.select(
        c("l_orderkey").alias("order_id"),
        c("l_partkey").alias("product_id"),
        c("l_quantity").alias("quantity"),
        numbers.to_cents(c("l_extendedprice")).alias("total_cents"),
    )
    return orders_with_products(orders, products)


# --- store sales, readings, trips ------------------------------------------------------------------------


def store_sales(sales: DataFrame, bad_date: str = "05-Nov-2040") -> DataFrame:
    """Sales per store and day; rows with the placeholder date lose their store."""
    store = F.when(c("date") != bad_date, c("store"))
    return sales.select(store.alias("store"), "date", "sales").groupBy("store", "date").agg(F.sum("sales").alias("sales"))


@query(
    "m10_store_sales",
    f"""select case when strftime(o_orderdate, '%d-%b-%Y') = '05-Nov-1998' then null else o_orderpriority end as store,
        strftime(o_orderdate, '%d-%b-%Y') as date, cast(sum({_CENTS.format('o_totalprice')}) as bigint) as sales from orders group by 1, 2""",
)
def _(t):
    sales = t.orders.select(
        c("o_orderpriority").alias("store"),
        F.date_format("o_orderdate", "dd-MMM-yyyy").alias("date"),
        numbers.to_cents(c("o_totalprice")).alias("sales"),
    )
    return store_sales(sales, "05-Nov-1998")


def raw_readings(t) -> DataFrame:
    stamp = F.when(c("value") > 99, "late").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.events.select(
        c("event_type").alias("site_name"), c("user_id").alias("owner"), stamp.alias("timestamp"), c("value").alias("measurement")
    )


def readings_clean(readings: DataFrame) -> DataFrame:
    keyed = readings.withColumn("_pk", keys.sha256_key(c("timestamp"), c("site_name")))
    return reshape.add_constants(
        keyed,
        _test_column="test_column",
        broken_column="additional_column",
        _third_column="third column",
        _fourth_column="fourth column",
    )


def readings_aggregated(clean: DataFrame) -> DataFrame:
    return clean.select(
        "site_name", "owner", dates.parse_timestamp(c("timestamp")).alias("timestamp"), "measurement", "_fourth_column", "_pk"
    )


@query(
    "m11_readings",
    """with r as (select event_type as site_name, user_id as owner, case when value > 99 then 'late' else strftime(ts, '%Y-%m-%d %H:%M:%S') end
      as stamp, value as measurement from events)
    select site_name, owner, try_cast(stamp as timestamp) as "timestamp", measurement, 'fourth column' as _fourth_column,
      sha256(stamp || site_name) as _pk from r""",
)
def _(t):
    return readings_aggregated(readings_clean(raw_readings(t)))


TRIP_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate"]


def trips_and_zones(spark, path: str, zones: DataFrame, columns: Sequence[str], start: str, stop: str) -> DataFrame:
    trips = scan(spark, path, columns, half_open("l_shipdate", start, stop))
    return trips.join(zones.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey", "left")


def trips_between(trips: DataFrame, miles: str, low: float, high: float, since: Column) -> DataFrame:
    kept = trips.where((c("l_shipdate") >= since) & (c(miles) > low) & (c(miles) < high))
    return kept.withColumn("log_trip_miles", F.round(F.log10(miles), 9))


_TRIPS = """trips as (select l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate, p_name, p_size from lineitem
    left join part on p_partkey = l_partkey where l_shipdate >= timestamp '1995-01-01 05:00:00' and l_shipdate < timestamp '2003-01-01 05:00:00')"""


def _trips(t) -> DataFrame:
    zones = t.part.select("p_partkey", "p_name", "p_size")
    return trips_and_zones(
        t.spark, t.path("lineitem"), zones, TRIP_COLUMNS, "1995-01-01T00:00:00-05:00", "2003-01-01T00:00:00-05:00"
    )


@query("m12_trips_and_zones", f"with {_TRIPS} select * from trips")
def _(t):
    return _trips(t)


def _since() -> Column:
    return F.lit("1997-01-01").cast("timestamp_ntz")


@query("m12_normalized_trips", f"with {_TRIPS} select *, round(log10(l_quantity), 9) as log_trip_miles from trips where l_shipdate >= timestamp '1997-01-01' and l_quantity > 0 and l_quantity < 30")
def _(t):
    return trips_between(_trips(t), "l_quantity", 0.0, 30.0, _since())


_STAGED = f"with {_TRIPS} select *, round(log10(l_quantity), 9) as log_trip_miles from trips where l_shipdate >= timestamp '1997-01-01' and l_quantity > 1 and l_quantity < 45"


@query("m12_trip_staging", _STAGED)
def _(t):
    return trips_between(_trips(t), "l_quantity", 1.0, 45.0, _since())


# Four downstream tables pass the staged trips on as they are.
for _name in ("trips", "journeys", "fares", "profit_and_loss"):

    @query(f"m12_{_name}_passed_on", _STAGED)
    def _(t):
        return trips_between(_trips(t), "l_quantity", 1.0, 45.0, _since()).select("*")


# --- extract-time statistics and pass-through ------------------------------------------------------------


def extract_status_daily(runs: DataFrame) -> DataFrame:
    day = dates.day_of(F.coalesce("started_at", "completed_at", "updated_at")).alias("run_date")
    return runs.groupBy(day, "status").agg(F.count("*").alias("run_count"))


def extract_duration_stats(runs: DataFrame) -> DataFrame:
    both = runs.where(c("started_at").isNotNull() & c("completed_at").isNotNull())
    d = dates.datediff(c("started_at"), c("completed_at"), "second")
    made = both.groupBy(dates.day_of(c("started_at")).alias("run_date")).agg(
        F.count("*").alias("num_runs"),
        (F.sum(d).cast("double") / F.count("*")).alias("avg_duration_seconds"),
        F.min(d).alias("min_duration_seconds"),
        F.max(d).alias("max_duration_seconds"),
        F.percentile_approx(d, [0.5, 0.9], 10_000).alias("p"),
    )
    return made.select("*", c("p")[0].alias("p50"), c("p")[1].alias("p90")).drop("p")


@query("m14_status_daily", f"with {_RUNS} select run_date, status, count(*) as run_count from stg group by 1, 2")
def _(t):
    return extract_status_daily(stg_runs(raw_runs(t)))


@query(
    "m14_duration_stats",
    f"""with {_RUNS} select run_date, count(*) as num_runs, cast(sum(duration_seconds) as double) / count(*) as avg_duration_seconds,
        min(duration_seconds) as min_duration_seconds, max(duration_seconds) as max_duration_seconds,
        quantile_disc(duration_seconds, 0.5) as p50, quantile_disc(duration_seconds, 0.9) as p90
        from stg where started_at is not null and completed_at is not null group by 1""",
)
def _(t):
    return extract_duration_stats(stg_runs(raw_runs(t)))


@query("m15_pass_through", "select * from customer")
def _(t):
    return t.customer.select("*")


@query("m15_preview", "select *, sha256(cast(c_custkey as varchar)) as _pk from customer order by c_custkey limit 10")
def _(t):
    return t.customer.withColumn("_pk", keys.sha256_key(c("c_custkey"))).orderBy("c_custkey").limit(10)
