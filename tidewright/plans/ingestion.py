"""Normaliser queries. Landed JSON and grids are derived from the given tables and read back as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.functions import dates
from tidewright.plans.registry import query
from tidewright.session import scratch_path
from tidewright.sources import ingest
from tidewright.sources.load import KeyedTable, VersionedTable
from tidewright.sources.schemas import SchemaConflict

c = F.col


def text(col):
    return col.cast("string")


# --- CRM pages -------------------------------------------------------------------------------------------


def crm_pages(t) -> DataFrame:
    """Pages of at most 100 customers as JSON; some results carry no ``properties`` object."""
    props = F.struct(
        text(c("c_custkey")).alias("hs_object_id"),
        c("c_name").alias("name"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
    )
    result = F.when(
        c("c_nationkey") < 20, F.to_json(F.struct(F.concat(F.lit("c"), text(c("c_custkey"))).alias("id"), props.alias("properties")))
    ).otherwise(F.to_json(F.struct(F.concat(F.lit("c"), text(c("c_custkey"))).alias("id"), props["hs_object_id"].alias("hs_object_id"), props["name"].alias("name"))))
    page = F.floor(c("c_custkey") / 100).alias("page")
    return t.customer.groupBy(page).agg(F.collect_list(result).alias("results"))


def landed_pages(t) -> DataFrame:
    """The pages written as JSON files and read again."""
    path = scratch_path(t.spark, "crm")
    pages = crm_pages(t)
    whole = F.concat(F.lit('{"page":'), text(c("page")), F.lit(',"results":['), F.array_join("results", ","), F.lit("]}"))
    pages.select(whole.alias("value")).write.text(path)
    return t.spark.read.schema("page bigint, results array<string>").json(path)


_CRM = "select 'c' || c_custkey as id, cast(c_custkey as varchar) as hs_object_id, c_name as name, case when c_nationkey < 20 then nullif(c_mktsegment, 'BUILDING') end as segment from customer"


@query("i1_crm_flatten", _CRM)
def _(t):
    results = ingest.crm_results(landed_pages(t))
    return ingest.crm_table(results, ["hs_object_id", "name", "segment"])


@query("i14_crm_columns", f"select id, hs_object_id, name, segment from ({_CRM})")
def _(t):
    columns = ingest.crm_columns(["name", "hs_object_id"], ["hs_score", "segment", "name"])
    return ingest.crm_table(ingest.crm_results(crm_pages(t)), columns)


@query(
    "i2_association_links",
    """select distinct 'customers' as association, cast(o_orderkey as varchar) as value, cast(o_custkey as varchar) as linked_id from orders
       union select 'days', cast(o_orderkey as varchar), strftime(o_orderdate, '%Y-%m-%d') from orders where o_orderstatus <> 'P'""",
)
def _(t):
    def linked(col):
        return F.struct(F.array(F.struct(col.alias("id")), F.struct(col.alias("id"))).alias("results"))

    customers, days = linked(text(c("o_custkey"))), linked(F.date_format("o_orderdate", "yyyy-MM-dd"))
    assoc = F.struct(customers.alias("customers"), F.when(c("o_orderstatus") != "P", days).alias("days"))
    key = text(c("o_orderkey"))
    raw = F.to_json(F.struct(key.alias("id"), F.struct(key.alias("hs_object_id")).alias("properties"), assoc.alias("associations")))
    pages = t.orders.select(F.array(raw).alias("results"))
    return ingest.association_links(ingest.crm_results(pages))


@query(
    "i3_property_history",
    """with o as (select cast(o_orderkey as varchar) as object_id, strftime(o_orderdate, '%Y-%m-%d') as day, * from orders where o_orderpriority <> '5-LOW')
       select object_id, 'status' as property_name, o_orderstatus as value, day as "timestamp", 'CRM' as "sourceType", 's' || o_custkey as "sourceId",
         cast(null as varchar) as "sourceLabel", cast(o_custkey as varchar) as "updatedByUserId", 'r1' as request from o
       union all select object_id, 'status', 'new', '1990-01-01', 'IMPORT', null, 'old system', null, 'r1' from o
       union all select object_id, 'priority', o_orderpriority, day, 'CRM', 's' || o_custkey, null, cast(o_custkey as varchar), 'r1' from o""",
)
def _(t):
    none = F.lit(None).cast("string")

    def entry(value, at, source, source_id, label, user):
        return F.struct(
            value.alias("value"), at.alias("timestamp"), F.lit(source).alias("sourceType"), source_id.alias("sourceId"), label.alias("sourceLabel"),
            user.alias("updatedByUserId"), F.lit("r1").alias("requestId"),
        )

    day, who = F.date_format("o_orderdate", "yyyy-MM-dd"), text(c("o_custkey"))
    by_crm = F.concat(F.lit("s"), who), none, c("o_custkey")
    history = F.struct(
        F.array(
            entry(c("o_orderstatus"), day, "CRM", *by_crm),
            entry(F.lit("new"), F.lit("1990-01-01"), "IMPORT", none, F.lit("old system"), F.lit(None).cast("bigint")),
        ).alias("status"),
        F.array(entry(c("o_orderpriority"), day, "CRM", *by_crm)).alias("priority"),
        F.array().cast("array<struct<value:string>>").alias("owner"),
    )
    kept = F.when(c("o_orderpriority") != "5-LOW", history).alias("propertiesWithHistory")
    raw = F.to_json(F.struct(text(c("o_orderkey")).alias("id"), kept))
    found = ingest.property_history(t.orders.select(raw.alias("raw")))
    return found.select("*", c("more")["requestId"].alias("request")).drop("more")


# --- sheets ----------------------------------------------------------------------------------------------

_HEADER = '["key", "", "Ship Day", "Ship Time", "flag"]'


def serial(ts):
    """Days since the spreadsheet epoch, as a JSON number."""
    start = F.lit(dates.SHEET_EPOCH).cast("timestamp_ntz")
    return dates.datediff(start, ts, "second") / 86400


def sheet(t) -> DataFrame:
    """Events as sheet rows under a header; errors are short rows, views have an extra cell, high values are empty rows."""
    at = F.date_trunc("second", "ts").cast("timestamp_ntz")
    day, time = F.format_string("%d", F.floor(serial(at))), F.format_string("%.8f", serial(at))
    head = F.concat(F.lit("["), text(c("event_id")), F.lit(', "'), F.when(c("user_id") > 5, c("event_type")).otherwise(""), F.lit('", '), day)
    full = F.concat(head, F.lit(", "), time, F.lit(", "), F.when(c("value") > 50, "true").otherwise("false"))
    row = (
        F.when(c("value") > 99, "[]")
        .when(c("event_type") == "error", F.concat(head, F.lit("]")))
        .when(c("event_type") == "view", F.concat(full, F.lit(', "extra"]')))
        .otherwise(F.concat(full, F.lit("]")))
    )
    rows = t.events.select((c("event_id") + 1).alias("row_index"), row.alias("row_json"))
    header = t.spark.range(1).select(F.lit(0).cast("bigint").alias("row_index"), F.lit(_HEADER).alias("row_json"))
    return ingest.grid_cells(header.unionByName(rows))


def header_of(grid: DataFrame) -> tuple[list[str], bool]:
    cells = grid.where("row_index = 0").select(F.col("cells").cast("array<string>")).first()[0]
    return ingest.header_names(cells)


_SHEET = """select event_id as key, case when user_id > 5 then event_type end as col_2, cast(ts as date) as "Ship Day",
    case when event_type <> 'error' then date_trunc('second', ts) end as "Ship Time", case when event_type <> 'error' then
    value > 50 end as flag from events where value <= 99"""


@query("i4_sheet_rows", _SHEET)
def _(t):
    grid = sheet(t)
    names, has_header = header_of(grid)
    kinds = ingest.column_kinds([None, None, "DATE", "DATE_TIME", None], [1, "click", 45000, 45000.5, True])
    data = grid.where(c("row_index") > 0) if has_header else grid
    return ingest.typed_rows(data, names, kinds)


@query("i5_column_kinds", f'select "Ship Day" as day, "Ship Time" as time, count(*) as n from ({_SHEET}) group by all')
def _(t):
    kinds = ingest.column_kinds(["NUMBER", "TEXT", "DATE", "TIME", None])
    rows = ingest.typed_rows(sheet(t).where(c("row_index") > 0), ["key", "kind", "day", "time", "flag"], kinds)
    return rows.groupBy("day", "time").agg(F.count(F.lit(1)).alias("n"))


@query("i6_automatic_header", f"select cast(key as varchar) as col_1, col_2, cast(flag as varchar) as col_5 from ({_SHEET}) union all select '1', 'b', 'x'")
def _(t):
    names, has_header = ingest.header_names([1, "b", "c", "d", "x"])
    first = t.spark.range(1).select(F.lit(0).cast("bigint").alias("row_index"), F.lit('[1, "b", "c", "d", "x"]').alias("row_json"))
    grid = sheet(t).where("row_index > 0").unionByName(ingest.grid_cells(first))
    rows = ingest.typed_rows(grid if not has_header else grid.where("row_index > 0"), names, [])
    return rows.select("col_1", "col_2", "col_5")


def ranges(t) -> DataFrame:
    """One sheet per event type: an empty top row for odd users' rows, blank cells on the left."""
    row = F.when(c("value") < 2, "[]").otherwise(F.concat(F.lit('["", "", '), text(c("event_id")), F.lit(', "x"]')))
    rows = t.events.select(c("event_type").alias("sheet"), c("event_id").alias("row_index"), row.alias("row_json"))
    return ingest.grid_cells(rows)


@query(
    "i7_trim_range",
    """with f as (select event_type as sheet, min(event_id) as start_row from events where value >= 2 group by 1)
    select e.event_type as sheet, event_id as row_index, start_row, 2 as start_col, case when value >= 2 then cast(event_id as varchar) end as first_cell,
      case when value < 2 then 0 else 2 end as width from events e join f on f.sheet = e.event_type where event_id >= start_row""",
)
def _(t):
    trimmed = ingest.trim_top_left(ranges(t))
    return trimmed.select(
        "sheet",
        "row_index",
        "start_row",
        "start_col",
        ingest.cell_text(F.get("cells", F.lit(0))).alias("first_cell"),
        F.size("cells").alias("width"),
    )


@query(
    "i8_range_metadata",
    """select 'u' || user_id as sheet, count(*) as row_total, count(*) <= 1 or arg_min(value, event_id) < 10 as skipped from events group by 1""",
)
def _(t):
    row = F.when(c("value") < 10, "[]").otherwise('["a"]')
    grid = ingest.grid_cells(
        t.events.select(F.concat(F.lit("u"), text(c("user_id"))).alias("sheet"), c("event_id").alias("row_index"), row.alias("row_json"))
    )
    table = VersionedTable(t.spark, scratch_path(t.spark, "sheet-info"))
    return table.delete_insert(ingest.range_metadata(grid), ["sheet"])


@query("i13_records", f'select key, col_2 as kind, flag as e from ({_SHEET})')
def _(t):
    made = ingest.records(sheet(t).where("row_index > 0"), ["key", "kind", "c", "d", "e"])
    typed = {"key": "bigint", "kind": "string", "e": "boolean"}
    return made.select(*[F.try_variant_get(name, "$", kind).alias(name) for name, kind in typed.items()])


# --- issue tracker, cycles, analytics events, run metadata -----------------------------------------------


def issue_nodes(t) -> DataFrame:
    labels = F.array(
        F.struct(F.concat(F.lit("p"), F.left("o_orderpriority", F.lit(1))).alias("id"), c("o_orderpriority").alias("name"), F.lit("red").alias("color")),
        F.struct(c("o_orderstatus").alias("id"), c("o_orderstatus").alias("name"), F.lit("blue").alias("color")),
    )
    key, who, at = text(c("o_orderkey")), text(c("o_custkey")), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    done, place = c("o_orderstatus") == "F", F.left("o_orderpriority", F.lit(1)).cast("int")
    person = F.struct(who.alias("id"), F.concat(F.lit("n"), who).alias("name"), F.concat(who, F.lit("@x.org")).alias("email"))
    node = F.struct(
        key.alias("id"),
        F.concat(F.lit("ORD-"), key).alias("identifier"),
        c("o_orderkey").alias("number"),
        F.concat(F.lit("Order "), key).alias("title"),
        F.when(done, F.concat(F.lit("Done: "), key)).alias("description"),
        place.alias("priority"),
        c("o_orderpriority").alias("priorityLabel"),
        (place / 2).alias("estimate"),
        (-place / 4).alias("sortOrder"),
        at.alias("startedAt"),
        F.when(done, at).alias("completedAt"),
        F.when(c("o_orderstatus") == "P", at).alias("canceledAt"),
        at.alias("createdAt"),
        at.alias("updatedAt"),
        F.when(done, at).alias("archivedAt"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dueDate"),
        F.concat(F.lit("https://x.org/"), key).alias("url"),
        F.concat(F.lit("b/"), key).alias("branchName"),
        F.struct(c("o_orderstatus").alias("id"), F.lower("o_orderstatus").alias("name"), F.lit("t").alias("type"), F.lit("grey").alias("color")).alias("state"),
        F.struct(F.lit("1").alias("id"), F.lit("ORD").alias("key"), F.lit("Orders").alias("name")).alias("team"),
        person.alias("creator"),
        F.when(c("o_orderstatus") != "P", person).alias("assignee"),
        F.when(done, F.struct(F.lit("9").alias("id"), F.lit("Ship").alias("name"), F.lit("open").alias("state"))).alias("project"),
        F.struct(text(place).alias("id"), place.alias("number"), F.lit("week").alias("name")).alias("cycle"),
        F.struct(who.alias("id"), F.concat(F.lit("C-"), who).alias("identifier")).alias("parent"),
        F.when(c("o_totalprice") > 100000, F.struct(labels.alias("nodes"))).alias("labels"),
    )
    return t.orders.select(F.to_json(node).alias("node"))


@query(
    "i9_issue_flatten",
    """with o as (select *, cast(o_orderkey as varchar) as k, cast(o_custkey as varchar) as w, cast(left(o_orderpriority, 1) as integer) as p from orders)
    select k as id, 'ORD-' || k as identifier, o_orderkey as number, 'Order ' || k as title, case when o_orderstatus = 'F' then 'Done: ' || k end as description,
      p as priority, o_orderpriority as priority_label, p / 2 as estimate, -p / 4 as sort_order, o_orderdate as started_at,
      case when o_orderstatus = 'F' then o_orderdate end as completed_at, case when o_orderstatus = 'P' then o_orderdate end as canceled_at,
      o_orderdate as created_at, o_orderdate as updated_at, case when o_orderstatus = 'F' then o_orderdate end as archived_at, cast(o_orderdate as date) as due_date,
      'https://x.org/' || k as url, 'b/' || k as branch_name, lower(o_orderstatus) as state, 'grey' as state_color, 'ORD' as team, w || '@x.org' as creator,
      case when o_orderstatus <> 'P' then w || '@x.org' end as assignee, case when o_orderstatus = 'F' then 'Ship/open' end as project,
      cast(p as bigint) as cycle, 'C-' || w as parent, case when o_totalprice > 100000 then 2 else 0 end as labels from o""",
)
def _(t):
    rows = ingest.issues(issue_nodes(t))
    plain = {
        "id": "id", "identifier": "identifier", "number": "number", "title": "title", "description": "description", "priority": "priority",
        "priority_label": "priorityLabel", "estimate": "estimate", "sort_order": "sortOrder", "started_at": "startedAt", "completed_at": "completedAt",
        "canceled_at": "canceledAt", "created_at": "createdAt", "updated_at": "updatedAt", "archived_at": "archivedAt", "due_date": "dueDate", "url": "url",
        "branch_name": "branchName", "state": "state.name", "state_color": "state.color", "team": "team.key", "creator": "creator.email",
        "assignee": "assignee.email", "cycle": "cycle.number", "parent": "parent.identifier",
    }
    project = F.concat_ws("/", "project.name", "project.state")
    return rows.select(
        *[c(source).alias(name) for name, source in plain.items()], F.when(c("project").isNotNull(), project).alias("project"), F.size("labels").alias("labels")
    )


@query(
    "i9_issue_labels",
    """select cast(o_orderkey as varchar) as issue_id, 'p' || left(o_orderpriority, 1) as label_id, o_orderpriority as name, 'red' as color from orders where o_totalprice > 100000
       union all select cast(o_orderkey as varchar), o_orderstatus, o_orderstatus, 'blue' from orders where o_totalprice > 100000""",
)
def _(t):
    return ingest.issue_labels(ingest.issues(issue_nodes(t)))


@query(
    "i10_cycle_history",
    """select c_custkey as id, cast(d as integer) as day_number, (c_nationkey + d) as scope, case when d < 3 then c_nationkey * d end as done from customer, generate_series(0, 4) s(d)""",
)
def _(t):
    n = c("c_nationkey")
    cycles = t.customer.select(
        c("c_custkey").alias("id"),
        F.transform(F.sequence(F.lit(0), F.lit(4)), lambda d: (n + d).cast("bigint")).alias("scope"),
        F.transform(F.sequence(F.lit(0), F.lit(2)), lambda d: (n * d).cast("bigint")).alias("done"),
    )
    return ingest.cycle_history(cycles, "id", ["scope", "done"])


_VALUE = "struct<string_value:string,int_value:bigint,float_value:float,double_value:double>"


@query(
    "i11_event_params",
    """select event_id, 'kind' as param_key, event_type as param_value from events union all select event_id, 'user', cast(user_id as varchar) from events
       union all select event_id, 'k', json_extract_string(props, '$.k') from events""",
)
def _(t):
    def param(key, string=None, whole=None):
        value = F.struct(
            (string if string is not None else F.lit(None).cast("string")).alias("string_value"),
            (whole if whole is not None else F.lit(None).cast("bigint")).alias("int_value"),
            F.lit(None).cast("float").alias("float_value"),
            F.lit(None).cast("double").alias("double_value"),
        )
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    params = F.array(
        param("kind", c("event_type")),
        param("user", whole=c("user_id")),
        param("k", whole=F.get_json_object("props", "$.k").cast("bigint")),
    ).cast(f"array<struct<key:string,value:{_VALUE}>>")
    return ingest.event_params(t.events.select("event_id", params.alias("event_params")), ["event_id"])


@query(
    "i12_run_metadata",
    """select cast(event_id as varchar) as id, case when event_type in ('view', 'error') then 'DONE' else event_type end as status from events""",
)
def _(t):
    schema = "id string, status string, seq bigint"

    def landed(rows: DataFrame, name: str) -> DataFrame:
        path = scratch_path(t.spark, name)
        rows.write.json(path)
        return t.spark.read.schema(schema).json(path)

    first = t.events.select(text(c("event_id")).alias("id"), c("event_type").alias("status"), F.lit(1).alias("seq"))
    again = t.events.where("event_type in ('view', 'error')").select(text(c("event_id")).alias("id"), F.lit("DONE").alias("status"), F.lit(2).alias("seq"))
    runs = KeyedTable(t.spark, scratch_path(t.spark, "run-metadata"), ["id"], buckets=16)
    runs.merge(landed(first, "runs-1"), order_by=["seq"])
    return runs.merge(landed(again, "runs-2"), order_by=["seq"]).drop("seq")


_RESOURCE = "case event_type when 'click' then 'pipeline_runs' when 'view' then 'task_runs' when 'error' then 'operations' else 'assets' end"


@query(
    "i12_all_resources",
    f"""select {_RESOURCE} as resource, cast(user_id as varchar) as key, max(event_id) as seq, arg_max(event_type, event_id) as status from events group by 1, 2""",
)
def _(t):
    root, made = scratch_path(t.spark, "run-resources"), {}
    for half in (0, 1):
        rows = t.events.where(c("event_id") % 2 == half).select(F.expr(_RESOURCE).alias("resource"), text(c("user_id")).alias("key"), c("event_id").alias("seq"), c("event_type").alias("status"))
        batches = {n: rows.where(c("resource") == n).withColumnRenamed("key", k).drop("resource") for n, k in ingest.RUN_RESOURCES.items()}
        made = ingest.merge_resources(t.spark, root, batches, ["seq"], late=True, buckets=4)
    parts = [df.select(F.lit(n).alias("resource"), c(ingest.RUN_RESOURCES[n]).alias("key"), "seq", "status") for n, df in made.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# --- schemas that grow ------------------------------------------------------------------------------------


@query(
    "i1_schema_evolution",
    """select c_custkey as id, c_name as name, cast(c_nationkey as bigint) as nation, case when c_nationkey < 12 then null when c_nationkey < 18 then c_mktsegment end as segment,
      case when c_nationkey < 12 then floor(c_acctbal) else round(c_acctbal, 2) end as balance,
      case when c_nationkey < 12 then cast(c_nationkey as varchar) else 'n' || c_nationkey end as code, true as refused from customer""",
)
def _(t):
    """Landed batches: the second has wider numbers, a text where numbers were, new fields; the third does not fit."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "grown"))
    key, nation = c("c_custkey").alias("id"), c("c_nationkey").alias("nation")

    def landed(rows, *fields):
        path = scratch_path(t.spark, "landed")
        rows.select(F.to_json(F.struct(*fields)).alias("value")).write.text(path)
        return t.spark.read.text(path)

    first = t.customer.where("c_nationkey < 12")
    table.append_json(landed(first, key, c("c_name").alias("name"), F.floor("c_acctbal").alias("balance"), F.struct(nation).alias("place"), c("c_nationkey").alias("code")))
    rest = t.customer.where("c_nationkey >= 12")
    place = F.struct(nation, F.when(c("c_nationkey") < 18, c("c_mktsegment")).alias("segment")).alias("place")
    code = F.concat(F.lit("n"), text(c("c_nationkey"))).alias("code")
    whole = table.append_json(landed(rest, key, c("c_name").alias("name"), F.round("c_acctbal", 2).alias("balance"), place, code))
    try:
        table.append_json(landed(t.customer, key, F.struct(c("c_acctbal").alias("amount")).alias("balance")))
        refused = False
    except SchemaConflict:
        refused = table.read().count() == t.customer.count()
    return whole.select("id", "name", "place.nation", "place.segment", c("balance").cast("double").alias("balance"), "code", F.lit(refused).alias("refused"))
