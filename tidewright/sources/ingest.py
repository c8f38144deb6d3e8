"""Landed JSON pages and sheet grids turned into tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.dates import serial_to_date, serial_to_timestamp
from tidewright.functions.text import slugify_name
from tidewright.sources.load import KeyedTable

_MAP = "map<string,string>"


# --- CRM pages -------------------------------------------------------------------------------------------


def crm_results(pages: DataFrame, results: str = "results") -> DataFrame:
    """One row per result: id, its properties and its raw text.

    ``results`` is an array of JSON texts. Properties are the ``properties`` object, or the result itself where
    there is none; an id missing from them is lifted from the result.
    """
    raw = pages.select(F.explode(results).alias("raw"))
    whole = F.from_json("raw", _MAP)
    parsed = raw.select(
        "raw",
        F.coalesce(F.from_json(F.get_json_object("raw", "$.properties"), _MAP), whole).alias("properties"),
        F.get_json_object("raw", "$.id").alias("__id"),
    )
    return parsed.select(F.coalesce(F.col("properties")["id"], F.col("__id")).alias("id"), "properties", "raw")


def crm_columns(default: Sequence[str], available: Sequence[str], include_custom: bool = True) -> list[str]:
    """Default columns and, if wanted, the custom ones (those not starting ``hs_``), sorted, without doubles."""
    custom = [c for c in available if not c.startswith("hs_")] if include_custom else []
    return sorted(set(default) | set(custom))


def crm_table(results: DataFrame, columns: Sequence[str]) -> DataFrame:
    return results.select("id", *[F.col("properties")[c].alias(c) for c in columns if c != "id"])


def association_links(results: DataFrame) -> DataFrame:
    """Distinct links: association name, the object's own id and the linked id."""
    kind = "map<string,struct<results:array<struct<id:string>>>>"
    parsed = results.select(
        F.col("properties")["hs_object_id"].alias("value"),
        F.explode(F.from_json(F.get_json_object("raw", "$.associations"), kind)).alias("association", "linked"),
    )
    links = parsed.select("association", "value", F.explode("linked.results.id").alias("linked_id"))
    return links.distinct()


# The fields of a history entry that become columns.
HISTORY_FIELDS = ("value", "timestamp", "sourceType", "sourceId", "sourceLabel", "updatedByUserId")


def property_history(objects: DataFrame, raw: str = "raw", fields: Sequence[str] = HISTORY_FIELDS) -> DataFrame:
    """One row per change: object, property and the fields of the entry; objects without history give none.

    Fields of an entry that are not listed stay in the map ``more``, as text.
    """
    kind = "map<string,array<map<string,string>>>"
    history = objects.select(
        F.get_json_object(raw, "$.id").alias("object_id"),
        F.explode(F.from_json(F.get_json_object(raw, "$.propertiesWithHistory"), kind)).alias("property_name", "changes"),
    )
    entries = history.select("object_id", "property_name", F.explode("changes").alias("entry"))
    more = F.map_filter("entry", lambda k, v: ~k.isin(*fields))
    return entries.select("object_id", "property_name", *[F.col("entry")[f].alias(f) for f in fields], more.alias("more"))


# --- Sheets ----------------------------------------------------------------------------------------------


def grid_cells(rows: DataFrame, raw: str = "row_json") -> DataFrame:
    """Row texts such as ``["a", 1.5, true]`` as an array of typed cells in ``cells``."""
    return rows.withColumn("cells", F.expr(f"try_variant_get(try_parse_json({raw}), '$', 'array<variant>')"))


def cell_text(cell: Column) -> Column:
    """Cell as text; '' is null."""
    return F.nullif(F.try_variant_get(cell, "$", "string"), F.lit(""))


def column_kinds(formats: Sequence[str | None], first_row: Sequence[object] = ()) -> list[str | None]:
    """Kind of each column from the number formats and, where these say nothing, the values of the first data row."""
    kinds = {"DATE_TIME": "timestamp", "TIME": "timestamp", "DATE": "date"}
    out = [kinds.get(f) if f else None for f in formats]
    for i, value in enumerate(first_row):
        if i < len(out) and out[i] is None and not isinstance(value, str) and value is not None:
            out[i] = "boolean" if isinstance(value, bool) else "bigint" if isinstance(value, int) else "double"
    return out


def header_names(cells: Sequence[object]) -> tuple[list[str], bool]:
    """Column names from the first row, and whether that row is a header.

    All cells must be text, or blank, and differ once normalised; blanks get ``col_n``. Otherwise all names are
    automatic and the first row is data.
    """
    automatic = [f"col_{i}" for i in range(1, len(cells) + 1)]
    if any(c is not None and not isinstance(c, str) for c in cells):
        return automatic, False
    names = [c if c else auto for c, auto in zip(cells, automatic)]
    if len({slugify_name(n) for n in names}) != len(names):
        return automatic, False
    return names, True


_NO_NUMBER = ("STRING", "BOOLEAN", "VOID")


def typed_cell(cell: Column, kind: str | None) -> Column:
    """A cell as text (no kind), as a date or timestamp, as any other SQL type, or as it is (``variant``); '' is null.

    Numbers in date and timestamp cells are spreadsheet serials.
    """
    if kind is None:
        return cell_text(cell)
    if kind == "variant":
        return F.when(cell_text(cell).isNotNull(), cell)
    if kind not in ("date", "timestamp"):
        return F.try_variant_get(cell, "$", kind)
    number = F.when(~F.schema_of_variant(cell).isin(*_NO_NUMBER), F.try_variant_get(cell, "$", "double"))
    if kind == "date":
        return F.coalesce(serial_to_date(number), cell_text(cell).try_cast("date"))
    return F.coalesce(serial_to_timestamp(number), cell_text(cell).try_cast("timestamp_ntz"))


def typed_rows(grid: DataFrame, headers: Sequence[str], kinds: Sequence[str | None], keep: Sequence[str] = ()) -> DataFrame:
    """Grid rows as a table: empty rows go, short rows are filled with null, cells past the header are dropped."""
    kinds = list(kinds) + [None] * (len(headers) - len(kinds))
    cells = [typed_cell(F.get("cells", F.lit(i)), kind).alias(name) for i, (name, kind) in enumerate(zip(headers, kinds))]
    return grid.where(F.size("cells") > 0).select(*keep, *cells)


def records(grid: DataFrame, headers: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows as records whose fields keep the types of their cells; fields past the end of a row are absent."""
    return typed_rows(grid, headers, ["variant"] * len(headers), keep)


def trim_top_left(grid: DataFrame, sheet: str = "sheet", row: str = "row_index") -> DataFrame:
    """Drop the empty rows on top and the blank cells left of the first filled row, and shift the origin."""
    blank = F.transform("cells", lambda c: F.coalesce(F.try_variant_get(c, "$", "string"), F.lit("")) == "")
    left = F.coalesce(F.nullif(F.array_position(blank, F.lit(False)), F.lit(0)) - 1, F.size("cells"))
    filled = grid.where(F.size("cells") > 0)
    origin = filled.groupBy(sheet).agg(
        F.min_by(F.struct(F.col(row).alias("start_row"), left.cast("int").alias("start_col")), F.col(row)).alias("o")
    )
    placed = grid.join(origin.select(sheet, "o.*"), sheet, "inner").where(F.col(row) >= F.col("start_row"))
    tail = F.greatest(F.size("cells") - F.col("start_col"), F.lit(0))
    return placed.withColumn("cells", F.slice("cells", F.col("start_col") + 1, tail))


def range_metadata(grid: DataFrame, sheet: str = "sheet", row: str = "row_index") -> DataFrame:
    """Per range: its rows and whether it is skipped: no rows, one row, or a blank first row."""
    info = grid.groupBy(sheet).agg(
        F.count(F.lit(1)).alias("row_total"),
        F.min_by(F.size("cells"), F.col(row)).alias("first_width"),
    )
    skipped = (F.col("row_total") <= 1) | (F.col("first_width") == 0)
    return info.select(sheet, "row_total", skipped.alias("skipped"))


# --- Issue tracker and event logs ------------------------------------------------------------------------

# The fields of an issue as the tracker gives them.
ISSUE = """
    id string, identifier string, number bigint, title string, description string, priority int, priorityLabel string,
    estimate double, sortOrder double, startedAt timestamp_ntz, completedAt timestamp_ntz, canceledAt timestamp_ntz,
    createdAt timestamp_ntz, updatedAt timestamp_ntz, archivedAt timestamp_ntz, dueDate date, url string, branchName string,
    state struct<id:string,name:string,type:string,color:string>, team struct<id:string,key:string,name:string>,
    creator struct<id:string,name:string,email:string>, assignee struct<id:string,name:string,email:string>,
    project struct<id:string,name:string,state:string>, cycle struct<id:string,number:bigint,name:string>,
    parent struct<id:string,identifier:string>, labels struct<nodes:array<struct<id:string,name:string,color:string>>>
"""


def issues(nodes: DataFrame, raw: str = "node") -> DataFrame:
    """Issue nodes as columns, with the labels as a plain list."""
    parsed = nodes.select(F.from_json(raw, ISSUE).alias("n")).select("n.*")
    empty = F.array().cast("array<struct<id:string,name:string,color:string>>")
    return parsed.withColumn("labels", F.coalesce("labels.nodes", empty))


def issue_labels(issue_rows: DataFrame) -> DataFrame:
    """Child table: one row per issue and label."""
    return issue_rows.select(F.col("id").alias("issue_id"), F.inline("labels")).withColumnRenamed("id", "label_id")


def cycle_history(cycles: DataFrame, key: str, arrays: Sequence[str]) -> DataFrame:
    """Daily history arrays as (cycle, day number, one value per array)."""
    zipped = F.arrays_zip(*[F.col(a) for a in arrays])
    return cycles.select(key, F.posexplode(zipped).alias("day_number", "v")).select(
        key, "day_number", *[F.col(f"v.{a}").alias(a) for a in arrays]
    )


def event_params(events: DataFrame, key: Sequence[str], params: str = "event_params") -> DataFrame:
    """One row per event parameter, its one typed value as text."""
    rows = events.select(*key, F.inline(params))
    v = F.col("value")
    value = F.coalesce(
        v["string_value"],
        v["int_value"].cast("string"),
        v["float_value"].cast("string"),
        v["double_value"].cast("string"),
    )
    return rows.select(*key, F.col("key").alias("param_key"), value.alias("param_value"))


def params_map(events: DataFrame, key: Sequence[str], params: str = "event_params") -> DataFrame:
    """Parameters of each event as one map from key to value struct."""
    return events.select(*key, F.map_from_entries(params).alias("params"))


# --- Run metadata ----------------------------------------------------------------------------------------

# The resources of the run log and what their rows are merged by.
RUN_RESOURCES = {"pipeline_runs": "id", "task_runs": "id", "operations": "id", "assets": "assetId"}


def merge_resources(
    spark: SparkSession, root: str, batches: dict[str, DataFrame], order_by: Sequence[str], late: bool = False, buckets: int = 16
) -> dict[str, DataFrame]:
    """Merge a batch of each run resource into its table by the resource's key, and return the tables.

    Only the folders of the batch's keys are read and written. With ``late`` the newest row of table and batch stays,
    else the batch's row replaces the table's.
    """
    unknown = sorted(set(batches) - set(RUN_RESOURCES))
    if unknown:
        raise ValueError(f"unknown resources {unknown}")
    made = {}
    for name, df in batches.items():
        table = KeyedTable(spark, f"{root}/{name}", [RUN_RESOURCES[name]], buckets)
        made[name] = table.upsert_latest(df, order_by=order_by) if late else table.merge(df, order_by=order_by)
    return made
