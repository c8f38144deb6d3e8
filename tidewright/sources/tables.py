"""Named tables: one parquet path per name."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.session import hadoop_path, prepare
from tidewright.sources.layout import unload_by_bytes


class Tables:
    """Tables of one folder, read by name: ``t("orders")`` or ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(self.path(name))
        return self._read[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self(name)


def scan(spark: SparkSession, path: str, columns: Sequence[str], where: Column | str | None = None) -> DataFrame:
    """Parquet scan of listed columns; the filter reaches the file reader."""
    df = spark.read.parquet(path)
    return (df.where(where) if where is not None else df).select(*columns)


def half_open(column: str, start: str, stop: str) -> Column:
    """``start <= column < stop`` for ISO-8601 bounds, which may carry a zone offset.

    Bounds are turned into UTC wall-clock literals, so the comparison stays a plain pushed filter.
    """

    def bound(text: str) -> Column:
        from datetime import datetime, timezone

        at = datetime.fromisoformat(text)
        if at.tzinfo is not None:
            at = at.astimezone(timezone.utc).replace(tzinfo=None)
        return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")

    return (F.col(column) >= bound(start)) & (F.col(column) < bound(stop))


def read_csv(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """CSV files under a path or glob, with a header row and a declared schema; a quote inside quotes is doubled (RFC 4180)."""
    return spark.read.schema(schema).options(**{"header": True, "escape": '"', **options}).csv(path)


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Small CSV with column types; a byte-order mark before the first name is ignored."""
    return read_csv(spark, path, schema, enforceSchema="true")


def row_counts(tables: dict[str, DataFrame], extracted_at: Column | None = None) -> DataFrame:
    """One row per table: name, row count and extraction time."""
    at = extracted_at if extracted_at is not None else F.current_timestamp()
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", at.alias("extracted_at")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def column_catalog(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column: table, name, position, type and nullability; no data is read."""
    rows = [
        (table, field.name, i, field.dataType.simpleString(), "YES" if field.nullable else "NO")
        for table, df in tables.items()
        for i, field in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "table_name string, column_name string, ordinal_position int, data_type string, is_nullable string",
    )


def run_log_rows(sources: DataFrame, source_col: str, details: Column) -> DataFrame:
    """Append-only run log rows: id, time, source and JSON details."""
    return sources.select(
        F.expr("uuid()").alias("run_id"),
        F.current_timestamp().alias("run_ts"),
        F.col(source_col).alias("source_name"),
        F.to_json(details).alias("details"),
    )


def _like(pattern: str) -> re.Pattern[str]:
    body = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern)
    return re.compile(f"^{body}$", re.IGNORECASE | re.DOTALL)


def relations_by_pattern(names: Iterable[str], pattern: str, exclude: str = "", schema_pattern: str = "") -> list[str]:
    """Table names that match a case-insensitive LIKE pattern and not the exclude pattern, without doubles.

    With ``schema_pattern`` the names carry their schema (``schema.table``), and that must match as well.
    """
    keep, drop = _like(pattern), _like(exclude) if exclude else None
    schema = _like(schema_pattern) if schema_pattern else None

    def wanted(name: str) -> bool:
        place, _, table = name.partition(".") if schema else ("", "", name)
        return bool(keep.match(table)) and not (drop and drop.match(table)) and not (schema and not schema.match(place))

    return sorted({n for n in names if wanted(n)})


def relations_by_prefix(names: Iterable[str], prefix: str, exclude: str = "", schema_pattern: str = "") -> list[str]:
    return relations_by_pattern(names, prefix + "%", exclude, schema_pattern)


def catalog_names(spark: SparkSession, schema_pattern: str = "") -> list[str]:
    """Names of the tables and views the session knows.

    With ``schema_pattern`` those of all matching schemas of the current catalog, as ``schema.table``.
    """
    if not schema_pattern:
        return [t.name for t in spark.catalog.listTables()]
    match = _like(schema_pattern)
    schemas = [d.name for d in spark.catalog.listDatabases() if match.match(d.name)]
    return [f"{s}.{t.name}" for s in schemas for t in spark.catalog.listTables(s) if not t.isTemporary]


def match_by_name(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns of ``target`` matched by name in any case, cast to its types; absent ones are null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def json_payload(df: DataFrame, column: str) -> DataFrame:
    """Parse a JSON text column to a variant; invalid text becomes null."""
    return df.withColumn(column, F.try_parse_json(column))


def unload(df: DataFrame, path: str, rows_per_file: int | None = None, max_bytes: int | None = None) -> None:
    """Query result to a clean parquet folder, with a bound on the rows or on the bytes of a file."""
    if max_bytes:
        unload_by_bytes(df, path, max_bytes)
        return
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


_CSV = {"header": True, "escape": '"'}
# Fixed value: a sheet holds at most this many cells.
SHEET_CELLS = 10_000_000


def export_csv(df: DataFrame, path: str, single: bool = False, quote_all: bool = False) -> None:
    """CSV with header, replacing what is there. ``single`` gives one file: for small exports only."""
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").options(**_CSV, quoteAll=quote_all).csv(path)


def export_per_value(df: DataFrame, path: str, column: str, single: bool = False) -> None:
    """One CSV folder ``column=value`` per value in a single job; the files have all columns, the value's included.

    Rows of a value are brought together, so that it has a few files, large values some more. ``single`` gives one file per
    value, each written by one task: for values of bounded size. The folders appear together when all are written.
    """
    spark, copy = df.sparkSession, "__value"
    rows = df.withColumn(copy, F.col(column))
    rows = rows.repartition(copy) if single else rows.hint("rebalance", copy)
    parent, slash, name = path.rstrip("/").rpartition("/")
    made = f"{parent}{slash}_{name}.{uuid.uuid4().hex}"
    rows.write.partitionBy(copy).options(**_CSV).csv(made)
    folder, files = hadoop_path(spark, made)
    for status in files.listStatus(folder):
        value = status.getPath().getName()
        if value.startswith(f"{copy}="):
            files.rename(status.getPath(), hadoop_path(spark, f"{made}/{column}={value[len(copy) + 1 :]}")[0])
    final, _ = hadoop_path(spark, path)
    files.delete(final, True)
    if not files.rename(folder, final):
        raise OSError(f"cannot rename {made} to {path}")


def sheet_rows(df: DataFrame) -> DataFrame:
    """All columns as text with '' for null, as a sheet wants them."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def push_sheet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header and rows as one CSV file; each append brings a file with its own header.

    More cells than a sheet holds are an error.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be 'overwrite' or 'append', got {mode!r}")
    most = SHEET_CELLS // max(len(df.columns), 1)
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {SHEET_CELLS} cells")
    sheet_rows(df).coalesce(1).write.mode(mode).options(**_CSV, emptyValue="").csv(path)


def mirror(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Full refresh of a set of tables; returns where each one lies."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{root}/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    return paths
