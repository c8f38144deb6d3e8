"""Compare a registered query with its SQL on the same parquet files."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _kind(name: str) -> str:
    name = name.lower()
    if name.startswith(("decimal", "numeric")):
        return "decimal"
    for kind, words in {
        "int": ("int64", "int32", "int16", "int8", "bigint", "integer", "smallint", "tinyint", "uint", "hugeint"),
        "float": ("double", "float"),
        "text": ("string", "varchar", "large_string"),
        "time": ("timestamp",),
        "date": ("date",),
        "bool": ("bool",),
    }.items():
        if name.startswith(words):
            return kind
    return name


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, float):
        return (1, repr(value))
    return (1, str(value))


def rows_of(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(tuple(_cell(v) for v in row) for row in zip(*columns)) if names else []


def differences(spark_df, sql: str, con) -> list[str]:
    """What differs, in words; empty when names, kinds and rows agree."""
    ours, theirs = spark_df.toArrow(), con.sql(sql).to_arrow_table()
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return [f"columns {sorted(ours.column_names)} != {sorted(theirs.column_names)}"]
    out = []
    for name in ours.column_names:
        a, b = str(ours.schema.field(name).type), str(theirs.schema.field(name).type)
        if _kind(a) != _kind(b):
            out.append(f"type of {name}: {a} != {b}")
        elif a != b and _kind(a) in ("int", "decimal"):
            out.append(f"width of {name}: {a} != {b}")
    a, b = rows_of(ours), rows_of(theirs)
    if len(a) != len(b):
        out.append(f"row count {len(a)} != {len(b)}")
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3]
        only_b = [r for r in b if r not in set(a)][:3]
        out.append(f"rows differ, ours {only_a} theirs {only_b}")
    return out
