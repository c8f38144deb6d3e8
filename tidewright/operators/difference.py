"""Finds the rows in which two large tables differ, reading all rows but shuffling only those of differing buckets.

Rows are dealt to the nodes of a tree by the leading bits of a hash of their key. Checksums of the nodes of one level are
compared, and only what lies under nodes that differ is dealt to the next level. Rows under the last level's nodes are
compared as they are, so a result never rests on a checksum alone - only the absence of one does.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.session import landed

_NODE, _SUMS = "__node", ("__n", "__high", "__low", "__high2", "__low2")


def _parts(column: Column, kind: T.DataType) -> list[Column]:
    """What tells two values apart when hashed; hashes skip nulls, so where they are is part of it."""
    if isinstance(kind, T.StructType | T.ArrayType | T.MapType | T.VariantType):
        return [column.isNull(), F.to_json(F.struct(column.alias("v")))]
    if isinstance(kind, T.FloatType | T.DoubleType):
        return [column.isNull(), column + F.lit(0.0)]  # zero has one sign
    return [column.isNull(), column]


def _hash(df: DataFrame, columns: Sequence[str], seed: int) -> Column:
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    return F.xxhash64(F.lit(seed), *[p for c in columns for p in _parts(F.col(c), kinds[c.lower()])])


def _node(df: DataFrame, keys: Sequence[str], bits: int) -> Column:
    """The first bits of the key's hash."""
    return F.shiftrightunsigned(_hash(df, keys, 11), 64 - bits)


def checksums(df: DataFrame, keys: Sequence[str], bits: int, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per node: its number of rows, and exact sums of two hashes of its rows, order-free and blind to no copy.

    Sums add up, so the checksums of a coarser level, or of a table in parts, are the sums of these.
    """
    columns = list(columns or df.columns)
    hashed = df.select(_node(df, keys, bits).alias(_NODE), _hash(df, columns, 1).alias("a"), _hash(df, columns, 2).alias("b"))
    low = F.lit(0xFFFFFFFF).cast("long")
    return hashed.groupBy(_NODE).agg(
        F.count(F.lit(1)).alias("__n"),
        F.sum(F.shiftright("a", 32)).alias("__high"),
        F.sum(F.col("a").bitwiseAND(low)).alias("__low"),
        F.sum(F.shiftright("b", 32)).alias("__high2"),
        F.sum(F.col("b").bitwiseAND(low)).alias("__low2"),
    )


def differing_nodes(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes whose checksums differ, or that one side lacks."""
    zero = F.lit(0).cast("long")
    sides = [df.select(_NODE, *[(F.col(s) * sign).alias(s) for s in _SUMS]) for df, sign in ((a, 1), (b, -1))]
    both = sides[0].unionByName(sides[1]).groupBy(_NODE).agg(*[F.sum(s).alias(s) for s in _SUMS])
    return both.where(reduce(lambda x, y: x | y, [F.col(s) != zero for s in _SUMS])).select(_NODE)


def _under(df: DataFrame, keys: Sequence[str], bits: int, nodes: DataFrame | None) -> DataFrame:
    """Rows under some of a level's nodes; the nodes are few, and Spark sees by their size whether to broadcast them."""
    if nodes is None:
        return df
    return df.withColumn(_NODE, _node(df, keys, bits)).join(nodes, _NODE, "left_semi").drop(_NODE)


def suspects(a: DataFrame, b: DataFrame, keys: Sequence[str], bits: int = 12, levels: int = 2) -> DataFrame:
    """Nodes of the last level under which the tables differ, found by descending from level to level."""
    nodes = None
    for level in range(1, levels + 1):
        parts = [checksums(_under(df, keys, bits * (level - 1), nodes), keys, bits * level, a.columns) for df in (a, b)]
        nodes = landed(differing_nodes(*parts), "differing-nodes")
        if nodes.isEmpty():
            break
    return nodes


def differing_rows(a: DataFrame, b: DataFrame, keys: Sequence[str], bits: int = 12, levels: int = 2) -> DataFrame:
    """Rows that one table has more often than the other: the columns, ``only_in`` (``a`` or ``b``) and ``copies``.

    These are the rows of ``EXCEPT ALL`` in both directions. ``b`` has the columns of ``a`` with the same types. The tree
    has ``2 ** (bits * levels)`` leaves; each level reads both tables once and shuffles a row per task and node. Keys need
    not be unique nor filled; rows of one key lie under one leaf, so a key that names very many rows costs their number.
    """
    if sorted(c.lower() for c in a.columns) != sorted(c.lower() for c in b.columns):
        raise ValueError(f"columns differ: {a.columns} and {b.columns}")
    b = b.select(*a.columns)
    odd = [f.name for f, g in zip(a.schema.fields, b.schema.fields, strict=True) if f.dataType != g.dataType]
    if odd:
        raise ValueError(f"types differ: {odd}")
    if not 0 < bits * levels <= 62:
        raise ValueError("bits * levels must lie between 1 and 62")
    nodes = suspects(a, b, keys, bits, levels)
    sides = [_under(df, keys, bits * levels, nodes).withColumn("__side", F.lit(sign).cast("long")) for df, sign in ((a, 1), (b, -1))]
    rest = sides[0].unionByName(sides[1]).groupBy(*a.columns).agg(F.sum("__side").alias("__side")).where("__side <> 0")
    side = F.when(F.col("__side") > 0, "a").otherwise("b")
    return rest.select(*a.columns, side.alias("only_in"), F.abs("__side").alias("copies"))
