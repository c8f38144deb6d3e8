"""Parquet files of a bounded byte size, and rows laid out so that filters on any of several columns prune."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.session import hadoop_path, scratch_path

#: Rows that the row size, and the ranks of a column's values, are estimated from.
SAMPLE_ROWS = 50_000
#: How full files are planned; rows differ, and files over the limit are split again.
FILL = 0.8


def file_sizes(spark, path: str) -> dict[str, int]:
    """Bytes of every data file of a folder."""
    folder, files = hadoop_path(spark, path)
    listed = files.listFiles(folder, True)
    sizes = {}
    while listed.hasNext():
        status = listed.next()
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            sizes[status.getPath().toString()] = status.getLen()
    return sizes


def row_bytes(df: DataFrame, rows: int) -> float:
    """Bytes a row takes on disk, from a sample written to the scratch folder.

    Every partition is sampled where it lies; only the sampled rows meet in the task that writes them.
    """
    path = scratch_path(df.sparkSession, "row-size")
    share = min(1.0, SAMPLE_ROWS / max(rows, 1))
    (df if share == 1.0 else df.sample(share, seed=11)).repartition(1).write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path).count()
    return sum(file_sizes(df.sparkSession, path).values()) / max(written, 1)


def _write_bounded(df: DataFrame, path: str, max_bytes: int, per_file: int) -> None:
    """Write, then split what came out too large, until no file is above the limit; the folder appears when it is whole."""
    spark = df.sparkSession
    parent, slash, name = path.rstrip("/").rpartition("/")
    made = f"{parent}{slash}_{name}.{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", per_file).parquet(made)
    _, files = hadoop_path(spark, made)
    while True:
        large = {f: size for f, size in file_sizes(spark, made).items() if size > max_bytes}
        if not large:
            break
        if per_file == 1:
            raise ValueError(f"a single row takes more than {max_bytes} bytes")
        per_file = max(1, min(per_file // 2, int(per_file * FILL * max_bytes / max(large.values()))))
        again = spark.read.schema(df.schema).parquet(*large)
        again.write.mode("append").option("maxRecordsPerFile", per_file).parquet(made)
        for f in large:
            files.delete(hadoop_path(spark, f)[0], False)
    final, files = hadoop_path(spark, path)
    files.delete(final, True)
    if not files.rename(hadoop_path(spark, made)[0], final):
        raise OSError(f"cannot rename {made} to {path}")


def unload_by_bytes(df: DataFrame, path: str, max_bytes: int) -> None:
    """Query result to a clean parquet folder in which no file has more than ``max_bytes``.

    Rows per file follow from the size of sampled rows. Files that still come out above the limit (rows differ) are
    read again and split; a row that alone exceeds it is an error, and the old folder then stays.
    """
    rows = df.count()
    per_file = max(1, int(max_bytes * FILL / max(row_bytes(df, rows), 1e-9)))
    _write_bounded(df, path, max_bytes, per_file)


def _ranks(df: DataFrame, columns: Sequence[str], bits: int, rows: int) -> dict[str, list]:
    """Bounds that cut each column's values into equal parts, from a sample; only the layout depends on them."""
    share = min(1.0, SAMPLE_ROWS / max(rows, 1))
    kept = df.select(*columns) if share == 1.0 else df.select(*columns).sample(share, seed=13)
    sample = kept.limit(2 * SAMPLE_ROWS).collect()
    bounds = {}
    for c in columns:
        values = sorted(r[c] for r in sample if r[c] is not None)
        parts = 1 << bits
        bounds[c] = [values[len(values) * i // parts] for i in range(1, parts)] if values else []
    return bounds


def _rank(value: Column, kind, bounds: list, bits: int) -> Column:
    """How many bounds lie at or below the value, by binary search; null is before all."""
    if not bounds:
        return F.lit(0)
    cuts = F.array(*[F.lit(b).cast(kind) for b in bounds])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.element_at(cuts, at + step) <= value, at + step).otherwise(at))


def curve_key(df: DataFrame, columns: Sequence[str], bits: int = 8, rows: int | None = None) -> Column:
    """Place of a row on a space-filling curve (Z-order) through the ranks of some columns.

    Ranks, unlike values, are spread evenly whatever the distribution. Bits of all columns are interleaved, highest first.
    """
    if bits * len(columns) > 62:
        raise ValueError("too many bits for a 64-bit key")
    bounds = _ranks(df, columns, bits, df.count() if rows is None else rows)
    key = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        rank = _rank(F.col(c), df.schema[c].dataType, bounds[c], bits).cast("long")
        for b in range(bits):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - i))
    return key


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], max_bytes: int, bits: int = 8) -> None:
    """A clean parquet folder laid out along the curve, so that a filter on any of ``columns`` meets few files.

    Neighbours on the curve share files of at most ``max_bytes``; rows that share a place are told apart by the columns and
    a hash, so that a frequent value spreads over as many files as it needs.
    """
    rows = df.count()
    size = row_bytes(df, rows)
    per_file = max(1, int(max_bytes * FILL / max(size, 1e-9)))
    names = [f"`{c}`" for c in df.columns]
    tie = F.xxhash64(*[F.col(n) for n, f in zip(names, df.schema.fields, strict=True) if f.dataType.typeName() not in ("map", "variant")])
    keyed = df.withColumns({"__place": curve_key(df, columns, bits, rows), "__tie": tie})
    order = ["__place", *columns, "__tie"]
    dealt = keyed.repartitionByRange(max(1, math.ceil(rows / per_file)), *order).sortWithinPartitions(*order)
    _write_bounded(dealt.select(*names), path, max_bytes, per_file)


def files_to_read(df: DataFrame, column: str, lower, upper) -> int:
    """How many files of a scan hold values between two bounds by their least and largest one, as a reader skips them."""
    spans = df.groupBy(F.input_file_name().alias("file")).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return spans.where((F.col("lo") <= F.lit(upper)) & (F.col("hi") >= F.lit(lower))).count()
