"""Load modes on plain parquet: replace, append, merge, history, by-period and audited publishing.

A ``VersionedTable`` keeps every version in folders of its own and a small log that names the current ones with their
schema, so a load never overwrites what it reads and readers see either the old or the new version. Of two writers that
start from the same version one fails. A ``KeyedTable`` deals its rows to buckets by key and replaces touched buckets only.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.dates import dateadd, datediff
from tidewright.operators.reshape import newest
from tidewright.session import hadoop_path, landed, scratch_path, written
from tidewright.sources.schemas import infer_json, merged_frames, parse_json, shaped, union_schema, without_void

_LOG = "version bigint, paths array<string>, mode string, schema string, schemas array<string>, kinds array<int>"


class AuditFailed(Exception):
    """A staged version did not pass its checks."""


class ConcurrentLoad(Exception):
    """Another load published a version since this one read the table."""


def _add_entry(spark: SparkSession, root: str, version: int, entry: dict) -> None:
    """Write a log entry under its number, unless that number is taken.

    The entry gets its name only when it is whole. Where the file system renames without overwriting (as HDFS does), no
    two writers get the same number; on others that holds unless both rename at the same moment.
    """
    name = f"{version:012d}.json"
    temporary, files = hadoop_path(spark, f"{root}/log/.{name}.{uuid.uuid4().hex}")
    final, _ = hadoop_path(spark, f"{root}/log/{name}")
    out = files.create(temporary, False)
    out.write(bytearray(json.dumps({"version": version, **entry}).encode()))
    out.close()
    if files.exists(final) or not files.rename(temporary, final):
        files.delete(temporary, False)
        raise ConcurrentLoad(f"{root}: version {version} is already there")


def _last_entry(spark: SparkSession, root: str, schema: str) -> dict | None:
    """The newest log entry; it is one small file, so no job is needed to read it."""
    folder, files = hadoop_path(spark, f"{root}/log")
    if not files.exists(folder):
        return None
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    numbered = max((n for n in names if re.fullmatch(r"\d{12}\.json", n)), default=None)
    if numbered is None:  # entries of an earlier form
        last = spark.read.schema(schema).json(f"{root}/log").orderBy(F.desc("version")).first()
        return last.asDict() if last else None
    stream = files.open(hadoop_path(spark, f"{root}/log/{numbered}")[0])
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


class VersionedTable:
    """A version is a list of immutable parquet folders, so appends and clones copy nothing.

    The log holds the schema of each version and the one each folder was written in. A batch may lack columns, bring new
    ones or wider types (see ``schemas``): the version's schema then grows, and older rows read as null or in the wider
    type. A conflict is an error before anything is written.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._staged: dict[str, T.StructType] = {}

    def _last(self):
        return _last_entry(self.spark, self.root, _LOG)

    def _written_in(self, last, path: str) -> T.StructType:
        if path in self._staged:
            return self._staged[path]
        if last is not None and last.get("schemas") and path in last["paths"]:
            return T.StructType.fromJson(json.loads(last["schemas"][last["kinds"][last["paths"].index(path)]]))
        return self.spark.read.parquet(path).schema  # published by hand

    def _schema(self, last) -> T.StructType:
        if last.get("schema"):
            return T.StructType.fromJson(json.loads(last["schema"]))
        return reduce(union_schema, [self._written_in(last, p) for p in last["paths"]])

    def schema(self) -> T.StructType | None:
        """Schema of the current version."""
        last = self._last()
        return self._schema(last) if last is not None else None

    def _frame(self, last, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
        """Rows of some folders; folders written in one schema are read together."""
        schema = schema or self._schema(last)
        alike: dict[str, list[str]] = {}
        if last.get("schemas"):
            kind = dict(zip(last["paths"], last["kinds"], strict=True))
            for p in paths:
                alike.setdefault(last["schemas"][kind[p]], []).append(p)
        else:
            for p in paths:
                alike.setdefault(self._written_in(last, p).json(), []).append(p)
        if not alike:
            return self.spark.createDataFrame([], schema)
        read = [self.spark.read.schema(T.StructType.fromJson(json.loads(s))).parquet(*ps) for s, ps in alike.items()]
        return merged_frames(read, schema)

    def _read_or_none(self) -> DataFrame | None:
        last = self._last()
        return self._frame(last, last["paths"]) if last is not None else None

    def exists(self) -> bool:
        return self._last() is not None

    def read(self) -> DataFrame:
        df = self._read_or_none()
        if df is None:
            raise FileNotFoundError(self.root)
        return df

    def stage(self, df: DataFrame, partition_by: Sequence[str] = ()) -> str:
        """Write a candidate folder; nobody reads it until it is published. Columns without a type are left out."""
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        schema = without_void(df.schema) or T.StructType()
        written(shaped(df, schema), path, partition_by)
        self._staged[path] = schema
        return path

    def publish(self, paths: Sequence[str], mode: str = "replace", after: int | None = None, schema: T.StructType | None = None) -> DataFrame:
        """Make the folders the current version, and return it; the schema is that of all folders together."""
        last = self._last()
        if after is None:
            after = last["version"] if last else 0
        own = [self._written_in(last, p) for p in paths]
        schema = schema or reduce(union_schema, own, T.StructType())
        named = [s.json() for s in own]
        kinds = {s: i for i, s in enumerate(dict.fromkeys(named))}
        entry = {"paths": list(paths), "mode": mode, "schema": schema.json(), "schemas": list(kinds), "kinds": [kinds[s] for s in named]}
        _add_entry(self.spark, self.root, after + 1, entry)
        return self._frame(entry, entry["paths"], schema)

    def replace(self, df: DataFrame, mode: str = "replace", partition_by: Sequence[str] = (), after: int | None = None) -> DataFrame:
        return self.publish([self.stage(df, partition_by)], mode, after)

    def grown(self, last, df: DataFrame) -> T.StructType:
        """Schema of the table with a batch's columns; raises ``SchemaConflict`` if they do not go together."""
        batch = without_void(df.schema) or T.StructType()
        return union_schema(self._schema(last), batch) if last is not None else batch

    def append(self, df: DataFrame) -> DataFrame:
        """Add a folder; what is there is neither read nor written again."""
        last = self._last()
        schema = self.grown(last, df)
        path = self.stage(df)
        before = list(last["paths"]) if last else []
        return self.publish([*before, path], "append", last["version"] if last else 0, schema)

    def append_json(self, lines: DataFrame, column: str = "value", keep: Sequence[str] = ()) -> DataFrame:
        """Append JSON objects with the columns found in them (see ``infer_json``) and the ``keep`` columns of the lines.

        New columns and wider types grow the schema; lines that do not parse and types that do not go together are errors,
        and then nothing is written.
        """
        last = self._last()
        found = infer_json(lines, column)
        return self.append(parse_json(lines, found, column, self._schema(last) if last is not None else None, keep))

    def _rewritten(
        self, batch: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame], mode: str, beside: Sequence[str] = ()
    ) -> DataFrame:
        """Replace the table by ``change(table, batch)``, both in the table's grown schema.

        The batch's columns ``beside`` are not the table's, and are there for ``change`` only.
        """
        last = self._last()
        schema = self.grown(last, batch.drop(*beside))
        now = self._frame(last, last["paths"], schema) if last is not None else self.spark.createDataFrame([], schema)
        made = change(now, self._batch(batch, schema, beside))
        return self.publish([self.stage(shaped(made, schema))], mode, last["version"] if last else 0, schema)

    @staticmethod
    def _batch(batch: DataFrame, schema: T.StructType, beside: Sequence[str]) -> DataFrame:
        return shaped(batch, T.StructType([*schema.fields, *[batch.schema[c] for c in beside]]))

    def merge(self, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
        return self._rewritten(batch, lambda now, new: merge_by_key(now, new, keys, order_by), "merge")

    def upsert_latest(self, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
        """Keep the newest row per key among the table and the batch; repeating a batch changes nothing."""
        return self._rewritten(batch, lambda now, new: newest(now.unionByName(new), keys, order_by), "upsert")

    def delete_insert(self, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
        return self._rewritten(batch, lambda now, new: delete_insert(now, new, keys), "delete_insert")

    def apply_changes(self, changes: DataFrame, keys: Sequence[str], sequence: str, op: str, delete: str = "D") -> DataFrame:
        """The last change per key updates, inserts or deletes; the sequence stays only if the table has that column."""
        known = {f.name.lower() for f in (self.schema() or T.StructType()).fields}
        gone = [op] if sequence.lower() in known else [op, sequence]
        told = changes.withColumns({"__sequence": F.col(sequence), "__op": F.col(op)}).drop(*gone)
        return self._rewritten(
            told, lambda now, new: apply_changes(now, new, keys, "__sequence", "__op", delete), "changes", ["__sequence", "__op"]
        )

    def audited(self, df: DataFrame, checks: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
        """Write, audit, publish: the staged files are checked, and only a clean version becomes current."""
        path = self.stage(df)
        staged = self.spark.read.schema(self._staged[path]).parquet(path)
        failed = [name for name, check in checks.items() if not check(staged).isEmpty()]
        if failed:
            raise AuditFailed(f"{self.root}: {', '.join(failed)}")
        return self.publish([path], "audited")

    def track(
        self, new: DataFrame, key: str, now: Column, check_cols: Sequence[str] | None = None, updated_at: str | None = None
    ) -> DataFrame:
        """Next snapshot of a slowly changing history (see ``scd2``), started at ``now`` by the first one.

        The last folder holds the open versions, the others closed ones, which are never read or written again.
        """
        last = self._last()
        if last is None:
            one_per_key(new, key)
            return self.publish([self.stage(first_snapshot(new, now.cast("timestamp_ntz")))], "track", 0)
        *closed, current = last["paths"]
        made = landed(scd2(self._frame(last, [current]), new, key, now, check_cols, updated_at), "history")
        done, still = made.where(F.col("valid_to").isNotNull()), made.where(F.col("valid_to").isNull())
        more = [] if done.isEmpty() else [self.stage(done)]
        return self.publish([*closed, *more, self.stage(still)], "track", last["version"])

    def vacuum(self, keep_versions: int = 1) -> list[str]:
        """Remove folders that none of the last ``keep_versions`` versions name, and return their names.

        Not for tables that others are cloned from, nor while a load runs.
        """
        log = self.spark.read.schema(_LOG).json(f"{self.root}/log").where("version is not null")
        kept = log.orderBy(F.desc("version")).limit(keep_versions).select(F.explode("paths").alias("path")).distinct()
        named = {r["path"].rstrip("/") for r in kept.toLocalIterator()}
        used = {p[len(f"{self.root}/data/") :].split("/")[0] for p in named if p.startswith(f"{self.root}/data/")}
        folder, files = hadoop_path(self.spark, f"{self.root}/data")
        gone = []
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            if name not in used:
                files.delete(status.getPath(), True)
                gone.append(name)
                continue
            for part in files.listStatus(status.getPath()) if f"{self.root}/data/{name}" not in named else ():
                inner = f"{name}/{part.getPath().getName()}"
                if part.isDirectory() and f"{self.root}/data/{inner}" not in named:
                    files.delete(part.getPath(), True)
                    gone.append(inner)
        return gone

    def clone_to(self, root: str) -> VersionedTable:
        """A table of its own that starts from the same folders."""
        last = self._last()
        if last is None:
            raise FileNotFoundError(self.root)
        copy = VersionedTable(self.spark, root)
        copy._staged = {p: self._written_in(last, p) for p in last["paths"]}
        copy.publish(last["paths"], "clone", 0, self._schema(last))
        return copy


class KeyedTable(VersionedTable):
    """A table dealt to buckets by a hash of its key, one folder each: a batch reads and writes its own buckets only.

    Choose ``buckets`` so that one of them is a few files' worth; it cannot be changed later, nor can the key's columns
    change their type in ways that change how they are written as text. A null key is a key like any other.

    A load goes through the buckets in waves: what a wave shuffles leaves the disk before the next one starts.
    """

    BUCKET = "__bucket"
    # Bytes of files, the batch's and the table's, that make a wave; one bucket at least.
    WAVE = 128 << 20

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 64):
        super().__init__(spark, root)
        self.keys, self.buckets = list(keys), buckets

    def _dealt(self, df: DataFrame) -> DataFrame:
        """Rows with their bucket. Text, so that a whole number keeps its bucket when its type grows."""
        return df.withColumn(self.BUCKET, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int"))

    def _bucket_of(self, path: str) -> int:
        return int(re.search(rf"{self.BUCKET}=(\d+)$", path)[1])

    def grown(self, last, df: DataFrame) -> T.StructType:
        schema = super().grown(last, df)
        if last is not None:
            before, after = ({f.name.lower(): f.dataType for f in s.fields} for s in (self._schema(last), schema))
            for k in self.keys:
                a, b = before[k.lower()], after[k.lower()]
                if a != b and not (isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType)):
                    raise ValueError(f"key {k} cannot turn from {a.simpleString()} into {b.simpleString()}")
        return schema

    def _stage_buckets(self, df: DataFrame, schema: T.StructType) -> list[str]:
        """Write rows to a folder per bucket, and return the folders."""
        root = self.stage(_clustered(self._dealt(shaped(df, schema)), self.BUCKET), [self.BUCKET])
        folder, files = hadoop_path(self.spark, root)
        names = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
        paths = sorted(f"{root}/{n}" for n in names if n.startswith(f"{self.BUCKET}="))
        self._staged |= dict.fromkeys(paths, schema)
        return paths

    def _in_waves(
        self, batch: DataFrame, schema: T.StructType, before: Sequence[str], change: Callable[[list[str], DataFrame], DataFrame]
    ) -> list[str]:
        """Folders of the table after a load: ``change(folders, rows)`` takes the place of those of the batch's buckets.

        The batch is written once, the rows of each file in the order of their buckets, so that a wave reads little but its own.
        """
        dealt, path, bucket = self._dealt(batch), scratch_path(self.spark, "batch"), F.col(self.BUCKET)
        written(dealt.sortWithinPartitions(bucket), path)
        rows = self.spark.read.schema(dealt.schema).parquet(path)
        counts = dict(sorted(rows.groupBy(bucket).count().collect()))  # at most ``buckets``
        each = _bytes(self.spark, path) / max(1, sum(counts.values()))
        inside: dict[int, list[str]] = {b: [] for b in counts}
        for p in before:
            inside.get(self._bucket_of(p), []).append(p)
        waves: list[list[int]] = []
        held = self.WAVE
        for b, n in counts.items():
            if held >= self.WAVE:
                waves.append([])
                held = 0
            waves[-1].append(b)
            held += n * each + sum(_bytes(self.spark, p) for p in inside[b])
        paths = [p for p in before if self._bucket_of(p) not in counts]
        for wave in waves:
            new = rows.where(bucket.between(wave[0], wave[-1])).drop(self.BUCKET)
            paths += self._stage_buckets(change(sorted(p for b in wave for p in inside[b]), new), schema)
        folder, files = hadoop_path(self.spark, path)
        files.delete(folder, True)
        return paths

    def replace(self, df: DataFrame, mode: str = "replace", partition_by: Sequence[str] = (), after: int | None = None) -> DataFrame:
        schema = without_void(df.schema)
        return self.publish(self._in_waves(shaped(df, schema), schema, (), lambda now, rows: rows), mode, after, schema)

    def append(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError("rows come into a keyed table by merge, upsert_latest, delete_insert or apply_changes")

    def _rewritten(
        self, batch: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame], mode: str, beside: Sequence[str] = ()
    ) -> DataFrame:
        last = self._last()
        schema = self.grown(last, batch.drop(*beside))
        paths = list(last["paths"]) if last is not None else []

        def changed(folders: list[str], rows: DataFrame) -> DataFrame:
            now = self._frame(last, folders, schema) if last is not None else self.spark.createDataFrame([], schema)
            return change(now, rows)

        made = self._in_waves(self._batch(batch, schema, beside), schema, paths, changed)
        return self.publish(made, mode, last["version"] if last else 0, schema)

    def merge(self, batch: DataFrame, keys: Sequence[str] = (), order_by: Sequence[str] = ()) -> DataFrame:
        return super().merge(batch, self._same(keys), order_by)

    def upsert_latest(self, batch: DataFrame, keys: Sequence[str] = (), order_by: Sequence[str] = ()) -> DataFrame:
        return super().upsert_latest(batch, self._same(keys), order_by)

    def delete_insert(self, batch: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
        return super().delete_insert(batch, self._same(keys))

    def apply_changes(self, changes: DataFrame, keys: Sequence[str], sequence: str, op: str, delete: str = "D") -> DataFrame:
        return super().apply_changes(changes, self._same(keys), sequence, op, delete)

    def replace_groups(self, batch: DataFrame, keep: str) -> DataFrame:
        """All rows of the batch's keys go; the batch's rows that ``keep`` marks come in."""
        return self._rewritten(
            batch, lambda now, new: without_keys(now, new.select(*self.keys).distinct(), self.keys).unionByName(new.where(keep).drop(keep)), "groups", [keep]
        )

    def folded(self, batch: DataFrame, fold: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """The rows of touched buckets replaced by ``fold(rows, batch)``, which leaves rows of other keys as they are."""
        return self._rewritten(batch, fold, "fold")

    def _same(self, keys: Sequence[str]) -> list[str]:
        if keys and [k.lower() for k in keys] != [k.lower() for k in self.keys]:
            raise ValueError(f"the table is dealt by {self.keys}, not {list(keys)}")
        return self.keys


class PromotedSet:
    """A set of tables whose current versions change together: one log entry names the folders of all of them."""

    _ENTRY = "version bigint, paths map<string,string>"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _last(self):
        return _last_entry(self.spark, self.root, self._ENTRY)

    def read(self) -> dict[str, DataFrame]:
        last = self._last()
        if last is None:
            raise FileNotFoundError(self.root)
        return {name: self.spark.read.parquet(path) for name, path in last["paths"].items()}

    def promote(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Stage all tables, then publish them by one entry; a run that fails before leaves the old set."""
        last = self._last()
        made = {name: f"{self.root}/data/{uuid.uuid4().hex}" for name in tables}
        for name, df in tables.items():
            df.write.parquet(made[name])
        _add_entry(self.spark, self.root, (last["version"] if last else 0) + 1, {"paths": made})
        return self.read()


def merge_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Newest batch row per key replaces the target's row; other target rows stay. Null is a key like any other."""
    last = newest(batch, keys, order_by)
    return without_keys(target, last, keys).unionByName(last)


def without_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the batch does not have; null is a key like any other."""
    gone = batch.select(*[F.col(k).alias(f"__gone_{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__gone_{i}")) for i, k in enumerate(keys)])
    return target.join(gone, same, "left_anti")


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All target rows of the batch's keys go, then the whole batch comes in."""
    return without_keys(target, batch.select(*keys).distinct(), keys).unionByName(batch)


def merge_partitions(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str], partition: str
) -> None:
    """Merge into a partitioned folder, rewriting only the partitions the batch touches, that of null included.

    The partition value must follow from the key, and the folder has the batch's columns and types. New partition
    contents are written to a scratch folder first, so a run that stops half way can be repeated from there.
    """
    from tidewright.session import scratch_path

    touched = batch.select(F.col(partition).alias("__p")).distinct()
    target = spark.read.schema(batch.schema).parquet(path)  # else partition values would be read as what they look like
    named = target.join(touched.where("__p is not null"), F.col(partition) == F.col("__p"), "left_semi")
    unnamed = target.where(F.col(partition).isNull()).join(
        touched.where("__p is null"), F.col(partition).eqNullSafe(F.col("__p")), "left_semi"
    )
    made = scratch_path(spark, "merge")
    _clustered(merge_by_key(named.unionByName(unnamed), batch, keys, order_by), partition).write.partitionBy(partition).parquet(made)
    _clustered(spark.read.schema(batch.schema).parquet(made), partition).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(partition).parquet(path)


def _bytes(spark: SparkSession, path: str) -> int:
    folder, files = hadoop_path(spark, path)
    return files.getContentSummary(folder).getLength()


def _clustered(rows: DataFrame, column: str) -> DataFrame:
    """Rows of one value in few tasks, so that a partitioned write makes few files; AQE splits large values."""
    return rows.hint("rebalance", column)


def incremental_rows(
    source: DataFrame, cursor: str, last: Column | None, upto: Column | None = None, from_last: bool = False
) -> DataFrame:
    """Source rows after the last cursor value, up to a bound fixed at the start of the run.

    ``from_last`` also takes the rows at the last value, and those without a cursor value.
    """
    at, rows = F.col(cursor), source
    if from_last:
        rows = rows.where(at.isNull() | (at >= last)) if last is not None else rows
        return rows.where(at.isNull() | (at <= upto)) if upto is not None else rows
    rows = rows.where(at > last) if last is not None else rows
    return rows.where(at <= upto) if upto is not None else rows


def incremental_append(
    table: VersionedTable,
    source: DataFrame,
    cursor: str,
    initial: Column | None = None,
    upto: Column | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Append the source rows behind the newest cursor value the table holds.

    With ``keys``, rows that arrived late with that very value, or without a value, come in as well, unless the table
    has their key; without keys they cannot be told from those already there and are left out.
    """
    last, seen = initial, None
    if table.exists():
        now, kind = table.read(), source.schema[cursor].dataType
        top = now.agg(F.max(cursor)).first()[0]
        last = F.lit(top).cast(kind) if top is not None else initial
        edge = F.col(cursor).isNull() if top is None else F.col(cursor).isNull() | (F.col(cursor) == last)
        seen = now.where(edge).select(*[F.col(k).alias(f"__k_{k}") for k in keys])
    rows = incremental_rows(source, cursor, last, upto, from_last=bool(keys))
    if keys and seen is not None:
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        rows = rows.join(seen, same, "left_anti")
    return table.append(rows)


def incremental_by_key(
    table: VersionedTable, rows: DataFrame, keys: Sequence[str], recent: Column, full_refresh: bool = False
) -> DataFrame:
    """First run or full refresh: all rows. Later: only rows that meet ``recent``, put in by key."""
    if full_refresh or not table.exists():
        return table.replace(rows)
    return table.merge(rows.where(recent), keys, keys)


def apply_changes(
    target: DataFrame, changes: DataFrame, keys: Sequence[str], sequence: str, op: str, delete: str = "D"
) -> DataFrame:
    """Change rows applied: the last change per key updates, inserts or deletes."""
    last = newest(changes, keys, [sequence])
    changed = last.where(~F.col(op).eqNullSafe(F.lit(delete))).select(*target.columns)
    return without_keys(target, last, keys).unionByName(changed)


def one_per_key(new: DataFrame, key: str) -> None:
    """Raise if a key, null included, has more than one row."""
    twice = new.groupBy(key).count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"{key} {twice[0]!r} occurs {twice['count']} times")


def first_snapshot(new: DataFrame, valid_from: Column) -> DataFrame:
    return new.select("*", valid_from.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))


def scd2(
    history: DataFrame,
    new: DataFrame,
    key: str,
    now: Column,
    check_cols: Sequence[str] | None = None,
    updated_at: str | None = None,
) -> DataFrame:
    """Next state of a slowly changing history.

    A key changes when one of ``check_cols`` differs (null counts as a value) or when its ``updated_at`` is later.
    The open version is closed and the new one opened at ``now``, or at ``updated_at``. Keys missing from ``new``
    stay open, so a second run on the same input changes nothing. A null key is a key like any other; a key that
    occurs twice in ``new`` is an error. A column that one side lacks is null there, so a new checked column with a value
    is a change.
    """
    if (check_cols is None) == (updated_at is None):
        raise ValueError("give either check_cols or updated_at")
    one_per_key(new, key)
    period = T.StructType([T.StructField("valid_from", T.TimestampNTZType()), T.StructField("valid_to", T.TimestampNTZType())])
    before = T.StructType([f for f in history.schema.fields if f.name.lower() not in ("valid_from", "valid_to")])
    whole = union_schema(before, without_void(new.schema))
    new, history = shaped(new, whole), shaped(history, T.StructType([*whole.fields, *period.fields]))
    at = F.col(f"n.{updated_at}").cast("timestamp_ntz") if updated_at else now.cast("timestamp_ntz")
    columns = new.columns
    both = (
        history.where(F.col("valid_to").isNull())
        .alias("o")
        .join(new.withColumn("__new", F.lit(True)).alias("n"), F.col(f"o.{key}").eqNullSafe(F.col(f"n.{key}")), "full_outer")
    )
    known, found = F.col("o.valid_from").isNotNull(), F.col("n.__new").isNotNull()
    if updated_at:
        differs = F.coalesce(F.col(f"n.{updated_at}") > F.col(f"o.{updated_at}"), F.lit(False))
    else:
        differs = F.lit(False)
        for c in check_cols:
            differs = differs | ~F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
    changed = known & found & differs

    never = F.lit(None).cast("timestamp_ntz")
    old = F.struct(
        *[F.col(f"o.{c}").alias(c) for c in columns],
        F.col("o.valid_from").alias("valid_from"),
        F.when(changed, at).otherwise(never).alias("valid_to"),
    )
    opened = F.struct(*[F.col(f"n.{c}").alias(c) for c in columns], at.alias("valid_from"), never.alias("valid_to"))
    versions = F.array(F.when(known, old), F.when(changed | ~known, opened))
    moved = both.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("v")).select("v.*")
    return history.where(F.col("valid_to").isNotNull()).unionByName(moved)


def by_period(rows: DataFrame, ts: str, period: str, start: Column, stop: Column) -> DataFrame:
    """Rows with ``start < ts < stop`` and the number of the period each one falls in.

    Period ``i`` holds ``start + i periods < ts <= start + i + 1 periods``.
    """
    inside = rows.where((F.col(ts) > start) & (F.col(ts) < stop))
    whole = datediff(start, F.col(ts), period)
    # The boundary count is at most one too high for times early in their period, or on its upper edge.
    number = F.when(F.col(ts) <= dateadd(period, whole.cast("int"), start), whole - 1).otherwise(whole)
    return inside.withColumn("period_number", number)


def insert_by_period(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    ts: str,
    period: str,
    start: Column,
    stop: Column,
    resume: bool = False,
) -> DataFrame:
    """Backfill by period in one job: each period is a partition of its own, and a repeat replaces only those.

    ``resume`` takes up at the last period already there, which is filled anew as it may be incomplete. Periods are
    always counted from ``start``, so that must stay the same.
    """
    numbered = by_period(rows, ts, period, start, stop)
    if resume:
        try:
            last = spark.read.parquet(path).agg(F.max("period_number")).first()[0]
        except AnalysisException as err:
            if "PATH_NOT_FOUND" not in str(err) and "UNABLE_TO_INFER_SCHEMA" not in str(err):
                raise
            last = None
        if last is not None:
            numbered = numbered.where(F.col("period_number") >= last)
    _clustered(numbered, "period_number").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "period_number"
    ).parquet(path)
    return spark.read.parquet(path)


def backfill_windows(bounds: DataFrame, start: str, end: str, days: int = 7) -> DataFrame:
    """Windows from ``end`` backwards, each ending one second before the later one starts."""
    step = days * 86400 + 1
    span = datediff(F.col(start), F.col(end), "microsecond")
    last = F.floor((span - 1) / (step * 1_000_000))
    number = F.explode(F.sequence(F.lit(0).cast("bigint"), last))
    made = bounds.where(F.col(start) < F.col(end)).select(start, end, number.alias("chunk_number"))
    upper = F.timestamp_add("SECOND", -F.col("chunk_number") * step, F.col(end))
    lower = F.timestamp_add("DAY", F.lit(-days), upper)
    return made.select(
        "chunk_number", F.greatest(F.col(start), lower).alias("window_from"), upper.alias("window_to")
    )


def chunk_of(ts: Column, end: Column, days: int = 7) -> Column:
    """Number of the backfill window a time belongs to, without joining the windows."""
    step = (days * 86400 + 1) * 1_000_000
    return F.floor(datediff(ts, end, "microsecond") / step)


def chunk_start(number: Column, start: Column, end: Column, days: int = 7) -> Column:
    """First moment of a backfill window."""
    upper = F.timestamp_add("SECOND", -number * (days * 86400 + 1), end)
    return F.greatest(start, F.timestamp_add("DAY", F.lit(-days), upper))


def lookback(rows: DataFrame, column: str, now: Column, days: int | None) -> DataFrame:
    """Rows changed within the last days; None keeps all."""
    return rows if days is None else rows.where(F.col(column) >= dateadd("day", -days, now))


def route(rows: DataFrame, path: str, column: str) -> DataFrame:
    """One folder per value, in one job; folders of values no longer met go. Returns the routed rows.

    Values are folder names, so whoever reads the folders later should pass the schema as well, or texts that look like
    numbers are read as such.
    """
    _clustered(rows, column).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(column).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def materialize(df: DataFrame, kind: str, name: str, root: str) -> DataFrame:
    """``table``: parquet under ``root``; ``view``: session view; ``ephemeral``: the frame itself."""
    spark = df.sparkSession
    if kind == "table":
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind == "ephemeral":
        return df
    raise ValueError(f"unknown kind {kind!r}")
