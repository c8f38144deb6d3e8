"""Schemas of landed data: found from all rows, merged over versions, and rows brought into the merged shape.

Types form a lattice: whole numbers < decimal < double < text by value range, dates < timestamps < text, structs field by
field in any spelling, arrays and maps by their parts. What has no common type (a struct and a number, say) is a conflict.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_FRACTIONS = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)
_TEXT = (T.StringType, T.CharType, T.VarcharType)
_PLAIN = (*_DIGITS, *_FRACTIONS, *_TIMES, *_TEXT, T.DecimalType, T.BooleanType)


class SchemaConflict(Exception):
    """Two types of one column have no common type."""


class BrokenLines(Exception):
    """Lines that are no JSON objects."""


def _digits(t: T.DataType) -> tuple[int, int] | None:
    """Digits before and behind the point that a type has to hold."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return (_DIGITS[type(t)], 0) if type(t) in _DIGITS else None


def wider(a: T.DataType, b: T.DataType, path: str = "") -> T.DataType:
    """The least type that holds the values of both; ``double`` holds whole numbers beyond 2^53 only roughly."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return union_schema(a, b, path)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType, f"{path}[]"))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(wider(a.keyType, b.keyType, f"{path}.key"), wider(a.valueType, b.valueType, f"{path}.value"))
    if not isinstance(a, _PLAIN) or not isinstance(b, _PLAIN):
        raise SchemaConflict(f"{path or 'value'}: {a.simpleString()} and {b.simpleString()}")
    x, y = _digits(a), _digits(b)
    if x and y:
        if type(a) in _DIGITS and type(b) in _DIGITS:
            return a if x > y else b
        whole, scale = max(x[0], y[0]), max(x[1], y[1])
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    numbers = [x or isinstance(a, _FRACTIONS), y or isinstance(b, _FRACTIONS)]
    if all(numbers):
        return T.DoubleType()
    if isinstance(a, _TIMES) and isinstance(b, _TIMES) and T.DateType in (type(a), type(b)):
        return b if isinstance(a, T.DateType) else a
    return T.StringType()


def union_schema(a: T.StructType, b: T.StructType, path: str = "") -> T.StructType:
    """Fields of both in the order met; names that differ in case only are one field, spelled as first met."""
    made: dict[str, T.StructField] = {}
    for field in [*a.fields, *b.fields]:
        low, place = field.name.lower(), f"{path}.{field.name}".lstrip(".")
        kind = wider(made[low].dataType, field.dataType, place) if low in made else field.dataType
        made[low] = T.StructField(made[low].name if low in made else field.name, kind)
    return T.StructType(list(made.values()))


def without_void(kind: T.DataType) -> T.DataType | None:
    """The type without parts that only ever were null; None if nothing is left."""
    if isinstance(kind, T.NullType):
        return None
    if isinstance(kind, T.StructType):
        left = [(f.name, without_void(f.dataType)) for f in kind.fields]
        left = [T.StructField(n, t) for n, t in left if t is not None]
        return T.StructType(left) if left else None
    if isinstance(kind, T.ArrayType):
        inner = without_void(kind.elementType)
        return T.ArrayType(inner) if inner is not None else None
    if isinstance(kind, T.MapType):
        inner = without_void(kind.valueType)
        return T.MapType(kind.keyType, inner) if inner is not None else None
    return kind


def _as(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        by_name = {f.name.lower(): f for f in have.fields}
        fields = []
        for f in want.fields:
            own = by_name.get(f.name.lower())
            part = _as(value.getField(own.name), own.dataType, f.dataType) if own else F.lit(None).cast(f.dataType)
            fields.append(part.alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: _as(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        keyed = F.transform_keys(value, lambda k, _: _as(k, have.keyType, want.keyType))
        return F.transform_values(keyed, lambda _, v: _as(v, have.valueType, want.valueType))
    return value.cast(want)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name in any case, cast to its types; those the frame lacks are null, others go."""
    have = {f.name.lower(): f for f in df.schema.fields}
    return df.select(
        *[
            (
                _as(F.col(_quoted(have[f.name.lower()].name)), have[f.name.lower()].dataType, f.dataType)
                if f.name.lower() in have
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )


def _variants(kind: T.DataType, steps: tuple = ()) -> list[tuple]:
    """Places whose values had no common type; a step is a field's name, or None for an array's elements."""
    if isinstance(kind, T.VariantType):
        return [steps]
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in _variants(f.dataType, (*steps, f.name))]
    return _variants(kind.elementType, (*steps, None)) if isinstance(kind, T.ArrayType) else []


def _kinds(value: Column, steps: tuple) -> Column:
    """What stands at a place of one row's value, as an array of type names."""
    if not steps:
        return F.array(F.schema_of_variant(value))
    if steps[0] is None:
        return F.flatten(F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda x: _kinds(x, steps[1:])))
    mark = '"' if "'" in steps[0] else "'"
    return _kinds(F.try_variant_get(value, f"$[{mark}{steps[0]}{mark}]", "variant"), steps[1:])


def _place(steps: tuple) -> str:
    return "".join("[]" if s is None else f".{s}" for s in steps).lstrip(".")


def _with_text(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.VariantType):
        return T.StringType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _with_text(f.dataType)) for f in kind.fields])
    return T.ArrayType(_with_text(kind.elementType)) if isinstance(kind, T.ArrayType) else kind


def _spelled_once(kind: T.DataType, path: str = "") -> None:
    """Fields below the top that differ in case only cannot be told apart when read."""
    if isinstance(kind, T.StructType):
        if len({f.name.lower() for f in kind.fields}) < len(kind.fields):
            raise SchemaConflict(f"{path}: fields that differ in case only")
        for f in kind.fields:
            _spelled_once(f.dataType, f"{path}.{f.name}")
    elif isinstance(kind, T.ArrayType):
        _spelled_once(kind.elementType, f"{path}[]")


def infer_json(lines: DataFrame, column: str = "value") -> T.StructType:
    """Schema that fits the JSON objects of all lines, from one aggregation (a second one if types were mixed).

    Numbers are whole, decimal or double; mixed plain types are text; a place that never held a value is left out. Names
    keep their spelling. Null and blank lines are skipped; other lines that are no JSON objects are an error, and so are
    structs, arrays and plain values that meet in one place.
    """
    text = F.col(column)
    parsed = lines.where(F.trim(text) != "").select(F.try_parse_json(text).alias("v"))
    whole = F.coalesce(F.schema_of_variant("v").startswith("OBJECT<"), F.lit(False))
    found = parsed.agg(F.schema_of_variant_agg(F.when(whole, F.col("v"))).alias("s"), F.count_if(~whole).alias("broken")).first()
    if found["broken"]:
        raise BrokenLines(f"{found['broken']} lines of {column} are no JSON objects")
    # Type names as DDL has them; quoted field names stay as they are.
    ddl = re.sub(r"(`(?:[^`]|``)*`)|OBJECT<", lambda m: m[1] or "STRUCT<", found["s"])
    kind = T.DataType.fromDDL(ddl) if ddl not in ("VOID", "STRUCT<>") else T.StructType()
    mixed = _variants(kind)
    if mixed:
        tests = {"struct": lambda k: k.startswith("OBJECT<"), "array": lambda k: k.startswith("ARRAY<")}
        tests["plain"] = lambda k: ~k.startswith("OBJECT<") & ~k.startswith("ARRAY<") & (k != "VOID")
        seen = parsed.agg(
            *[F.max(F.exists(_kinds(F.col("v"), p), t)).alias(f"{i}_{n}") for i, p in enumerate(mixed) for n, t in tests.items()]
        ).first()
        for i, p in enumerate(mixed):
            met = [n for n in tests if seen[f"{i}_{n}"]]
            if len(met) > 1:
                raise SchemaConflict(f"{_place(p)}: {' and '.join(met)}")
        kind = _with_text(kind)
    kind = without_void(kind) or T.StructType()
    for f in kind.fields:
        _spelled_once(f.dataType, f.name)
    return kind


def _retyped(have: T.DataType, want: T.DataType) -> T.DataType:
    """The fields of ``have`` with the types that ``want`` gives them."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        kinds = {f.name.lower(): f.dataType for f in want.fields}
        return T.StructType([T.StructField(f.name, _retyped(f.dataType, kinds[f.name.lower()])) for f in have.fields])
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return T.ArrayType(_retyped(have.elementType, want.elementType))
    return want


def parse_json(
    lines: DataFrame, schema: T.StructType, column: str = "value", within: T.StructType | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Rows of JSON objects with the columns of ``schema``, which ``infer_json`` found, and the ``keep`` columns.

    Types are those of ``within`` where that has the column; text takes numbers as Spark writes them. Names that differ in
    case only become one column with the first value that is not null.
    """
    merged = union_schema(T.StructType(), schema)
    double = {f.name.lower() for f in merged.fields} & {k.lower() for k in keep}
    if double:
        raise ValueError(f"columns to keep that the objects have as well: {sorted(double)}")
    target = _retyped(merged, union_schema(within, merged)) if within is not None else merged
    spellings: dict[str, list[str]] = {}
    for f in schema.fields:
        spellings.setdefault(f.name.lower(), []).append(f.name)
    kinds = {f.name.lower(): f.dataType for f in target.fields}
    # Spark cannot tell fields apart by case, so each further spelling is parsed on its own.
    rounds = max([len(s) for s in spellings.values()], default=0)
    reads = [T.StructType([T.StructField(s[i], kinds[low]) for low, s in spellings.items() if i < len(s)]) for i in range(rounds)]
    rows = lines.where(F.trim(F.col(column)) != "").select(*keep, *[F.from_json(column, s).alias(f"__{i}") for i, s in enumerate(reads)])
    columns = [
        F.coalesce(*[F.col(f"__{i}").getField(name) for i, name in enumerate(spellings[f.name.lower()])]).alias(f.name) for f in target.fields
    ]
    return rows.select(*keep, *columns)


def merged_frames(frames: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """All rows in one shape."""
    return reduce(DataFrame.unionAll, [shaped(df, schema) for df in frames])
