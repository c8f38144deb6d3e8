"""Types that grow: inference from landed JSON, the lattice, and tables whose versions differ in schema."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidewright.sources import schemas
from tidewright.sources.load import ConcurrentLoad, VersionedTable
from tidewright.sources.schemas import BrokenLines, SchemaConflict, infer_json, parse_json, shaped, union_schema, wider


def ddl(text):
    return T.DataType.fromDDL(text)


def lines(spark, *values):
    return spark.createDataFrame([(v if v is None or isinstance(v, str) else json.dumps(v),) for v in values], "value string")


@pytest.mark.parametrize(
    "a, b, both",
    [
        ("int", "bigint", "bigint"),
        ("tinyint", "smallint", "smallint"),
        ("int", "decimal(4,2)", "decimal(12,2)"),
        ("bigint", "decimal(38,20)", "double"),
        ("decimal(5,1)", "decimal(4,3)", "decimal(7,3)"),
        ("bigint", "double", "double"),
        ("float", "int", "double"),
        ("decimal(3,1)", "string", "string"),
        ("boolean", "int", "string"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("timestamp", "date", "timestamp"),
        ("void", "array<int>", "array<int>"),
        ("array<int>", "array<double>", "array<double>"),
        ("map<string,int>", "map<string,string>", "map<string,string>"),
        ("struct<a:int,B:string>", "struct<b:int,c:date>", "struct<a:int,B:string,c:date>"),
    ],
)
def test_wider_types(spark, a, b, both):
    assert wider(ddl(a), ddl(b)) == ddl(both)
    if "struct" not in a:
        assert wider(ddl(b), ddl(a)) == ddl(both)


@pytest.mark.parametrize("a, b", [("int", "struct<a:int>"), ("array<int>", "string"), ("binary", "int"), ("array<int>", "array<map<int,int>>")])
def test_conflicts_name_the_place(spark, a, b):
    with pytest.raises(SchemaConflict, match="(?i)x.y"):
        union_schema(ddl(f"struct<x:struct<y:{a}>>"), ddl(f"struct<X:struct<Y:{b}>>"))


def test_shapes(spark):
    df = spark.sql("select 1 as A, named_struct('x', 1, 'y', 'p') as s, array(named_struct('v', 1), null) as l, map('k', 1) as m")
    want = ddl("struct<a:double,s:struct<z:int,X:bigint>,l:array<struct<v:string,w:int>>,m:map<string,double>,new:date>")
    got = shaped(df, want)
    assert got.schema.simpleString() == want.simpleString()
    row = got.first()
    assert (row.a, tuple(row.s), [r and tuple(r) for r in row.l], row.m, row.new) == (1.0, (None, 1), [("1", None), None], {"k": 1.0}, None)
    nothing = spark.sql("select cast(null as struct<x:int>) as s")
    assert shaped(nothing, ddl("struct<s:struct<x:bigint,y:int>>")).first().s is None


def test_inference_from_all_lines(spark):
    found = infer_json(
        lines(spark, {"a": 1, "b": {"c": [1, 2.5]}, "n": None}, {"a": 2.25, "V": 1}, {"v": "x", "b": {"d": True}, "e": []}, None, " ", '{"x y": 1e300}')
    )
    assert {f.name: f.dataType.simpleString() for f in found.fields} == {
        "a": "decimal(22,2)", "b": "struct<c:array<decimal(21,1)>,d:boolean>", "V": "bigint", "v": "string", "x y": "double",
    }
    assert infer_json(lines(spark)) == T.StructType() and infer_json(lines(spark, {}, None)) == T.StructType()


def test_plain_values_mix_as_text(spark):
    data = lines(spark, '{"a":[1.50,"x"],"b":true}', '{"a":[false],"b":"1e3"}', '{"b":1.0}')
    found = infer_json(data)
    assert found.simpleString() == "struct<a:array<string>,b:string>"
    assert rows(parse_json(data, found)) == [(None, "1.0"), (["1.5", "x"], "true"), (["false"], "1e3")]


@pytest.mark.parametrize("a, b", [({"k": 1}, {"k": {"x": 1}}), ({"k": [1]}, {"k": "s"}), ({"k": [1]}, {"k": [{"x": 1}]}), ({"o": {"x": 1, "X": 2}}, {})])
def test_conflicts_within_a_batch(spark, a, b):
    with pytest.raises(SchemaConflict):
        infer_json(lines(spark, a, b))


def test_broken_lines_are_errors(spark):
    with pytest.raises(BrokenLines, match="^2 "):
        infer_json(lines(spark, {"a": 1}, "[1]", "{oops"))


def test_spellings_of_one_name(spark):
    data = lines(spark, {"Key": 1, "v": "a"}, {"key": 2, "V": "b"}, {"KEY": None, "key": 3})
    assert rows(parse_json(data, infer_json(data))) == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(ValueError):
        parse_json(data.withColumn("V", F.lit(1)), infer_json(data), keep=["V"])


_VALUES = st.one_of(st.none(), st.integers(-(2**40), 2**40), st.sampled_from([0.5, 1.25, -7.75]), st.text("ab1", max_size=3), st.booleans())
_OBJECTS = st.lists(st.dictionaries(st.sampled_from(["a", "b", "c d", "é"]), _VALUES, max_size=4), min_size=1, max_size=6)


@settings(max_examples=15, deadline=None)
@given(data=_OBJECTS)
def test_every_value_is_read(spark, data):
    frame = lines(spark, *data).repartition(2)
    found = infer_json(frame)
    got = sorted(map(str, (r.asDict() for r in parse_json(frame, found).collect())))
    kinds = {f.name: f.dataType for f in found.fields}

    def cell(name, v):
        if v is None or isinstance(kinds[name], T.BooleanType):
            return v
        if isinstance(kinds[name], T.StringType):
            return v if isinstance(v, str) else json.dumps(v)  # numbers as Spark writes them, which is the same for these
        scale = getattr(kinds[name], "scale", None)
        return round(Decimal(str(v)), scale).quantize(Decimal(1).scaleb(-scale)) if scale else Decimal(v) if scale == 0 else v

    assert set(kinds) == {k for d in data for k, v in d.items() if v is not None}
    assert got == sorted(str({n: cell(n, d.get(n)) for n in kinds}) for d in data)


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "table"))


def test_appends_grow_the_schema(spark, table):
    """A new column in every order of files, a wider type, a missing column."""
    table.append(spark.createDataFrame([(1, 1)], "k int, v int"))
    table.append(spark.createDataFrame([(2, 2.5, "x")], "k bigint, V double, w string"))
    table.append(spark.createDataFrame([(3,)], "k int"))
    want = [(1, 1.0, None), (2, 2.5, "x"), (3, None, None)]
    assert table.read().schema.simpleString() == "struct<k:bigint,v:double,w:string>"
    for _ in range(3):
        assert rows(table.read()) == want
    assert rows(table.read().where("v > 2")) == [(2, 2.5, "x")]
    assert rows(table.clone_to(table.root + "-copy").read()) == want
    assert table.schema().simpleString() == "struct<k:bigint,v:double,w:string>"


def test_int_after_long_is_read(spark, table):
    table.append(spark.createDataFrame([(2**40,)], "k bigint"))
    table.append(spark.createDataFrame([(7,)], "k int"))
    assert sorted(r.k for r in table.read().collect()) == [7, 2**40]


def test_a_conflict_leaves_the_table(spark, table, tmp_path):
    table.append(spark.createDataFrame([(1, 1)], "k int, v int"))
    folders = set((tmp_path / "table" / "data").iterdir())
    with pytest.raises(SchemaConflict):
        table.append(spark.createDataFrame([(2, [1])], "k int, v array<int>"))
    assert set((tmp_path / "table" / "data").iterdir()) == folders
    assert rows(table.read()) == [(1, 1)]


def test_json_batches(spark, table):
    table.append_json(lines(spark, {"id": 1, "v": 1, "empty": None}))
    table.append_json(lines(spark, {"id": 2, "v": "n2", "more": {"x": 1.5}}, {"ID": 3}))
    table.append_json(lines(spark, {"id": 4, "v": 4.0, "more": {"x": 2, "y": []}}))
    got = table.read()
    assert got.schema["v"].dataType == T.StringType() and got.schema["more"].dataType.simpleString().startswith("struct<x:decimal")
    values = sorted((r.id, r.v, r.more and float(r.more.x)) for r in got.collect())
    assert values == [(1, "1", None), (2, "n2", 1.5), (3, None, None), (4, "4.0", 2.0)]
    with pytest.raises(SchemaConflict):
        table.append_json(lines(spark, {"id": 5, "more": 1}))
    with pytest.raises(BrokenLines):
        table.append_json(lines(spark, "{"))
    assert table.read().count() == 4


def test_two_writers_of_one_version(spark, table):
    table.replace(spark.createDataFrame([(1,)], "k int"))
    other = VersionedTable(spark, table.root)
    path = other.stage(spark.createDataFrame([(2,)], "k int"))
    table.append(spark.createDataFrame([(3,)], "k int"))
    with pytest.raises(ConcurrentLoad):
        other.publish([path], "replace", after=1)
    assert rows(table.read()) == [(1,), (3,)]


def test_logs_of_an_earlier_form_are_read(spark, tmp_path):
    root = str(tmp_path / "old")
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(f"{root}/data/x")
    entry = spark.createDataFrame([(1, [f"{root}/data/x"], "replace")], "version bigint, paths array<string>, mode string")
    entry.write.json(f"{root}/log")
    table = VersionedTable(spark, root)
    assert rows(table.read()) == [(1, "a")]
    assert rows(table.append(spark.createDataFrame([(2, 1.5)], "k int, w double"))) == [(1, "a", None), (2, None, 1.5)]


def test_columns_without_a_type_are_left_out(spark, table):
    table.append(spark.sql("select 1 as k, null as v, struct(null as x) as s, array() as l"))
    assert table.read().columns == ["k"]
    assert schemas.without_void(ddl("map<string,void>")) is None
