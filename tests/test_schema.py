from decimal import Decimal

import pytest
from pyspark.sql import types as T

from keytide import KeyedTable, TableError
from keytide.functions.columns import parse_partition_desc, partition_desc
from keytide.plans import schema as S


def test_union_evolve_merges_structs_and_widens(frame, rows):
    a = frame([(1, {"x": 1})], "k smallint, s struct<x: int>")
    b = frame([(2, {"X": 2, "y": "b"}, "n")], "K int, s struct<X: int, y: string>, note string")
    out = S.union_evolve([a, b])
    assert out.schema.simpleString() == "struct<k:int,s:struct<x:int,y:string>,note:string>"
    assert rows(out.select("k", "s.x", "s.y", "note")) == [(1, 1, None, None), (2, 2, "b", "n")]


@pytest.mark.parametrize("left,right", [
    ("k int", "k string"), ("k int", "k bigint"), ("d decimal(10,2)", "d decimal(12,2)"),
    ("d decimal(10,2)", "d decimal(10,3)"), ("s struct<a: int>", "s struct<a: string>"),
])
def test_types_that_do_not_merge(frame, left, right):
    with pytest.raises(TableError):
        S.union_evolve([frame([], left), frame([], right)])


def test_migrate_positions_and_nested_places(frame, rows):
    df = frame([(1, "a", [{"p": 1}], {"m": {"q": 2}})],
               "v1 int, v2 string, arr array<struct<p: int>>, mp map<string, struct<q: int>>")
    out = S.migrate(df, [
        S.add_column("v3", "bigint", first=True), S.add_column("v4", "string", after="v1"), S.add_column("v5", "int"),
        S.add_column("arr.element.r", "int"), S.add_column("mp.value.w", "string"), S.comment_column("v1", "first"),
    ])
    assert out.columns == ["v3", "v1", "v4", "v2", "arr", "mp", "v5"]
    assert out.schema["arr"].dataType.simpleString() == "array<struct<p:int,r:int>>"
    assert out.schema["mp"].dataType.simpleString() == "map<string,struct<q:int,w:string>>"
    assert out.schema["v1"].metadata == {"comment": "first"}
    assert rows(out.selectExpr("v3", "v1", "v4", "arr[0].p", "arr[0].r", "mp['m'].q", "v5")) == [
        (None, 1, None, 1, None, 2, None)]
    for bad in ({"do": "rename", "path": "v1"}, S.retype_column("v1", "string"), S.add_column("V1", "int"),
                S.add_column("n", "int", nullable=False), S.move_column("none", first=True)):
        with pytest.raises(TableError):
            S.migrate(df, [bad])
    assert S.without_column(out, "arr").columns == ["v3", "v1", "v4", "v2", "mp", "v5"]


def test_altered_table_reads_null_for_new_columns(spark, frame, root, rows):
    t = KeyedTable.create(spark, root, frame([(1, 2)], "k int, v int"), keys=["k"], buckets=1)
    t.alter([S.add_column("w", "string", after="k")])
    assert rows(t.read(), "k", "v", "w") == [(1, 2, None)]
    t.upsert(frame([(1, "x")], "k int, w string"))
    assert rows(t.read(), "k", "v", "w") == [(1, 2, "x")]


def test_drift_report(spark, frame):
    expected = T.StructType.fromDDL("a int, b string, c struct<d: int>, e array<int>").add("n", T.IntegerType(), False)
    actual = T.StructType.fromDDL("A int, b bigint, c struct<d: int, x: int>, n int")
    got = {r["path"]: (r["differences"], r["read_compatible"]) for r in S.drift_report(spark, expected, actual).collect()}
    assert got == {
        "a": ("case", False), "b": ("type", False), "c.x": ("extra", True), "e": ("missing", False),
        "e[]": ("missing", False), "n": ("nullability", False),
    }


def test_constraints_fail_writes(spark, frame, root):
    inner = T.StructType([T.StructField("x", T.IntegerType(), False)])
    schema = T.StructType([
        T.StructField("a", T.LongType()), T.StructField("b", T.StringType(), False), T.StructField("s", inner),
        T.StructField("c", T.IntegerType(), True, {"check": "c > 0"}),
    ])
    t = KeyedTable.define(spark, root, schema)
    ddl = "a bigint, b string, s struct<x: int>, c int"
    t.append(frame([(1, "b", {"x": 1}, 1), (2, "b", None, 2)], ddl))
    for bad, name in (((1, None, {"x": 1}, 1), "b"), ((1, "b", {"x": None}, 1), "s.x"), ((1, "b", {"x": 1}, 0), "c > 0"),
                      ((1, "b", {"x": 1}, None), "c > 0")):
        with pytest.raises(TableError, match=name):
            t.append(frame([bad], ddl))
    with pytest.raises(TableError, match="NOT NULL columns"):
        t.append(frame([(1,)], "a bigint"))
    assert t.read().count() == 2


def test_audit_counts_false_and_null(frame, rows):
    df = frame([(1,), (-1,), (None,)], "v int")
    assert rows(S.audit(df, S.expr_rules({"positive": "v > 0"}) | {"null": df["v"].isNull()})) == [
        ("null", 1), ("positive", 2)]


def test_normalize_and_drop_null_type(spark, frame):
    schema = frame([], "Key int, s struct<A: int>").schema
    assert S.normalize_columns(frame([], "KEY int"), schema).columns == ["Key"]
    with pytest.raises(TableError, match="not in the table"):
        S.normalize_columns(frame([], "other int"), schema)
    with pytest.raises(TableError, match="nested"):
        S.normalize_columns(frame([], "Key int, s struct<a: int>"), schema)
    deep = frame([], "Key int, s struct<A: int, B: struct<C: int>>").schema
    with pytest.raises(TableError, match=r"s\.a.*s\.b\.c"):  # mixed depths, all reported
        S.normalize_columns(frame([], "KEY int, s struct<a: int, B: struct<c: int>>"), deep)
    df = spark.sql("select 1 a, null n, named_struct('x', 1, 'y', null) s")
    assert S.drop_null_type(df).schema.simpleString() == "struct<a:int,s:struct<x:int>>"
    with pytest.raises(TableError, match="untyped NULL"):
        S.drop_null_type(spark.sql("select array(null) a"))


def test_partition_descriptors(frame, rows):
    df = frame([(1, "x")], "b int, a string")
    d = df.select(partition_desc(["b", "a"]).alias("d"), partition_desc([]).alias("none"))
    assert rows(d) == [("a=x,b=1", "-5")]
    back = d.select(parse_partition_desc(d["d"])["b"], parse_partition_desc(d["none"]).isNotNull())
    assert rows(back) == [("1", True)]


@pytest.mark.parametrize("values,want", [
    (["1", "2"], "int"), (["1", "3000000000"], "bigint"), (["1", "99999999999999999999"], "decimal"),
    (["1.5", "2"], "double"), (["1.5", "3000000000"], "string"), (["2020-01-01"], "date"),
    (["2020-01-01 10:00:00", "2020-01-02"], "timestamp"), (["1", "x"], "string"), (["2020-01-01", "5"], "string"),
    (["__HIVE_DEFAULT_PARTITION__", "7"], "int"), (["__HIVE_DEFAULT_PARTITION__"], "void"), (["2020-13-01"], "string"),
    (["1e3"], "double"), (["007"], "int"),
])
def test_partition_value_types(frame, values, want):
    paths = frame([(f"root/c={v}/f.parquet",) for v in values], "path string")
    assert [r["type"] for r in S.infer_partition_types(paths).collect()] == [want]
    assert Decimal(S.infer_partition_types(paths).first()["values"]) == len(values)
