import datetime as dt
import json
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keytide import KeyedTable, TableError
from keytide.functions import decode as D
from keytide.functions.columns import bucket_id
from keytide.plans.rank import in_order
from keytide.streaming import cdc, sinks


def event(op, before=None, after=None, table="t", ts=0, db="d"):
    return (json.dumps({"before": before, "after": after, "source": {"db": db, "table": table}, "op": op, "ts_ms": ts}),)


ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("value", T.StringType())])


def test_flatten_and_explode(frame, rows):
    raw = frame([
        event("c", after={"id": 1, "value": "a"}), event("u", {"id": 1, "value": "a"}, {"id": 1, "value": "b"}),
        event("d", before={"id": 1, "value": "b"}), event("r", after={"id": 2, "value": "s"}), event("x"), (None,),
    ], "value string")
    events = cdc.parse_events(raw, ROW)
    assert rows(cdc.flatten_envelope(events)) == [
        (1, "a", "insert"), (1, "b", "delete"), (1, "b", "update"), (2, "s", "insert"), (None, None, "unknown"),
    ]
    assert ("unknown",) in rows(cdc.flatten_envelope(events.filter("op = 'r'"), snapshot_reads=False), "op")
    assert rows(cdc.explode_changes(events.filter("op <> 'x'")), "value", "op", "kind") == [
        ("a", "delete", "-U"), ("a", "insert", "+I"), ("b", "delete", "-D"), ("b", "update", "+U"), ("s", "insert", "+I"),
    ]


def test_changes_of_a_hot_key_are_ranked_across_slots(spark):
    n = 5000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id"),
        (F.hash("id") % 1000000).cast("bigint").alias("t"), F.element_at(F.array(*map(F.lit, cdc.KINDS)), (F.col("id") % 4 + 1).cast("int")).alias("kind"),
    )
    got = cdc.order_changes(df, ["k"], "t", ties=["id"]).collect()
    by_key = {}
    for r in got:
        by_key.setdefault(r["k"], []).append(r)
    assert len(got) == n
    for group in by_key.values():
        group.sort(key=lambda r: (r["t"], cdc.KINDS.index(r["kind"]), r["id"]))
        assert [r["rank"] for r in group] == list(range(1, len(group) + 1))


def test_one_moment_of_a_hot_key_is_ranked_by_many_tasks(spark):
    """All changes of a key in one millisecond, some of them equal in every column; a NULL key and NULL times beside it."""
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    n = 4000
    df = spark.range(n).select(
        F.when(F.col("id") % 4 != 0, F.lit(7)).when(F.col("id") % 8 == 0, F.col("id")).alias("k"),
        F.when(F.col("id") % 16 != 0, F.lit(1700000000000)).cast("bigint").alias("t"),
        F.lit("+I").alias("kind"), (F.col("id") - F.col("id") % 3).alias("seq"),
    )
    spark.conf.set(coalesce, "false")
    try:
        placed = in_order(df, ["k"], [F.col("t"), F.col("seq")])
        assert placed.filter("k = 7").select(F.shiftright("__at", 33)).distinct().count() > 1
        got = cdc.order_changes(df, ["k"], "t", ties=["seq"]).collect()
    finally:
        spark.conf.unset(coalesce)
    by_key = {}
    for r in got:
        by_key.setdefault(r["k"], []).append(r)
    assert len(got) == n and len(by_key[7]) == 3000
    for group in by_key.values():
        group.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in group] == list(range(1, len(group) + 1))
        order = [(r["t"] is not None, r["t"] or 0, r["seq"]) for r in group]
        assert order == sorted(order)


def test_ranks_of_no_rows(spark):
    none = spark.range(0).select(F.col("id").alias("k"), F.col("id").alias("t"), F.lit("+I").alias("kind"))
    assert cdc.order_changes(none, ["k"], "t").collect() == []


CDC = "range string, hash string, op string"


def test_cdc_merge_drops_deleted_keys(spark, frame, root, rows):
    first = frame([("r1", f"h{i}", "insert") for i in range(4)] + [("r2", "h1", "insert"), ("r2", "h2", None)], CDC)
    t = KeyedTable.create(spark, root, first, ["range"], ["hash"], 2, cdc_col="op")
    t.upsert(frame([("r1", "h1", "delete"), ("r1", "h3", "update")], CDC))
    t.upsert(frame([("r2", "h1", "delete"), ("r1", "h1", "insert")], CDC))
    assert rows(t.read_cdc(), "range", "hash", "op") == [
        ("r1", "h0", "insert"), ("r1", "h1", "insert"), ("r1", "h2", "insert"), ("r1", "h3", "update")]
    t.compact()
    assert t.read_cdc().count() == 4 and t.read().count() == 6


def test_typed_decode(frame, rows):
    specs = {
        "value5": D.FieldSpec(D.DATE), "value6": D.FieldSpec(D.YEAR), "value7": D.FieldSpec(D.DECIMAL, 10, 0),
        "value8": D.FieldSpec(D.DECIMAL, 9, 4), "value1": D.FieldSpec("bytes"), "range": D.FieldSpec("int16"),
    }
    df = frame([(19255, 2022, "Hg==", "BjRI", "dGVzdA==", 2)],
               "value5 int, value6 int, value7 string, value8 string, value1 string, range smallint")
    out = D.decode_envelope(df, specs)
    assert out.schema["range"].dataType == T.IntegerType()
    assert rows(out) == [(dt.date(2022, 9, 20), 2022, Decimal(30), Decimal("40.6600"), bytearray(b"test"), 2)]


@pytest.mark.parametrize("precision,scale", [(9, 0), (18, 4), (20, 2), (38, 0), (38, 10), (30, 7)])
def test_decimal_bytes(spark, frame, precision, scale):
    import base64

    top = 10**precision - 1
    numbers = [0, 1, -1, 127, 128, -128, -129, 255, 256, -32768, 10**8 + 7, -(10**8) - 7, top, -top]
    data = []
    for n in numbers:
        size = max(1, (n.bit_length() + 8) // 8)
        data += [(n, base64.b64encode(n.to_bytes(s, "big", signed=True)).decode()) for s in (size, size + 1, 17)]
    df = frame([(str(n), b) for n, b in data], "n string, b string")
    out = D.decode_envelope(df, {"b": D.FieldSpec(D.DECIMAL, precision, scale)}).collect()
    with localcontext(prec=60):
        for r in out:
            assert r["b"] == Decimal(r["n"]).scaleb(-scale), r


def test_times_before_1970_round_down_in_any_session_zone(spark, frame):
    specs = {"us": D.FieldSpec(D.TIMESTAMP_MICROS), "ms": D.FieldSpec(D.TIMESTAMP_MILLIS), "ns": D.FieldSpec(D.TIMESTAMP_NANOS),
             "z": D.FieldSpec(D.ZONED_TIMESTAMP), "tn": D.FieldSpec(D.TIME_NANOS), "tm": D.FieldSpec(D.TIME_MILLIS)}
    df = frame([(-1, -1, -1, "2020-01-01T00:00:00Z", 1999, 5)], "us bigint, ms bigint, ns bigint, z string, tn bigint, tm bigint")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = D.decode_envelope(df, specs, "Asia/Shanghai").first()
            assert r["us"] == r["ns"] == dt.datetime(1969, 12, 31, 23, 59, 59, 999999)
            assert r["ms"] == dt.datetime(1969, 12, 31, 23, 59, 59, 999000)
            assert r["z"] == dt.datetime(2020, 1, 1, 8)
            assert (r["tn"], r["tm"]) == (1, 5000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_field_specs_from_a_schema_block():
    shaded = "com.example.shaded." + D.DECIMAL
    assert D.field_spec("bytes", shaded, {"scale": "4", "connect.decimal.precision": "9"}) == D.FieldSpec(D.DECIMAL, 9, 4)
    assert D.field_spec("int32", D.DATE).kind == D.DATE
    assert D.field_spec("int16") == D.FieldSpec("int16")
    assert D.field_spec("string", "io.debezium.data.Enum") == D.FieldSpec("string")
    assert cdc.wire_schema({"a": D.FieldSpec(D.DATE), "b": D.FieldSpec("bytes")}).simpleString() == "struct<a:int,b:string>"


def test_source_types(frame, rows):
    kinds = ["int", "BIGINT", "varchar(255)", "decimal(10, 2)", "numeric", "geometry", "json", "char(1)", "tinyblob", "bit(2)"]
    df = frame([("t", f"c{i}", i, k) for i, k in enumerate(kinds)], "table_name string, column_name string, position int, source_type string")
    got = {r["source_type"]: r["table_type"] for r in D.schema_from_source(df).collect()}
    assert got == {"int": "int", "BIGINT": "bigint", "varchar(255)": "string", "decimal(10, 2)": "decimal(10,2)",
                   "numeric": "decimal(9,3)", "geometry": None, "json": None, "char(1)": "char(1)", "tinyblob": "binary",
                   "bit(2)": None}
    assert D.struct_of([("a", "int"), ("b", "decimal(9,3)")]).simpleString() == "struct<a:int,b:decimal(9,3)>"


def test_split_ddl_and_schema_sync(spark, frame, root, rows):
    raw = frame([
        event("c", after={"id": 1}),
        (json.dumps({"source": {"db": "d", "table": "t"}, "historyRecord": json.dumps({"ddl": "ALTER TABLE t ADD c INT"})}),),
        (json.dumps({"databaseName": "d", "ddl": "insert into x values (1)"}),),
        (json.dumps({"databaseName": "d2", "ddl": " create table y (a int)"}),),
    ], "value string")
    dml, ddl = cdc.split_ddl(raw)
    assert dml.count() == 1
    assert rows(ddl, "db", "table", "statement") == [("d", "t", "alter"), ("d2", None, "create")]
    t = KeyedTable.create(spark, root, frame([(1, "a")], "id bigint, value string"), keys=["id"], buckets=1)
    assert sinks.sync_schema(t, frame([], "id bigint, value string, extra int").schema)
    assert not sinks.sync_schema(t, frame([], "id bigint, extra int").schema)
    assert t.spec().columns == ["id", "value", "extra"]
    with pytest.raises(TableError):
        sinks.sync_schema(t, frame([], "id string").schema)


def test_bucket_ids_are_those_of_repartition(spark):
    df = spark.range(1000).withColumn("b", bucket_id(["id"], 7)).repartition(7, "id")
    assert df.filter(F.col("b") != F.spark_partition_id()).count() == 0
