import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keytide import KeyedTable, TableError
from keytide.streaming import cdc, sinks


@pytest.fixture
def feed(spark, tmp_path):
    """Batches of JSON rows, one file and one micro-batch each."""
    folder = tmp_path / "feed"
    folder.mkdir()

    class Feed:
        count = 0

        def add(self, *records):
            self.count += 1
            path = folder / f"{self.count:04d}.json"
            path.write_text("\n".join(json.dumps(r) for r in records) + "\n")
            os.utime(path, (self.count, self.count))

        def stream(self, ddl):
            return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).json(str(folder))

        text_dir = str(folder)

    return Feed()


INT, TEXT = T.IntegerType(), T.StringType()


def finish(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def test_append_keyed_duplicates_and_replay(spark, feed, frame, root, rows):
    feed.add({"range": 1, "hash": 1, "value": 1})
    feed.add({"range": 1, "hash": 2, "value": 2}, {"range": 1, "hash": 2, "value": 2})
    feed.add({"range": 1, "hash": 3, "value": 3})
    ddl = "range int, hash int, value int"
    t = KeyedTable.define(spark, root, frame([], ddl).schema, ["range"], ["hash"], 2)
    for i in range(2):
        finish(sinks.write_stream(feed.stream(ddl), root, "q", f"{root}-cp{i}"))
    assert rows(t.read(), "hash") == [(1,), (2,), (3,)]
    assert t.state().partitions["range=1"].version == 2


def test_complete_and_update_modes(spark, feed, frame, root, rows):
    for k in (1, 1, 2):
        feed.add({"k": k})
    counts = feed.stream("k int").groupBy().agg(F.count(F.lit(1)).alias("n"))
    t = KeyedTable.define(spark, f"{root}-c", counts.schema)
    finish(sinks.write_stream(counts, t.root, "c", f"{root}-ccp", mode="complete"))
    assert rows(t.read()) == [(3,)]
    assert t.state().partitions["-5"].version == 2
    per_key = feed.stream("k int").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    u = KeyedTable.define(spark, f"{root}-u", per_key.schema, keys=["k"], buckets=1)
    finish(sinks.write_stream(per_key, u.root, "u", f"{root}-ucp", mode="update"))
    assert rows(u.read(), "k", "n") == [(1, 2), (2, 1)]
    with pytest.raises(TableError, match="hash keys"):
        sinks.write_stream(counts, t.root, "x", f"{root}-xcp", mode="update")


def test_watermarked_windows(spark, feed, frame, root, rows):
    feed.add({"t": 100})
    feed.add({"t": 104}, {"t": 123})
    feed.add({"t": 140})
    ts = feed.stream("t bigint").select(F.timestamp_seconds("t").alias("ts"))
    counts = sinks.windowed_counts(ts, "ts")
    t = KeyedTable.define(spark, root, counts.schema)
    finish(sinks.write_stream(counts, root, "w", f"{root}-cp"))
    got = t.read().select(F.unix_seconds("start"), F.unix_seconds("end"), "count")
    assert rows(got) == [(100, 105, 2), (120, 125, 1)]


def test_guards(spark, feed, frame, root):
    feed.add({"id": 1})
    t = KeyedTable.define(spark, root, frame([], "id int, v string").schema, ["id"])
    spec = t.spec()
    for schema, kw, message in (
        (T.StructType().add("id", INT).add("v", T.NullType()), {}, "untyped"),
        (T.StructType().add("id", INT).add("v", INT), {}, "cannot merge"),
        (T.StructType().add("id", INT).add("v", TEXT).add("w", INT), {}, "another schema"),
        (T.StructType().add("id", INT), {}, "partition columns"),
        (T.StructType().add("id", INT).add("v", TEXT), {"range_cols": ["v"]}, "partitioned by"),
        (T.StructType().add("id", INT).add("v", TEXT), {"mode": "other"}, "mode"),
    ):
        with pytest.raises(TableError, match=message):
            sinks.check_stream(spec, schema, **{"mode": "append", **kw})


ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("value", T.StringType())])


def _event(op, ts, table="a", before=None, after=None):
    return {"before": before, "after": after, "source": {"db": "d", "table": table}, "op": op, "ts_ms": ts}


def test_changes_apply_in_event_order_and_route_to_tables(spark, feed, root, rows):
    feed.add(
        _event("u", 5, after={"id": 1, "value": "new"}), _event("c", 1, after={"id": 1, "value": "old"}),
        _event("c", 1, "b", after={"id": 9, "value": "b"}), _event("c", 1, after={"id": 2, "value": "x"}),
    )
    feed.add(_event("d", 9, before={"id": 2, "value": "x"}), {"source": {"db": "d", "table": "a"}, "ddl": "ALTER TABLE a"})
    full = T.StructType([*ROW.fields, T.StructField("op", T.StringType())])
    tables = {}
    for name in ("a", "b"):
        KeyedTable.define(spark, f"{root}-{name}", full, keys=["id"], buckets=2, cdc_col="op")
        tables[f"d.{name}"] = (f"{root}-{name}", ROW)

    def run(cp, targets, unknown="error"):
        stream = cdc.read_change_stream(spark, feed.text_dir, maxFilesPerTrigger="1")
        router = sinks.table_router(targets, "r", [F.col("ts_ms"), F.col("id")], unknown)
        finish(stream.writeStream.foreachBatch(router).option("checkpointLocation", cp))

    run(f"{root}-cp0", {"d.a": tables["d.a"]}, "ignore")
    run(f"{root}-cp1", tables)
    a, b = (KeyedTable(spark, tables[k][0]) for k in ("d.a", "d.b"))
    assert rows(a.read_cdc(), "id", "value", "op") == [(1, "new", "update")]
    assert rows(b.read_cdc(), "id", "value") == [(9, "b")]
    assert a.state().partitions["-5"].version == 1
    with pytest.raises(Exception, match="unknown tables"):
        run(f"{root}-cp2", {"d.a": tables["d.a"]})


def test_a_stream_creates_its_table_once(spark, feed, root, rows):
    feed.add({"p": 1, "k": 1, "v": 1}, {"p": 2, "k": 2, "v": 2})
    feed.add({"p": 1, "k": 1, "v": 3})
    ddl = "p int, k int, v int"
    shape = {"range_cols": ["p"], "keys": ["k"], "buckets": 2}
    for i in range(2):  # the second run replays both batches, the first of them against its own table
        finish(sinks.write_stream(feed.stream(ddl), root, "q", f"{root}-cp{i}", create=shape))
    t = KeyedTable.for_path(spark, root)
    assert rows(t.read(), "p", "k", "v") == [(1, 1, 3), (2, 2, 2)]
    assert {p.desc: p.version for p in t.state().partitions.values()} == {"p=1": 1, "p=2": 0}
    assert {r["log_version"] for r in t.versions().collect()} == {0, 1}
    assert t.spec().primary_key and not t.spec().field("k").nullable
    with pytest.raises(TableError, match="partitioned by"):
        sinks.write_stream(feed.stream(ddl), root, "q2", f"{root}-cp2", create={"keys": ["k"], "buckets": 2})
    with pytest.raises(TableError, match="keys"):
        sinks.write_stream(feed.stream(ddl), root, "q2", f"{root}-cp2", create={"range_cols": ["p"]})
    with pytest.raises(TableError):
        sinks.write_stream(feed.stream(ddl), f"{root}-none", "q2", f"{root}-cp2")


@pytest.mark.parametrize("mode", ["complete", "append"])
def test_created_by_any_mode_and_by_an_empty_batch(spark, feed, root, rows, mode):
    feed.add({"k": 1})
    stream = feed.stream("k int").filter("k > 5")
    df = stream.groupBy("k").agg(F.count(F.lit(1)).alias("n")) if mode == "complete" else stream
    finish(sinks.write_stream(df, root, "e", f"{root}-cp", mode=mode, create={}))
    assert rows(KeyedTable.for_path(spark, root).read()) == []
    feed.add({"k": 7})
    finish(sinks.write_stream(df, root, "e", f"{root}-cp", mode=mode, create={}))
    assert rows(KeyedTable.for_path(spark, root).read(), "k") == [(7,)]
