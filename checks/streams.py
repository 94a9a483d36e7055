"""Streams run to their end over a file source."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import BUCKETS, CHANGE_OP, EVENT_MS, EVENT_ROW, change_events, scratch, table
from keytide import KeyedTable
from keytide.streaming import cdc, sinks

_EVENTS = ("event_id", "user_id", "event_type", "value")


def _stream(spark, sf):
    """The events file as a stream."""
    schema = table(spark, sf, "events").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )


def _finish(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def append_sink(spark, sf):
    df = _stream(spark, sf).select(*_EVENTS)
    t = KeyedTable.define(spark, scratch(spark, "t1"), df.schema, range_cols=["event_type"])
    _finish(sinks.write_stream(df, t.root, "t1", scratch(spark, "t1-cp")))
    return t.read().select(*_EVENTS)


def creating_sink(spark, sf):
    """No table yet: the first batch creates it; replays of both runs change nothing."""
    df = _stream(spark, sf).select(*_EVENTS)
    root = scratch(spark, "t1-new")
    shape = {"range_cols": ["event_type"], "keys": ["event_id"], "buckets": BUCKETS}
    for attempt in range(2):
        _finish(sinks.write_stream(df, root, "t1-new", scratch(spark, f"t1-new-cp{attempt}"), create=shape))
    t = KeyedTable.for_path(spark, root)
    last = t.versions().groupBy("partition").agg(F.max("version").alias("version"))
    at = F.concat(F.lit("event_type="), F.col("event_type"))
    return t.read().join(last, at == F.col("partition")).select(*_EVENTS, "version")


def append_sink_keyed(spark, sf):
    """A keyed table takes appended batches as merges: one row per user remains."""
    df = _stream(spark, sf).select("user_id", "event_id", "event_type")
    t = KeyedTable.define(spark, scratch(spark, "t1-keyed"), df.schema, keys=["user_id"], buckets=BUCKETS,
                          order_cols=("event_id",))
    _finish(sinks.write_stream(df, t.root, "t1-keyed", scratch(spark, "t1-keyed-cp")))
    return t.read().select("user_id", "event_id", "event_type")


def complete_sink(spark, sf):
    df = _stream(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    t = KeyedTable.define(spark, scratch(spark, "t2"), df.schema)
    _finish(sinks.write_stream(df, t.root, "t2", scratch(spark, "t2-cp"), mode="complete"))
    return t.read()


def update_sink(spark, sf):
    df = _stream(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))
    t = KeyedTable.define(spark, scratch(spark, "t3"), df.schema, keys=["user_id"], buckets=BUCKETS)
    _finish(sinks.write_stream(df, t.root, "t3", scratch(spark, "t3-cp"), mode="update"))
    return t.read()


def windowed(spark, sf):
    df = sinks.windowed_counts(_stream(spark, sf).select("ts"), "ts")
    t = KeyedTable.define(spark, scratch(spark, "t4"), df.schema)
    _finish(sinks.write_stream(df, t.root, "t4", scratch(spark, "t4-cp")))
    return t.read().select(F.unix_seconds("start").alias("start_s"), F.unix_seconds("end").alias("end_s"), "count")


def exactly_once(spark, sf):
    """The same stream replayed from its start under one query id adds nothing."""
    df = _stream(spark, sf).select(*_EVENTS)
    t = KeyedTable.define(spark, scratch(spark, "t5"), df.schema)
    for attempt in range(2):
        _finish(sinks.write_stream(df, t.root, "t5", scratch(spark, f"t5-cp{attempt}")))
    return t.read().groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


def evolving_sink(spark, sf):
    """A guarded stream that brings a new column into a table of users."""
    users = table(spark, sf, "events").select("user_id", F.lit("seen").alias("state")).distinct()
    t = KeyedTable.create(spark, scratch(spark, "t6"), users, keys=["user_id"], buckets=BUCKETS, unique_keys=True)
    df = _stream(spark, sf).groupBy("user_id").agg(F.sum(F.lit(1)).alias("total"))
    _finish(sinks.write_stream(df, t.root, "t6", scratch(spark, "t6-cp"), mode="update", merge_schema=True))
    return t.read().select("user_id", "state", "total")


def _record_stream(spark, sf, label):
    """Change records in four files, read as a text stream file by file."""
    folder = scratch(spark, label)
    change_events(spark, sf).repartition(4, F.get_json_object("value", "$.ts_ms")).write.text(folder)
    return cdc.read_change_stream(spark, folder, maxFilesPerTrigger="1")


def _row():
    return T.StructType.fromDDL(EVENT_ROW)


def _newest():
    return [F.col("ts_ms"), F.col("event_id")]


def apply_changes(spark, sf):
    """All records in one batch; per user the newest change counts."""
    folder = scratch(spark, "d5-in")
    change_events(spark, sf).write.text(folder)
    schema = T.StructType([*_row().fields, T.StructField("op", T.StringType())])
    t = KeyedTable.define(spark, scratch(spark, "d5"), schema, keys=["user_id"], buckets=BUCKETS, cdc_col="op")
    stream = cdc.read_change_stream(spark, folder)
    _finish(
        stream.writeStream.foreachBatch(sinks.change_applier(t.root, "d5", _row(), _newest()))
        .option("checkpointLocation", scratch(spark, "d5-cp"))
    )
    return t.read_cdc().select(*_EVENTS, "op")


def route_tables(spark, sf):
    """Two tables keyed by event; four batches, each table commits on its own."""
    schema = T.StructType([*_row().fields, T.StructField("op", T.StringType())])
    targets = {}
    for name in ("accounts", "activity"):
        t = KeyedTable.define(spark, scratch(spark, f"d6-{name}"), schema, keys=["event_id"], buckets=BUCKETS, cdc_col="op")
        targets[f"shop.{name}"] = (t.root, _row())
    _finish(
        _record_stream(spark, sf, "d6-in").writeStream
        .foreachBatch(sinks.table_router(targets, "d6", _newest()))
        .option("checkpointLocation", scratch(spark, "d6-cp"))
    )
    out = None
    for name, (root, _) in targets.items():
        one = KeyedTable.for_path(spark, root).read_cdc().select(F.lit(name).alias("target"), *_EVENTS, "op")
        out = one if out is None else out.unionByName(one)
    return out


def change_stream(spark, sf):
    """Records as they arrive, counted by operation and table."""
    stream = _record_stream(spark, sf, "s16-in")
    events = cdc.parse_events(stream, _row()).select(cdc.table_id().alias("target"), "op")
    t = KeyedTable.define(spark, scratch(spark, "s16"), events.schema)
    _finish(sinks.write_stream(events, t.root, "s16", scratch(spark, "s16-cp")))
    return t.read().groupBy("target", "op").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "s15_t1_append_sink": append_sink,
    "t1_append_sink_keyed": append_sink_keyed,
    "t1_creating_sink": creating_sink,
    "t2_complete_sink": complete_sink,
    "t3_update_sink": update_sink,
    "t4_windowed_counts": windowed,
    "t5_exactly_once": exactly_once,
    "t6_evolving_sink": evolving_sink,
    "s16_change_stream": change_stream,
    "d5_apply_changes": apply_changes,
    "d6_route_tables": route_tables,
}

_COLS = ", ".join(_EVENTS)
_TARGET = "CASE WHEN event_type IN ('signup', 'purchase') THEN 'shop.accounts' ELSE 'shop.activity' END"

SQL = {
    "s15_t1_append_sink": f"SELECT {_COLS} FROM events",
    "t1_append_sink_keyed": "SELECT user_id, event_id, event_type FROM events"
    " QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1",
    "t1_creating_sink": f"SELECT {_COLS}, CAST(0 AS BIGINT) AS version FROM events",
    "t2_complete_sink": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "t3_update_sink": "SELECT user_id, count(*) AS n, max(event_id) AS last FROM events GROUP BY user_id",
    "t4_windowed_counts": """WITH w AS (
  SELECT CAST(floor(epoch_us(ts) / 5000000.0) AS BIGINT) * 5 AS start_s, count(*) AS count FROM events GROUP BY 1
) SELECT start_s, start_s + 5 AS end_s, count FROM w
  WHERE start_s + 5 <= (SELECT floor(epoch_ms(max(ts)) / 1000.0) - 10 FROM events)""",
    "t5_exactly_once": "SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY event_type",
    "t6_evolving_sink": "SELECT user_id, 'seen' AS state, count(*) AS total FROM events GROUP BY user_id",
    "s16_change_stream": f"SELECT {_TARGET} AS target, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd'"
    " ELSE 'u' END AS op, count(*) AS n FROM events GROUP BY ALL",
    "d5_apply_changes": f"""SELECT {_COLS}, op FROM (
  SELECT *, {CHANGE_OP} AS op FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {EVENT_MS} DESC, event_id DESC) = 1
) WHERE NOT (op = 'delete')""",
    "d6_route_tables": f"SELECT {_TARGET} AS target, {_COLS}, {CHANGE_OP} AS op FROM events WHERE event_type <> 'error'",
}
