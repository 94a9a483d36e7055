"""Change events as batch plans."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import BUCKETS, CHANGE_OP, EVENT_MS, EVENT_ROW, bucketed_sql, change_events, scratch, table
from keytide import KeyedTable
from keytide.functions import decode as D
from keytide.functions.columns import route_by_key
from keytide.streaming import cdc


def _row():
    return T.StructType.fromDDL(EVENT_ROW)


def flatten(spark, sf):
    events = cdc.parse_events(change_events(spark, sf), _row())
    return cdc.flatten_envelope(events, keep=("ts_ms",))


def explode(spark, sf):
    events = cdc.parse_events(change_events(spark, sf), _row())
    return cdc.explode_changes(events).select("event_id", "user_id", "event_type", "value", "op", "kind")


def order(spark, sf):
    events = cdc.parse_events(change_events(spark, sf), _row())
    images = cdc.explode_changes(events, keep=("ts_ms",))
    ranked = cdc.order_changes(images, ["user_id"], "ts_ms", ties=["event_id"])
    return ranked.select("user_id", "event_id", "kind", F.col("rank").cast("bigint").alias("rank"))


def read_cdc(spark, sf):
    """First half of the month as inserts, later events as changes of the same users."""
    e = table(spark, sf, "events")
    events = cdc.parse_events(change_events(spark, sf), _row())
    rows = cdc.flatten_envelope(events, keep=("ts_ms",))
    split = F.unix_millis(F.lit("2024-01-16 00:00:00").cast("timestamp_ntz").cast("timestamp"))
    schema = T.StructType([*_row().fields, T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType())])
    t = KeyedTable.define(spark, scratch(spark, "d4"), schema, keys=["user_id"], buckets=BUCKETS, cdc_col="op",
                          order_cols=("ts_ms", "event_id"))
    t.upsert(rows.filter(F.col("ts_ms") < split))
    t.upsert(rows.filter(F.col("ts_ms") >= split))
    return t.read_cdc().select(*[c for c in e.columns if c in ("event_id", "user_id", "event_type", "value")], "op")


def split(spark, sf):
    """Views stand for schema changes, all other events for row changes."""
    e = table(spark, sf, "events")
    source = F.struct(F.lit("shop").alias("db"), F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("table"))
    ddl = F.to_json(F.struct(source.alias("source"), F.when(
        F.col("value") > 10, F.concat(F.lit("ALTER TABLE t ADD COLUMN c"), F.col("event_id").cast("string"), F.lit(" INT"))
    ).otherwise("create table t (id int)").alias("ddl")))
    dml = F.to_json(F.struct(source.alias("source"), F.struct("event_id").alias("after"), F.lit("c").alias("op")))
    stream = e.select(F.when(F.col("event_type") == "view", ddl).otherwise(dml).alias("value"))
    rows, changes = cdc.split_ddl(stream)
    return changes.select("table", "statement").unionByName(
        rows.select(F.get_json_object("value", "$.source.table").alias("table"), F.lit("row").alias("statement"))
    ).groupBy("table", "statement").agg(F.count(F.lit(1)).alias("n"))


def route(spark, sf):
    """The bucket of every change; all changes of a key have one."""
    routed = route_by_key(table(spark, sf, "events"), ["user_id"], BUCKETS)
    return routed.groupBy("user_id", "bucket").agg(F.count(F.lit(1)).alias("n"))


def _encoded(spark, sf):
    """Orders written the way a connector writes logical types."""
    o = table(spark, sf, "orders")
    day = F.col("o_orderdate").cast("date")
    micros = F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_custkey")
    old = F.col("o_orderstatus") == "F"
    micros = F.when(old, -micros).otherwise(micros)
    cents = F.round((F.col("o_totalprice") - 250000) * 100).cast("bigint")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.datediff(day, F.lit("1970-01-01").cast("date")).alias("d"),
        F.floor(micros / 1000).alias("ms"),
        micros.alias("us"),
        (micros * 1000 + 999).alias("ns"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("z"),
        F.base64(F.unhex(F.lpad(F.hex(cents), 16, "0"))).alias("dec8"),
        F.base64(F.unhex(F.concat(
            F.when(cents < 0, "FFFFFFFF").otherwise("00000000"), F.lpad(F.hex(cents), 16, "0")
        ))).alias("dec12"),
        cents.cast("string").alias("text"),
        F.base64(F.col("o_orderpriority").cast("binary")).alias("raw"),
        F.year("o_orderdate").alias("y"),
        (F.col("o_custkey") * 1_000_000_000).alias("tn"),
    )


_SPECS = {
    "d": D.FieldSpec(D.DATE),
    "ms": D.FieldSpec(D.TIMESTAMP_MILLIS),
    "us": D.FieldSpec(D.TIMESTAMP_MICROS),
    "ns": D.FieldSpec(D.TIMESTAMP_NANOS),
    "z": D.FieldSpec(D.ZONED_TIMESTAMP),
    "dec8": D.FieldSpec(D.DECIMAL, 18, 2),
    "dec12": D.FieldSpec(D.DECIMAL, 24, 4),
    "text": D.FieldSpec(D.DECIMAL_TEXT, 18, 0),
    "raw": D.FieldSpec("bytes"),
    "y": D.FieldSpec(D.YEAR),
    "tn": D.FieldSpec(D.TIME_NANOS),
}


def decode(spark, sf):
    out = D.decode_envelope(_encoded(spark, sf), _SPECS, "Asia/Shanghai")
    return out.withColumn("raw", F.col("raw").cast("string"))


def source_types(spark, sf):
    p = table(spark, sf, "part")
    kinds = ["int", "BIGINT", "varchar(255)", "char(3)", "decimal(10, 2)", "numeric", "geometry", "mediumblob",
             "datetime", "longtext", "double"]
    pick = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.length("p_name") % len(kinds) + 1).cast("int"))
    columns = p.select(
        F.col("p_brand").alias("table_name"), F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("column_name"),
        F.col("p_size").alias("position"), pick.alias("source_type"),
    )
    return D.schema_from_source(columns)


QUERIES = {
    "d1_flatten_envelope": flatten,
    "d2_explode_changes": explode,
    "d3_order_changes": order,
    "d4_read_cdc": read_cdc,
    "d7_split_ddl": split,
    "d8_route_by_key": route,
    "d9_decode_envelope": decode,
    "d10_schema_from_source": source_types,
}

_IMAGES = f"""images AS (
  SELECT event_id, user_id, event_type, value, 'insert' AS op, '+I' AS kind, 1 AS k, {EVENT_MS} AS ms
    FROM events WHERE event_type = 'signup'
  UNION ALL SELECT event_id, user_id, event_type, value, 'delete', '-D', 4, {EVENT_MS} FROM events WHERE event_type = 'error'
  UNION ALL SELECT event_id, user_id, event_type, value, 'delete', '-U', 2, {EVENT_MS}
    FROM events WHERE event_type NOT IN ('signup', 'error')
  UNION ALL SELECT event_id, user_id, event_type, value, 'update', '+U', 3, {EVENT_MS}
    FROM events WHERE event_type NOT IN ('signup', 'error')
)"""

_MICROS = """(CASE WHEN o_orderstatus = 'F' THEN -(epoch_us(o_orderdate) + o_custkey)
  ELSE epoch_us(o_orderdate) + o_custkey END)"""

SQL = {
    "d1_flatten_envelope": f"SELECT event_id, user_id, event_type, value, {CHANGE_OP} AS op, {EVENT_MS} AS ts_ms FROM events",
    "d2_explode_changes": f"WITH {_IMAGES} SELECT event_id, user_id, event_type, value, op, kind FROM images",
    "d3_order_changes": f"WITH {_IMAGES} SELECT user_id, event_id, kind,"
    " row_number() OVER (PARTITION BY user_id ORDER BY ms, k, event_id) AS rank FROM images",
    "d4_read_cdc": f"""SELECT event_id, user_id, event_type, value, op FROM (
  SELECT *, {CHANGE_OP} AS op FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {EVENT_MS} DESC, event_id DESC) = 1
) WHERE NOT (op = 'delete')""",
    "d7_split_ddl": "SELECT 't' || user_id AS \"table\", CASE WHEN event_type <> 'view' THEN 'row'"
    " WHEN value > 10 THEN 'alter' ELSE 'create' END AS statement, count(*) AS n FROM events GROUP BY ALL",
    "d8_route_by_key": f"WITH {bucketed_sql('events', 'user_id', BUCKETS, 'b')}"
    " SELECT user_id, bucket, count(*) AS n FROM b GROUP BY user_id, bucket",
    "d10_schema_from_source": """WITH c AS (
  SELECT p_brand AS table_name, 'c' || p_partkey AS column_name, p_size AS position,
         ['int', 'BIGINT', 'varchar(255)', 'char(3)', 'decimal(10, 2)', 'numeric', 'geometry', 'mediumblob',
          'datetime', 'longtext', 'double'][length(p_name) % 11 + 1] AS source_type FROM part
), m AS (SELECT *, CASE source_type WHEN 'int' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'varchar(255)' THEN 'string'
  WHEN 'char(3)' THEN 'char(3)' WHEN 'decimal(10, 2)' THEN 'decimal(10,2)' WHEN 'numeric' THEN 'decimal(9,3)'
  WHEN 'mediumblob' THEN 'binary' WHEN 'longtext' THEN 'string' WHEN 'double' THEN 'double' END AS table_type FROM c)
SELECT *, table_type IS NOT NULL AS supported FROM m""",
}
_CENTS = "CAST(round((o_totalprice - 250000) * 100) AS BIGINT)"
SQL["d9_decode_envelope"] = f"""SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS d,
  make_timestamp(CAST(floor({_MICROS} / 1000) AS BIGINT) * 1000) AS ms, make_timestamp({_MICROS}) AS us,
  make_timestamp({_MICROS}) AS ns, o_orderdate + INTERVAL 8 HOUR AS z,
  CAST({_CENTS} * 0.01::DECIMAL(4,2) AS DECIMAL(18,2)) AS dec8,
  CAST({_CENTS} * 0.0001::DECIMAL(6,4) AS DECIMAL(24,4)) AS dec12,
  CAST({_CENTS} AS DECIMAL(18,0)) AS text, o_orderpriority AS raw, CAST(year(o_orderdate) AS INTEGER) AS y,
  o_custkey * 1000000 AS tn FROM orders"""
