"""Conditions in one text, range values with marks, and events without a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import EVENT_ROW, YEARLY, change_events, scratch, table, yearly_table
from keytide import KeyedTable
from keytide.streaming.sinks import change_applier


def _by_partition(t: KeyedTable) -> DataFrame:
    """Newest version and rows of every year."""
    newest = t.versions().groupBy("partition").agg(F.max("version").alias("version"))
    year = F.substring_index("partition", "=", -1).cast("int")
    rows = t.read().groupBy("o_year").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return newest.select(year.alias("o_year"), "version").join(rows, "o_year")


def delete_one_text(spark: SparkSession, sf: str) -> DataFrame:
    t = yearly_table(spark, sf, "guards-delete")
    t.delete("o_year = 1995 and o_totalprice > 150000")
    return _by_partition(t)


def update_one_text(spark: SparkSession, sf: str) -> DataFrame:
    t = yearly_table(spark, sf, "guards-update")
    t.update({"o_totalprice": F.lit(0.0)}, "o_year in (1994, 1996) and (o_orderstatus = 'F' or o_orderpriority = '5-LOW')")
    return _by_partition(t)


def marked_range_values(spark: SparkSession, sf: str) -> DataFrame:
    """Every row is found again under values that hold the marks of a descriptor."""
    o = table(spark, sf, "orders")
    marks = o.select(
        "o_orderkey", F.concat(F.col("o_orderpriority"), F.lit(",b=2%")).alias("a"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("=,"), F.col("o_orderstatus"))).otherwise("%2C").alias("b"),
    )
    t = KeyedTable.create(spark, scratch(spark, "guards-marks"), marks, range_cols=["a", "b"])
    sizes = t.size_report("a <> '1-URGENT,b=2%'").agg(F.count(F.lit(1)).alias("parts"), F.sum("rows").alias("sized"))
    return t.read().groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(sizes))  # one row


def events_without_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Truncate and heartbeat events stand between the changes of users."""
    row = T.StructType.fromDDL(EVENT_ROW)
    odd = table(spark, sf, "events").select(
        F.to_json(F.struct(F.when(F.col("event_id") % 2 == 0, "t").otherwise("m").alias("op"), F.col("event_id").alias("ts_ms"))).alias("value")
    )
    schema = T.StructType([*row.fields, T.StructField("op", T.StringType())])
    t = KeyedTable.define(spark, scratch(spark, "guards-events"), schema, keys=["event_id"], buckets=2, cdc_col="op")
    change_applier(t.root, "guards", row, [F.col("ts_ms")])(change_events(spark, sf).union(odd), 0)
    return t.read_cdc().groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def _years(changed: str, deleted: str, price: str) -> str:
    return f"""WITH {YEARLY} SELECT o_year, CAST(CASE WHEN o_year IN ({changed}) THEN 1 ELSE 0 END AS BIGINT) AS version,
      count(*) AS n, round(sum({price}), 2) AS total FROM yearly WHERE NOT ({deleted}) GROUP BY o_year"""


QUERIES = {
    "u8_delete_one_text": delete_one_text,
    "u11_update_one_text": update_one_text,
    "e6_marked_range_values": marked_range_values,
    "d5_events_without_rows": events_without_rows,
}
SQL = {
    "u8_delete_one_text": _years("1995", "o_year = 1995 AND o_totalprice > 150000", "o_totalprice"),
    "u11_update_one_text": _years(
        "1994, 1996", "false",
        "CASE WHEN o_year IN (1994, 1996) AND (o_orderstatus = 'F' OR o_orderpriority = '5-LOW') THEN 0 ELSE o_totalprice END",
    ),
    "e6_marked_range_values": """
      WITH m AS (SELECT o_orderpriority || ',b=2%' AS a, CASE WHEN o_orderstatus <> 'P' THEN '=,' || o_orderstatus ELSE '%2C' END AS b FROM orders),
      g AS (SELECT a, b, count(*) AS n FROM m GROUP BY a, b)
      SELECT a, b, n, (SELECT count(*) FROM g WHERE a <> '1-URGENT,b=2%') AS parts,
             (SELECT CAST(sum(n) AS BIGINT) FROM g WHERE a <> '1-URGENT,b=2%') AS sized FROM g""",
    "d5_events_without_rows": "SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY event_type",
}
