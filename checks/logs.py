"""V1-V7: queries over a commit log.

The plans run over log rows that orders and customers describe: an order is a
file operation or a partition version, a customer is a commit that arrives.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import YEARLY, YEARLY_COLUMNS, table, yearly, yearly_table
from keytide.sources import log as L


def _file_ops(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        F.concat(F.lit("f"), F.col("o_custkey").cast("string")).alias("path"),
        F.col("o_orderkey").alias("seq"),
        F.lit(0).alias("pos"),
        F.when(F.col("o_orderstatus") == "F", "del").otherwise("add").alias("file_op"),
        F.col("o_orderpriority").alias("partition"),
        F.floor("o_totalprice").alias("size"),
        F.col("o_orderkey").cast("string").alias("commit_id"),
        (F.col("o_custkey") % 8).cast("int").alias("bucket"),
        F.lit(1).cast("bigint").alias("rows"),
    )


def live_files(spark, sf):
    """Operations arrive as one array per customer and are unfolded first."""
    o = table(spark, sf, "orders")
    op = F.struct(
        F.col("l_suppkey").cast("string").alias("path"),
        F.when(F.col("l_returnflag") == "R", "del").otherwise("add").alias("file_op"),
        F.col("l_partkey").alias("size"),
    )
    items = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("seq"), op.alias("op"), "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"
    )
    commits = items.groupBy("seq").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "op"))),
            lambda x: x["op"],
        ).alias("file_ops")
    )
    known = commits.join(o.select(F.col("o_orderkey").alias("seq")), "seq", "left_semi")
    return L.live_files(L.explode_file_ops(known)).select("path", "size")


def live_files_flat(spark, sf):
    return L.live_files(_file_ops(spark, sf)).select("path", "partition", "size")


def _log(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("partition"),
        F.col("o_orderkey").alias("version"),
        F.col("o_orderstatus").alias("op"),
        F.array(F.col("o_orderkey").cast("string"), F.col("o_orderpriority")).alias("commits"),
    )


def latest_versions(spark, sf):
    return L.latest_versions(_log(spark, sf)).select(
        "partition", "version", "op", F.array_join("commits", "|").alias("commits")
    )


def history(spark, sf):
    return L.history(_log(spark, sf)).select("partition", "version", "op")


def rollback(spark, sf):
    log = _log(spark, sf)
    first = log.groupBy("partition").agg(F.min("version").alias("version"))
    return L.rolled_back(log, first).select("partition", "version", "op", F.array_join("commits", "|").alias("commits"))


def rollback_table(spark, sf):
    t = yearly_table(spark, sf, "v4")
    t.upsert(yearly(table(spark, sf, "orders")).withColumn("o_orderstatus", F.lit("later")))
    t.rollback("o_year=1997", 0)
    return t.read().select(*YEARLY_COLUMNS.split(", "))


def next_versions(spark, sf):
    new = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("partition"),
        F.when(F.col("c_mktsegment") == "BUILDING", "compaction")
        .when(F.col("c_mktsegment") == "MACHINERY", "append")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "update")
        .otherwise("merge").alias("op"),
        F.array(F.col("c_name")).alias("commits"),
    )
    return L.next_versions(_log(spark, sf), new).select(
        "partition", "version", "op", F.array_join("commits", "|").alias("commits")
    )


def size_report(spark, sf):
    return L.size_report(L.live_files(_file_ops(spark, sf))).select("partition", "bytes", "rows", "files")


def layout_report(spark, sf):
    return L.layout_report(L.live_files(_file_ops(spark, sf)))


def table_sizes(spark, sf):
    """Rows of live files of a real table after a delete that only touched the log."""
    t = yearly_table(spark, sf, "v6")
    t.delete("o_year = 1996")
    return t.size_report("o_year >= 1996").select("partition", "rows")


QUERIES = {
    "v1_live_files": live_files_flat,
    "v1_live_files_from_arrays": live_files,
    "v2_latest_versions": latest_versions,
    "v3_history": history,
    "v4_rollback": rollback,
    "v4_rollback_table": rollback_table,
    "v5_next_versions": next_versions,
    "v6_size_report": size_report,
    "v6_size_report_of_table": table_sizes,
    "v7_layout_report": layout_report,
}

_OPS = """ops AS (SELECT 'f' || o_custkey AS path, o_orderkey AS seq,
  CASE WHEN o_orderstatus = 'F' THEN 'del' ELSE 'add' END AS file_op, o_orderpriority AS partition,
  CAST(floor(o_totalprice) AS BIGINT) AS size, CAST(o_custkey % 8 AS INTEGER) AS bucket, o_orderkey AS commit_id
  FROM orders),
 live AS (SELECT * FROM ops QUALIFY row_number() OVER (PARTITION BY path ORDER BY seq DESC) = 1 AND file_op = 'add')"""
_LOG = """log AS (SELECT CAST(o_custkey AS VARCHAR) AS partition, o_orderkey AS version, o_orderstatus AS op,
  o_orderkey || '|' || o_orderpriority AS commits FROM orders),
 newest AS (SELECT partition, max(version) AS version, arg_max(op, version) AS op,
  arg_max(commits, version) AS commits FROM log GROUP BY partition)"""

SQL = {
    "v1_live_files": f"WITH {_OPS} SELECT path, partition, size FROM live",
    "v1_live_files_from_arrays": """WITH ops AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS path, l_orderkey AS seq, l_partkey AS size,
         CASE WHEN l_returnflag = 'R' THEN 'del' ELSE 'add' END AS file_op,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS pos
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
) SELECT path, size FROM (
  SELECT * FROM ops QUALIFY row_number() OVER (PARTITION BY path ORDER BY seq DESC, pos DESC) = 1
) WHERE file_op = 'add'""",
    "v2_latest_versions": f"WITH {_LOG} SELECT partition, version, op, commits FROM newest",
    "v3_history": f"WITH {_LOG} SELECT partition, version, op FROM log",
    "v4_rollback": f"WITH {_LOG} SELECT n.partition, n.version + 1 AS version, l.op, l.commits FROM newest n JOIN log l"
    " ON l.partition = n.partition AND l.version = (SELECT min(version) FROM log x WHERE x.partition = n.partition)",
    "v4_rollback_table": f"WITH {YEARLY} SELECT "
    + YEARLY_COLUMNS.replace(
        "o_orderstatus", "CASE WHEN o_year = 1997 THEN o_orderstatus ELSE 'later' END AS o_orderstatus"
    )
    + " FROM yearly",
    "v5_next_versions": f"""WITH {_LOG}, new AS (
  SELECT CAST(c_custkey AS VARCHAR) AS partition, c_name AS commits,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'compaction' WHEN 'MACHINERY' THEN 'append'
              WHEN 'HOUSEHOLD' THEN 'update' ELSE 'merge' END AS op FROM customer
) SELECT new.partition, coalesce(n.version, -1) + 1 AS version, new.op,
         CASE WHEN new.op IN ('append', 'merge') AND n.commits IS NOT NULL
              THEN n.commits || '|' || new.commits ELSE new.commits END AS commits
  FROM new LEFT JOIN newest n ON n.partition = new.partition""",
    "v6_size_report": f"WITH {_OPS} SELECT partition, CAST(sum(size) AS BIGINT) AS bytes, count(*) AS rows,"
    " count(*) AS files FROM live GROUP BY partition",
    "v6_size_report_of_table": f"WITH {YEARLY} SELECT 'o_year=' || o_year AS partition, count(*) AS rows FROM yearly"
    " WHERE o_year > 1996 GROUP BY o_year",
    "v7_layout_report": f"WITH {_OPS} SELECT partition, bucket, count(*) AS files,"
    " count(DISTINCT commit_id) AS depth, CAST(sum(size) AS BIGINT) AS bytes FROM live GROUP BY partition, bucket",
}
