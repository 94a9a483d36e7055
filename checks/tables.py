"""Operations on tables in a folder."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from checks.inputs import (
    BUCKETS,
    MERGED,
    ORDER_COLUMNS,
    ORDER_VERSIONS,
    YEARLY,
    YEARLY_BUCKETS,
    YEARLY_COLUMNS,
    bucketed_sql,
    merged_sql,
    order_table,
    scratch,
    table,
    yearly,
    yearly_table,
)
from keytide import KeyedTable
from keytide.functions.columns import bucket_id
from keytide.sources.log import bucket_of, read_files

_ORDER = ORDER_COLUMNS.split(", ")
_YEARLY = YEARLY_COLUMNS.split(", ")


# -- scans ----------------------------------------------------------------------


def read_table(spark, sf):
    return order_table(spark, sf, "s1").read().select(*_ORDER)


def read_pruned(spark, sf):
    t = yearly_table(spark, sf, "s2")
    t.upsert(yearly(table(spark, sf, "orders")).filter("o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("Z")))
    return t.read(where=["o_year >= 1997", "o_year < 1999", "o_totalprice > 100000"]).select(*_YEARLY)


def read_partition_path(spark, sf):
    t = yearly_table(spark, sf, "s3")
    return KeyedTable.read_path(spark, f"{t.root}/o_year=1998").select(*_YEARLY)


def read_as_of(spark, sf):
    t = yearly_table(spark, sf, "s4")
    df = yearly(table(spark, sf, "orders"))
    t.upsert(df.withColumn("o_orderstatus", F.lit("1")))
    t.upsert(df.withColumn("o_orderstatus", F.lit("2")))
    old, mid = t.read_as_of("o_year=1997", 0), t.read_as_of("o_year=1997", 1)
    return (
        old.withColumn("v", F.lit(0))
        .unionByName(mid.withColumn("v", F.lit(1)))
        .select("v", "o_orderkey", "o_orderstatus")
    )


def read_commits(spark, sf):
    t = order_table(spark, sf, "s5")
    commits = next(iter(t.state().partitions.values())).commits
    return t.read_commits([c.id for c in commits[1:3]]).select(*_ORDER)


def append(spark, sf):
    o = table(spark, sf, "orders")
    t = KeyedTable.create(spark, scratch(spark, "s6"), yearly(o), range_cols=["o_year"])
    t.append(yearly(o.filter("o_orderstatus = 'F'")))
    return t.read().select(*_YEARLY)


def overwrite(spark, sf):
    t = yearly_table(spark, sf, "s7")
    t.overwrite(yearly(table(spark, sf, "orders").filter("o_orderstatus <> 'F'")), unique_keys=True)
    return t.read().select(*_YEARLY)


def replace_where(spark, sf):
    t = yearly_table(spark, sf, "s8", keys=False)
    new = yearly(table(spark, sf, "orders").filter("o_orderstatus = 'O'")).filter("o_year in (1996, 1997)")
    t.replace_where(new.withColumn("o_orderpriority", F.lit("new")), "o_year in (1996, 1997)")
    return t.read().select(*_YEARLY)


def save_ignore(spark, sf):
    t = yearly_table(spark, sf, "s9")
    changed = yearly(table(spark, sf, "orders")).withColumn("o_orderstatus", F.lit("never"))
    same = KeyedTable.create(spark, t.root, changed, range_cols=["o_year"], keys=["o_orderkey"], buckets=BUCKETS,
                             mode="ignore")
    return same.read().select(*_YEARLY)


def read_random(spark, sf):
    """A random condition that every row meets keeps every partition and row."""
    t = yearly_table(spark, sf, "s2r")
    t.upsert(yearly(table(spark, sf, "orders")).filter("o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("Z")))
    return t.read("rand(7) < 2 AND o_year >= 1997").select(*_YEARLY)


def insert_by_position(spark, sf):
    p = table(spark, sf, "part")
    t = KeyedTable.create(spark, scratch(spark, "s10"), p)
    t.insert_by_position(
        p.select(
            (F.col("p_partkey") + 1_000_000).cast("string").alias("p_name"),
            F.col("p_name").alias("p_partkey"),
            F.col("p_type").alias("a"),
            F.col("p_brand").alias("b"),
            F.col("p_size").cast("string").alias("c"),
            F.col("p_retailprice").alias("d"),
        )
    )
    return t.read()


def insert_overwrite_partition(spark, sf):
    t = yearly_table(spark, sf, "s11", keys=False)
    t.insert_overwrite_partition(
        table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(*[c for c in _ORDER]), {"o_year": 1998}
    )
    return t.read().select(*_YEARLY)


def create_table(spark, sf):
    return yearly_table(spark, sf, "s12").read().select(*_YEARLY)


def bucketed_write(spark, sf):
    """Rows and keys of every bucket, as the names of the files tell them apart."""
    rows = order_table(spark, sf, "s13", deltas=1).read()
    bucket = bucket_of(F.concat(F.lit("/"), F.col("_metadata.file_name")))
    return rows.withColumn("bucket", bucket).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")
    )


def publish_partition(spark, sf):
    t = yearly_table(spark, sf, "s14")
    t.upsert(yearly(table(spark, sf, "orders")).withColumn("o_orderstatus", F.lit("U")).filter("o_totalprice < 50000"))
    target = scratch(spark, "s14-target")
    t.publish_partition("o_year = 1996", target)
    t.publish_partition("o_year = 1997", target)
    return spark.read.parquet(target).select(*_YEARLY)


# -- projection and filter ------------------------------------------------------


def projection_without_key(spark, sf):
    return order_table(spark, sf, "p1").read().select("o_orderstatus", "o_totalprice")


def filter_after_merge(spark, sf):
    return order_table(spark, sf, "p2").read().filter("o_totalprice < 200000 and o_orderstatus <> 'X'").select(*_ORDER)


def partition_and_data_filter(spark, sf):
    t = yearly_table(spark, sf, "p3")
    t.upsert(yearly(table(spark, sf, "orders")).filter("o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("Z")))
    return t.read().filter("o_year = 1997 and o_orderpriority = '2-HIGH'").select(*_YEARLY)


# -- upserts --------------------------------------------------------------------


def upsert_delta(spark, sf):
    return order_table(spark, sf, "u1", deltas=2).read().select(*_ORDER)


def _rewrite_source(spark, sf):
    o = yearly(table(spark, sf, "orders"))
    changed = o.filter("o_orderstatus = 'F'").select(
        "o_orderkey", "o_year", F.lit("R").alias("o_orderstatus"),
        F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice") + 1).alias("o_totalprice"),
    )
    fresh = o.filter("o_orderstatus = 'P'").select(
        (F.col("o_orderkey") + 10_000_000).alias("o_orderkey"), "o_year", "o_orderstatus", "o_totalprice"
    )
    return changed.unionByName(fresh)


def upsert_rewrite(spark, sf):
    t = yearly_table(spark, sf, "u2")
    t.upsert(_rewrite_source(spark, sf), mode="rewrite", full_scan=True)
    return t.read().select(*_YEARLY)


def upsert_evolving(spark, sf):
    o = table(spark, sf, "orders")
    t = order_table(spark, sf, "u4", deltas=1)
    t.upsert(
        o.filter("o_totalprice > 250000").select("o_orderkey", F.concat("o_orderpriority", F.lit("!")).alias("o_note")),
        merge_schema=True,
    )
    return t.read().select(*_ORDER, "o_note")


def upsert_conditional(spark, sf):
    t = yearly_table(spark, sf, "u5")
    t.upsert(_rewrite_source(spark, sf), where="o_year = 1997", mode="rewrite")
    return t.read().select(*_YEARLY)


# -- delete and update ----------------------------------------------------------

_NULLABLE = "nullif(o_orderpriority, '3-MEDIUM') > '3'"


def delete_rows(spark, sf):
    t = yearly_table(spark, sf, "u8")
    t.delete(_NULLABLE)
    return t.read().select(*_YEARLY)


def delete_in_buckets(spark, sf):
    """Buckets that a delete wrote anew, found in the log, and their rows afterwards."""
    t = yearly_table(spark, sf, "u8b")
    t.delete("o_orderkey % 499 = 0")
    dead = read_files(spark, t.root).filter("file_op = 'del'").select("partition", "bucket")
    new = t.read().withColumn("bucket", bucket_id(["o_orderkey"], YEARLY_BUCKETS)).groupBy(
        F.concat(F.lit("o_year="), F.col("o_year").cast("string")).alias("partition"), "bucket"
    ).agg(F.count(F.lit(1)).alias("n"))
    left = dead.distinct().join(new, ["partition", "bucket"], "left")
    return left.select(F.split("partition", "=")[1].cast("bigint").alias("o_year"), "bucket", F.coalesce("n", F.lit(0)).alias("n"))


def delete_rows_unkeyed(spark, sf):
    t = yearly_table(spark, sf, "u8-unkeyed", keys=False)
    t.delete(["o_year <= 1998", _NULLABLE])
    return t.read().select(*_YEARLY)


def delete_partitions(spark, sf):
    t = yearly_table(spark, sf, "u9")
    t.delete("o_year < 1998")
    return t.read().select(*_YEARLY)


def delete_all(spark, sf):
    t = yearly_table(spark, sf, "u10")
    t.delete()
    return t.read().select(*_YEARLY)


def update_rows(spark, sf):
    t = yearly_table(spark, sf, "u11")
    t.update({"o_orderstatus": F.lit(7), "o_totalprice": "o_totalprice * 2"}, where=_NULLABLE)
    return t.read().select(*_YEARLY)


def update_all(spark, sf):
    t = yearly_table(spark, sf, "u12")
    t.update({"o_orderpriority": "substring(o_orderpriority, 1, 1)", "O_CUSTKEY": "o_custkey + 1"})
    return t.read().select(*_YEARLY)


def update_nested(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey",
        F.struct(
            F.struct(F.col("c_name").alias("d"), F.col("c_nationkey").alias("e")).alias("c"),
            F.col("c_acctbal").alias("g"),
        ).alias("a"),
        F.col("c_mktsegment").alias("z"),
    )
    t = KeyedTable.create(spark, scratch(spark, "u13"), c, keys=["c_custkey"], buckets=BUCKETS, unique_keys=True)
    t.update({"a.c.d": "concat(z, '!')", "a.g": F.lit(0)}, where="a.c.e < 12")
    return t.read().select("c_custkey", F.col("a.c.d").alias("d"), F.col("a.c.e").alias("e"), F.col("a.g").alias("g"), "z")


def _merge_source(spark, sf):
    o = table(spark, sf, "orders")
    changed = o.filter("o_totalprice > 150000").select(
        "o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "null").otherwise("new").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), "o_orderdate", "o_orderpriority",
    )
    fresh = o.filter("o_orderstatus = 'P'").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)
    return changed.unionByName(fresh)


def conditional_merge(spark, sf):
    t = order_table(spark, sf, "u14", deltas=1)
    every = {"o_custkey": "s.o_custkey", "o_totalprice": "t.o_totalprice + s.o_totalprice"}
    t.merge_into(
        _merge_source(spark, sf),
        [
            ("s.o_orderstatus <> 'null'", {**every, "o_orderstatus": "s.o_orderstatus"}),
            ("s.o_orderstatus = 'null'", every),
        ],
    )
    return t.read().select(*_ORDER)


def drop_partition(spark, sf):
    t = yearly_table(spark, sf, "u15")
    t.drop_partition("o_year = 1997")
    return t.read().select(*_YEARLY)


def touched_files(spark, sf):
    t = yearly_table(spark, sf, "u16", keys=False)
    found = t.touched_files(["o_year >= 1997", "o_orderstatus = 'P'"])
    year = F.regexp_extract("path", "/o_year=([0-9]+)/", 1).cast("int")
    return found.groupBy(year.alias("o_year")).agg(F.sum("matches").cast("bigint").alias("matches"))


# -- compaction -----------------------------------------------------------------


def compact_table(spark, sf):
    t = order_table(spark, sf, "c1")
    t.compact()
    return t.read().select(*_ORDER)


def compact_partition(spark, sf):
    t = yearly_table(spark, sf, "c2")
    t.upsert(yearly(table(spark, sf, "orders")).withColumn("o_orderstatus", F.lit("U")).filter("o_totalprice < 90000"))
    t.compact("o_year = 1997")
    return t.read().select(*_YEARLY)


def compact_when_deep(spark, sf):
    """Only the year that got more than two deltas is compacted; rows stay."""
    t = yearly_table(spark, sf, "c3")
    df = yearly(table(spark, sf, "orders"))
    for i, cond in enumerate(["o_year = 1997", "o_year = 1997", "o_year >= 1997"]):
        t.upsert(df.filter(cond).withColumn("o_orderstatus", F.lit(f"d{i}")))
    done = t.compact(force=False, min_deltas=2)
    depth = t.layout_report().groupBy("partition").agg(F.max("depth").alias("depth"))
    return t.read().groupBy("o_year", "o_orderstatus").agg(F.count(F.lit(1)).alias("n")).join(
        depth.select(F.substring_index("partition", "=", -1).cast("int").alias("o_year"), "depth"), "o_year"
    ).withColumn("compacted", F.concat(F.lit("o_year="), F.col("o_year").cast("string")).isin(done))


def compact_oldest(spark, sf):
    t = order_table(spark, sf, "c4")
    t.compact_oldest(3)
    return t.read().select(*_ORDER)


def orphans(spark, sf):
    """Files of a write that never published: found, while live ones are not."""
    t = order_table(spark, sf, "c5", deltas=2)
    lost = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    lost.write.partitionBy("o_orderpriority").parquet(f"{t.root}/data/__write=lost/__commit=000000000000-lost")
    found = t.find_orphans(timedelta(0))
    return found.groupBy(
        F.regexp_extract("path", "o_orderpriority=([^/]*)/", 1).alias("o_orderpriority")
    ).agg((F.count(F.lit(1)) > 0).alias("found"))


def remove_orphans(spark, sf):
    """Per priority: orders read after a cleanup, whether files of a lost write went, whether any is left."""
    orders = table(spark, sf, "orders")
    t = KeyedTable.create(spark, scratch(spark, "c5-remove"), orders, keys=["o_orderkey"], buckets=BUCKETS, unique_keys=True)
    orders.filter("o_orderstatus = 'P'").write.partitionBy("o_orderpriority").parquet(
        f"{t.root}/data/__write=lost/__commit=000000000000-lost"
    )
    priority = F.regexp_extract("path", "o_orderpriority=([^/]*)/", 1).alias("o_orderpriority")
    done = t.remove_orphans(timedelta(0), dry_run=False).filter("removed").select(priority, F.lit(1).alias("removed"))
    left = t.find_orphans(timedelta(0)).select(priority, F.lit(1).alias("remaining"))
    read = t.read().groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return read.join(done.distinct(), "o_orderpriority", "left").join(left.distinct(), "o_orderpriority", "left").select(
        "o_orderpriority", "n", F.col("removed").isNotNull().alias("removed"), F.col("remaining").isNotNull().alias("remaining")
    )


QUERIES = {
    "s1_read_table": read_table,
    "s2_read_pruned": read_pruned,
    "s2_read_random": read_random,
    "s3_read_partition_path": read_partition_path,
    "u8_delete_in_buckets": delete_in_buckets,
    "s4_read_as_of": read_as_of,
    "s5_read_commits": read_commits,
    "s6_append": append,
    "s7_overwrite": overwrite,
    "s8_replace_where": replace_where,
    "s9_save_ignore": save_ignore,
    "s10_insert_by_position": insert_by_position,
    "s11_insert_overwrite_partition": insert_overwrite_partition,
    "s12_create_table": create_table,
    "s13_bucketed_write": bucketed_write,
    "s14_publish_partition": publish_partition,
    "p1_projection_without_key": projection_without_key,
    "p2_filter_after_merge": filter_after_merge,
    "p3_partition_and_data_filter": partition_and_data_filter,
    "u1_upsert": upsert_delta,
    "u2_upsert_rewrite": upsert_rewrite,
    "u4_upsert_evolving": upsert_evolving,
    "u5_upsert_conditional": upsert_conditional,
    "u8_delete_rows": delete_rows,
    "u8_delete_rows_unkeyed": delete_rows_unkeyed,
    "u9_delete_partitions": delete_partitions,
    "u10_delete_all": delete_all,
    "u11_update_rows": update_rows,
    "u12_update_all": update_all,
    "u13_update_nested": update_nested,
    "u14_conditional_merge": conditional_merge,
    "u15_drop_partition": drop_partition,
    "u16_touched_files": touched_files,
    "c1_compact": compact_table,
    "c2_compact_partition": compact_partition,
    "c3_compact_when_deep": compact_when_deep,
    "c4_compact_oldest": compact_oldest,
    "c5_orphans": orphans,
    "c5_remove_orphans": remove_orphans,
}

_Y = f"WITH {YEARLY} SELECT {{cols}} FROM yearly"
_PLAIN = _Y.format(cols=YEARLY_COLUMNS)


_LATER = "CASE WHEN o_orderstatus = 'F' THEN 'Z' ELSE o_orderstatus END"


def _status(case: str) -> str:
    return YEARLY_COLUMNS.replace("o_orderstatus", f"{case} AS o_orderstatus")


_REWRITE = f"""WITH {YEARLY}, source AS (
  SELECT o_orderkey, o_year, 'R' AS o_orderstatus,
         CASE WHEN o_totalprice > 200000 THEN o_totalprice + 1 END AS o_totalprice
  FROM yearly WHERE o_orderstatus = 'F'
  UNION ALL SELECT o_orderkey + 10000000, o_year, o_orderstatus, o_totalprice FROM yearly WHERE o_orderstatus = 'P'
) SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, t.o_custkey,
         coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
         coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice, t.o_orderdate, t.o_orderpriority,
         coalesce(s.o_year, t.o_year) AS o_year
  FROM yearly t FULL JOIN (SELECT * FROM source WHERE {{cond}}) s
    ON t.o_orderkey = s.o_orderkey AND t.o_year = s.o_year"""

SQL = {
    "s1_read_table": f"{MERGED} SELECT {ORDER_COLUMNS} FROM merged",
    "s2_read_pruned": f"WITH {YEARLY} SELECT {_status('''CASE WHEN o_orderstatus = 'F' THEN 'Z' ELSE o_orderstatus END''')}"
    " FROM yearly WHERE o_year >= 1997 AND o_year < 1999 AND o_totalprice > 100000",
    "s3_read_partition_path": f"{_PLAIN} WHERE o_year = 1998",
    "s4_read_as_of": f"WITH {YEARLY} SELECT 0 AS v, o_orderkey, o_orderstatus FROM yearly WHERE o_year = 1997"
    " UNION ALL SELECT 1, o_orderkey, '1' FROM yearly WHERE o_year = 1997",
    "s5_read_commits": f"WITH {ORDER_VERSIONS}, {merged_sql(only='seq IN (1, 2)')} SELECT {ORDER_COLUMNS} FROM merged",
    "s6_append": f"{_PLAIN} UNION ALL SELECT {YEARLY_COLUMNS} FROM yearly WHERE o_orderstatus = 'F'",
    "s7_overwrite": f"{_PLAIN} WHERE o_orderstatus <> 'F'",
    "s8_replace_where": f"{_PLAIN} WHERE o_year NOT IN (1996, 1997) UNION ALL SELECT "
    + YEARLY_COLUMNS.replace("o_orderpriority", "'new' AS o_orderpriority")
    + " FROM yearly WHERE o_year IN (1996, 1997) AND o_orderstatus = 'O'",
    "s9_save_ignore": _PLAIN,
    "s10_insert_by_position": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part UNION ALL"
    " SELECT p_partkey + 1000000, p_name, p_type, p_brand, p_size, p_retailprice FROM part",
    "s11_insert_overwrite_partition": f"{_PLAIN} WHERE o_year <> 1998 UNION ALL SELECT {ORDER_COLUMNS}, 1998"
    " FROM yearly WHERE o_orderstatus = 'P'",
    "s12_create_table": _PLAIN,
    "s13_bucketed_write": f"WITH {bucketed_sql('orders', 'o_orderkey', BUCKETS, 'b')}"
    " SELECT bucket, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM b GROUP BY bucket",
    "s14_publish_partition": f"WITH {YEARLY} SELECT "
    + _status("CASE WHEN o_totalprice < 50000 THEN 'U' ELSE o_orderstatus END")
    + " FROM yearly WHERE o_year IN (1996, 1997)",
    "p1_projection_without_key": f"{MERGED} SELECT o_orderstatus, o_totalprice FROM merged",
    "p2_filter_after_merge": f"{MERGED} SELECT {ORDER_COLUMNS} FROM merged"
    " WHERE o_totalprice < 200000 AND o_orderstatus <> 'X'",
    "p3_partition_and_data_filter": f"WITH {YEARLY} SELECT {_status(_LATER)} FROM yearly"
    " WHERE o_year = 1997 AND o_orderpriority = '2-HIGH'",
    "s2_read_random": f"WITH {YEARLY} SELECT {_status(_LATER)} FROM yearly WHERE o_year >= 1997",
    "u8_delete_in_buckets": f"""WITH {YEARLY}, {bucketed_sql('yearly', 'o_orderkey', YEARLY_BUCKETS, 'b')}
SELECT o_year, bucket, count(*) FILTER (WHERE o_orderkey % 499 <> 0) AS n FROM b GROUP BY o_year, bucket
HAVING count(*) FILTER (WHERE o_orderkey % 499 = 0) > 0""",
    "u1_upsert": f"WITH {ORDER_VERSIONS}, {merged_sql(only='seq <= 1')} SELECT {ORDER_COLUMNS} FROM merged",
    "u2_upsert_rewrite": _REWRITE.format(cond="true"),
    "u4_upsert_evolving": f"SELECT {ORDER_COLUMNS}, CASE WHEN o_totalprice > 250000 THEN o_orderpriority || '!' END"
    " AS o_note FROM orders",
    "u5_upsert_conditional": _REWRITE.format(cond="o_year = 1997"),
    "u8_delete_rows": f"{_PLAIN} WHERE ({_NULLABLE}) IS DISTINCT FROM true",
    "u8_delete_rows_unkeyed": f"{_PLAIN} WHERE (o_year <= 1998 AND {_NULLABLE}) IS DISTINCT FROM true",
    "u9_delete_partitions": f"{_PLAIN} WHERE o_year >= 1998",
    "u10_delete_all": f"{_PLAIN} WHERE false",
    "u11_update_rows": f"WITH {YEARLY} SELECT "
    + _status(f"CASE WHEN {_NULLABLE} THEN '7' ELSE o_orderstatus END").replace(
        "o_totalprice", f"CASE WHEN {_NULLABLE} THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice"
    )
    + " FROM yearly",
    "u12_update_all": f"WITH {YEARLY} SELECT "
    + YEARLY_COLUMNS.replace("o_orderpriority", "substring(o_orderpriority, 1, 1) AS o_orderpriority").replace(
        "o_custkey", "o_custkey + 1 AS o_custkey"
    )
    + " FROM yearly",
    "u13_update_nested": "SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN c_mktsegment || '!' ELSE c_name END AS d,"
    " c_nationkey AS e, CASE WHEN c_nationkey < 12 THEN 0.0::DOUBLE ELSE c_acctbal END AS g, c_mktsegment AS z"
    " FROM customer",
    "u14_conditional_merge": """WITH source AS (
  SELECT o_orderkey, o_custkey + 1 AS o_custkey,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'null' ELSE 'new' END AS o_orderstatus,
         1.0::DOUBLE AS o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_totalprice > 150000
  UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
         FROM orders WHERE o_orderstatus = 'P'
) SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
         CASE WHEN t.o_orderkey IS NULL THEN s.o_orderstatus WHEN s.o_orderstatus <> 'null' THEN s.o_orderstatus
              ELSE t.o_orderstatus END AS o_orderstatus,
         CASE WHEN t.o_orderkey IS NULL THEN s.o_totalprice WHEN s.o_orderkey IS NULL THEN t.o_totalprice
              ELSE t.o_totalprice + s.o_totalprice END AS o_totalprice,
         coalesce(t.o_orderdate, s.o_orderdate) AS o_orderdate,
         coalesce(t.o_orderpriority, s.o_orderpriority) AS o_orderpriority
  FROM orders t FULL JOIN source s ON t.o_orderkey = s.o_orderkey""",
    "u15_drop_partition": f"{_PLAIN} WHERE o_year <> 1997",
    "u16_touched_files": f"WITH {YEARLY} SELECT o_year, count(*) AS matches FROM yearly"
    " WHERE o_year >= 1997 AND o_orderstatus = 'P' GROUP BY o_year",
    "c1_compact": f"{MERGED} SELECT {ORDER_COLUMNS} FROM merged",
    "c2_compact_partition": f"WITH {YEARLY} SELECT "
    + _status("CASE WHEN o_totalprice < 90000 THEN 'U' ELSE o_orderstatus END")
    + " FROM yearly",
    "c3_compact_when_deep": f"""WITH {YEARLY}, named AS (
  SELECT o_year, CASE WHEN o_year >= 1997 THEN 'd2' ELSE o_orderstatus END AS o_orderstatus FROM yearly
) SELECT o_year, o_orderstatus, count(*) AS n,
         CASE WHEN o_year > 1997 THEN 2 ELSE 1 END::BIGINT AS depth, o_year = 1997 AS compacted
  FROM named GROUP BY o_year, o_orderstatus""",
    "c4_compact_oldest": f"{MERGED} SELECT {ORDER_COLUMNS} FROM merged",
    "c5_orphans": "SELECT o_orderpriority, true AS found FROM orders WHERE o_orderstatus = 'P' GROUP BY o_orderpriority",
    "c5_remove_orphans": "SELECT o_orderpriority, count(*) AS n, bool_or(o_orderstatus = 'P') AS removed,"
    " false AS remaining FROM orders GROUP BY o_orderpriority",
}
