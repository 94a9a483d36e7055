"""Joins and set comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import MERGED, ORDER_COLUMNS, order_deltas, order_table, scratch, table
from keytide import KeyedTable
from keytide.operators.bucketed import cobucketed_join, join_tables
from keytide.plans.compare import fingerprint, same_rows
from keytide.plans.joins import equi_join
from keytide.plans.merge import merge_deltas

_ON = [("o_orderkey", "l_orderkey")]
_COLS = ("o_orderkey", "o_custkey", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")


def _sides(spark, sf):
    """Orders without the pending ones, and items of orders that were not returned."""
    o = table(spark, sf, "orders").filter("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", "o_totalprice")
    li = table(spark, sf, "lineitem").filter("l_returnflag <> 'R'").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    return o, li


def _join(how):
    def run(spark, sf):
        o, li = _sides(spark, sf)
        return equi_join(o, li, _ON, how).select(*_COLS)

    return run


def inner_residual(spark, sf):
    o, li = _sides(spark, sf)
    return equi_join(o, li, _ON, "inner", residual=F.col("l_extendedprice") > F.col("o_totalprice")).select(*_COLS)


def full_residual(spark, sf):
    o, li = _sides(spark, sf)
    return equi_join(o, li, _ON, "full", residual=F.col("l_extendedprice") > F.col("o_totalprice")).select(*_COLS)


def _half(how):
    def run(spark, sf):
        o, li = _sides(spark, sf)
        return equi_join(o, li, _ON, how).select("o_orderkey", "o_custkey")

    return run


def existence(spark, sf):
    o, li = _sides(spark, sf)
    return equi_join(o, li, _ON, "existence", flag="has_items").select("o_orderkey", "has_items")


def cobucketed(spark, sf):
    o, li = _sides(spark, sf)
    return cobucketed_join(o, li, _ON, 8).select(*_COLS)


def tables_on_buckets(spark, sf):
    """Two keyed tables, one with changes, joined on the key that places their rows."""
    o, li = _sides(spark, sf)
    a = KeyedTable.create(spark, scratch(spark, "j8-o"), o, keys=["o_orderkey"], buckets=8, unique_keys=True)
    b = KeyedTable.create(spark, scratch(spark, "j8-l"), li, keys=["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], buckets=8,
                          bucket_by=["l_orderkey"], unique_keys=True)
    a.upsert(o.filter("o_totalprice > 200000").select("o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey")))
    return join_tables(a, b, _ON).select(*_COLS)


def rows_differ(spark, sf):
    o = table(spark, sf, "orders")
    return same_rows(o, merge_deltas(order_deltas(spark, sf), ["o_orderkey"]).select(*o.columns))


def rows_equal_after_compaction(spark, sf):
    t = order_table(spark, sf, "q1")
    before = t.read()
    t.compact()
    return same_rows(before, t.read())


def checksum(spark, sf):
    """Checksum of the merged orders, with amounts as whole cents and dates as texts."""
    merged = order_table(spark, sf, "q2").read()
    plain = merged.select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderpriority",
    )
    return fingerprint(plain).withColumn("checksum", F.col("checksum").cast("string"))


def checksums_agree(spark, sf):
    """Fingerprints of a merged table, its compacted form and the merge of its deltas."""
    t = order_table(spark, sf, "q2-agree")
    prints = [t.read(), merge_deltas(order_deltas(spark, sf), ["o_orderkey"])]
    t.compact()
    prints.append(t.read())
    union = None
    for p in prints:
        one = fingerprint(p)
        union = one if union is None else union.unionByName(one)
    return union.agg(F.max("rows").alias("rows"), F.count_distinct("rows", "checksum").alias("different"))


QUERIES = {
    "j1_inner": _join("inner"),
    "j1_inner_residual": inner_residual,
    "j2_left": _join("left"),
    "j3_right": _join("right"),
    "j4_full": _join("full"),
    "j4_full_residual": full_residual,
    "j5_left_semi": _half("left_semi"),
    "j6_left_anti": _half("left_anti"),
    "j7_existence": existence,
    "j8_cobucketed": cobucketed,
    "j8_tables_on_buckets": tables_on_buckets,
    "q1_same_rows": rows_differ,
    "q1_same_rows_after_compaction": rows_equal_after_compaction,
    "q2_fingerprint": checksum,
    "q2_fingerprints_agree": checksums_agree,
}

_SIDES = """WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'),
 li AS (SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem WHERE l_returnflag <> 'R')"""
_SELECT = f"{_SIDES} SELECT {', '.join(_COLS)} FROM o"


def _changed_sql() -> str:
    return (
        f"{MERGED}, a AS (SELECT {ORDER_COLUMNS} FROM orders EXCEPT ALL SELECT {ORDER_COLUMNS} FROM merged),"
        f" b AS (SELECT {ORDER_COLUMNS} FROM merged EXCEPT ALL SELECT {ORDER_COLUMNS} FROM orders)"
        " SELECT (SELECT count(*) FROM a) AS only_in_a, (SELECT count(*) FROM b) AS only_in_b,"
        " (SELECT count(*) FROM a) = 0 AND (SELECT count(*) FROM b) = 0 AS same"
    )


SQL = {
    "j1_inner": f"{_SELECT} JOIN li ON o_orderkey = l_orderkey",
    "j1_inner_residual": f"{_SELECT} JOIN li ON o_orderkey = l_orderkey AND l_extendedprice > o_totalprice",
    "j2_left": f"{_SELECT} LEFT JOIN li ON o_orderkey = l_orderkey",
    "j3_right": f"{_SELECT} RIGHT JOIN li ON o_orderkey = l_orderkey",
    "j4_full": f"{_SELECT} FULL JOIN li ON o_orderkey = l_orderkey",
    "j4_full_residual": f"{_SELECT} FULL JOIN li ON o_orderkey = l_orderkey AND l_extendedprice > o_totalprice",
    "j5_left_semi": f"{_SIDES} SELECT o_orderkey, o_custkey FROM o WHERE o_orderkey IN (SELECT l_orderkey FROM li)",
    "j6_left_anti": f"{_SIDES} SELECT o_orderkey, o_custkey FROM o WHERE NOT EXISTS"
    " (SELECT 1 FROM li WHERE l_orderkey = o_orderkey)",
    "j7_existence": f"{_SIDES} SELECT o_orderkey, EXISTS (SELECT 1 FROM li WHERE l_orderkey = o_orderkey)"
    " AS has_items FROM o",
    "j8_cobucketed": f"{_SELECT} JOIN li ON o_orderkey = l_orderkey",
    "j8_tables_on_buckets": f"{_SIDES} SELECT {', '.join(_COLS)} FROM (SELECT * REPLACE"
    " (CASE WHEN o_totalprice > 200000 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey) FROM o)"
    " JOIN li ON o_orderkey = l_orderkey",
    "q1_same_rows": _changed_sql(),
    "q2_fingerprint": f"""{MERGED}, plain AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority FROM merged),
 texts AS (SELECT concat_ws(',', {", ".join(
     f"coalesce(length({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
     for c in ("cents", "day", "o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus"))}) AS t FROM plain)
SELECT count(*) AS rows, CAST(sum(CAST('0x' || substr(md5(t), 1, 15) AS BIGINT)) AS VARCHAR) AS checksum FROM texts""",
    "q1_same_rows_after_compaction": "SELECT 0::BIGINT AS only_in_a, 0::BIGINT AS only_in_b, true AS same",
    "q2_fingerprints_agree": "SELECT count(*) + count(*) FILTER (WHERE o_orderstatus = 'P') AS rows,"
    " 1::BIGINT AS different FROM orders",
}
