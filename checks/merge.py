"""Merge plans over in-memory deltas and over a table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import (
    ACCESS_COLUMNS,
    BUCKETS,
    MERGED,
    ORDER_COLUMNS,
    ORDER_VERSIONS,
    access_batches,
    access_sql,
    order_deltas,
    order_table,
    scratch,
    table,
)
from keytide import Concat, Custom, KeyedTable, Running, register_merge_op
from keytide.plans.merge import merge_deltas, premerge

_KEY = ["o_orderkey"]


def latest(spark, sf):
    return merge_deltas(order_deltas(spark, sf), _KEY)


def _money(spark, sf):
    """Deltas with an exact price, so that sums do not depend on their order."""
    return [
        d.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")) if "o_totalprice" in d.columns else d
        for d in order_deltas(spark, sf)
    ]


def summed(spark, sf):
    return merge_deltas(_money(spark, sf), _KEY, {"o_totalprice": "sum"}).select("o_orderkey", "o_totalprice")


def joined_text(spark, sf):
    return merge_deltas(order_deltas(spark, sf), _KEY, {"o_orderstatus": "concat"}).select(
        "o_orderkey", "o_orderstatus"
    )


def joined_semicolon(spark, sf):
    return merge_deltas(order_deltas(spark, sf), _KEY, {"o_orderpriority": Concat(";")}).select(
        "o_orderkey", "o_orderpriority"
    )


def customer_history(spark, sf):
    """Statuses of all orders of a customer in date order: long chains on few keys."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return merge_deltas([o], ["o_custkey"], {"o_orderstatus": "concat"}, ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderstatus"
    )


def non_null(spark, sf):
    return merge_deltas(access_batches(spark, sf), ["uuid"], {"name": "non_null"}).select("uuid", "name")


def per_column(spark, sf):
    return merge_deltas(access_batches(spark, sf), ["uuid"], {"requests": "sum", "name": "non_null"})


def _access_table(spark, sf, label):
    first, *rest = access_batches(spark, sf)
    t = KeyedTable.create(spark, scratch(spark, label), first, keys=["uuid"], buckets=BUCKETS, unique_keys=True)
    t.bulk_upsert(rest)
    return t


def read_time_ops(spark, sf):
    return _access_table(spark, sf, "m7").read(ops={"requests": "sum", "name": "non_null"}).select(*ACCESS_COLUMNS)


def own_operator(spark, sf):
    longest = Custom(lambda values: max((v for v in values if v is not None), key=lambda v: (len(v), v), default=None))
    register_merge_op("longest", longest)
    return merge_deltas(access_batches(spark, sf), ["uuid"], {"name": "longest"}).select("uuid", "name")


def _turn(state, price):
    """(last price, last direction, changes of direction) after one more price."""
    last, way, turns = state
    if last is None or price is None or price == last:
        return price if price is not None else last, way, turns
    now = price > last
    return price, now, turns + (way is not None and now != way)


_TURNS = Running(lambda: (None, None, 0), _turn, lambda state: state[2])


def running_fold(spark, sf):
    """How often the prices of a customer's orders change their direction, beside the newest status and a sum:
    a fold that no pieces could be put together for."""
    o = table(spark, sf, "orders").select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("turns"),
        F.lit(1).cast("bigint").alias("orders"),
    )
    ops = {"turns": _TURNS, "orders": "sum"}
    return merge_deltas([o], ["o_custkey"], ops, ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderstatus", "turns", "orders")


def running_fold_of_a_table(spark, sf):
    """Directions of one column over all commits of a table; a commit without the column is no step."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("turns"))
    by_month = [o.join(table(spark, sf, "orders").filter(F.month("o_orderdate") == m).select("o_orderkey"), "o_orderkey") for m in range(1, 7)]
    deltas = [d.groupBy("o_custkey").agg(F.max("turns").alias("turns")) for d in by_month]
    first, *rest = [*deltas[:3], o.groupBy("o_custkey").agg(F.count("*").alias("orders")), *deltas[3:]]
    schema = T.StructType([o.schema["o_custkey"], o.schema["turns"], T.StructField("orders", T.LongType())])
    t = KeyedTable.define(spark, scratch(spark, "m8-running"), schema, keys=["o_custkey"], buckets=BUCKETS)
    t.bulk_upsert([first, *rest])
    return t.read(ops={"turns": _TURNS}).select("o_custkey", "turns", "orders")


def compacted_ops(spark, sf):
    t = _access_table(spark, sf, "m9")
    t.compact(ops={"requests": "sum", "name": "non_null"})
    return t.read().select(*ACCESS_COLUMNS)


def sum_after_compaction(spark, sf):
    """A sum persisted by compaction keeps adding up with later deltas."""
    batches = access_batches(spark, sf)
    t = KeyedTable.create(spark, scratch(spark, "m9-later"), batches[0], keys=["uuid"], buckets=BUCKETS,
                          unique_keys=True)
    t.bulk_upsert(batches[1:6])
    t.compact(ops={"requests": "sum"})
    t.bulk_upsert(batches[6:])
    return t.read(ops={"requests": "sum"}).select("uuid", "requests")


def partial_columns(spark, sf):
    return order_table(spark, sf, "u3").read().select(*ORDER_COLUMNS.split(", "))


def bulk(spark, sf):
    first, *rest = order_deltas(spark, sf)
    t = KeyedTable.create(spark, scratch(spark, "u6"), first, keys=_KEY, buckets=BUCKETS, unique_keys=True)
    t.bulk_upsert(rest)
    return t.read().select(*ORDER_COLUMNS.split(", "))


def premerged(spark, sf):
    return premerge(access_batches(spark, sf), ["uuid"], sums=["requests"], skip_null_text=["name"])


def premerged_table(spark, sf):
    """Batches collapsed in four groups, then upserted as one version and read back."""
    b = access_batches(spark, sf)

    def group(part):
        return premerge(part, ["uuid"], sums=["requests"], skip_null_text=["name"]) if len(part) > 1 else part[0]

    groups = [group(b[:1]), group(b[1:5]), group(b[5:8]), group(b[8:11])]
    t = KeyedTable.define(spark, scratch(spark, "u7"), b[0].schema, keys=["uuid"], buckets=BUCKETS)
    t.bulk_upsert(groups)
    return t.read(ops={"requests": "sum", "name": "non_null"}).select(*ACCESS_COLUMNS)


_SEQ_MAX = "arg_max({{'c': {c}}}, seq).c AS {c}"
_LATEST = {c: _SEQ_MAX.format(c=c) for c in ACCESS_COLUMNS if c != "uuid"}
_SUM = "CAST(sum(requests) AS BIGINT) AS requests"
_NON_NULL = (
    "coalesce(arg_max(name, seq) FILTER (WHERE name <> 'null'), max(name) FILTER (WHERE name = 'null')) AS name"
)


def _access(**over):
    cols = ", ".join({**_LATEST, **over}.values())
    return f"WITH {access_sql()} SELECT uuid, {cols} FROM batches GROUP BY uuid"


_NEWEST = {c: f"arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ACCESS_COLUMNS if c != "uuid"}
_OLDEST_NAME = (
    "coalesce(arg_max(name, seq) FILTER (WHERE name <> 'null'), max(name) FILTER (WHERE seq = {first})) AS name"
)


def _premerge_sql(source: str, first: int, where: str) -> str:
    cols = ", ".join({**_NEWEST, "requests": _SUM, "name": _OLDEST_NAME.format(first=first)}.values())
    return f"SELECT uuid, {cols} FROM {source} WHERE {where} GROUP BY uuid"


def _premerged_table_sql() -> str:
    cols = ", ".join(ACCESS_COLUMNS)
    groups = [f"SELECT 0 AS seq, {cols} FROM batches WHERE seq = 0"]
    for i, (lo, hi) in enumerate([(1, 4), (5, 7), (8, 10)], start=1):
        inner = _premerge_sql("batches", lo, f"seq BETWEEN {lo} AND {hi}")
        groups.append(f"SELECT {i} AS seq, {cols} FROM ({inner})")
    final = ", ".join({**_LATEST, "requests": _SUM, "name": _NON_NULL}.values())
    return (
        f"WITH {access_sql()}, grouped AS ({' UNION ALL '.join(groups)}) "
        f"SELECT uuid, {final} FROM grouped GROUP BY uuid"
    )


def _turns_sql(rows: str, order: str) -> str:
    """Changes of direction of ``p`` along an order, by key; steps without a direction are passed over."""
    return (
        f"ways AS (SELECT *, sign(p - lag(p) OVER (PARTITION BY o_custkey ORDER BY {order})) AS way FROM {rows}),"
        f" pairs AS (SELECT *, lag(way) OVER (PARTITION BY o_custkey ORDER BY {order}) AS before FROM ways WHERE way <> 0),"
        " turned AS (SELECT o_custkey, count(*) FILTER (WHERE way <> before) AS turns FROM pairs GROUP BY o_custkey)"
    )


QUERIES = {
    "m1_latest_wins": latest,
    "m2_sum": summed,
    "m3_ordered_concat": joined_text,
    "m3_long_chains": customer_history,
    "m4_concat_separator": joined_semicolon,
    "m5_non_null": non_null,
    "m6_operator_per_column": per_column,
    "m7_read_time_operators": read_time_ops,
    "m8_own_operator": own_operator,
    "m8_running_fold": running_fold,
    "m8_running_fold_of_a_table": running_fold_of_a_table,
    "m9_compaction_operators": compacted_ops,
    "m9_sum_after_compaction": sum_after_compaction,
    "u3_partial_columns": partial_columns,
    "u6_bulk_upsert": bulk,
    "u7_premerge": premerged,
    "u7_premerge_then_bulk_upsert": premerged_table,
}

SQL = {
    "m1_latest_wins": f"{MERGED} SELECT {ORDER_COLUMNS} FROM merged",
    "m2_sum": f"WITH {ORDER_VERSIONS} SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2))"
    " AS o_totalprice FROM versions GROUP BY o_orderkey",
    "m3_ordered_concat": f"WITH {ORDER_VERSIONS} SELECT o_orderkey, string_agg(o_orderstatus, ',' ORDER BY seq)"
    " AS o_orderstatus FROM versions GROUP BY o_orderkey",
    "m3_long_chains": "SELECT o_custkey, string_agg(o_orderstatus, ',' ORDER BY o_orderdate, o_orderkey)"
    " AS o_orderstatus FROM orders GROUP BY o_custkey",
    "m4_concat_separator": f"WITH {ORDER_VERSIONS} SELECT o_orderkey, string_agg(o_orderpriority, ';' ORDER BY seq)"
    " AS o_orderpriority FROM versions GROUP BY o_orderkey",
    "m5_non_null": f"WITH {access_sql()} SELECT uuid, {_NON_NULL} FROM batches GROUP BY uuid",
    "m6_operator_per_column": _access(requests=_SUM, name=_NON_NULL),
    "m7_read_time_operators": _access(requests=_SUM, name=_NON_NULL),
    "m8_own_operator": f"WITH {access_sql()} SELECT uuid, arg_max(name, {{'n': length(name), 'v': name}}) AS name"
    " FROM batches GROUP BY uuid",
    "m8_running_fold": "WITH prices AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS p FROM orders), "
    + _turns_sql("prices", "o_orderdate, o_orderkey")
    + " SELECT o_custkey, arg_max(o_orderstatus, {'d': o_orderdate, 'k': o_orderkey}) AS o_orderstatus, count(*) AS orders,"
    " coalesce(any_value(turns), 0) AS turns FROM orders LEFT JOIN turned USING (o_custkey) GROUP BY o_custkey",
    "m8_running_fold_of_a_table": "WITH steps AS (SELECT o_custkey, month(o_orderdate) AS m, max(CAST(round(o_totalprice * 100) AS BIGINT)) AS p"
    " FROM orders WHERE month(o_orderdate) <= 6 GROUP BY ALL), " + _turns_sql("steps", "m")
    + " SELECT o_custkey, CASE WHEN bool_or(month(o_orderdate) <= 6) THEN coalesce(any_value(turns), 0) END AS turns,"
    " count(*) AS orders FROM orders LEFT JOIN turned USING (o_custkey) GROUP BY o_custkey",
    "m9_compaction_operators": _access(requests=_SUM, name=_NON_NULL),
    "m9_sum_after_compaction": f"WITH {access_sql()} SELECT uuid, {_SUM} FROM batches GROUP BY uuid",
    "u3_partial_columns": f"{MERGED} SELECT {ORDER_COLUMNS} FROM merged",
    "u6_bulk_upsert": f"{MERGED} SELECT {ORDER_COLUMNS} FROM merged",
    "u7_premerge": f"WITH {access_sql()} {_premerge_sql('batches', 0, 'true')}",
    "u7_premerge_then_bulk_upsert": _premerged_table_sql(),
}
