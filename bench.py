"""Headline timings; prints one JSON line.

Tables are built before the clock starts unless the write is what is measured.
Every timed query runs to the end of its plan into the no-op sink, after one
warm-up run; the best of three runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import checks.cdc as C
from checks.inputs import ACCESS_COLUMNS, access_batches, change_events, order_deltas, scratch, table
from checks.joins import _ON, _sides
from keytide import KeyedTable
from keytide.operators.bucketed import store_bucketed
from keytide.plans.joins import equi_join
from keytide.plans.merge import merge_deltas, premerge
from keytide.streaming import cdc

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
BUCKETS = 8
OPS = {"requests": "sum", "name": "non_null"}


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def exchanges(df) -> int:
    """Shuffles and broadcasts that the plan starts with."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(line.lstrip(" :+-*()0123456789").startswith(("Exchange", "BroadcastExchange")) for line in plan.splitlines())


def timed(run, runs: int = RUNS) -> float:
    best = None
    for i in range(runs + 1):
        start = time.perf_counter()
        run()
        took = time.perf_counter() - start
        if i and (best is None or took < best):
            best = took
    return round(best, 3)


def chained_joins(batches, ops):
    """What the pre-merge replaces: one full join per batch, columns combined by their operator."""
    combined = {
        "sum": lambda old, new: F.coalesce(old + new, new, old),
        "non_null": lambda old, new: F.coalesce(F.nullif(new, F.lit("null")), old),
        "latest": lambda old, new: F.coalesce(new, old),
    }
    key, *rest = ACCESS_COLUMNS
    out = batches[0]
    for i, batch in enumerate(batches[1:]):
        named = batch.select(key, *(F.col(c).alias(f"{c}_{i}") for c in rest))
        out = out.join(named, key, "full").select(
            key, *(combined[ops.get(c, "latest")](F.col(c), F.col(f"{c}_{i}")).alias(c) for c in rest)
        )
    return out


def main() -> None:
    spark = session()
    q: dict[str, float] = {}
    plans: dict[str, int] = {}

    def read(name, make, runs=RUNS):
        """Time a query to its end and note how many exchanges its plan has."""
        plans[name] = exchanges(make())
        q[name] = timed(lambda: drain(make()), runs)

    deltas = order_deltas(spark, SF)
    batches = access_batches(spark, SF)

    def table_of(parts, key, unique=True):
        t = KeyedTable.create(spark, scratch(spark, "bench"), parts[0], keys=[key], buckets=BUCKETS, unique_keys=unique)
        if len(parts) > 1:
            t.bulk_upsert(parts[1:])
        return t

    read("b0_merge_in_memory", lambda: merge_deltas(deltas, ["o_orderkey"]))
    one = table_of(deltas[:2], "o_orderkey")
    read("b1_merge_read_1_delta", lambda: one.read())
    four = table_of(deltas, "o_orderkey")
    read("b1_merge_read_4_deltas", lambda: four.read())
    eleven = table_of(batches, "uuid")
    read("b1_merge_read_11_deltas", lambda: eleven.read())
    read("b2_operator_read", lambda: eleven.read(ops=OPS))
    q["b2_bulk_write"] = timed(lambda: table_of(batches, "uuid"), 1)
    read("b3_premerge", lambda: premerge(batches, ["uuid"], ["requests"], ["name"]))
    read("b3_chained_full_joins", lambda: chained_joins(batches, OPS), 1)
    eleven.compact(ops=OPS)
    read("b4_read_after_compaction", lambda: eleven.read(ops=OPS))
    o, li = _sides(spark, SF)
    tag = str(os.getpid())
    bo = store_bucketed(o, f"bench_o_{tag}", ["o_orderkey"], BUCKETS, scratch(spark, "bench-o"))
    bl = store_bucketed(li, f"bench_l_{tag}", ["l_orderkey"], BUCKETS, scratch(spark, "bench-l"))
    read("b5_join_cobucketed", lambda: equi_join(bo.hint("merge"), bl, _ON))
    read("b5_join_shuffled", lambda: equi_join(o.hint("merge"), li, _ON))
    read("b5_join_full_split", lambda: equi_join(o, li, _ON, "full"))
    row = T.StructType.fromDDL("event_id bigint, user_id bigint, event_type string, value double")
    records = change_events(spark, SF)

    def apply():
        schema = T.StructType([*row.fields, T.StructField("op", T.StringType())])
        t = KeyedTable.define(spark, scratch(spark, "bench-cdc"), schema, keys=["user_id"], buckets=BUCKETS, cdc_col="op")
        events = cdc.flatten_envelope(cdc.parse_events(records, row), keep=("ts_ms",))
        t.upsert(cdc.latest_changes(events, ["user_id"], [F.col("ts_ms"), F.col("event_id")]).drop("ts_ms"))
        drain(t.read_cdc())

    q["b6_change_apply"] = timed(apply, 1)
    q["b7_delete_rewrite"] = timed(lambda: table_of(deltas[:1], "o_orderkey").delete("o_orderpriority > '3'"), 1)
    chains = table(spark, SF, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    read("b8_concat_long_chains", lambda: merge_deltas([chains], ["o_custkey"], {"o_orderstatus": "concat"},
                                                       ["o_orderdate", "o_orderkey"]))
    read("b9_decode_envelope", lambda: C.decode(spark, SF))
    read("b9_order_changes", lambda: C.order(spark, SF))
    total = round(sum(q.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": q,
                      "sf": os.path.basename(SF.rstrip("/")), "cpus": int(CPUS), "exchanges": plans,
                      "rows": {n: table(spark, SF, n).count() for n in ("orders", "lineitem", "events")}}))
    spark.stop()
    sys.stdout.flush()


if __name__ == "__main__":
    main()
