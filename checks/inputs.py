"""Change sets that the registered queries derive from the given tables.

A change set is chosen by what an order says (status, priority, price, month),
and every query reads whole tables. SQL fragments next to the Spark builders
describe the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keytide import KeyedTable
from keytide.sources.scratch import scratch_dir

BUCKETS = 4
YEARLY_BUCKETS = 2


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    return scratch_dir(spark, label)


# -- ordered deltas of orders ---------------------------------------------------


def order_deltas(spark: SparkSession, sf: str) -> list[DataFrame]:
    """All orders, then four changes; two of them carry only some columns."""
    o = table(spark, sf, "orders")
    return [
        o,
        o.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2),
        o.filter("o_orderpriority = '1-URGENT'").select("o_orderkey", F.lit("X").alias("o_orderstatus")),
        o.filter("o_orderstatus = 'P'").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000),
        o.filter("o_totalprice > 300000").select(
            "o_orderkey", F.lit(None).cast("string").alias("o_orderpriority")
        ),
    ]


ORDER_VERSIONS = """
versions AS (
  SELECT 0 AS seq, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         true AS whole, true AS has_status, true AS has_priority FROM orders
  UNION ALL SELECT 1, o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2, o_orderdate, o_orderpriority,
         true, true, true FROM orders WHERE o_orderstatus = 'F'
  UNION ALL SELECT 2, o_orderkey, NULL, 'X', NULL, NULL, NULL, false, true, false
         FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT 3, o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         o_orderpriority, true, true, true FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT 4, o_orderkey, NULL, NULL, NULL, NULL, NULL, false, false, true
         FROM orders WHERE o_totalprice > 300000
)"""


def merged_sql(name: str = "merged", only: str = "true") -> str:
    return f"""
{name} AS (
  SELECT o_orderkey,
         (arg_max({{'c': o_custkey}}, seq) FILTER (WHERE whole)).c AS o_custkey,
         (arg_max({{'c': o_orderstatus}}, seq) FILTER (WHERE has_status)).c AS o_orderstatus,
         (arg_max({{'c': o_totalprice}}, seq) FILTER (WHERE whole)).c AS o_totalprice,
         (arg_max({{'c': o_orderdate}}, seq) FILTER (WHERE whole)).c AS o_orderdate,
         (arg_max({{'c': o_orderpriority}}, seq) FILTER (WHERE has_priority)).c AS o_orderpriority
  FROM versions WHERE {only} GROUP BY o_orderkey
)"""


ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
MERGED = f"WITH {ORDER_VERSIONS}, {merged_sql()}"


def order_table(spark: SparkSession, sf: str, label: str, deltas: int = 5) -> KeyedTable:
    """Orders as a keyed table: a base and the first deltas above it."""
    first, *rest = order_deltas(spark, sf)[:deltas]
    t = KeyedTable.create(spark, scratch(spark, label), first, keys=["o_orderkey"], buckets=BUCKETS,
                          unique_keys=True)
    for d in rest:
        t.upsert(d)
    return t


# -- orders by year -------------------------------------------------------------


def yearly(df: DataFrame) -> DataFrame:
    return df.withColumn("o_year", F.year("o_orderdate"))


YEARLY_COLUMNS = f"{ORDER_COLUMNS}, o_year"
YEARLY = "yearly AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders)"


def yearly_table(spark: SparkSession, sf: str, label: str, keys: bool = True) -> KeyedTable:
    df = yearly(table(spark, sf, "orders"))
    if not keys:
        return KeyedTable.create(spark, scratch(spark, label), df, range_cols=["o_year"])
    return KeyedTable.create(spark, scratch(spark, label), df, range_cols=["o_year"], keys=["o_orderkey"],
                             buckets=YEARLY_BUCKETS, unique_keys=True)


# -- eleven ordered batches -----------------------------------------------------

BATCHES = 11


def access_batches(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Batch 0 holds every order, batch i the orders of month i with new values."""
    o = table(spark, sf, "orders")
    out = []
    for i in range(BATCHES):
        name = (
            F.when(F.col("o_orderpriority") == "1-URGENT", "null")
            .when((F.col("o_orderpriority") == "5-LOW") & F.lit(i > 0), F.lit(None).cast("string"))
            .otherwise(F.concat("o_orderpriority", F.lit(f"-{i}")))
        )
        rows = o if i == 0 else o.filter(F.month("o_orderdate") == i)
        out.append(
            rows.select(
                F.col("o_orderkey").alias("uuid"),
                F.concat(F.lit(f"10.{i}."), F.col("o_custkey").cast("string")).alias("ip"),
                F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("hostname"),
                (F.col("o_custkey") + i).alias("requests"),
                name.alias("name"),
                F.lit(f"city-{i}").alias("city"),
                F.col("o_orderdate").cast("date").cast("string").alias("job"),
                F.concat(F.lit(f"+{i}-"), F.col("o_orderkey").cast("string")).alias("phonenum"),
            )
        )
    return out


def access_sql() -> str:
    parts = []
    for i in range(BATCHES):
        low = "WHEN o_orderpriority = '5-LOW' THEN NULL " if i else ""
        where = f"WHERE month(o_orderdate) = {i}" if i else ""
        parts.append(
            f"SELECT {i} AS seq, o_orderkey AS uuid, '10.{i}.' || o_custkey AS ip,"
            " CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS hostname,"
            f" o_custkey + {i} AS requests, CASE WHEN o_orderpriority = '1-URGENT' THEN 'null' {low}"
            f"ELSE o_orderpriority || '-{i}' END AS name, 'city-{i}' AS city,"
            f" CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS job, '+{i}-' || o_orderkey AS phonenum"
            f" FROM orders {where}"
        )
    return "batches AS (" + " UNION ALL ".join(parts) + ")"


ACCESS_COLUMNS = ("uuid", "ip", "hostname", "requests", "name", "city", "job", "phonenum")
# -- change events --------------------------------------------------------------

EVENT_ROW = "event_id bigint, user_id bigint, event_type string, value double"


def change_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as change records: sign-ups create, errors delete, the rest update."""
    e = table(spark, sf, "events")
    image = F.struct("event_id", "user_id", "event_type", "value")
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    db_table = F.when(F.col("event_type").isin("signup", "purchase"), "accounts").otherwise("activity")
    return e.select(
        F.to_json(
            F.struct(
                F.when(op != "c", image).alias("before"),
                F.when(op != "d", image).alias("after"),
                F.struct(F.lit("shop").alias("db"), db_table.alias("table")).alias("source"),
                op.alias("op"),
                F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
            )
        ).alias("value")
    )


CHANGE_OP = "CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END"
# Milliseconds since 1970 of an event.
EVENT_MS = "CAST(floor(epoch_us(ts) / 1000.0) AS BIGINT)"


# -- buckets --------------------------------------------------------------------

_WORD = 1 << 32
# The constants of the 32-bit Murmur3 hash, and the seed of bucket numbers.
_MULTIPLIERS, _FINAL, _ADD, _SEED = (0xCC9E2D51, 0x1B873593), (0x85EBCA6B, 0xC2B2AE35), 0xE6546B64, 42


def bucketed_sql(source: str, key: str, buckets: int, name: str) -> str:
    """CTEs that end in ``name``: the rows of ``source`` with the bucket of a bigint key, step by step."""
    def turned(x: str, by: int) -> str:
        return f"((({x} << {by}) | ({x} >> {32 - by})) % {_WORD})"

    first, steps = f"{name}_0", []

    def step(expr: str) -> None:
        old = f"{name}_{len(steps)}"
        steps.append(f"{name}_{len(steps) + 1} AS (SELECT * EXCLUDE (h, k), {expr} FROM {old})")

    for half in ("lo", "hi"):
        step(f"h, ({half} * {_MULTIPLIERS[0]}) % {_WORD} AS k")
        step(f"h, {turned('k', 15)} AS k")
        step(f"xor(h, (k * {_MULTIPLIERS[1]}) % {_WORD}) AS h, k")
        step(f"({turned('h', 13)} * 5 + {_ADD}) % {_WORD} AS h, k")
    step("xor(h, 8::HUGEINT) AS h, k")
    step(f"(xor(h, h >> 16) * {_FINAL[0]}) % {_WORD} AS h, k")
    step(f"(xor(h, h >> 13) * {_FINAL[1]}) % {_WORD} AS h, k")
    step("xor(h, h >> 16) AS h, k")
    signed = f"(CASE WHEN h >= {_WORD // 2} THEN h - {_WORD} ELSE h END)"
    return (
        f"{first} AS (SELECT *, {key}::HUGEINT % {_WORD} AS lo, {key}::HUGEINT // {_WORD} AS hi, {_SEED}::HUGEINT AS h, 0::HUGEINT AS k"
        f" FROM {source}), {', '.join(steps)}, {name} AS (SELECT * EXCLUDE (h, k, lo, hi),"
        f" ((({signed} % {buckets}) + {buckets}) % {buckets})::INT AS bucket FROM {name}_{len(steps)})"
    )
