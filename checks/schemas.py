"""Schema evolution, drift and constraints."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import table
from keytide.functions.columns import parse_partition_desc, partition_desc
from keytide.plans import schema as S


def union_evolve(spark, sf):
    p = table(spark, sf, "part")
    a = p.select("p_partkey", F.col("p_size").cast("tinyint").alias("p_size"),
                 F.struct("p_name").alias("info"), F.lit(None).alias("note"))
    b = p.select(
        (F.col("p_partkey") + 1_000_000).alias("P_PARTKEY"), F.col("p_size"),
        F.struct(F.col("p_name"), F.col("p_brand")).alias("info"), F.col("p_type").alias("note"),
        F.col("p_retailprice").alias("price"),
    )
    return S.union_evolve([a, b]).select(
        "p_partkey", "p_size", F.col("info.p_name").alias("name"), F.col("info.p_brand").alias("brand"), "note", "price"
    )


def migrate(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.struct("c_name", "c_nationkey").alias("who"),
        F.array(F.struct("c_acctbal")).alias("accounts"), "c_mktsegment",
    )
    out = S.migrate(
        c,
        [
            S.add_column("c_rank", "int", first=True),
            S.add_column("who.title", "string", after="c_name"),
            S.add_column("accounts.element.currency", "string"),
            S.move_column("c_mktsegment", after="c_custkey"),
            S.comment_column("c_custkey", "customer id"),
        ],
    )
    return out.select(
        "c_rank", "c_custkey", "c_mktsegment", F.col("who.c_name").alias("name"), F.col("who.title").alias("title"),
        F.col("accounts")[0]["c_acctbal"].alias("bal"), F.col("accounts")[0]["currency"].alias("currency"),
    )


def drift(spark, sf):
    """Drift of a changed copy of customer, with the values at stake per column."""
    c = table(spark, sf, "customer")
    expected = T.StructType(
        [
            T.StructField("c_custkey", T.LongType(), False),
            T.StructField("c_name", T.StringType(), True),
            T.StructField("c_nationkey", T.LongType(), True),
            T.StructField("c_acctbal", T.DoubleType(), True),
            T.StructField("c_phone", T.StringType(), True),
            T.StructField("C_MKTSEGMENT", T.StringType(), True),
        ]
    )
    actual = c.withColumn("c_note", F.when(F.col("c_acctbal") < 0, "overdrawn"))
    report = S.drift_report(spark, expected, actual).select("path", "differences", "read_compatible")
    counted = S.audit(actual, {n.lower(): F.col(n).isNotNull() for n in actual.columns})
    return report.join(counted, F.lower("path") == F.col("rule"), "left").select(
        "path", "differences", "read_compatible", F.col("violations").alias("values_at_stake")
    )


def not_null_audit(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"),
        F.struct(F.when(F.col("value") > 10, F.col("value")).alias("amount"), "user_id").alias("body"),
    )
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType(), False),
            T.StructField("kind", T.StringType(), False),
            T.StructField("body", T.StructType([T.StructField("amount", T.DoubleType(), False),
                                                T.StructField("user_id", T.LongType(), True)]), True),
        ]
    )
    return S.audit(e, S.not_null_rules(schema))


def not_null_enforced(spark, sf):
    return S.check_not_null(table(spark, sf, "events").select("event_id", "event_type"), ["event_id", "event_type"])


def expr_audit(spark, sf):
    c = table(spark, sf, "customer")
    checks = {"positive": "c_acctbal > 0", "known": "nullif(c_mktsegment, 'BUILDING') <> 'MACHINERY'"}
    return S.audit(c, S.expr_rules(checks))


def expr_enforced(spark, sf):
    return S.check_expr(
        table(spark, sf, "customer").select("c_custkey", "c_acctbal"), {"key": "c_custkey >= 0", "any": "true"}
    )


def descriptors(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("Year"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("prio"),
    )
    d = o.select("o_orderkey", partition_desc(["status", "Year", "prio"]).alias("descriptor"))
    back = parse_partition_desc(F.col("descriptor"))
    return d.select("o_orderkey", "descriptor", back["status"].alias("status"), F.size(back).alias("parts"))


def infer_types(spark, sf):
    o = table(spark, sf, "orders")
    text = "string"
    paths = o.select(
        F.concat(
            F.lit("root/day="), F.col("o_orderdate").cast("date").cast(text),
            F.lit("/at="), F.date_format("o_orderdate", "yyyy-MM-dd HH'%3A'mm'%3A'ss"),
            F.lit("/num="), F.col("o_custkey").cast(text),
            F.lit("/big="), (F.col("o_orderkey") + 3_000_000_000).cast(text),
            F.lit("/huge="), F.concat(F.lit("9999999999999999999"), F.col("o_orderkey").cast(text)),
            F.lit("/price="), F.concat(F.floor("o_totalprice").cast(text), F.lit(".5")),
            F.lit("/mixed="), F.when(F.col("o_orderstatus") == "F", F.concat((F.col("o_orderkey") + 3_000_000_000).cast(text)))
            .otherwise("0.5"),
            F.lit("/sparse="), F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast(text))
            .otherwise("__HIVE_DEFAULT_PARTITION__"),
            F.lit("/word="), F.col("o_orderpriority"),
            F.lit("/part.parquet"),
        ).alias("path")
    )
    return S.infer_partition_types(paths)


def normalize(spark, sf):
    p = table(spark, sf, "part")
    upper = p.toDF(*[c.upper() for c in p.columns])
    return S.normalize_columns(upper, p.schema)


def drop_null_type(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.lit(None).alias("nothing"), F.struct(F.col("c_name").alias("name"), F.lit(None).alias("n")).alias("s")
    )
    out = S.drop_null_type(c)
    return out.select("c_custkey", F.to_json("s").alias("s"))


QUERIES = {
    "e1_union_evolve": union_evolve,
    "e2_migrate": migrate,
    "e3_drift_report": drift,
    "e4_not_null_audit": not_null_audit,
    "e4_not_null_enforced": not_null_enforced,
    "e5_expr_audit": expr_audit,
    "e5_expr_enforced": expr_enforced,
    "e6_partition_desc": descriptors,
    "e7_infer_partition_types": infer_types,
    "p4_normalize_columns": normalize,
    "p5_drop_null_type": drop_null_type,
}

SQL = {
    "e1_union_evolve": "SELECT p_partkey, p_size, p_name AS name, NULL::VARCHAR AS brand, NULL::VARCHAR AS note,"
    " NULL::DOUBLE AS price FROM part UNION ALL SELECT p_partkey + 1000000, p_size, p_name, p_brand, p_type,"
    " p_retailprice FROM part",
    "e2_migrate": "SELECT NULL::INTEGER AS c_rank, c_custkey, c_mktsegment, c_name AS name, NULL::VARCHAR AS title,"
    " c_acctbal AS bal, NULL::VARCHAR AS currency FROM customer",
    "e3_drift_report": """SELECT 'c_custkey' AS path, 'nullability' AS differences, false AS read_compatible,
         (SELECT count(c_custkey) FROM customer) AS values_at_stake
  UNION ALL SELECT 'c_nationkey', 'type', false, (SELECT count(c_nationkey) FROM customer)
  UNION ALL SELECT 'c_phone', 'missing', false, NULL
  UNION ALL SELECT 'C_MKTSEGMENT', 'case', false, (SELECT count(c_mktsegment) FROM customer)
  UNION ALL SELECT 'c_note', 'extra', true, (SELECT count(*) FROM customer WHERE c_acctbal < 0)""",
    "e4_not_null_audit": "SELECT 'event_id' AS rule, count(*) FILTER (WHERE event_id IS NULL) AS violations FROM events"
    " UNION ALL SELECT 'kind', count(*) FILTER (WHERE event_type = 'error' OR event_type IS NULL) FROM events"
    " UNION ALL SELECT 'body.amount', count(*) FILTER (WHERE (value > 10) IS DISTINCT FROM true) FROM events",
    "e4_not_null_enforced": "SELECT event_id, event_type FROM events",
    "e5_expr_audit": "SELECT 'positive' AS rule, count(*) FILTER (WHERE (c_acctbal > 0) IS DISTINCT FROM true)"
    " AS violations FROM customer UNION ALL SELECT 'known', count(*) FILTER"
    " (WHERE (nullif(c_mktsegment, 'BUILDING') <> 'MACHINERY') IS DISTINCT FROM true) FROM customer",
    "e5_expr_enforced": "SELECT c_custkey, c_acctbal FROM customer",
    "e6_partition_desc": "SELECT o_orderkey, 'Year=' || year(o_orderdate) || ',prio=' || CASE WHEN o_orderpriority"
    " <> '5-LOW' THEN o_orderpriority ELSE '__HIVE_DEFAULT_PARTITION__' END || ',status=' || o_orderstatus"
    " AS descriptor, o_orderstatus AS status, 3 AS parts FROM orders",
    "e7_infer_partition_types": "SELECT t.c AS column, t.t AS type, count(*) AS values FROM orders,"
    " (VALUES ('day', 'date'), ('at', 'timestamp'), ('num', 'int'), ('big', 'bigint'), ('huge', 'decimal'),"
    " ('price', 'double'), ('mixed', 'string'), ('sparse', 'int'), ('word', 'string')) t(c, t) GROUP BY ALL",
    "p4_normalize_columns": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "p5_drop_null_type": "SELECT c_custkey, '{\"name\":\"' || c_name || '\"}' AS s FROM customer",
}
