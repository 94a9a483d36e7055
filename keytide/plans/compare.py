"""Set comparison of results (Q1, Q2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytide.functions.columns import quoted


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows only in a, rows only in b (with multiplicity), and the verdict.

    Copies are counted before the shuffle, so many equal rows travel as one.
    """
    if set(a.columns) != set(b.columns):
        raise ValueError(f"columns differ: {a.columns} and {b.columns}")
    cols = [F.col(quoted(c)) for c in a.columns]
    counted = (
        a.select(*cols, F.lit(1).alias("__d"))
        .unionAll(b.select(*cols, F.lit(-1).alias("__d")))
        .groupBy(*cols)
        .agg(F.sum("__d").alias("__d"))
    )
    d = F.col("__d")
    only_a = F.coalesce(F.sum(F.when(d > 0, d)), F.lit(0).cast("bigint"))
    only_b = F.coalesce(F.sum(F.when(d < 0, -d)), F.lit(0).cast("bigint"))
    return counted.agg(only_a.alias("only_in_a"), only_b.alias("only_in_b")).withColumn(
        "same", (F.col("only_in_a") == 0) & (F.col("only_in_b") == 0)
    )


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-insensitive checksum over all columns.

    A row is the text of its values in order of their names, each with its length so
    that no two rows share a text; the checksum adds the first 60 bits of the texts' MD5.
    """

    def text(name: str) -> Column:
        value = F.col(quoted(name)).cast("string")
        return F.coalesce(F.concat(F.length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    row = F.md5(F.concat_ws(",", *[text(c) for c in sorted(df.columns)]))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")).alias("checksum"),
    )
