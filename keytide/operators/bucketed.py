"""Joins of tables stored in the same buckets.

:func:`join_tables` joins keyed tables where they lie. :func:`cobucketed_join` is for plain
frames: it stores both sides first, and the catalog entries it needs go again at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from keytide.operators.table import KeyedTable
from keytide.plans.joins import equi_join
from keytide.sources.scratch import scratch_dir


def store_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None, mode: str = "error"
) -> DataFrame:
    """Save as a catalog table, bucketed and sorted by key.

    Every task writes one file per bucket it holds, so rows are first placed by
    key; with fewer buckets than tasks would need, raise ``buckets``: it is the
    parallelism of every later join.
    """
    writer = df.repartition(buckets, *keys).write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def cobucketed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    buckets: int,
    how: str = "inner",
) -> DataFrame:
    """Store both sides in equal buckets and join them without a shuffle."""
    spark: SparkSession = left.sparkSession
    tag = uuid.uuid4().hex[:12]
    names = [f"cobucket_{side}_{tag}" for side in "lr"]
    try:
        a = store_bucketed(left, names[0], [k for k, _ in on], buckets, scratch_dir(spark, "cobucket-l"))
        b = store_bucketed(right, names[1], [k for _, k in on], buckets, scratch_dir(spark, "cobucket-r"))
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return equi_join(a.hint("merge"), b, on, how)


def join_tables(left: KeyedTable, right: KeyedTable, on: Sequence[tuple[str, str]], how: str = "inner") -> DataFrame:
    """Join two keyed tables on the columns that place their rows.

    Tables without changes since their last compaction and with the same number of buckets
    are joined bucket by bucket, without an exchange and without writing anything. Changes
    are merged first. With other numbers the side with fewer buckets is exchanged,
    unless ``spark.sql.bucketing.coalesceBucketsInJoin.enabled`` lets one task read several
    buckets of the other. Both sides hash equal values of equal types alike.
    """
    specs = left.spec(), right.spec()
    pairs = list(on)
    if sorted(a for a, _ in pairs) != sorted(specs[0].bucket_cols) or [
        dict(pairs)[c] for c in specs[0].bucket_cols
    ] != specs[1].bucket_cols:
        raise ValueError(f"the buckets are made of {specs[0].bucket_cols} and {specs[1].bucket_cols}, not of {pairs}")
    sides = [t.read() for t in (left, right)]
    if how == "full":
        return sides[0].hint("merge").join(sides[1], [sides[0][a] == sides[1][b] for a, b in pairs], "full")
    return equi_join(sides[0].hint("merge"), sides[1], pairs, how)
