"""Exact ranks inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keytide.functions.columns import all_of, content_hash, quoted
from keytide.sources.scratch import scratch_dir

_AT, _SLOT, _TIE = "__at", "__slot", "__tie"


def in_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows sorted by key and ``order`` over tasks of about equal size, with their place ``__at``.

    Spark cuts the ranges at quantiles that it counts over key, order and a hash of the
    content, so a hot key, or a hot moment of it, spans as many tasks as it needs; only rows
    that agree in everything stay together. Places rise along the order: the number of the
    range above bit 33, the place inside it below. They are written to the shared folder, for a
    second run could cut the ranges elsewhere.
    """
    by = [F.col(quoted(k)) for k in keys]
    along = [*by, *order, F.col(_TIE)]
    ranged = df.withColumn(_TIE, content_hash(df)).repartitionByRange(*along).sortWithinPartitions(*along)
    placed = ranged.drop(_TIE).withColumn(_AT, F.monotonically_increasing_id())
    path = scratch_dir(df.sparkSession, "ranks")
    placed.write.parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def split_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """``row_number()`` per key without a task that sees a whole key.

    Rows are placed by `in_order`. What a rank lacks beside the place inside its range is one
    number per key and range: where the key begins there, and how many of its rows earlier
    ranges hold. That table is aggregated on the map side and joined back.
    """
    placed = in_order(df, keys, order).withColumn(_SLOT, F.shiftright(_AT, 33))
    group = [*keys, _SLOT]
    cols = [F.col(quoted(c)) for c in group]
    counts = placed.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"), F.min(_AT).alias("__first"))
    before = Window.partitionBy(*cols[:-1]).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("__n").over(before), F.lit(0))
    theirs = [f"__k{i}" for i in range(len(group))]
    offsets = counts.select(*[c.alias(t) for c, t in zip(cols, theirs)], (earlier - F.col("__first") + 1).alias("__offset"))
    same = all_of([c.eqNullSafe(F.col(t)) for c, t in zip(cols, theirs)])
    kept = [F.col(quoted(c)) for c in df.columns]
    return placed.join(offsets, same).select(*kept, (F.col("__offset") + F.col(_AT)).alias(name))
