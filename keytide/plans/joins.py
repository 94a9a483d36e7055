"""Join types over tables (J1-J7), laid out so that hot keys can be split.

Adaptive execution splits a hot key on the streamed side of a join, and on
either side of an inner join. A full outer join cannot be split that way, so a
full join on non-unique keys is put together from joins that can.

A task sorts its part of both sides. Adaptive execution makes these parts as large as the
advisory size of a partition, which is lowered here unless the session has set one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keytide.functions.columns import quoted

PART = "16MB"  # compressed shuffle data of both sides that one task sorts
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
HOW = ("inner", "left", "right", "full", "left_semi", "left_anti", "existence")


def small_parts(spark: SparkSession) -> None:
    """Partitions of at most about PART for the joins of this session; a size that was set stays."""
    if _ADVISORY not in spark.conf.getAll:
        spark.conf.set(_ADVISORY, PART)


def _match(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], residual: Column | None) -> Column:
    cond = None
    for a, b in on:
        term = left[quoted(a)] == right[quoted(b)]
        cond = term if cond is None else cond & term
    if cond is None:
        raise ValueError("a join needs at least one key pair")
    return cond if residual is None else cond & residual


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    residual: Column | None = None,
    unique_keys: bool = False,
    flag: str = "exists",
) -> DataFrame:
    """Join on ``left.a = right.b`` pairs; column names of both sides must differ.

    ``residual`` is an extra condition over both sides. ``unique_keys`` promises
    that no key repeats on either side, which makes the plain full join safe.
    ``existence`` keeps every left row and adds a boolean ``flag``.
    """
    if how not in HOW:
        raise ValueError(f"how must be one of {HOW}, not {how}")
    small_parts(left.sparkSession)
    if how == "existence":
        return _existence(left, right, on, residual, flag)
    cond = _match(left, right, on, residual)
    if how != "full" or unique_keys:
        return left.join(right, cond, how)
    matched = left.join(right, cond, "inner")
    left_only = _unmatched(left, right, on, residual)
    right_only = _unmatched(right, left, [(b, a) for a, b in on], residual)
    return matched.unionByName(left_only, allowMissingColumns=True).unionByName(
        right_only, allowMissingColumns=True
    )


def _unmatched(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], residual: Column | None
) -> DataFrame:
    if residual is not None:
        return left.join(right, _match(left, right, on, residual), "left_anti")
    keys = right.select(*[F.col(quoted(b)) for _, b in on]).distinct()
    return left.join(keys, _match(left, keys, on, None), "left_anti")


def _existence(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    residual: Column | None,
    flag: str,
) -> DataFrame:
    if residual is None:
        keys = right.select(*[F.col(quoted(b)) for _, b in on]).distinct().withColumn("__hit", F.lit(True))
        joined = left.join(keys, _match(left, keys, on, None), "left")
        return joined.select(
            *[left[quoted(c)] for c in left.columns], F.col("__hit").isNotNull().alias(flag)
        )
    cond = _match(left, right, on, residual)
    hits = left.join(right, cond, "left_semi").withColumn(flag, F.lit(True))
    misses = left.join(right, cond, "left_anti").withColumn(flag, F.lit(False))
    return hits.unionByName(misses)
