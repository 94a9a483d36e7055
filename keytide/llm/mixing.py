"""Mixing sources to target weights by weighted fair queueing.

Documents of a source wait in shuffled order, pass after pass. A document's
virtual finish time is the source's running word count after it, divided by the
source's target. All documents are ranked by finish time and the mix ends when
the total budget is spent, so every source is near its share at any point.

Running counts over a source and over the whole ranking are two-level: sums per
bucket of hash or finish time, running sums over those sums, and a window inside
a bucket. No source and no ranking is ever one task.

Edge cases: an empty table gives an empty mix; NULL texts have no words and are
never taken; NULL is a source of its own and stands last. Rows equal in id, source
and text are repeats: they queue one by one, and the documents returned carry
the other columns of one of them. Clashing column names do not matter, since only
the three named columns enter the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from keytide.llm.text import cut, n_words

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
FINISH_BUCKETS = 4096


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """Words that every source should give. ``sizes``: source, source_size.

    Sharing the excess of capped sources again and again ends where the sources
    with the smallest cap per weight are capped and all others share the rest by
    weight; sorting by cap per weight finds that end in one pass over the sources.
    """
    i = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*map(F.lit, weights)), (i % len(weights) + 1).cast("int")).cast("long")
    ranked = sizes.withColumn("rank", i).withColumn("w", w).withColumn("cap", F.col("source_size") * repeats)
    by_ratio = W.orderBy(F.col("cap") / F.col("w"), "rank")
    upto = by_ratio.rowsBetween(W.unboundedPreceding, 0)
    everything = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    t = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_w", F.sum("w").over(everything))
        .withColumn("caps_before", F.sum("cap").over(upto) - F.col("cap"))
        .withColumn("w_before", F.sum("w").over(upto) - F.col("w"))
    )
    # capped: the even share of what is left, at this place of the order, is above the cap
    capped = F.col("cap") * (F.col("all_w") - F.col("w_before")) <= F.col("w") * (F.col("total") - F.col("caps_before"))
    t = t.withColumn("capped", capped)
    t = t.withColumn("cap_sum", F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything))
    t = t.withColumn("cap_w", F.sum(F.when(F.col("capped"), F.col("w")).otherwise(0)).over(everything))
    share = (F.col("w") * (F.col("total") - F.col("cap_sum"))).cast("double") / F.nullif(
        F.col("all_w") - F.col("cap_w"), F.lit(0)
    )
    return t.select(
        "source", "source_size", "rank", "total",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def _running(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str], size: str, name: str) -> DataFrame:
    """Running sum of ``size`` in (bucket, order) within a group, this row included."""
    inner = W.partitionBy(*group, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    sums = df.groupBy(*group, bucket).agg(F.sum(size).alias("__sum"))
    outer = W.partitionBy(*(group or [F.lit(0)])).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(*group, bucket, F.coalesce(F.sum("__sum").over(outer), F.lit(0)).alias("__start"))
    return (
        df.withColumn("__in", F.sum(size).over(inner))
        .join(starts, [*group, bucket])
        .withColumn(name, F.col("__start") + F.col("__in"))
        .drop("__in", "__start")
    )


def queue(df: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = MAX_REPEATS,
          finish_buckets: int = FINISH_BUCKETS, hash_digits: int = 3) -> DataFrame:
    """One row per document: doc_id, source, text_md5, ordinal, size, source_size,
    target, taken (words) and times (passes taken).

    ``df``: doc_id, source, text. ``16 ** hash_digits`` buckets per source and
    ``finish_buckets`` buckets of the ranking: choose them so that a bucket fits a task.
    """
    rows = df.select("doc_id", "source", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"),
                     n_words(F.col("text")).alias("size"))
    rows = rows.groupBy("doc_id", "source", "text_md5", "size").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.select("doc_id", "source", "text_md5", "size",
                       F.explode(F.sequence(F.lit(1), F.col("n"))).alias("ordinal"))
    rows = cut(rows, "mix-rows")
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("\x00")), "text_md5",
                            F.col("ordinal").cast("string")))
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats)
    rows = rows.withColumn("key", key).withColumn("part", F.substring("key", 1, hash_digits))
    same = rows["source"].eqNullSafe(sources["source"])
    rows = rows.join(sources, same).select(
        "doc_id", rows["source"], "text_md5", "ordinal", "size", "key", "part",
        "rank", "source_size", "target", "total",
    )
    rows = _running(rows, ["rank"], "part", ["key"], "size", "done")
    rows = cut(rows, "mix-queue")
    # only documents that begin before their source's target take part; later ones are never reached
    begins = F.col("done") - F.col("size") + F.col("turn") * F.col("source_size")
    turns = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("turn"))
    turns = turns.filter((F.col("size") > 0) & (begins < F.col("target")))
    finish = (F.col("done") + F.col("turn") * F.col("source_size")).cast("double") / F.col("target")
    turns = turns.withColumn("finish", finish)
    # crossing documents are one per source, all others spread evenly over the buckets
    bucket = F.least(F.floor(F.col("finish") * finish_buckets), F.lit(finish_buckets)).cast("int")
    turns = _running(turns.withColumn("bucket", bucket), [], "bucket", ["finish", "rank", "key", "turn"], "size", "spent")
    taken = (
        turns.filter(F.col("spent") <= F.col("total"))
        .groupBy("key", "rank").agg(F.count(F.lit(1)).alias("times"))
    )
    return rows.join(taken, ["key", "rank"], "left").select(
        "doc_id", "source", "text_md5", "ordinal", "size", "source_size", "target",
        (F.coalesce("times", F.lit(0)) * F.col("size")).cast("long").alias("taken"),
        F.coalesce("times", F.lit(0)).cast("int").alias("times"),
    )


def mix(df: DataFrame, weights: Sequence[int] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """The mixed documents themselves: rows of ``df``, each as often as it is taken."""
    times = (
        queue(df, weights, repeats).filter("times > 0")
        .groupBy("doc_id", "source", "text_md5").agg(F.sum("times").cast("int").alias("__times"))
    )
    keyed = df.withColumn("__md5", F.md5(F.coalesce("text", F.lit(""))))
    one = keyed.dropDuplicates(["doc_id", "source", "__md5"])
    match: Column = (
        one["doc_id"].eqNullSafe(times["doc_id"]) & one["source"].eqNullSafe(times["source"])
        & (one["__md5"] == times["text_md5"])
    )
    picked = one.join(times.select("doc_id", "source", "text_md5", "__times"), match)
    copies = F.explode(F.sequence(F.lit(1), F.col("__times")))
    return picked.select(*(one[c] for c in df.columns), copies.alias("__copy")).drop("__copy")
