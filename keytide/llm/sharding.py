"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of slots, bytes and rows are added up per
slot, and a versioned map says which shard holds a slot. Rebalancing edits the
map: slots move, records are never hashed anew. Everything here is DataFrame
code; only tables of ``n_slots`` rows are ever gathered or broadcast.

Edge cases: an empty table gives an empty placement and a map whose slots all
have size 0. NULL keys hash like any other value. Rows that agree in all key
columns share a slot, so give :func:`place` an ordinal of equal rows
(:func:`with_ordinal`) if they may be many. Columns named like the added ones
are refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

N_SLOTS = 4096
_ADDED = ("vslot", "shard", "slot")
MAP_SCHEMA = "vslot int, shard int, bytes long, rows long"


def vslot(keys: Sequence[str | Column], n_slots: int = N_SLOTS) -> Column:
    """Virtual slot of a record."""
    return F.pmod(F.xxhash64(*keys), F.lit(n_slots)).cast("int")


def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Rows numbered among their equals. Equal rows are counted map side first, so
    a row that fills a third of the table is no hot key."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return counted.select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("__n"))).alias(name))


def slot_sizes(df: DataFrame, size: str, n_slots: int = N_SLOTS) -> DataFrame:
    """Bytes and rows of every slot, empty ones included. ``df`` has ``vslot``."""
    sums = df.groupBy("vslot").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    slots = df.sparkSession.range(0, n_slots, 1, 1).select(F.col("id").cast("int").alias("vslot"))
    return slots.join(sums, "vslot", "left").select(
        "vslot",
        *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("bytes", "rows")),
    )


def first_map(sizes: DataFrame, shards: int) -> DataFrame:
    """Version 0 of the map: slots dealt round."""
    return sizes.select("vslot", (F.col("vslot") % shards).alias("shard"), "bytes", "rows")


def _dealt(pool: Column, loads: Column) -> Column:
    """Shards for the slots of ``pool`` in order, each to the one that is least full."""
    state = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        least = F.array_position(acc["loads"], F.array_min(acc["loads"])).cast("int") - 1
        grown = F.transform(acc["loads"], lambda v, i: F.when(i == least, v + x["bytes"]).otherwise(v))
        return F.struct(grown.alias("loads"), F.concat(acc["out"], F.array(least)).alias("out"))

    return F.aggregate(pool, state, step)["out"]


def rebalanced(current: DataFrame, shards: int) -> DataFrame:
    """The next version of a map: shards keep their largest slots up to an equal
    share of all bytes; what is above goes, largest first, to the emptiest shard.
    With more shards than before, the new ones start empty."""
    total = current.agg(F.sum("bytes").alias("total"))
    by_size = W.partitionBy("shard").orderBy(F.desc("bytes"), "vslot").rowsBetween(W.unboundedPreceding, 0)
    ranked = current.crossJoin(F.broadcast(total)).select(
        "vslot", "shard", "bytes", "rows",
        ((F.sum("bytes").over(by_size) * shards <= F.col("total")) & (F.col("shard") < shards)).alias("stays"),
    )
    room = ranked.filter("stays").groupBy("shard").agg(F.sum("bytes").alias("load"))
    one = ranked.agg(
        F.array_sort(
            F.collect_list(F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("neg"), "vslot", "bytes", "rows")))
        ).alias("pool")
    ).crossJoin(F.broadcast(room.agg(F.collect_list(F.struct("shard", "load")).alias("full"))))
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda k: F.aggregate(
            F.filter(F.col("full"), lambda x: x["shard"] == k), F.lit(0).cast("long"), lambda a, x: a + x["load"]
        ),
    )
    moved = one.select(F.explode(F.arrays_zip("pool", _dealt(F.col("pool"), loads).alias("to"))).alias("m"))
    return ranked.filter("stays").select("vslot", "shard", "bytes", "rows").unionByName(
        moved.select(F.col("m.pool.vslot").alias("vslot"), F.col("m.to").alias("shard"),
                     F.col("m.pool.bytes").alias("bytes"), F.col("m.pool.rows").alias("rows"))
    )


def save_map(frame: DataFrame, root: str, version: int) -> None:
    """Store one version; an existing version is never overwritten."""
    frame.write.mode("error").parquet(f"{root}/version={version}")


def load_map(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.schema(T.StructType.fromDDL(MAP_SCHEMA)).parquet(f"{root}/version={version}")


def moves(old: DataFrame, new: DataFrame) -> DataFrame:
    """Slots that change their shard between two versions."""
    return old.select("vslot", F.col("shard").alias("was")).join(new.select("vslot", "shard"), "vslot").filter(
        "was <> shard"
    )


def place(df: DataFrame, slot_map: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``shard`` and ``slot``, the row's gapless position within its shard.

    Rows are numbered inside their virtual slot; how many rows of the shard lie in
    lower slots comes from the map, so no shard is ever sorted as a whole.
    """
    if clash := [c for c in _ADDED[1:] if c in df.columns]:
        raise ValueError(f"columns {clash} exist already")
    below = W.partitionBy("shard").orderBy("vslot").rowsBetween(W.unboundedPreceding, -1)
    starts = slot_map.select("vslot", "shard", F.coalesce(F.sum("rows").over(below), F.lit(0)).alias("__start"))
    within = F.row_number().over(W.partitionBy("vslot").orderBy(*order)) - 1
    return (
        df.withColumn("__pos", within)
        .join(F.broadcast(starts), "vslot")  # n_slots rows
        .withColumn("slot", (F.col("__start") + F.col("__pos")).cast("long"))
        .drop("__start", "__pos")
    )
