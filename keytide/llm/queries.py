"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keytide.llm import (
    audit, chat, decontaminate, divergence, embedding, mixing, nbest, quality, sharding, simhash, suffix, tokens, toxicity, twins,
)
from keytide.llm.text import cut, documents, n_bytes, ship
from keytide.sources.scratch import scratch_dir

SHARDS = 8
MAX_TOKENS = 4096


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id", (n_bytes(F.col("text")) + 1).alias("size"), F.crc32(text).cast("long").alias("text_crc32")
    )
    rows = sharding.with_ordinal(rows)
    rows = cut(rows.withColumn("vslot", sharding.vslot(rows.columns)), "shard-rows")
    root = scratch_dir(spark, "shard-map")
    sharding.save_map(sharding.first_map(sharding.slot_sizes(rows, "size"), SHARDS), root, 0)
    sharding.save_map(sharding.rebalanced(sharding.load_map(spark, root, 0), SHARDS), root, 1)
    placed = sharding.place(rows, sharding.load_map(spark, root, 1), ["doc_id", "size", "text_crc32", "ordinal"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot",
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(documents(spark, sf_dir))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.queue(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measures(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_clean_words",
    )


def op3_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return embedding.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _marked() -> Column:
    """A turn of `conversations` as a raw transcript shows it: markers of several styles, often none."""
    style = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(8)).cast("int")
    marks = {
        "user": ("User: ", "Human: ", "USER - ", "<user> ", "Q: ", "", "", ""),
        "assistant": ("Assistant: ", "AI: ", "ASSISTANT - ", "<assistant> ", "A: ", "", "", ""),
        "system": ("System: ", "SYSTEM: ", "[system] ", "<system> ", "Instruction: ", "", "", ""),
    }
    mark = F.lit("")
    for role, forms in marks.items():
        mark = F.when(F.col("role") == role, F.element_at(F.array(*map(F.lit, forms)), style + 1)).otherwise(mark)
    gap = F.when(style % 2 == 1, F.lit("\n")).otherwise(F.lit(""))
    return F.concat(gap, mark, F.coalesce("text", F.lit("")))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles of transcripts made of `conversations`; four conversations of five teach the model."""
    ship(spark)
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    rows = cut(chat.parts(turns, _marked()), "transcripts")
    held_out = F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit(""))) % 5 == 0
    found = chat.parsed(rows, chat.learned(rows.filter(~held_out)))
    role = F.array(*map(F.lit, chat.ROLES))
    right = F.zip_with("states", "roles", lambda s, r: F.element_at(role, F.floor(s / 2).cast("int") + 1) == r)
    return found.select(
        "conv_id", "part", held_out.alias("held_out"), F.size("states").cast("long").alias("n_lines"),
        F.size("turns").cast("long").alias("n_turns"), F.size(F.filter(right, lambda x: x)).cast("long").alias("n_right"),
        F.sha2("chat", 256).alias("chat_sha256"),
    )


def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.counts(documents(spark, sf_dir))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.scores(documents(spark, sf_dir), labels, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.digests(documents(spark, sf_dir))


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.removed(documents(spark, sf_dir))


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = audit.labelled(audit.failures(documents(spark, sf_dir)), labels,
                          {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1})
    return audit.interactions(rows, "ABCDE", {"good_lost": "good", "toxic_lost": "toxic"})


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_simhash": op2_simhash,
    "op3_embedding": op3_embedding,
    "op4_chat": op4_chat,
    "op5_tokens": op5_tokens,
    "op6_toxicity": op6_toxicity,
    "op7_mixing": op7_mixing,
    "op8_nbest": op8_nbest,
    "op9_quality": op9_quality,
    "op10_suffix": op10_suffix,
    "op11_audit": op11_audit,
    "op12_decontaminate": op12_decontaminate,
    "op13_divergence": op13_divergence,
}
SQL = {
    "op7_mixing": twins.MIXING,
    "op9_quality": twins.QUALITY,
    "op11_audit": twins.AUDIT,
    "op12_decontaminate": twins.DECONTAMINATE,
    "op13_divergence": twins.DIVERGENCE,
}
