"""Small helpers that several operators share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keytide.sources.scratch import scratch_dir

# What the contracts call a word, as a Java and a Python pattern.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, for clusters
    (and working folders) where it is not installed."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        home = tempfile.mkdtemp(prefix="keytide-code-")  # the driver serves the archive from here
        atexit.register(shutil.rmtree, home, ignore_errors=True)
        package = Path(__file__).resolve().parents[1]
        if package.is_dir():  # already inside an archive: it came with the job
            context.addPyFile(shutil.make_archive(f"{home}/keytide", "zip", package.parent, package.name))


BATCH = 1000  # texts that pass to a Python worker at once


def few_rows(spark: SparkSession) -> None:
    """Batches of at most BATCH rows for the Python steps of this session: a worker and its executor hold whole
    batches, and Spark's 10,000 texts of a few kilobytes each take tens of megabytes on either side."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH:
        spark.conf.set(name, str(BATCH))


def words(text: Column) -> Column:
    """Words of a text in order; none for NULL. Splitting at one literal character
    is several times faster than at a pattern, so the pattern is for texts that need it."""
    t = F.coalesce(text, F.lit(""))
    return F.array_remove(
        F.when(t.rlike(r"[\x09\x0B-\x0D]"), F.split(t, GAP)).otherwise(F.split(F.replace(t, F.lit("\n"), F.lit(" ")), " ")),
        "",
    )


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def n_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def step(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that no filter above is pushed through: pushing one down would
    put their whole computation into the filter and do it twice."""
    row = F.struct(*(c.alias(name) for name, c in columns.items()))
    return df.select("*", F.inline(F.array(row)))


def cut(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: later jobs and lost
    executors start from the written table instead of from its lineage."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_in_buckets(df: DataFrame, label: str, column: str, codec: str) -> DataFrame:
    """Like `cut`, dealt to as many buckets of a column as shuffles have partitions, so that
    joins on it leave these rows where they are. The catalog entry goes as soon as the plan knows it."""
    spark, name = df.sparkSession, f"keytide_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").options(path=scratch_dir(spark, label), compression=codec)
    try:
        writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).saveAsTable(name)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
