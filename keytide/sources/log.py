"""The commit log as DataFrames (V1-V7).

Two row sets describe a table. *Versions*: one row per (partition, version) with
the ordered commits a reader must merge. *Files*: one row per file operation of
a commit. Both are written by Spark into folders of the write attempt, which its
version rows name. A version appears by one rename that fails if its place is
taken, so a writer that loses or dies leaves only folders that no version names.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from keytide.functions.columns import UNPARTITIONED
from keytide.sources.local import local_rows
from keytide.spec import TableError

# Names of the commit operations.
APPEND, MERGE, UPDATE, DELETE, COMPACTION, DROP, ROLLBACK = (
    "append", "merge", "update", "delete", "compaction", "drop", "rollback",
)

_STRING, _LONG, _STRINGS = T.StringType(), T.LongType(), T.ArrayType(T.StringType())
_VALUES = T.MapType(T.StringType(), T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# clean: keys are unique, also among the clean commits before it; parts: partitions the commit wrote;
# dead: buckets that a later commit replaced; holes: attempts whose file operations replaced files of it
COMMIT_TYPE = _struct(
    id=_STRING, dir=_STRING, cols=_STRINGS, clean=T.BooleanType(), parts=_LONG, files=_LONG,
    bytes=_LONG, rows=_LONG, dead=T.ArrayType(T.IntegerType()), holes=_STRINGS,
)
VERSION_SCHEMA = _struct(
    log_version=_LONG, kind=_STRING, partition=_STRING, values=_VALUES, version=_LONG, op=_STRING,
    spec=_STRING, query_id=_STRING, batch_id=_LONG, committed_at=T.TimestampType(), attempt=_STRING,
    commits=T.ArrayType(COMMIT_TYPE),
)
FILE_SCHEMA = _struct(
    log_version=_LONG, pos=T.IntegerType(), partition=_STRING, commit_id=_STRING, bucket=T.IntegerType(),
    path=_STRING, file_op=_STRING, size=_LONG, rows=_LONG, values=_VALUES, cols=_STRINGS, attempt=_STRING,
)


def versions_path(root: str) -> str:
    return f"{root}/log/versions"


def files_path(root: str) -> str:
    return f"{root}/log/files"


def data_path(root: str) -> str:
    return f"{root}/data"


def _entry(base: str, log_version: int) -> str:
    return f"{base}/v{log_version:012d}"


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(VERSION_SCHEMA).option("recursiveFileLookup", True).parquet(versions_path(root))
    except AnalysisException as e:
        raise TableError(f"{root} is not a table") from e


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """File operations of published versions; those of a crashed write do not count."""
    try:
        files = spark.read.schema(FILE_SCHEMA).option("recursiveFileLookup", True).parquet(files_path(root))
    except AnalysisException:
        return local_rows(spark, [], FILE_SCHEMA)
    published = read_versions(spark, root).select("attempt").distinct()
    return files.join(published, "attempt", "left_semi")


def exists(spark: SparkSession, root: str) -> bool:
    try:
        read_versions(spark, root)
    except TableError:
        return False
    return True


def new_attempt() -> str:
    """Name of one attempt to write a version."""
    return uuid.uuid4().hex


def publish(spark: SparkSession, root: str, log_version: int, rows: list[dict], attempt: str) -> None:
    """Write the rows of one log version; fails when another writer was first."""
    frame = local_rows(spark, [{**r, "log_version": log_version, "attempt": attempt} for r in rows], VERSION_SCHEMA)
    written = f"{root}/log/attempts/{attempt}"
    frame.withColumn("committed_at", F.current_timestamp()).write.mode("error").parquet(written)
    if not _renamed(spark, written, _entry(versions_path(root), log_version)):
        raise TableError(f"log version {log_version} was taken by another writer")


def _renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Give a folder its final name unless the name is taken; the file system decides who is first."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs
    old, new = fs.Path(source), fs.Path(target)
    files = fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration()) if new.toUri().getScheme() else (
        fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    )
    files.mkdir(new.getParent(), fs.permission.FsPermission.getDirDefault(), True)
    no_options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        files.rename(old, new, no_options)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName() or "not empty" in str(e.java_exception):
            return False
        raise
    return True


def write_files(spark: SparkSession, root: str, log_version: int, files: DataFrame, attempt: str) -> DataFrame:
    """Write the file operations of a coming version and return them as stored."""
    target = f"{files_path(root)}/{attempt}"
    rows = files.withColumn("log_version", F.lit(log_version)).withColumn("attempt", F.lit(attempt))
    rows.select(*[F.col(f.name).cast(f.dataType) for f in FILE_SCHEMA.fields]).write.mode("error").parquet(target)
    return spark.read.schema(FILE_SCHEMA).parquet(target)


# -- queries over a log ---------------------------------------------------------


def live_files(file_ops: DataFrame) -> DataFrame:
    """Files whose last operation is an add (V1).

    Takes rows (seq, pos, path, file_op, ...); the last operation of a path by
    (seq, pos) decides. Folding is a map-side combined aggregate.
    """
    other = [c for c in file_ops.columns if c not in ("path", "seq", "pos")]
    last = file_ops.groupBy("path").agg(
        F.max_by(F.struct(*other), F.struct("seq", "pos")).alias("last")
    )
    return last.filter(F.col("last.file_op") == "add").select("path", "last.*")


def explode_file_ops(commits: DataFrame, ops_col: str = "file_ops") -> DataFrame:
    """Commits with an array of file operations to rows with their position."""
    keep = [c for c in commits.columns if c != ops_col]
    return commits.select(*keep, F.posexplode(ops_col).alias("pos", "op")).select(*keep, "pos", "op.*")


def latest_versions(log: DataFrame) -> DataFrame:
    """Newest version row of every partition (V2)."""
    rest = [c for c in log.columns if c != "partition"]
    newest = log.groupBy("partition").agg(F.max_by(F.struct(*rest), F.col("version")).alias("n"))
    return newest.select("partition", "n.*")


def history(log: DataFrame, partition: str | None = None) -> DataFrame:
    """Versions with their operation, oldest first per partition (V3)."""
    rows = log if partition is None else log.filter(F.col("partition") == partition)
    return rows.orderBy("partition", "version")


def as_of(log: DataFrame, partition: str, version: int) -> DataFrame:
    """The row of one partition version; no state is kept anywhere."""
    return log.filter((F.col("partition") == partition) & (F.col("version") == version))


def rolled_back(log: DataFrame, targets: DataFrame) -> DataFrame:
    """Next version rows that publish old versions again (V4).

    ``targets`` has (partition, version) of the versions to bring back. Targets
    that do not exist give no row.
    """
    newest = latest_versions(log).select("partition", F.col("version").alias("newest"))
    old = log.join(targets, ["partition", "version"], "left_semi")
    cols = [c for c in log.columns if c not in ("partition", "version")]
    return old.join(newest, "partition").select("partition", (F.col("newest") + 1).alias("version"), *cols)


def next_versions(log: DataFrame, new: DataFrame) -> DataFrame:
    """Version rows that follow when commits arrive (V5).

    ``new`` has (partition, op, commits). Append and merge extend the commits of
    the newest version; every other operation replaces them. First version is 0.
    """
    cur = latest_versions(log).select(
        "partition", F.col("version").alias("cur_version"), F.col("commits").alias("cur_commits")
    )
    extends = F.col("op").isin(APPEND, MERGE)
    return new.join(cur, "partition", "left").select(
        "partition",
        (F.coalesce("cur_version", F.lit(-1)) + 1).alias("version"),
        "op",
        F.when(extends & F.col("cur_commits").isNotNull(), F.concat("cur_commits", "commits"))
        .otherwise(F.col("commits"))
        .alias("commits"),
    )


def size_report(live: DataFrame) -> DataFrame:
    """Bytes and files per partition over live file rows (V6)."""
    return live.groupBy("partition").agg(
        F.sum("size").alias("bytes"), F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files")
    )


def layout_report(live: DataFrame) -> DataFrame:
    """Files, commits (delta depth) and bytes per partition and bucket (V7)."""
    return live.groupBy("partition", "bucket").agg(
        F.count(F.lit(1)).alias("files"),
        F.count_distinct("commit_id").alias("depth"),
        F.sum("size").alias("bytes"),
    )


def replaced_files(spark: SparkSession, root: str, holes: list[dict]) -> DataFrame:
    """Paths of replaced files; ``holes`` has partition, commit_id and the attempt that replaced some."""
    attempts = sorted({h["attempt"] for h in holes})
    ops = spark.read.schema(FILE_SCHEMA).parquet(*[f"{files_path(root)}/{a}" for a in attempts])
    pairs = local_rows(spark, holes, "partition string, commit_id string, attempt string")
    return ops.filter("file_op = 'del'").join(pairs, ["partition", "commit_id", "attempt"], "left_semi").select("path")


def bucket_of(path: Column) -> Column:
    """Spark's writers put the bucket into the file name."""
    found = F.regexp_extract(path, r"_([0-9]{5})\.c[0-9]+[^/]*$", 1)
    return F.when(found != "", found).cast("int")


__all__ = [
    "APPEND", "COMPACTION", "DELETE", "DROP", "MERGE", "ROLLBACK", "UNPARTITIONED", "UPDATE",
    "as_of", "bucket_of", "data_path", "exists", "explode_file_ops", "files_path", "history", "local_rows",
    "latest_versions", "layout_report", "live_files", "new_attempt", "next_versions", "publish", "read_files",
    "read_versions", "replaced_files", "rolled_back", "size_report", "versions_path", "write_files",
]
