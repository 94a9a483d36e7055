"""Commit directories: bucketed writes and scans of chosen commits."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from keytide.functions.columns import (
    NULL_PARTITION,
    UNPARTITIONED,
    bucket_id,
    partition_desc,
    quoted,
    unescape_path,
)
from keytide.plans.merge import ORDER_DIGITS, Versions
from keytide.sources.log import bucket_of, data_path, replaced_files
from keytide.spec import BUCKET, COMMIT, WRITE, TableSpec



def commit_id(order: int) -> str:
    """Commit ids sort in merge order."""
    return f"{order:0{ORDER_DIGITS}d}-{uuid.uuid4().hex[:12]}"


def commit_order(commit: str) -> int:
    return int(commit[:ORDER_DIGITS])


@dataclass(frozen=True)
class Part:
    """What one commit left in one partition; never more than ids and totals."""

    commit: str
    partition: str
    values: dict[str, str]
    dir: str
    files: int
    bytes: int
    rows: int


def hash_bucketed(df: DataFrame, spec: TableSpec, extra: Sequence[str] = ()) -> DataFrame:
    """Rows placed by (range columns, bucket).

    The rebalance lets adaptive execution cut a bucket or partition that holds
    far more than its share into several files, and join small ones in one task.
    """
    lead = [*extra, *spec.range_cols]
    if spec.keys:
        df = df.withColumn(BUCKET, bucket_id(spec.bucket_cols, spec.buckets))
        return df.hint("rebalance", *[F.col(quoted(c)) for c in (*lead, BUCKET)]).drop(BUCKET)
    if spec.range_cols:
        cols = [F.col(quoted(c)) for c in lead]
        return df.hint("rebalance", *cols).sortWithinPartitions(*cols)
    return df


def _catalog_name() -> str:
    return f"spark_catalog.default.keytide_{uuid.uuid4().hex}"


def write_commits(df: DataFrame, root: str, spec: TableSpec, placed: bool = False) -> str:
    """Write rows tagged with their commit in one job, into a folder of this write.

    Rows of a keyed table go into Spark buckets, sorted by key. ``placed`` rows lie by bucket
    already and are not exchanged. The catalog entry that Spark's bucketed writer
    needs is dropped at once; the files stay.
    """
    write = uuid.uuid4().hex
    target = f"{data_path(root)}/{WRITE}={write}"
    rows = df if placed else hash_bucketed(df, spec, [COMMIT])
    writer = rows.write.partitionBy(COMMIT, *spec.range_cols).format("parquet")
    for k, v in spec.write_options.items():
        writer = writer.option(k, v)
    if not spec.keys:
        writer.save(target)
        return write
    name = _catalog_name()
    try:
        writer.bucketBy(spec.buckets, *spec.bucket_cols).sortBy(*spec.keys).option("path", target).saveAsTable(name)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    return write


def _relation(spark: SparkSession, root: str, spec: TableSpec, write: str) -> DataFrame:
    """One write as a bucketed relation, so that Spark knows how its rows are placed."""
    columns = [T.StructField(c, spec.field(c).dataType) for c in spec.columns if c not in spec.range_cols]
    parts = [T.StructField(COMMIT, T.StringType()), *[T.StructField(c, spec.field(c).dataType) for c in spec.range_cols]]
    names = lambda cols: ", ".join(quoted(c) for c in cols)
    location = f"{data_path(root)}/{WRITE}={write}".replace("\\", "\\\\").replace("'", "\\'")
    name = _catalog_name()
    tracked = "spark.sql.hive.manageFilesourcePartitions"  # off: the folders below the location are the partitions
    before = spark.conf.get(tracked)
    spark.conf.set(tracked, "false")
    try:
        spark.sql(
            f"CREATE TABLE {name} ({T.StructType([*columns, *parts]).toDDL()}) USING parquet"
            f" PARTITIONED BY ({names(f.name for f in parts)}) CLUSTERED BY ({names(spec.bucket_cols)})"
            f" SORTED BY ({names(spec.keys)}) INTO {spec.buckets} BUCKETS LOCATION '{location}'"
        )
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.conf.set(tracked, before)


def relative_path(file_path: Column) -> Column:
    """Path below the data folder from `_metadata.file_path`, which is a URI."""
    return unescape_path(F.concat(F.lit(f"{WRITE}="), F.substring_index(file_path, f"/{WRITE}=", -1)))


def _listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """Path, size and row count of files; no column is read, rows come from the footers."""
    try:
        files = spark.read.schema(T.StructType()).option("recursiveFileLookup", True).parquet(*paths)
    except AnalysisException:
        return None
    meta = F.col("_metadata")
    listed = files.groupBy(meta["file_path"].alias("path"), meta["file_size"].alias("length")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return listed.withColumn("path", relative_path(F.col("path")))


def _dir_value(path: Column, column: str) -> Column:
    raw = F.regexp_extract(path, f"/{column}=([^/]*)/", 1)
    return unescape_path(raw)


def commit_files(spark: SparkSession, root: str, spec: TableSpec, writes: Sequence[str]) -> DataFrame | None:
    """File rows of fresh writes, relative to the data folder."""
    if not writes:
        return None
    found = _listed(spark, [f"{data_path(root)}/{WRITE}={w}" for w in writes])
    if found is None:
        return None
    rows = found.filter(F.col("path").endswith(".parquet")).select("path", F.col("length").alias("size"), "rows")
    rows = rows.withColumn("commit_id", F.regexp_extract("path", f"/{COMMIT}=([^/]*)/", 1))
    for c in spec.range_cols:
        rows = rows.withColumn(c, _dir_value(F.col("path"), _escaped_name(c)))
    return rows.select(
        partition_desc(spec.range_cols).alias("partition"),
        "commit_id",
        bucket_of(F.col("path")).alias("bucket"),
        "path",
        "size",
        "rows",
        F.create_map(*[x for c in spec.range_cols for x in (F.lit(c), F.col(quoted(c)))]).cast(
            "map<string,string>"
        ).alias("values"),
    )


def _escaped_name(name: str) -> str:
    return "".join(f"\\{ch}" if not (ch.isalnum() or ch == "_") else ch for ch in name)


def commit_parts(files: DataFrame) -> list[Part]:
    """Totals per commit and partition; this is all the driver sees of a write."""
    rows = (
        files.withColumn("dir", F.regexp_replace("path", "/[^/]*$", ""))
        .groupBy("commit_id", "partition", "dir")
        .agg(
            F.any_value("values").alias("values"),
            F.count(F.lit(1)).alias("files"),
            F.sum("size").alias("bytes"),
            F.sum("rows").alias("rows"),
        )
        .collect()
    )
    return [
        Part(r["commit_id"], r["partition"], dict(r["values"] or {}), r["dir"], r["files"], r["bytes"],
             r["rows"])
        for r in rows
    ]


def _of_values(spec: TableSpec, chosen: Sequence[dict[str, str]]) -> Column:
    """Whether the range columns of a row have one of these values, given as folder names have them."""
    typed = [
        [F.lit(None if v[c] == NULL_PARTITION else v[c]).cast(spec.field(c).dataType) for c in spec.range_cols] for v in chosen
    ]
    if len(spec.range_cols) > 1:
        return F.struct(*[F.col(quoted(c)) for c in spec.range_cols]).isin(
            [F.struct(*[x.alias(c) for x, c in zip(row, spec.range_cols)]) for row in typed]
        )
    c = spec.range_cols[0]
    known = [row[0] for row, v in zip(typed, chosen) if v[c] != NULL_PARTITION]
    among = F.coalesce(F.col(quoted(c)).isin(known), F.lit(False)) if known else F.lit(False)
    return among | F.col(quoted(c)).isNull() if len(known) < len(chosen) else among


def _picked_rows(df: DataFrame, spec: TableSpec, picked: Sequence[tuple], whole: frozenset[str]) -> DataFrame:
    """Rows of chosen commits in chosen partitions, without their dead buckets."""
    by_commit: dict[str, list[dict]] = {}
    for p, c in picked:
        by_commit.setdefault(c.id, []).append(p.values)
    complete = [c for c in by_commit if c in whole or not spec.range_cols]
    cond = F.col(COMMIT).isin(complete) if complete else F.lit(False)
    for c, values in by_commit.items():
        if c not in complete:
            cond = cond | ((F.col(COMMIT) == c) & _of_values(spec, values))
    df = df.filter(cond)
    dead: dict[tuple, list[dict]] = {}
    for p, c in picked:
        if c.dead:
            dead.setdefault((c.id, c.dead), []).append(p.values)
    for (c, buckets), values in dead.items():
        gone = (F.col(COMMIT) == c) & bucket_id(spec.bucket_cols, spec.buckets).isin(list(buckets))
        df = df.filter(~(gone & _of_values(spec, values) if spec.range_cols else gone))
    return df


def by_writes(picked: Sequence[tuple]) -> dict[str, list[tuple]]:
    """(partition, commit) pairs by the write that made the commit."""
    out: dict[str, list[tuple]] = {}
    for p, c in picked:
        out.setdefault(c.dir.split("/", 1)[0].removeprefix(f"{WRITE}="), []).append((p, c))
    return out


def scan(
    spark: SparkSession, root: str, spec: TableSpec, picked: Sequence[tuple], whole: frozenset[str] = frozenset(),
    paths: bool = False, bucketed: bool = True,
) -> Versions | None:
    """Rows of chosen (partition, commit) pairs, with the id of their commit.

    ``whole`` are commits all of whose partitions are chosen. Rows of one write of a keyed
    table are a bucketed relation, unless ``bucketed`` is False; a union would lose the buckets.
    ``paths`` adds the relative path of a row's file as `__file`.
    """
    if not picked:
        return None
    carried: dict[frozenset[str], tuple[int, ...]] = {}
    for c in {c.id: c for _, c in picked}.values():
        cols = frozenset(c.cols)
        carried[cols] = tuple(sorted((*carried.get(cols, ()), commit_order(c.id))))
    known = [c for c in spec.columns if any(c in cols for cols in carried)]
    wanted = [*[F.col(quoted(c)) for c in known], F.col(COMMIT)]
    writes = by_writes(picked)
    if bucketed and spec.keys and len(writes) == 1 and not paths:
        rows = _picked_rows(_relation(spark, root, spec, *writes), spec, picked, whole).select(*wanted)
    else:
        fields = [T.StructField(c, spec.field(c).dataType) for c in spec.columns]
        schema = T.StructType([*fields, T.StructField(WRITE, T.StringType()), T.StructField(COMMIT, T.StringType())])
        dirs = dict.fromkeys(
            f"{data_path(root)}/" + (c.dir.split(f"/{COMMIT}=")[0] + f"/{COMMIT}={c.id}" if c.id in whole else c.dir) for _, c in picked
        )
        rows = spark.read.schema(schema).option("basePath", data_path(root)).parquet(*dirs)
        if spec.keys:
            rows = _picked_rows(rows, spec, picked, whole)
        holes = [{"partition": p.desc, "commit_id": c.id, "attempt": a} for p, c in picked for a in c.holes]
        path = relative_path(F.col("_metadata.file_path")).alias("__file")
        rows = rows.select(*wanted, *([path] if holes or paths else []))
        if holes:
            rows = rows.join(replaced_files(spark, root, holes).toDF("__file"), "__file", "left_anti")
        rows = rows.select(*wanted, *([F.col("__file")] if paths else []))
    return Versions(rows, carried, tuple(c for c in spec.order_cols if c in known))


REMOVED = "path string, size bigint, removed boolean, problem string"


def remover(base: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task that deletes the files of its rows (path, size), paths being relative to ``base``."""
    # Arrow's name of the object store that Hadoop calls s3a or s3n
    scheme, colon, rest = base.partition("://")
    base = f"s3://{rest}" if scheme in ("s3a", "s3n") else base

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = fs.FileSystem.from_uri(base)
        for batch in batches:
            problems = [_remove(files, f"{top}/{path}") for path in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([p is None for p in problems]), pa.array(problems, pa.string())],
                names=["path", "size", "removed", "problem"],
            )

    return run


def _remove(files: fs.FileSystem, path: str) -> str | None:
    """Delete a file; the reason when that fails. What is gone already counts as deleted."""
    try:
        files.delete_file(path)
    except FileNotFoundError:
        return None
    except OSError as e:
        return str(e)
    return None


__all__ = [
    "NULL_PARTITION", "REMOVED", "UNPARTITIONED", "Part", "by_writes", "commit_files", "commit_id", "commit_order",
    "commit_parts", "hash_bucketed", "remover", "scan", "write_commits",
]
