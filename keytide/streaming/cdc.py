"""Database change events to table rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keytide.functions.columns import quoted
from keytide.functions.decode import FieldSpec, decode_envelope, wire_type
from keytide.plans.rank import split_rank

# Change kinds in the order in which equal times apply.
KINDS = ("+I", "-U", "+U", "-D")


def envelope_schema(row: T.StructType) -> T.StructType:
    """Shape of a change event around a row type."""
    source = T.StructType.fromDDL("db string, `table` string, ts_ms bigint, file string, pos bigint")
    return (
        T.StructType()
        .add("before", row)
        .add("after", row)
        .add("source", source)
        .add("op", T.StringType())
        .add("ts_ms", T.LongType())
    )


def wire_schema(specs: Mapping[str, FieldSpec]) -> T.StructType:
    """Row type of an event as it is written, before `decode_envelope`."""
    return T.StructType([T.StructField(n, wire_type(s)) for n, s in specs.items()])


def parse_events(df: DataFrame, row: T.StructType, value: str = "value") -> DataFrame:
    """JSON text to before, after, source, op and ts_ms; empty records are dropped."""
    parsed = F.from_json(F.col(quoted(value)).cast("string"), envelope_schema(row))
    return df.filter(F.col(quoted(value)).isNotNull()).select(parsed.alias("e")).select("e.*")


def change_name(op: Column, snapshot_reads: bool = True) -> Column:
    """One-letter operation to insert, update or delete; anything else is unknown."""
    inserts = ["c", "r"] if snapshot_reads else ["c"]
    return F.when(op.isin(inserts), "insert").when(op == "u", "update").when(op == "d", "delete").otherwise("unknown")


def flatten_envelope(events: DataFrame, op_col: str = "op", snapshot_reads: bool = True,
                     keep: Sequence[str] = ()) -> DataFrame:
    """One row per event: the new image, or the old one of a delete, and the change name."""
    name = change_name(F.col("op"), snapshot_reads)
    image = F.when(name.isin("insert", "update"), F.col("after")).when(name == "delete", F.col("before"))
    return events.select(image.alias("__row"), name.alias(op_col), *keep).select("__row.*", op_col, *keep)


def explode_changes(events: DataFrame, op_col: str = "op", kind_col: str = "kind",
                    keep: Sequence[str] = ()) -> DataFrame:
    """Row images in apply order: an update gives its old image as a delete, then the new one."""
    def image(row: str, change: str, kind: str) -> Column:
        return F.struct(F.col(row).alias("r"), F.lit(change).alias("c"), F.lit(kind).alias("k"))

    op = F.col("op")
    images = (
        F.when(op.isin("c", "r"), F.array(image("after", "insert", "+I")))
        .when(op == "d", F.array(image("before", "delete", "-D")))
        .otherwise(F.array(image("before", "delete", "-U"), image("after", "update", "+U")))
    )
    return events.select(F.explode(images).alias("x"), *keep).select(
        "x.r.*", F.col("x.c").alias(op_col), F.col("x.k").alias(kind_col), *keep
    )


def kind_rank(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind).cast("int")


def order_changes(
    df: DataFrame, keys: Sequence[str], time_col: str, kind_col: str = "kind",
    ties: Sequence[str] = (), name: str = "rank",
) -> DataFrame:
    """Position of every change of a key by event time, then kind (D3).

    A key with very many changes is ordered by many tasks, also when they all
    have one time; a NULL time comes first. Rows are placed in a job of its own.
    """
    t = F.col(quoted(time_col))
    order = [t, kind_rank(F.col(quoted(kind_col))), *[F.col(quoted(c)) for c in ties]]
    return split_rank(df, keys, order, name)


def latest_changes(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Newest change per key; what a batch of changes leaves to apply."""
    rest = [F.col(quoted(c)) for c in df.columns if c not in keys]
    newest = df.groupBy(*[F.col(quoted(k)) for k in keys]).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")
    )
    return newest.select(*[F.col(quoted(k)) for k in keys], "__r.*")


def table_id() -> Column:
    """``db.table`` an event belongs to."""
    return F.concat_ws(".", F.col("source.db"), F.col("source.table"))


def is_ddl(value: Column) -> Column:
    """Whether a JSON record is a schema change rather than a row change."""
    return F.get_json_object(value, "$.ddl").isNotNull() | F.get_json_object(value, "$.historyRecord").isNotNull()


def split_ddl(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Row changes and schema changes of one stream of JSON records."""
    text = F.col(quoted(value)).cast("string")
    present = df.filter(text.isNotNull())
    # Schema changes may keep their statement inside a history record.
    record = F.coalesce(F.get_json_object(text, "$.historyRecord"), text)
    statement = F.get_json_object(record, "$.ddl")
    ddl = present.filter(is_ddl(text)).select(
        F.coalesce(F.get_json_object(text, "$.source.db"), F.get_json_object(record, "$.databaseName")).alias("db"),
        F.get_json_object(text, "$.source.table").alias("table"),
        statement.alias("ddl"),
        F.lower(F.regexp_extract(F.trim(statement), r"^(\w+)", 1)).alias("statement"),
    )
    return present.filter(~is_ddl(text)), ddl.filter(F.col("statement").isin("alter", "create", "drop", "rename"))


def read_change_stream(
    spark: SparkSession, source: str | None = None, fmt: str = "text", **options: str
) -> DataFrame:
    """Stream of change records as a JSON text column ``value``.

    Text files by default; ``fmt="kafka"`` with its options where the connector
    is on the class path.
    """
    reader = spark.readStream.format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    stream = reader.load(source) if source else reader.load()
    return stream.select(F.col("value").cast("string").alias("value"))


__all__ = [
    "KINDS", "change_name", "decode_envelope", "envelope_schema", "explode_changes", "flatten_envelope",
    "is_ddl", "kind_rank", "latest_changes", "order_changes", "parse_events", "read_change_stream",
    "split_ddl", "table_id", "wire_schema",
]
